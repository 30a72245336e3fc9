"""Rejection of what no language was learned for, at almost no cost in clean texts."""

import random
from functools import cache

import pytest

from episodica.llm import langid

SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or".split(), "fr": "ou es de re en le on te eu ai ie ne ré que é".split(), "de": "ei ch un sch er ie ge ber ver hei keit ung ß ä st".split()}


def text(rnd, lang, n):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randrange(1, 4))) for _ in range(n))


@cache
def model():
    rnd = random.Random(5)
    return langid.train([(text(rnd, lang, rnd.randrange(2, 200)), lang) for _ in range(600) for lang in SYLLABLES])


def share(texts):
    got = [model().predict(t)[2] for t in texts]
    return sum(got) / len(got)


def test_clean_texts_stay():
    rnd = random.Random(6)
    assert share([text(rnd, lang, rnd.randrange(2, 300)) for _ in range(300) for lang in SYLLABLES]) <= 0.005


def test_gibberish_goes():
    rnd = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    assert share([" ".join("".join(rnd.choices(letters, k=rnd.randrange(2, 9))) for _ in range(60)) for _ in range(200)]) > 0.95


def test_halves_in_two_languages_go():
    rnd = random.Random(8)
    assert share([" ".join(text(rnd, lang, 80) for lang in rnd.sample(sorted(SYLLABLES), 2)) for _ in range(200)]) > 0.9


@pytest.mark.parametrize("odd", [None, "", "123 !!", "\U0001f600"])
def test_texts_without_letters(odd):
    assert model().predict(odd or "") == (langid.UNDETERMINED, 0.0, True)


def test_rejected_texts_keep_a_prediction(spark):
    docs = spark.createDataFrame([(1, "zqx jvk wqz " * 30), (2, "th er on and re " * 30)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(docs, model()).collect()}
    assert got[1]["rejected"] and not got[2]["rejected"] and got[1]["lang_pred"] in SYLLABLES
