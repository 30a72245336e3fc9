"""Slow, independent versions of what SQL can't express: visible words of pages, and scores of the language model."""

import math
import re
from html.parser import HTMLParser

import numpy as np
import pytest
from compare import DATA

from episodica.llm import blocks as bl
from episodica.llm import html, lm


class Words(HTMLParser):
    """Words that are shown, in order, by an event parser of the standard library: no layout, and hidden parts by a count of depth."""

    UNSEEN = "head script style template noscript title iframe noembed noframes datalist object audio video canvas".split()
    VOID = "area base br col embed hr img input link meta param source track wbr".split()

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(reversed(attrs))
        unseen = tag in self.UNSEEN or "hidden" in attrs or re.search(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", attrs.get("style") or "", re.I)
        if tag in self.VOID:
            if tag == "img" and not self.hidden and not unseen:
                self.words += (attrs.get("alt") or "").split()
            elif tag == "input" and not self.hidden and not unseen and (attrs.get("type") or "text") in ("text", "submit", "button", "reset"):
                self.words += (attrs.get("value") or "").split()
        elif self.hidden or unseen:
            self.hidden.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def letters(words):
    """All visible characters but those of markers and rules, as white space between inline elements differs."""
    return re.sub(r"[\s|>.0-9-]+", "", "".join(words))


@pytest.mark.skipif(not DATA.exists(), reason="test tables are missing")
def test_pages_show_the_words_that_an_event_parser_sees(spark):
    for row in html.extract(spark.read.parquet(str(DATA / "pages.parquet"))).join(spark.read.parquet(str(DATA / "pages.parquet")).select("page_id", "html"), "page_id").collect():
        slow = Words()
        slow.feed((row["html"] or "").replace("\0", ""))
        slow.close()
        assert letters(row["text"]) == letters(slow.words), row["page_id"]


def naive(model, words, counts, distinct, tokens):
    """log10 probability of a text, token by token, from the model's tables by full softmaxes."""
    known = set(model.index)
    total, context = 0.0, [model.start, model.start]
    others, other_total = distinct - len(known), tokens - sum(counts[w] for w in known)
    for word in [*words, None]:
        out = model.end if word is None else model.index.get(word, model.other)
        q = (model.p1[context[1]] + model.p2[context[0]]).astype(float)
        kind = out // lm.CLASS
        first = model.a.astype(float) @ q + model.a0
        span = slice(kind * lm.CLASS, (kind + 1) * lm.CLASS)
        second = model.b[span].astype(float) @ q + model.b0[span]
        p = np.exp(first[kind]) / np.exp(first).sum() * np.exp(second[out % lm.CLASS]) / np.exp(second).sum()
        total += math.log10(p)
        if word is not None and out == model.other:
            total += math.log10((counts.get(word, 0) + lm.SMOOTH) / (other_total + lm.SMOOTH * (others + 1)))
        context = [context[1], out]
    return total


def test_scores_equal_a_token_by_token_model(spark, monkeypatch):
    import random
    from collections import Counter

    monkeypatch.setattr(lm, "MODEL_WORDS", 200)
    rnd = random.Random(3)
    rows = [(k, " ".join(f"w{min(int(rnd.expovariate(0.02)), 400)}" for _ in range(rnd.randrange(0, 60)))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs).collect()}
    counts = Counter(w for k, t in rows if not lm.held_out(k) for w in lm.words_of(t))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:200]
    texts, tokens = sum(not lm.held_out(k) for k, _ in rows), sum(counts.values())
    model = lm.fit(bl.pack(lm.shards(docs), bl.SpaceBuilder), top, texts, tokens)
    for k, text in rows:
        assert got[k] == pytest.approx(naive(model, lm.words_of(text), counts, len(counts), tokens), abs=1e-3), k
