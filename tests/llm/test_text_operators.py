"""Tokenisation, license scan, language identification, language model and personal data against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import data
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from episodica.llm import bpe, html, langid, licenses, lm, pii
from episodica.llm.queries import BPE_VOCABULARY

PATTERN = public_tokenizers.PATTERN


# ---- byte-level BPE --------------------------------------------------------------------------------------------------


def encoder():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(BPE_VOCABULARY), special_tokens={})


@pytest.mark.parametrize("block_bytes", [1, 2000, 1 << 20])
def test_bpe_equals_the_library_and_decodes(spark, block_bytes):
    docs = data.documents(spark)
    enc = encoder()
    want = collections.Counter((r["doc_id"], tuple(enc.encode_ordinary(r["text"] or ""))) for r in docs.select("doc_id", "text").collect())
    rows = bpe.encode(docs, BPE_VOCABULARY, PATTERN, block_bytes, decoded=True).collect()
    assert collections.Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in rows) == want
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in rows)
    have = collections.Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in rows)
    assert have == collections.Counter((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())


def test_decode_alone_and_null_ids(spark):
    encoded = bpe.encode(data.documents(spark, n=5), BPE_VOCABULARY, PATTERN)
    again = bpe.decode(encoded.unionByName(spark.createDataFrame([(1, None, None)], encoded.schema)), BPE_VOCABULARY).collect()
    assert sum(r["decoded"] is None for r in again) == 1


def test_bpe_of_nothing(spark):
    assert bpe.encode(data.empty(spark), BPE_VOCABULARY, PATTERN, decoded=True).count() == 0


def test_splitting_agrees_on_every_class_of_character():
    import regex

    enc, find = encoder(), regex.compile(PATTERN).findall
    for cp in [*range(0x250), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600]:
        text = f"ab{chr(cp)}{chr(cp)} c{chr(cp)}1{chr(cp)}"
        assert [i for w in find(text) for i in enc._core_bpe.encode_single_piece(w.encode())] == enc.encode_ordinary(text)


# ---- licenses --------------------------------------------------------------------------------------------------------


def scan_by_hand(text):
    text = (text or "").translate(data.LOWER)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    words, places, base = split(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += hits
        base |= {label} if hits else set()
    more, best = set(), 0.0
    span = licenses.span_of(licenses.TEMPLATES)
    for start in range(0, max(len(words) - span, 1), span):
        have = set(words[start : start + 2 * span])
        for label, template, need in licenses.template_sets():
            if len(have & template) >= need:
                more.add(label)
                best = max(best, len(have & template) / len(template))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else best)


LICENSED = [
    "cc by cc by CC-BY x", "General public license general PUBLIC license", "All rights  reserved.", "Released under the MIT License.\nmore", "mit license the under released by us",
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "licensed under the gnu general public license version 3", "ccby cc", "ccé by cc by", "K cc byİ",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: " * 30,
]


def test_license_scan_equals_brute_force(spark):
    docs = data.documents(spark, n=20).select("doc_id", "text").union(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(LICENSED)], "doc_id long, text string"))
    want = collections.Counter((r["doc_id"], *scan_by_hand(r["text"])) for r in docs.collect())
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) for r in licenses.scan(docs).collect())
    assert got == want
    assert licenses.scan(data.empty(spark)).count() == 0


def test_license_join_at_other_thresholds(spark):
    rnd = random.Random(4)
    words = "a b c d e f g h".split()
    templates = [(f"t{k}", " ".join(rnd.sample(words, rnd.randrange(2, 6)))) for k in range(6)]
    docs = spark.createDataFrame([(k, "\n".join(" ".join(rnd.choices(words, k=rnd.randrange(0, 7))) for _ in range(3))) for k in range(60)], "doc_id long, text string")
    span = licenses.span_of(templates)
    for threshold in (0.5, 0.75, 1.0):
        got = {(r["doc_id"], r["block"], r["label"], round(r["score"], 9)) for r in licenses.matches(docs, templates, threshold).collect()}
        want = set()
        for r in docs.collect():
            own = r["text"].split()
            for b, start in enumerate(range(0, max(len(own) - span, 1), span)):
                for label, template, need in licenses.template_sets(templates, threshold):
                    shared = len(set(own[start : start + 2 * span]) & template)
                    if shared >= need:
                        want.add((r["doc_id"], b, label, round(shared / len(template), 9)))
        assert got == want


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a
copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:"""


@pytest.mark.parametrize("before", [0, 50, 77, 1000])
@pytest.mark.parametrize("width", [30, 76])
def test_wrapped_statements_are_found(spark, before, width):
    import textwrap

    prose = " ".join(random.Random(before).choices(["lorem", "ipsum", "dolor"], k=before))
    texts = [MIT_TEXT, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]
    docs = spark.createDataFrame([(k, "\n".join(textwrap.wrap(f"{prose} {t} {prose}", width))) for k, t in enumerate(texts)] + [(9, prose)], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()} == {0: "mit", 1: "bsd", 2: "isc", 9: ""}


# ---- language --------------------------------------------------------------------------------------------------------

GERMAN = "der die und das nicht ein mit von auf für ist sich auch eine werden über haben wird dass nach aus bei einer zum wie".split()


def labelled(spark, n=400):
    rnd = random.Random(2)
    rows = [(k, " ".join(rnd.choices(data.WORDS if k % 2 else GERMAN, k=rnd.randrange(3, 60))), "en" if k % 2 else "de") for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_undetermined(spark):
    docs = labelled(spark)
    model = langid.fit(docs)
    odd = spark.createDataFrame([(-1, None, None), (-2, "", None), (-3, "123 !!", None), (-4, "!" * 500 + " the", None), (-5, "the of and " * 30_000, None)], docs.schema)
    rows = {r["doc_id"]: r for r in langid.identify(docs.union(odd).withColumn("rejected", F.lit("clash")), model).collect()}
    held = [r for r in rows.values() if r["doc_id"] >= 0 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 50 and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    for k in (-1, -2, -3):
        assert (rows[k]["lang_pred"], rows[k]["score"], rows[k]["rejected"]) == ("und", 0.0, True)
    assert rows[-4]["lang_pred"] != "und" and rows[-4]["rejected"]
    assert rows[-5]["lang_pred"] == "en" and 0 <= rows[-5]["score"] <= 1
    assert sum(r["rejected"] for r in held) <= 2


def test_predictions_use_the_text_alone(spark):
    docs = labelled(spark, 100)
    model = langid.fit(docs)
    changed = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a, b = ([(r["text"], r["lang_pred"], r["score"]) for r in langid.identify(d, model).orderBy("doc_id").collect()] for d in (docs, changed))
    assert a == b


def test_without_labels_everything_is_undetermined(spark):
    docs = labelled(spark, 20).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(docs)).collect()} == {"und"}
    assert langid.identify(data.empty(spark), langid.fit(data.empty(spark))).count() == 0


def test_subwords_cover_whole_texts(monkeypatch):
    text = data.prose(random.Random(1), 300)
    whole = np.sort(np.concatenate(list(langid.subwords(text))))
    monkeypatch.setattr(langid, "CHUNK", 37)
    assert (np.sort(np.concatenate(list(langid.subwords(text)))) == whole).all()


# ---- language model --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_counts_and_base_scores(spark, block_bytes):
    docs = data.documents(spark)
    rows = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(data.LOWER))) for r in docs.collect()]
    counts = collections.Counter()
    for k, words in rows:
        if not lm.held_out(k):
            counts.update([*words, 0])
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for k, words in rows:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words, 0])
        want[(k, lm.held_out(k), len(words) + 1, sum(counts[w] > 0 for w in [*words, 0]), n, round(base, 4))] += 1
    got = lm.score(docs, rounds=1, block_bytes=block_bytes).collect()
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores_are_normalised():
    counts = [("other", 5), ("end", 7), *((f"w{k}".encode(), 100 // (k + 1)) for k in range(150))]
    model = lm.Model(counts)
    rng = np.random.default_rng(1)
    one, two, target = (rng.integers(0, model.size, 3000) for _ in range(3))
    model.train(one, two, target, rng, {})
    for context in ((model.start, model.start), (3, 5)):
        every = np.arange(model.size)
        total = (10 ** model.log10_probs(np.full(model.size, context[0]), np.full(model.size, context[1]), every)).sum()
        assert total == pytest.approx(1, abs=1e-5)


def test_training_beats_unigrams_on_regular_text(spark):
    docs = spark.createDataFrame([(k, "alpha beta gamma delta " * 200) for k in range(60)], "doc_id long, text string")
    got = lm.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.8 * got[1]


def test_model_without_training_texts(spark):
    assert lm.score(data.empty(spark)).count() == 0
    out = next(k for k in range(100) if lm.held_out(k))
    row = lm.score(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"], row["base_score"]) == (0, 0, 3, 0.0)


# ---- personal data ---------------------------------------------------------------------------------------------------


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 14 <= len(d) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 10 <= len(d) <= 15),
)


def spans_by_hand(text):
    found = []
    for k, (name, pattern, valid) in enumerate(BASE):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if valid(m[0], re.sub("[^0-9]", "", m[0])):
                found.append((m.start(), k, m.end(), name))
    return sorted(found)


def test_personal_data_equals_brute_force(spark):
    rnd = random.Random(3)
    odd = ["a@b.c_d@e.f.g", "+" * 3000 + "1" * 3000, "4111 1111 1111 1111 and 4111-1111-1111-1111x +49 (30) 1234-5678 ", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.4", "é😀a@b.co 😀 1.1.1.1", "a.b@" * 2000 + "c.d"]
    made = ["".join(rnd.choice("ab1.@+- 94é_(%)\n5") for _ in range(rnd.randrange(1, 80))) for _ in range(800)]
    docs = spark.createDataFrame([(1000 + k, t) for k, t in enumerate([*odd, *made])], "doc_id long, text string").union(data.documents(spark, n=5).select("doc_id", "text"))
    want = collections.Counter()
    for r in docs.collect():
        spans = spans_by_hand(r["text"])
        joined = ",".join(f"{name}:{a}:{b}" for a, _, b, name in spans)
        want[(r["doc_id"], *(sum(s[3] == k for s in spans) for k in pii.BASE), hashlib.sha256(joined.encode()).hexdigest())] += 1
    got = collections.Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.digest(pii.find(docs)).collect())
    assert got == want and sum(sum(k[1:5]) for k in want) > 300
    assert pii.digest(pii.find(data.empty(spark))).count() == 0


def test_ibans_and_context(spark):
    rows = [(1, "pay DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 now"), (2, "DE88370400440532013000"), (3, "my bank account: DE89370400440532013000"), (4, "call phone +49 30 123456789")]
    got = {r["doc_id"]: r for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [s.split(":")[0] for s in got[1]["spans"].split(",")].count("iban") == 2
    assert got[2]["spans"] == ""
    assert got[3]["score"] > got[1]["score"] and got[3]["spans"] == "iban:17:39"
    assert got[4]["score"] > 0.6


# ---- html ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("a &lt; b <c", "a < b"),
        ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
        ("<ul><li>one<li>two<ol start=3><li>a<li>b</ol><li>three</ul>", "- one\n- two\n  3. a\n  4. b\n- three"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>", "Name      | Qty\napple pie | 3"),
        ("<table><tr><td>a<td><p>x<p>y<tr><td colspan=2>b<td>c</table>", "a | x |\n  |   |\n  | y |\nb |   | c"),
        ("<head><title>t</title><style>p{}</style></head><body>x<script>if (a < b) '</p>'</script>y", "xy"),
        ("a<div hidden>no<p>no</div>b<span style='Display : none'>no</span>c<input type=hidden value=no>", "ab c".replace(" ", "")),
        ("<pre>a\n  b </pre>c", "a\n  b\n\nc"),
        ("<blockquote>q<p>r</blockquote>", "> q\n>\n> r"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("<!-- x --><!DOCTYPE html>a<!-- open", "a"),
        ("<p>a</b></i>b</p></p>c", "ab\n\nc"),
        ("<td>stray", "stray"),
        ("<h1>T</h1>x<hr>y<img alt=pic src=z>", "T\n\nx\n\n---\n\ny pic"),
        ("x < y > z <3", "x < y > z <3"),
        ("<textarea>a<b>c</textarea>", "a<b>c"),
        ("<a title='>'>k</a>", "k"),
    ],
)
def test_rendering(source, text):
    assert html.render(source) == text


def test_rendering_is_linear_and_keeps_all_words():
    deep = "<div>" * 20_000 + "core" + "</div>" * 20_000
    assert html.render(deep) == "core"
    assert html.render("<a" * 50_000) == "" and html.render("<b>x" * 20_000) == "x" * 20_000
    rnd = random.Random(6)
    tags = ["p", "div", "b", "li", "ul", "ol", "table", "tr", "td", "span", "h2", "blockquote", "pre", "dd", "dl"]
    for _ in range(300):
        words, parts = [], []
        for k in range(rnd.randrange(1, 40)):
            parts.append(rnd.choice([f"<{rnd.choice(tags)}>", f"</{rnd.choice(tags)}>", f" w{k} "]))
            if parts[-1][1] == "w":
                words.append(parts[-1].strip())
        assert sorted(re.findall(r"w\d+", html.render("".join(parts)))) == sorted(words)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (None, None, None), (1, "u", "<p>a")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html.extract(pages).collect()
    assert collections.Counter((r["page_id"], r["text"], r["n_lines"], r["n_chars"]) for r in rows) == {(1, "a", 1, 1): 2, (None, "", 0, 0): 1}
    assert html.extract(pages.limit(0)).count() == 0
