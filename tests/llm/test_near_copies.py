"""Near copies against brute force where fingerprints say little."""

import random
from collections import Counter

import numpy as np
import pytest

from episodica.llm import components, simhash, similar
from episodica.llm.stages import NEAR_DUPLICATES


def classes(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, **NEAR_DUPLICATES).collect()}
    return [got[k] for k in range(len(texts))]


def jaccard(x, y):
    a, b = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (x, y))
    return len(a & b) / len(a | b)


def bits(x, y, mix=lambda h: h):
    a, b = (simhash.majority_bits(mix(simhash.shingle_hashes(t, 5))) for t in (x, y))
    return (a ^ b).bit_count()


def test_equal_fingerprints_of_unlike_texts(spark):
    """A line that is repeated often decides every bit."""
    rnd = random.Random(4)
    line = " ".join(f"line{k}" for k in range(11))
    texts = [" ".join([line] * 200 + [f"{name}{rnd.randrange(10**6)}" for _ in range(150)]) for name in "abc"]
    assert bits(texts[0], texts[1]) == 0 and bits(texts[0], texts[1], simhash.remix) == 0 and jaccard(*texts[:2]) < 0.1
    assert classes(spark, [*texts, texts[1] + " tail"]) == [0, 1, 2, 1]


def test_near_copies_whose_fingerprints_are_far_apart(spark):
    """Neither fingerprint may veto a pair that is similar enough."""
    rnd = random.Random(6)
    texts = []
    while len(texts) < 12:
        words = [f"v{rnd.randrange(10**6)}" for _ in range(60)]
        x, y = " ".join(words), " ".join(words[: -rnd.randrange(3, 12)])
        if jaccard(x, y) >= 0.8 and max(bits(x, y), bits(x, y, simhash.remix)) > 14:
            texts += [x, y]
    assert classes(spark, texts) == [k // 2 * 2 for k in range(12)]


def test_a_similar_pair_between_two_nearer_ones(spark):
    """C is nearer to A and B in bits than they are to each other, but only A and B are similar enough."""
    rnd = random.Random(7)
    fp = lambda t: simhash.majority_bits(simhash.shingle_hashes(t, 5))
    distance = lambda x, y: bits(x, y) + bits(x, y, simhash.remix)
    while True:
        words = [f"v{rnd.randrange(10**6)}" for _ in range(60)]
        a, b = (" ".join(words[: len(words) - cut]) for cut in (0, rnd.randrange(8, 12)))
        near = [" ".join([f"z{rnd.randrange(10**6)}" for _ in range(k)] + words[: 60 - cut]) for k in (9, 10, 11) for cut in (3, 4, 5, 6)]
        found = [c for c in near if jaccard(a, c) < 0.8 and jaccard(b, c) < 0.8 and max(distance(a, c), distance(b, c)) < distance(a, b)]
        found = [c for c in found if max(bits(x, y, m) for x, y in ((a, b), (a, c), (b, c)) for m in (lambda h: h, simhash.remix)) <= 14]
        # of one trie node in every rotation, so that the three meet wherever two of them do
        found = [c for c in found if not any((fp(a) ^ fp(o)) & 0xF000F000F000F000 for o in (b, c))]
        if jaccard(a, b) >= 0.8 and found:
            break
    assert classes(spark, [a, b, found[0]]) == [0, 0, 2]


def brute(rows, width=5, least=0.8):
    """component and kept of each (doc_id, text) by comparing all pairs."""
    sets = [set(simhash.shingle_hashes(t or "", width).tolist()) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] == sets[j] or shared >= least * (len(sets[i]) + len(sets[j]) - shared):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = lambda k: [rows[m][0] for m in range(len(rows)) if label[m] == label[k] and rows[m][0] is not None]
    return [min(ids(k), default=None) for k in range(len(rows))], len(set(label))


@pytest.mark.parametrize("sizes", [{}, {"part_items": 300, "fan": 3, "merge": 50}])
def test_components_equal_brute_force(spark, monkeypatch, sizes):
    """Passages that many share, chains of edits, short texts, nulls, repeated ids; also at other sizes of the exchange and of blocks."""
    if sizes:
        monkeypatch.setattr(similar, "BROADCAST_TEXTS", 0)
        monkeypatch.setattr(similar, "COMMON_SHARE", 0.05)
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(400)}"
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (None, "one two")]
    for k in range(40):
        words = [word() for _ in range(rnd.randrange(1, 60))]
        rows.append((10 + k, " ".join(words) + (f" {passage}" if k % 3 == 0 else "")))
        for _ in range(rnd.randrange(3)):  # a chain of edits
            words = list(words)
            words[rnd.randrange(len(words))] = word()
            rows.append((rnd.choice([None, 200 + len(rows), 10 + k]), " ".join(words) + (f" {passage}" if k % 3 == 0 else "")))
    want, groups = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = similar.near_copies(docs, 5, 0.8, **sizes).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((i, c) for (i, _), c in zip(rows, want, strict=True))
    assert sum(r["kept"] for r in got) == groups < len(rows)
    assert similar.near_copies(docs.limit(0), 5, 0.8).count() == 0


def test_stage_drops_rows_not_ids(spark, tmp_path):
    """A row that repeats a near copy's id with another text stays; of a group one row stays, whatever its ids."""
    from episodica.llm import stages

    text = " ".join(f"a{k}" for k in range(60))
    rows = [(2, text), (5, text + " tail"), (5, "something else altogether is told here"), (None, text + " end"), (7, None), (8, ""), (None, "no id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = stages.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(2, text), (5, rows[2][1]), (7, None), (None, "no id")], key=str)


def test_a_group_of_near_copies_forms_few_pairs(spark, monkeypatch):
    """Edits of one text, a quarter of whose pairs are similar enough: rounds of comparing with one text connect them, so pairs between
    classes, which would grow with the square of the group, are few."""
    rnd = random.Random(11)
    base = [f"b{k}" for k in range(146)]
    texts = []
    for _ in range(300):
        words = list(base)
        for _ in range(rnd.randrange(2, 6)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(50)}"
        texts.append(" ".join(words))
    seen, old = [], similar.verified
    monkeypatch.setattr(similar, "verified", lambda pairs, *more: (seen.append(pairs.count()), old(pairs, *more))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in similar.near_copies(docs, 5, 0.8).collect()}
    assert [got[k] for k in range(300)] == brute(list(enumerate(texts)))[0]
    assert seen[-1] < 300 * 299 / 2 / 6 and sum(seen) < 20_000


def test_a_group_whose_texts_are_mostly_alone(spark, monkeypatch):
    """Edits of one text, more than half of which are similar to no other: after the first round, which is linear, fewer pairs than texts
    are compared (115,654 before pairs were held against marks), no link is contracted again and again, and none is lost."""
    rnd, texts = random.Random(11), []
    for _ in range(600):
        words = [f"b{k}" for k in range(146)]
        for _ in range(rnd.choice([1, 3, 5, 7, 8])):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(2)}"
        texts.append(" ".join(words))
    compared, contracted, verified, roots = [], [], similar.verified, components.roots
    monkeypatch.setattr(similar, "verified", lambda pairs, *more: (compared.append(pairs.count()), verified(pairs, *more))[1])
    monkeypatch.setattr(components, "roots", lambda edges: (contracted.append(edges.count()), roots(edges))[1])
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in similar.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 5, 0.8).collect()}
    want, groups = brute(rows)
    assert [got[k] for k in range(600)] == want and groups > 300
    assert sum(compared[1:]) < 600 and sum(contracted) < 3 * 600


def test_marks_differ_in_no_more_bits_than_sets(spark):
    rnd, rows = np.random.default_rng(3), []
    for n in (0, 1, 146, 1000, 1024, 1025, 2040, 3000, 9000):
        x = rnd.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        for less, more in ((0, 0), (n // 20, n // 20), (n // 4, n // 4), (0, n // 5), (n // 2, 0), (n, 10), (0, 3 * n)):
            y = np.concatenate((x[less:], rnd.integers(0, 1 << 64, more, np.uint64, endpoint=False)))
            rows.append((n, len(np.setxor1d(x, y)), similar.mark_of(np.unique(x)).tolist(), similar.mark_of(np.unique(y)).tolist(), max(n, len(y)) < 1.3 * min(n, len(y))))
    marks = spark.createDataFrame(rows, "n int, differ int, x array<bigint>, y array<bigint>, alike boolean")
    for r in marks.select("n", "differ", "alike", similar.apart("x", "y").alias("bits"), similar.apart("y", "x").alias("back")).collect():
        assert r["bits"] == r["back"] <= r["differ"]
        if r["n"] >= 146 and r["alike"] and r["differ"] >= 0.5 * r["n"]:  # 0.22 n may differ in texts that are similar
            assert r["bits"] > 0.23 * r["n"]


def test_links_that_are_added_to_roots(spark):
    rnd = random.Random(5)
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    parts = [[(rnd.randrange(90), rnd.randrange(90)) for _ in range(n)] for n in (30, 20, 0, 15)]
    place = components.roots(frame(parts[0]))
    for k in (1, 2, 3):
        place = components.extended(place, frame(parts[k]))
        label = lambda rows: {frozenset(r["node"] for r in rows if r["root"] == root) for root in {r["root"] for r in rows}}
        got, want = place.collect(), components.roots(frame(sum(parts[: k + 1], []))).collect()
        own = {r["node"] for r in want}
        assert {c for c in label([r for r in got if r["node"] in own])} == label(want) and len(got) == len({r["node"] for r in got})
