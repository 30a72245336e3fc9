"""Top-k, deduplication, mixing and the pipeline against brute force."""

import collections
import hashlib
import random
import re

import data
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from episodica.llm import components, exact, mixing, simhash, vectors


# ---- top-k -----------------------------------------------------------------------------------------------------------


def best_by_hand(rows, queries, k, scale=1024):
    usable = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in {i: v for i, v in usable if i in queries}.items():
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=6), 1).astype(np.float32)]) for i in range(400)]
    rows += [(400 + k, rows[7][1]) for k in range(30)] + [(500, None), (501, [1.0, None]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, []), (505, [0.5]), (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("lane", F.lit("clash")).repartition(5)
    for shard, group in ((8192, 512), (50, 3)):
        got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vectors.top_k(table, table.filter("vec_id % 10 = 0"), 10, shard_rows=shard, group_queries=group).collect()}
        assert got == best_by_hand(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 10)


def test_fewer_candidates_than_k_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in vectors.top_k(table, table.filter("vec_id = 0")).collect()] == [(0, 1)]
    assert vectors.top_k(table.limit(0), table).count() == 0 and vectors.top_k(table, table.limit(0)).count() == 0


def test_large_components_are_exact(spark):
    rows = [(k, [float(2**30 + k), float(2**30 - k)]) for k in range(6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vectors.top_k(table, table, 3, scale=1).collect()}
    assert got == best_by_hand(rows, set(range(6)), 3, 1)


def test_blocks_are_pruned():
    rng = np.random.default_rng(2)
    x = np.floor(np.repeat(rng.normal(size=(40, 8)), 64, axis=0) * 1024 + rng.normal(size=(2560, 8)))
    *_, scored = vectors.search_shard(np.array([-1]), x[:1], np.arange(len(x)), x, 10)
    assert scored < len(x) / 3
    mixed = rng.permutation(len(x))  # neighbours are found, whatever the order of ids
    row, found, score, scored = vectors.search_shard(np.array([-1]), x[:1], mixed, x[mixed], 10)
    assert scored < len(x) / 3
    want = sorted(zip((-(x @ x[0])).tolist(), range(len(x)), strict=True))[:10]
    assert sorted(zip((-score).tolist(), found.tolist(), strict=True)) == want
    # a floor from a few rows keeps a shard without near rows from being scored at all
    far = np.floor(rng.normal(size=(640, 8)) * 10)
    *_, scored = vectors.search_shard(np.array([-1]), x[:1], np.arange(640), far, 10, floor=np.array([-want[-1][0]], np.int64))
    assert scored == 0


# ---- exact duplicates ------------------------------------------------------------------------------------------------


def exact_by_hand(rows):
    groups = collections.defaultdict(list)
    for k, t in rows:
        groups[(t or "").translate(data.LOWER)].append(k)
    out = collections.Counter()
    for k, t in rows:
        own = (t or "").translate(data.LOWER)
        keep = max((i for i in groups[own] if i is not None), default=None)
        out[(k, keep, len(groups[own]), k == keep, hashlib.sha256(own.encode()).hexdigest())] += 1
    return out


def short_digest(text):
    """Four bits, so that different texts meet in one digest."""
    return F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(exact.ascii_lower(text), 256), 1, 1)))


@pytest.mark.parametrize(("digest", "files"), [(exact.digest_of, 1000), (exact.digest_of, 1), (short_digest, 1000)])
def test_exact_deduplication_equals_brute_force(spark, digest, files):
    docs = data.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = exact.deduplicate(docs, digest, files).collect()
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in found) == exact_by_hand(rows)


def test_exact_deduplication_of_nothing(spark):
    assert exact.deduplicate(data.empty(spark)).count() == 0


def test_state_survives_a_restart(spark, tmp_path):
    source, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "ck"))

    def add(rows):
        spark.createDataFrame(rows, "doc_id long, text string").select(exact.digest_of(F.col("text")).alias("digest"), "doc_id", F.lit("f").alias("locator")).write.mode("append").parquet(source)
        stream = spark.readStream.schema("digest binary, doc_id long, locator string").parquet(source)
        exact.start(stream, state, checkpoint).awaitTermination()
        return {(r["keep_id"], r["group_size"]) for r in exact.latest(spark.read.schema(exact.STATE).option("recursiveFileLookup", "true").parquet(state)).collect()}

    assert add([(1, "a"), (2, "b")]) == {(1, 1), (2, 1)}
    assert add([(5, "A"), (3, "c")]) == {(5, 2), (2, 1), (3, 1)}


# ---- near duplicates -------------------------------------------------------------------------------------------------


def fingerprint_by_hand(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(data.LOWER))
    runs = [" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_hand(rows, max_bits):
    """rows: (doc_id, fp). Each row's smallest reachable id."""
    fps = np.array([f for _, f in rows], np.uint64)
    label = np.arange(len(rows))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
    while True:
        new = np.where(near, label[None, :], len(rows)).min(axis=1)
        if (new == label).all():
            break
        label = new
    least = {}
    for c, (k, _) in zip(label, rows):
        if k is not None:
            least[c] = min(least.get(c, k), k)
    return [least.get(c) for c in label]


def test_simhash_of_texts_equals_brute_force(spark):
    docs = data.documents(spark)
    rows = [(r["doc_id"], fingerprint_by_hand(r["text"], 3)) for r in docs.select("doc_id", "text").collect()]
    want = collections.Counter(zip((k for k, _ in rows), (format(f, "016x") for _, f in rows), classes_by_hand(rows, 2)))
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex16("fp").alias("f"), "component_id").collect()
    assert collections.Counter((r["doc_id"], r["f"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(data.empty(spark)).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered(seed, n):
    """Fingerprints of which many share long prefixes, at all small distances."""
    rnd = random.Random(seed)
    found = set()
    for _ in range(n // 20):
        centre = rnd.getrandbits(64)
        for _ in range(20):
            x = centre
            for b in rnd.sample(range(64), rnd.randrange(0, 9)):
                x ^= 1 << b
            found.add(x)
    return sorted(found)


@pytest.mark.parametrize(("max_bits", "rotations", "depth", "node_items"), [(2, 3, None, 1024), (2, 3, 6, 4), (0, 3, None, 2), (7, 4, 8, 4), (10, 4, 4, 1024)])
def test_trie_join_finds_every_link(spark, max_bits, rotations, depth, node_items):
    fps = clustered(max_bits, 400)
    items = spark.createDataFrame([(signed(f), 0) for f in fps], "fp long, fp2 long").repartition(3)
    links = simhash.links(items, max_bits, rotations, depth=depth, node_items=node_items)
    root = {r["node"]: r["root"] for r in components.roots(links).collect()}
    want = classes_by_hand(list(enumerate(fps)), max_bits)
    got = collections.defaultdict(set)
    for f, c in zip(fps, want):
        got[c].add(root.get(signed(f), signed(f)))
    assert all(len(v) == 1 for v in got.values())
    assert len({next(iter(v)) for v in got.values()}) == len(got)


def test_near_copies_at_five_words(spark):
    from episodica.llm.stages import NEAR_DUPLICATES

    rnd = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows = []
    for k in range(60):
        words = rnd.choices(vocabulary, k=250)
        for v in range(4 if k % 3 else 1):
            own = list(words)
            for i in rnd.sample(range(250), 3 * v):  # up to 45 of 246 shingles differ, so both sides of 0.8 occur
                own[i] = f"changed{k}{v}"
            rows.append((len(rows), " ".join(own)))
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t in rows]
    similar = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if similar[i][j]) for i in range(len(rows))]
    docs = spark.createDataFrame([*rows, rows[0], (None, rows[1][1])], "doc_id long, text string")
    found = simhash.near_duplicates(docs, **NEAR_DUPLICATES).collect()
    assert len(found) == len(rows) + 2
    got = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert [got[k] for k in range(len(rows))] == label
    assert 80 < len(set(label)) < 180


def test_spanning_forests():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40):
        i, j, w = rng.integers(0, n, 3 * n), rng.integers(0, n, 3 * n), rng.integers(0, 6, 3 * n)
        own = simhash._forest(i, j, w, n)
        assert len(own) == len(set(own.tolist()))
        for most in range(7):  # at every weight the forest connects what the links connect
            a, b = (simhash._merge(np.arange(n), i[m], j[m]) for m in (np.flatnonzero(w <= most), own[w[own] <= most]))
            assert (a == b).all()


def test_components(spark):
    rnd = random.Random(8)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 150)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    root = {r["node"]: r["root"] for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    for a in root:
        for b in root:
            assert (root[a] == root[b]) == (label[a] == label[b])
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- mixing ----------------------------------------------------------------------------------------------------------


def mixture(spark, n=900):
    rnd = random.Random(5)
    rows = [(k, data.prose(rnd, rnd.randrange(1, 40)), rnd.choice(["en", "de", None]), "hot" if k % 3 == 0 else f"s{rnd.randrange(6)}") for k in range(n)]
    return spark.createDataFrame([*rows, (n, None, "en", None), (n + 1, "", "en", "s1"), rows[0]], "doc_id long, text string, lang string, source string")


def test_raked_weights_have_the_target_marginals(spark):
    got = mixing.mix(mixing.measure(mixture(spark)).withColumn("weight", F.lit("clash")), rounds=30).persist()
    total = got.agg(F.sum("tokens")).first()[0]
    for dim, power in mixing.TEMPER.items():
        rows = got.groupBy(dim).agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w")).collect()
        norm = sum(r["t"] ** power for r in rows)
        for r in rows:
            assert r["w"] == pytest.approx(r["t"] ** power / norm * total, rel=1e-3)
    expected = got.agg(F.sum(F.col("probability") * F.col("tokens"))).first()[0]
    assert expected == pytest.approx(mixing.KEEP * total, rel=1e-9)
    assert got.filter("probability > 1 or probability < 0 or (tokens = 0 and sampled)").count() == 0
    drawn = got.filter("sampled").agg(F.sum("tokens")).first()[0]
    assert drawn == pytest.approx(mixing.KEEP * total, rel=0.1)


def test_mixing_keeps_rows_and_columns(spark):
    docs = mixture(spark, 30).withColumn("__extra", F.lit(1))
    got = mixing.mix(mixing.measure(docs))
    assert got.count() == docs.count() and "__extra" in got.columns
    assert mixing.mix(mixing.measure(docs.limit(0))).count() == 0
    once = got.groupBy("doc_id").agg(F.countDistinct("sampled").alias("n")).filter("n > 1").count()
    assert once == 0


# ---- the pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(12)
    words = [f"{a}{b}" for a in data.WORDS for b in ("", "ly", "er")]
    german = "der die und das nicht ein mit von auf für ist sich auch eine werden über haben wird dass nach aus bei einer zum wie".split()
    rows = [(k, " ".join(rnd.choices(words if k % 3 else german + [w + "en" for w in german], k=120)), "de" if k % 3 == 0 else "en", f"s{k % 3}", 0) for k in range(240)]
    shout = str.maketrans(data.UPPER.lower(), data.UPPER)
    copies = [(1000 + k, rows[k][1].translate(shout), rows[k][2], "s1", 0) for k in range(10)]
    near = [(2000 + k, rows[k][1] + " tail", rows[k][2], "s1", 0) for k in range(20, 30)]
    junk = [(3000, "!!! ### 123", None, "s0", 0), (3001, None, None, None, None), (3002, "", "en", "s0", 0)]
    folder = tmp_path / "sf"
    docs = spark.createDataFrame([*rows, *copies, *near, *junk, rows[50]], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(folder / "documents.parquet"))
    kept = spark.read.parquet(str(folder / "documents.parquet"))
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, kept, str(folder)).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        ids[name] = [r["doc_id"] for r in kept.collect()]
    assert not {3000, 3001, 3002} & set(ids["language"]) and len(ids["language"]) >= 255
    assert set(ids["exact_dedup"]) == set(ids["language"]) - set(range(10)) and len(ids["exact_dedup"]) == len(set(ids["exact_dedup"]))
    assert set(ids["simhash_dedup"]) == set(ids["exact_dedup"]) - set(range(2020, 2030))
    assert 0 < len(ids["mixing"]) < len(ids["simhash_dedup"])
    out = corpus_pipeline.run(spark, str(folder)).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(ids["mixing"])
    assert all(r["decoded_sha256"] for r in out)


def test_registered_queries():
    from episodica.llm import queries

    assert len(queries.QUERIES) == 11 and set(queries.ORACLES) <= set(queries.QUERIES)
