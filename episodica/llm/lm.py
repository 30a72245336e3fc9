"""Log-bilinear language model: corpus counts, noise-contrastive training in numpy, normalised scores.

Tokens are the words between ASCII white space, A-Z lower-cased, then one end per text. The counts of all words are a distributed
table. The ``MODEL_WORDS`` most frequent training words, the end and "any other word" are the model's outcomes; they are ranked by
count and cut into classes of CLASS neighbours. With q = P1[previous word] + P2[word before it]:

    p(outcome | context) = softmax over classes (q . A + a)  x  softmax within the class (q . B + b)

Both softmaxes are computed in full by batched matrix products, so scores are normalised. An "other" word costs its own smoothed
count among the other words besides. Parameters are learned by noise-contrastive estimation with unigram noise, shared by the
positions of a batch: every block trains from common parameters, the results are averaged (weighted by tokens), and that is
repeated ROUNDS times. Every position of every training text is learned from in one of the rounds, so what is learned from grows
with the corpus. Blocks are shards by the hash of the document, so scores don't depend on how the input is partitioned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm import blocks as bl
from episodica.llm.common import discard, lean, materialize, text_or_empty

MODEL_WORDS = 4094
CLASS = 64
DIM = 24
NOISE = 16
ROUNDS = 2
BATCH = 2048
RATE = 0.15
SMOOTH = 0.1
#: Bytes of text that are dealt to one shard, about; they make one block, and so one unit of learning.
SHARD_BYTES = 20 << 20
#: Parameter blobs are averaged in so many slices, and this many at a time.
SLICES = FAN_IN = 64


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def held_out(doc_id: int | None, folds: int = 10) -> bool:
    """Whether crc32 of the doc_id as text leaves remainder 0; a null id counts as the empty text and is held out."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


# ---- the model -------------------------------------------------------------------------------------------------------


class Model:
    """outcomes: their counts in training, by rank; index: word to outcome; other, end: their outcomes."""

    SHAPES = ("p1", "p2", "a", "a0", "b", "b0")

    def __init__(self, counts: list[tuple[bytes | str, int]]):
        ranked = sorted(counts, key=lambda x: (-x[1], isinstance(x[0], bytes), x[0]))
        self.index = {w: i for i, (w, _) in enumerate(ranked) if isinstance(w, bytes)}
        self.other = next(i for i, (w, _) in enumerate(ranked) if w == "other")
        self.end = next(i for i, (w, _) in enumerate(ranked) if w == "end")
        n = len(ranked)
        self.size = -(-n // CLASS) * CLASS
        self.start = self.size  # what stands before a text
        freq = np.zeros(self.size)
        freq[:n] = [c + SMOOTH for _, c in ranked]
        self.prob = freq / freq.sum()
        self.class_prob = self.prob.reshape(-1, CLASS).sum(1)
        rng = np.random.default_rng(7)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.p1, self.p2 = small(self.size + 1, DIM), small(self.size + 1, DIM)
        self.a, self.b = small(self.size // CLASS, DIM), small(self.size, DIM)
        with np.errstate(divide="ignore"):
            self.a0 = np.log(self.class_prob).astype(np.float32)
            self.b0 = np.maximum(np.log(self.prob / np.repeat(self.class_prob, CLASS)), -1e4).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.SHAPES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in self.SHAPES:
            old = getattr(self, k)
            setattr(self, k, np.ascontiguousarray(flat[at : at + old.size], np.float32).reshape(old.shape).copy())
            at += old.size

    def outcomes(self, words: list[bytes]) -> np.ndarray:
        get, other = self.index.get, self.other
        return np.fromiter((get(w, other) for w in words), np.int64, len(words))

    def log10_probs(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, rows: int = 1 << 14) -> np.ndarray:
        """Of target after the outcomes two, one (one stands last)."""
        out = np.empty(len(target))
        order = np.argsort((target // CLASS).astype(np.uint16), kind="stable")
        for at in range(0, len(order), rows):
            own = order[at : at + rows]
            q = self.p1[one[own]] + self.p2[two[own]]
            kind = target[own] // CLASS
            logits = self.a @ q.T + self.a0[:, None]  # positions along the rows, so that sums over classes run over whole rows
            got = logits[kind, np.arange(len(own))] - _logsumexp(logits)
            for lo, hi in _runs(kind):
                k = kind[lo]
                inner = self.b[k * CLASS : (k + 1) * CLASS] @ q[lo:hi].T + self.b0[k * CLASS : (k + 1) * CLASS, None]
                got[lo:hi] += inner[target[own[lo:hi]] - k * CLASS, np.arange(hi - lo)] - _logsumexp(inner)
            out[own] = got
        return out / np.log(10)

    def train(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, rng: np.random.Generator, state: dict[str, np.ndarray]) -> None:
        """One pass of stochastic gradient steps on the noise-contrastive loss, with a step size by row (Adagrad).

        A batch shares its noise: NOISE classes, and NOISE words within each class that it meets, so that all noise scores and their
        gradients are matrix products.
        """
        class_cdf, cdf = np.cumsum(self.class_prob), np.cumsum(self.prob)
        inner = np.maximum(self.prob / np.repeat(self.class_prob, CLASS), 1e-30)
        log_class, log_inner = (np.log(NOISE * x).astype(np.float32) for x in (self.class_prob, inner))
        shuffled = rng.permutation(len(target))
        for at in range(0, len(target), BATCH):
            own = shuffled[at : at + BATCH]
            own = own[np.argsort(target[own].astype(np.uint16), kind="stable")]  # targets, and so classes, stand together
            i, j, w = one[own], two[own], target[own]
            kind = w // CLASS
            q = self.p1[i] + self.p2[j]
            class_runs, word_runs = (np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) for x in (kind, w))
            noise_k = np.minimum(np.searchsorted(class_cdf, rng.random(NOISE) * class_cdf[-1]), len(class_cdf) - 1)
            # classes
            k = kind[class_runs]
            error = _miss(np.einsum("nd,nd->n", q, self.a[kind]) + (self.a0 - log_class)[kind])
            noise = _miss_noise(q @ self.a[noise_k].T + (self.a0 - log_class)[noise_k])
            grad_q = error[:, None] * self.a[kind] + noise @ self.a[noise_k]
            rows, grads, sums = [k, noise_k], [np.add.reduceat(error[:, None] * q, class_runs, axis=0), noise.T @ q], [np.add.reduceat(error, class_runs), noise.sum(0)]
            # words within their classes
            own_b = self.b[w]
            error = _miss(np.einsum("nd,nd->n", q, own_b) + (self.b0 - log_inner)[w])
            grad_q += error[:, None] * own_b
            places = np.searchsorted(cdf, (class_cdf[k] - self.class_prob[k])[:, None] + rng.random((len(k), NOISE)) * self.class_prob[k][:, None])
            ids = np.clip(places, (k * CLASS)[:, None], (k * CLASS + CLASS - 1)[:, None])
            tables = self.b[ids]
            runs = list(zip(class_runs.tolist(), [*class_runs[1:].tolist(), len(w)], strict=True))
            noise = np.empty((len(w), NOISE), np.float32)
            for (lo, hi), table in zip(runs, tables, strict=True):
                np.matmul(q[lo:hi], table.T, out=noise[lo:hi])
            noise = _miss_noise(noise + np.repeat(self.b0[ids] - log_inner[ids], [hi - lo for lo, hi in runs], axis=0))
            b_grads = np.empty((len(runs), NOISE, DIM), np.float32)
            for (lo, hi), table, out in zip(runs, tables, b_grads, strict=True):
                grad_q[lo:hi] += noise[lo:hi] @ table
                np.matmul(noise[lo:hi].T, q[lo:hi], out=out)
            rows_b = np.concatenate((w[word_runs], ids.ravel()))
            grads_b = np.concatenate((np.add.reduceat(error[:, None] * q, word_runs, axis=0), b_grads.reshape(-1, DIM)))
            sums_b = np.concatenate((np.add.reduceat(error, word_runs), np.add.reduceat(noise, class_runs, axis=0).ravel()))
            self._step("a", "a0", np.concatenate(rows), np.concatenate(grads), np.concatenate(sums), state)
            self._step("b", "b0", rows_b, grads_b, sums_b, state)
            self._step("p1", None, i, grad_q, None, state)
            self._step("p2", None, j, grad_q, None, state)

    def _step(self, name: str, bias: str | None, ids: np.ndarray, grad: np.ndarray, bias_grad: np.ndarray | None, state: dict[str, np.ndarray]) -> None:
        order = np.argsort(ids.astype(np.uint16), kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        rows = ids[first]
        for key, total in ((name, np.add.reduceat(grad[order], first, axis=0)), (bias, None if bias_grad is None else np.add.reduceat(bias_grad[order], first))):
            if total is None:
                continue
            table = getattr(self, key)
            held = state.setdefault(key, np.full(len(table), 1e-2, np.float32))
            held[rows] += total**2 if total.ndim == 1 else (total**2).mean(axis=1)
            step = np.float32(RATE) / np.sqrt(held[rows])
            table[rows] += total * (step if total.ndim == 1 else step[:, None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    with np.errstate(over="ignore"):
        np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _miss(score: np.ndarray) -> np.ndarray:
    """What data lacks to be told from noise; score is used up."""
    return 1 - _sigmoid(score)


def _miss_noise(score: np.ndarray) -> np.ndarray:
    return np.negative(_sigmoid(score), out=score)


def _logsumexp(x: np.ndarray) -> np.ndarray:
    """Over the first axis; x is used up."""
    top = x.max(axis=0)
    x -= top
    return top + np.log(np.exp(x, out=x).sum(axis=0))


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
    return zip(cuts[:-1], cuts[1:], strict=True) if len(x) else iter(())


def _sequences(sizes: np.ndarray, codes: np.ndarray, outcome: np.ndarray, model: Model) -> tuple[np.ndarray, ...]:
    """The block's outcomes one after another, with an end after each text: previous, the one before it, target, text number."""
    n = sizes.astype(np.int64) + 1
    total = int(n.sum())
    last = np.cumsum(n) - 1
    target = np.empty(total, np.int64)
    is_end = np.zeros(total, bool)
    is_end[last] = True
    target[is_end], target[~is_end] = model.end, outcome[codes]
    first = last - n + 1
    one = np.concatenate(([model.start], target[:-1]))
    two = np.concatenate(([model.start] * 2, target[:-2]))[:total]
    one[first] = model.start
    two[first] = model.start
    two[np.minimum(first + 1, total - 1)] = model.start
    two[first] = model.start
    return one, two, target, np.repeat(np.arange(len(n)), n)


# ---- over the corpus -------------------------------------------------------------------------------------------------


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs (doc_id, text) dealt out by the hash of id and text to shards of about shard_bytes and put in order there, so that blocks,
    and what is learned from each, are the same however the input is partitioned."""
    own = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    size = own.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    hashed = own.withColumn("h", F.xxhash64("doc_id", "text"))
    return hashed.repartition(max(1, -(-size // shard_bytes)), "h").sortWithinPartitions("h", "doc_id").drop("h")


def _training_counts(doc_ids: list, sizes: np.ndarray, codes: np.ndarray, n_words: int) -> np.ndarray:
    """How often each word of a block stands in its training texts."""
    train = np.array([not held_out(i) for i in doc_ids], bool)
    return np.bincount(codes[np.repeat(train, sizes)], minlength=n_words)


def _count_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The corpus counts of the words of each part.

    Every row of items is answered by counts (two numbers of 32 bits each); one row more has the part's distinct words, tokens and
    most frequent words. What is held of a part are its distinct words, and its rows as they came, packed: a word that every block
    has takes some bytes of each.
    """
    held: list[tuple] = []
    part = None

    def close():
        total: Counter[bytes] = Counter()
        for row in held:
            for word, c in zip(bl.unsqueeze_strings(row[3]), bl.unsqueeze(row[4]).tolist(), strict=True):
                if c:
                    total[word] += c
        for blocks, counts, idx, words, *_, block in held:
            c = np.array(list(map(total.__getitem__, bl.unsqueeze_strings(words))), np.int64)
            halves = np.stack((c & 0xFFFFFFFF, c >> 32), axis=1).ravel()
            yield bl.batch_of([(part, 0, blocks, counts, idx, None, None, bl.squeeze(np.full(len(c), 2)), bl.squeeze(halves), block, None, None, None, None)], COUNTS_ARROW)
        known, c = list(total), np.fromiter(total.values(), np.int64, len(total))
        near = range(len(known)) if len(known) <= MODEL_WORDS else np.flatnonzero(c >= np.partition(c, -MODEL_WORDS)[-MODEL_WORDS]).tolist()
        top = sorted(((known[i], int(c[i])) for i in near), key=lambda x: (-x[1], x[0]))[:MODEL_WORDS]
        yield bl.batch_of([(part, *[None] * 9, len(total), int(c.sum()), [w for w, _ in top], [c for _, c in top])], COUNTS_ARROW)

    for key, row in bl.rows_of(batches):
        if held and key != part:
            yield from close()
            held = []
        part = key
        held.append(row)
    if held:
        yield from close()


COUNTS = f"{bl.ITEMS}, kinds bigint, tokens bigint, top array<binary>, top_c array<bigint>"
COUNTS_ARROW = pa.schema([*bl.ITEMS_ARROW, ("kinds", pa.int64()), ("tokens", pa.int64()), ("top", pa.list_(pa.binary())), ("top_c", pa.list_(pa.int64()))])


def _average(parts: DataFrame, size: int) -> np.ndarray | None:
    """The mean of the changes of parameters by weight: FAN_IN blobs of a slice at a time, in the order of their slots, until one is
    left. Blocks send 16-bit floats, means are 32-bit."""

    def mean_of(kind: str):
        def mean(key, table):
            table = table.sort_by("slot")
            weights = np.array(table.column("weight").to_pylist(), float)
            blobs = np.stack([np.frombuffer(b, kind) for b in table.column("blob").to_pylist()])
            got = (weights[:, None] * blobs).sum(0) / max(weights.sum(), 1e-9)
            return pa.table({"slot": [key[1].as_py()], "slice": pa.array([key[0].as_py()], pa.int32()), "weight": [weights.sum()], "blob": [got.astype("<f4").tobytes()]})

        return mean

    most = parts.agg(F.max("slot")).first()[0]
    if most is None:
        return None
    kind, staged = "<f2", []
    while True:
        parts = parts.withColumn("up", F.floor(F.col("slot") / FAN_IN).cast("bigint")).groupBy("slice", "up").applyInArrow(mean_of(kind), "slot bigint, slice int, weight double, blob binary")
        most //= FAN_IN
        if not most:
            break
        parts = materialize(parts, "means")
        staged.append(parts)
        kind = "<f4"
    rows = sorted(parts.select("slice", "blob").collect())  # SLICES rows, the size of the parameters in all
    discard(*staged)
    return np.concatenate([np.frombuffer(r["blob"], "<f4") for r in rows])[:size]


def fit(packed: DataFrame, top: list[tuple[bytes, int]], texts: int, tokens: int, rounds: int = ROUNDS) -> Model:
    """The model of the training texts in packed. top: the model's words and their counts; texts: how many training texts there
    are; tokens: how many words they have. Every block is learned from on its own, from common parameters."""
    known = top
    model = Model([("other", tokens - sum(c for _, c in known)), ("end", texts), *known])
    size = len(model.flat())
    width = -(-size // SLICES)
    # a block's slot is its shard, or, where a shard has several blocks, they make a first group of their own
    alone = not packed.agg(F.max(F.col("block").bitwiseAND(F.lit((1 << 24) - 1)))).first()[0]
    slot = F.shiftright("block", 24) if alone else F.shiftright("block", 24) * FAN_IN + F.col("block") % FAN_IN
    for number in range(rounds):
        shared = packed.sparkSession.sparkContext.broadcast(model)  # of a fixed size

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            base = shared.value
            start = base.flat()
            for batch in batches:
                for k in range(batch.num_rows):
                    own = Model.__new__(Model)
                    own.__dict__.update(base.__dict__)
                    own.load(start)
                    sizes = np.frombuffer(batch.column(1)[k].as_py(), "<u4")
                    train = np.array([not held_out(i) for i in batch.column(0)[k].as_py()], bool)
                    one, two, target, text = _sequences(sizes, bl.unsqueeze(batch.column(2)[k].as_py()), own.outcomes(batch.column(3)[k].as_py()), own)
                    rng = np.random.default_rng([len(target), number])
                    picked = np.flatnonzero(train[text] & (np.arange(len(target)) % rounds == number))
                    if not len(picked):
                        continue
                    own.train(one[picked], two[picked], target[picked], rng, {})
                    flat = np.pad(own.flat() - start, (0, width * SLICES - size)).astype("<f2").reshape(SLICES, width)
                    at = batch.column(4)[k].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at] * SLICES, pa.int64()), pa.array(range(SLICES), pa.int32()), pa.array([float(len(picked))] * SLICES), pa.array([row.tobytes() for row in flat], pa.binary())],
                        ["slot", "slice", "weight", "blob"],
                    )

        parts = packed.select("doc_ids", "sizes", "codes", "words", slot.cast("bigint").alias("slot")).mapInArrow(lean(learn), "slot bigint, slice int, weight double, blob binary")
        parts = materialize(parts, "parameters")
        mean = _average(parts, size)
        discard(parts)
        if mean is not None:
            model.load(model.flat() + mean)
    return model


def most_frequent(counts: DataFrame, n: int) -> list[tuple[bytes, int]]:
    """The n most frequent of counts (word, c), ties by word: a bounded list, whatever the corpus.

    A histogram of log counts (some hundred rows) first says from which count on words matter, so that only about n of them, not n of
    every partition, come together to be sorted.
    """
    level = F.floor(F.log2(F.col("c").cast("double")) * 8)
    least, held = None, 0
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        least, held = row["level"], held + row["count"]
        if held >= n:
            break
    if least is None:
        return []
    return [(bytes(r["word"]), r["c"]) for r in counts.filter(level >= least).orderBy(F.desc("c"), "word").limit(n).collect()]


def score(docs: DataFrame, rounds: int = ROUNDS, block_bytes: int = bl.BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, **sizes: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs (doc_id, text).

    Training texts are those with held_out false. base_score is the smoothed unigram log10 probability, score that of the neural
    model. Null texts count as empty (the end alone); without any training text every count is 0. Repeated rows each count. Scores
    don't depend on how docs is partitioned. sizes are those of the exchange (``blocks.Exchange.of``).
    """
    packed = bl.pack(shards(docs, shard_bytes), bl.SpaceBuilder, block_bytes)
    exchange = bl.Exchange.of(packed, **sizes)
    counted = materialize(exchange.send_words(packed, _training_counts).mapInArrow(lean(_count_parts), COUNTS), "counts")
    parts = counted.filter("blocks is null")
    distinct, tokens = parts.agg(F.coalesce(F.sum("kinds"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    most = parts.select(F.explode(F.arrays_zip("top", "top_c")).alias("t")).select(F.col("t.top").alias("word"), F.col("t.top_c").alias("c"))
    top = most_frequent(most, MODEL_WORDS)
    is_out = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    texts = packed.select(F.explode("doc_ids").alias("id")).filter(~is_out).count()
    model = fit(packed, top, texts, tokens, rounds)
    total, kinds = tokens + texts, distinct + bool(texts)
    others, other_total = distinct - len(top), tokens - sum(c for _, c in top)
    shared = packed.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids = batch.column(0)[k].as_py()
                sizes = np.frombuffer(batch.column(1)[k].as_py(), "<u4")
                codes = bl.unsqueeze(batch.column(2)[k].as_py())
                words = batch.column(3)[k].as_py()
                seen = np.zeros(len(words), np.int64)
                idx, _, halves = bl.answers_of(batch.column(4)[k].as_py())
                seen[idx] = halves[::2] + (halves[1::2] << 32)
                outcome = own.outcomes(words)
                base = np.log10((seen + SMOOTH) / (total + SMOOTH * (kinds + 1)))
                extra = np.where(outcome == own.other, np.log10((seen + SMOOTH) / (other_total + SMOOTH * (others + 1))), 0)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                n = len(sizes)
                by_doc = lambda values, doc=doc, n=n: np.bincount(doc, values, n)
                got = np.zeros(n)
                ends, at = np.cumsum(sizes.astype(np.int64)), 0
                while at < n:  # some texts at a time
                    upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 18), "right")))
                    lo = int(ends[at - 1]) if at else 0
                    one, two, target, text = _sequences(sizes[at:upto], codes[lo : int(ends[upto - 1])], outcome, own)
                    got[at:upto] = np.bincount(text, own.log10_probs(one, two, target), upto - at)
                    at = upto
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array([held_out(i) for i in doc_ids]),
                        pa.array(sizes.astype(np.int64) + 1),
                        pa.array(by_doc(seen[codes] > 0).astype(np.int64) + (texts > 0)),
                        pa.array(np.full(n, total, np.int64)),
                        pa.array(by_doc(base[codes]) + np.log10((texts + SMOOTH) / (total + SMOOTH * (kinds + 1)))),
                        pa.array(got + by_doc(extra[codes])),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    answers = exchange.send_back(counted.filter("blocks is not null").select(*bl.ITEMS_ARROW.names), packed.rdd.getNumPartitions())
    joined = packed.join(answers, "block", "left").select("doc_ids", "sizes", "codes", "words", "table")
    return joined.mapInArrow(lean(rows), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
