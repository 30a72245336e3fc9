"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

A text is lower-cased; everything but letters becomes a boundary. Its subwords are the byte 2-, 3- and 4-grams of its words with
their boundaries, hashed into BUCKETS rows of an embedding table. The mean of its rows goes through a linear layer and a
softmax. As both are linear up to the softmax, prediction folds them into one table of bucket x language.

Rejection is calibrated on labelled texts that training didn't see. A temperature makes the softmax honest, and a prediction that is
likelier wrong than right is rejected. As a softmax is sure of any text that leans to one language, a second test asks whether
the text looks like that language at all: its familiarity is the mean log frequency of its subwords among those of the training
texts of the language, in standard deviations from what texts of its length have there. The threshold is what all but REJECT of the
rightly predicted calibration texts exceed, less SLACK times its distance from their median, so that clean texts of a larger corpus
stay; gibberish and texts half in another language fall far below. A text is also rejected when fewer than LETTER_SHARE of its
visible characters are letters, or none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import hand_back, lean, prepare, text_or_empty

BUCKETS = 1 << 15
DIM = 16
EPOCHS = 12
RATE = 4.0
#: Bound of the labelled sample that the classifier is fitted on, in rows; they are those with the smallest hashes.
SAMPLE_ROWS = 4000
#: Longer texts aren't chosen for the sample, so that it is bounded in bytes too.
SAMPLE_TEXT_BYTES = 1 << 15
#: Share of rightly predicted calibration texts below the threshold of familiarity, before SLACK is added to the distance.
REJECT = 0.01
SLACK = 1.0
EVEN = 0.5
LETTER_SHARE = 0.2
UNDETERMINED = "und"
#: Bytes of text whose subwords are hashed at a time.
CHUNK = 1 << 20

_PRIME = np.uint32(0x9E3779B1)


def _letters() -> np.ndarray:
    """ASCII bytes to what they stand for: letters stay, the rest is a boundary (32); bytes of other characters stay."""
    table = np.full(256, 32, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[128:] = np.arange(128, 256)
    return table


_TABLE = _letters()


def subwords(text: str) -> Iterator[np.ndarray]:
    """The buckets of all subwords of a text, in pieces; together they are those of the whole text."""
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    for at in range(0, len(raw), CHUNK):
        x = _TABLE[raw[at : at + CHUNK + 3]].astype(np.uint32)
        n = min(CHUNK, len(raw) - at)
        inner = x != 32
        h = x
        for size in (2, 3, 4):
            m = min(n, len(x) - size + 1)
            if m <= 0:
                break
            h = h[:m] * np.uint32(0x01000193) + x[size - 1 : size - 1 + m]
            # no boundary inside, and not boundaries alone
            ok = inner[:m] | inner[1 : m + 1] if size == 2 else inner[1 : m + 1] if size == 3 else inner[1 : m + 1] & inner[2 : m + 2]
            yield ((h[ok] * _PRIME) >> np.uint32(32 - 15)).astype(np.int32)


def mean_counts(text: str) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Buckets of a text, their shares and the number of subwords; None without subwords."""
    total = np.zeros(BUCKETS)
    for part in subwords(text):
        total += np.bincount(part, minlength=BUCKETS)
    own = np.flatnonzero(total)
    return (own, total[own] / total.sum(), int(total.sum())) if len(own) else None


def letter_share(text: str) -> float:
    visible = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    ascii_letters = len(text.encode("ascii", "ignore").translate(None, _NOT_LETTERS))
    others = 0 if text.isascii() else sum(map(str.isalpha, filter(lambda c: c > "\x7f", text)))
    return (ascii_letters + others) / visible if visible > 0 else 0.0


_NOT_LETTERS = bytes(b for b in range(256) if not chr(b).isascii() or not chr(b).isalpha())


@dataclass
class Classifier:
    """table: bucket x language; bias; temperature and threshold of the confidence; log_freq: bucket x language, and usual: language x
    (mean familiarity, its variance between texts, its variance of one subword); least: the threshold of familiarity."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    log_freq: np.ndarray | None = None
    usual: np.ndarray | None = None
    least: float = -np.inf

    def __post_init__(self) -> None:
        self.both = self.table if self.log_freq is None else np.ascontiguousarray(np.concatenate((self.table, self.log_freq), axis=1), np.float32)

    def sums(self, text: str) -> tuple[np.ndarray, int]:
        """The sums of the rows of both tables over a text's subwords, and their number."""
        total, n = np.zeros(self.both.shape[1]), 0
        for part in subwords(text):
            n += len(part)
            if len(part) > BUCKETS // 2:
                total += np.bincount(part, minlength=BUCKETS) @ self.both
            else:
                total += self.both[part].sum(axis=0, dtype=np.float64)
        return total, n

    def familiarity(self, total: np.ndarray, n: int, lang: int) -> float:
        mean, between, within = self.usual[lang]
        return float((total[len(self.languages) + lang] / n - mean) / np.sqrt(between + within / n))

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, calibrated confidence, rejected. Texts without letters are undetermined, with confidence 0."""
        share = letter_share(text)
        total, n = self.sums(text) if share and self.languages else (None, 0)
        if not n:
            return UNDETERMINED, 0.0, True
        p = softmax((total[: len(self.languages)] / n + self.bias)[None] / self.temperature)[0]
        best = int(p.argmax())
        strange = self.usual is not None and self.familiarity(total, n, best) < self.least
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold or share < LETTER_SHARE or strange)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 11) -> Classifier:
    """Fit on (text, language) rows: a fifth of them, every fifth in the order given, calibrates and isn't learned from."""
    rows = [(found[:2], lang, found[2]) for text, lang in rows if (found := mean_counts(text)) is not None]
    languages = sorted({lang for _, lang, _ in rows})
    if not languages:
        return Classifier([], np.zeros((BUCKETS, 0)), np.zeros(0))
    y = np.array([languages.index(lang) for _, lang, _ in rows])
    is_cal = (np.arange(len(rows)) % 5 == 4) if len(rows) >= 50 else np.zeros(len(rows), bool)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    out, bias = rng.normal(0, 0.1, (DIM, len(languages))), np.zeros(len(languages))
    learn = np.flatnonzero(~is_cal)
    steps, done = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            own, share = rows[i][0]
            hidden = share @ emb[own]
            p = softmax((hidden @ out + bias)[None])[0]
            p[y[i]] -= 1
            rate = RATE * (1 - done / steps)
            grad = out @ p
            out -= 0.1 * rate * np.outer(hidden, p)
            bias -= 0.01 * rate * p
            emb[own] -= rate * share[:, None] * grad
            done += 1
    counts = np.full((BUCKETS, len(languages)), 0.5)
    for i in learn:
        counts[rows[i][0][0], y[i]] += rows[i][0][1] * rows[i][2]
    made = Classifier(languages, (emb @ out).astype(np.float32), bias, log_freq=np.log(counts / counts.sum(axis=0)).astype(np.float32))
    cal = np.flatnonzero(is_cal)
    if len(cal):
        logits = np.stack([rows[i][0][1] @ made.table[rows[i][0][0]] + bias for i in cal])
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(softmax(logits / t)[np.arange(len(cal)), y[cal]] + 1e-12).mean() for t in grid]
        made.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(logits / made.temperature)
        right = p.argmax(axis=1) == y[cal]
        if right.any():
            made.threshold = min(EVEN, float(np.quantile(p.max(axis=1)[right], REJECT, method="lower")))
            _calibrate(made, [rows[i] for i in cal[right]], y[cal[right]])
    return made


def _calibrate(made: Classifier, rows: list, y: np.ndarray) -> None:
    """Set usual and least from texts that training didn't see."""
    means = np.array([share @ made.log_freq[own, lang] for ((own, share), _, _), lang in zip(rows, y, strict=True)])
    spread = np.array([share @ (made.log_freq[own, lang] - m) ** 2 for ((own, share), _, _), lang, m in zip(rows, y, means, strict=True)])
    n = np.array([n for _, _, n in rows], float)
    everywhere = means.mean()
    usual = []
    for k in range(len(made.languages)):
        own = y == k
        mean = np.average(means[own], weights=n[own]) if own.any() else everywhere
        # subwords of a word go together, so a text's mean varies by more than spread / n
        within = spread[own].mean() if own.any() else spread.mean()
        off = (means[own] - mean) ** 2
        grouped = max(1.0, float(np.median(off * n[own] / within)) / 0.455) if own.any() else 1.0  # 0.455: the median of a squared normal
        between = float(np.median(off[n[own] >= np.median(n[own])])) / 0.455 if own.any() else float(means.var())
        usual.append((mean, between, within * grouped))
    made.usual = np.array(usual)
    z = np.array([(m - made.usual[k][0]) / np.sqrt(made.usual[k][1] + made.usual[k][2] / size) for m, k, size in zip(means, y, n, strict=True)])
    low = float(np.quantile(z, REJECT, method="lower"))
    made.least = low - SLACK * (float(np.median(z)) - low)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Learn from text and lang of docs whose crc32(doc_id as text) mod 4 isn't 2: of the labelled rows with texts of at most
    SAMPLE_TEXT_BYTES, the sample_rows with the smallest hashes of doc_id (ties by doc_id and hash of the text). Whole texts are used."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.filter(F.col("lang").isNotNull() & (F.col("lang") != UNDETERMINED) & F.col("text").isNotNull() & (F.octet_length("text") <= SAMPLE_TEXT_BYTES) & (number % 4 != 2))
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid"))
    chosen = rows.select(key.alias("key"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h")).orderBy("key", "id", "h").limit(sample_rows)
    last = chosen.agg(F.max(F.struct("key", "id", "h"))).first()[0]
    if last is None:
        return train([])
    place = F.struct(key.alias("key"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    upto = F.struct(*(F.lit(last[c]).cast(t).alias(c) for c, t in chosen.dtypes))
    sample = rows.filter((key < last["key"]) | ((key == last["key"]) & (place <= upto))).select("text", F.col("lang").cast("string").alias("lang"), place.alias("place"))
    # rows that repeat the last one are all here; they are alike
    found = sorted(sample.limit(2 * sample_rows).collect(), key=lambda r: tuple((v is not None, v) for v in r["place"]))[:sample_rows]
    made = train([(r["text"], r["lang"]) for r in found if any(map(str.isalpha, r["text"]))])
    del found
    hand_back()
    return made


def identify(docs: DataFrame, model: Classifier | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with lang_pred string, score double and rejected boolean; without a model, one is fitted on docs itself.

    Predictions come from the whole text alone. Null texts, and texts without a letter, are "und" with score 0 and rejected; so is
    every text where nothing could be learned (no labelled rows). Columns of docs that have these names are replaced.
    """
    prepare(docs.sparkSession)
    model = model or fit(docs, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    new = ["lang_pred", "score", "rejected"]
    kept = docs.drop(*new).withColumn("__text", text_or_empty())
    names = [c for c in kept.columns if c != "__text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(text) for text in batch.column(len(names)).to_pylist()]
            more = [pa.array(v, t) for v, t in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.bool_()), strict=True)] if found else [pa.array([], t) for t in (pa.string(), pa.float64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *more], [*names, *new])

    fields = kept.select(names).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return kept.mapInArrow(lean(rows), fields)
