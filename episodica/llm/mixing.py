"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed into cells (source x language x topic) by tokens. Raking scales the cells' weights to the target marginals of
one dimension after the other, ROUNDS times. Each document is then sampled with the probability min(1, c x cell factor), c being such
that the expected tokens are the share ``keep`` of all. The draw is a hash of doc_id, so it can be repeated. Only DataFrame
functions are used; hot sources shrink to a few cells by partial sums before anything is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.llm.common import materialize, text_or_empty

#: Dimensions and the exponent that tempers a value's share of tokens into its target share.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.9}
ROUNDS = 8
KEEP = 0.7
SEED = "mix-1"
SPACE = r"[ \t\n\x0B\f\r]+"
#: What the topic of a text doesn't depend on.
NOT_MARKS = "[^|#$%&*!0-9]+"


def tokens_of(text: Column) -> Column:
    """The number of words between ASCII white space: the pieces of a split but empty ones at the ends."""
    edge = lambda pattern: text.rlike(pattern).cast("int")
    return F.when(text == "", 0).otherwise(F.size(F.split(text, SPACE)) - edge(r"^[ \t\n\x0B\f\r]") - edge(r"[ \t\n\x0B\f\r]\z")).cast("bigint")


def topic_of(length: Column, marks: Column) -> Column:
    """A coarse topic from the make-up of a text: table, symbols, numbers, empty or prose. marks: its MARKS alone."""
    share = lambda drop: (F.char_length(marks) - F.char_length(F.translate(marks, drop, ""))) / length
    return F.when(length == 0, "empty").when(share("|") > 0.02, "table").when(share("#$%&*!") > 0.05, "symbols").when(share("0123456789") > 0.05, "numbers").otherwise("prose")


def measure(docs: DataFrame) -> DataFrame:
    """docs with topic and tokens of their text (null counts as empty); columns of these names are replaced."""
    text = text_or_empty()
    marked = docs.drop("topic", "tokens").withColumns({"__marks": F.regexp_replace(text, NOT_MARKS, ""), "__length": F.char_length(text), "tokens": tokens_of(text)})
    return marked.withColumn("topic", topic_of(F.col("__length"), F.col("__marks"))).drop("__marks", "__length")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number from 0 to 1, one excluded, from the hash of doc_id (52 bits)."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))  , 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rake(cells: DataFrame, temper: dict[str, float], rounds: int = ROUNDS) -> DataFrame:
    """cells (the dimensions, tokens) with weight: the tokens raked so that each value's share of its dimension is its target.

    A value's target is proportional to its tokens to the power in temper. Cells without tokens keep weight 0. The sums are windows
    over the cells; every four rounds the cells are written, which keeps the plan short.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    for dim, power in temper.items():
        own = cells.groupBy(dim).agg(F.sum("tokens").alias("of_value"))
        norm = float(own.agg(F.sum(F.pow("of_value", F.lit(power)))).first()[0] or 1) or 1.0
        cells = cells.withColumn(f"t_{dim}", F.pow(F.sum("tokens").over(W.partitionBy(dim)).cast("double"), F.lit(power)) / F.lit(norm) * F.lit(total))
    cells = materialize(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for number in range(rounds):
        for dim in temper:
            have = F.sum("weight").over(W.partitionBy(dim))
            cells = cells.withColumn("weight", F.when(have > 0, F.col("weight") * (F.col(f"t_{dim}") / have)).otherwise(F.lit(0.0)))
        if number % 4 == 3 or number == rounds - 1:
            cells = materialize(cells, "cells")
    return cells


def calibrate(cells: DataFrame, keep: float) -> float:
    """c such that the cells' min(1, c x weight / tokens) x tokens sum to keep x all tokens; every round fixes the full cells."""
    factor = F.col("weight") / F.col("tokens")
    c, before = 0.0, -1
    while True:
        full = F.col("tokens").cast("double") if c else F.lit(0.0)
        is_full = (F.lit(c) * factor >= 1) if c else F.lit(False)
        row = cells.filter("tokens > 0").agg(F.sum("tokens"), F.sum(F.when(is_full, full)), F.sum(F.when(~is_full, F.col("weight"))), F.count(F.when(is_full, 1))).first()
        total, held, rest, count = float(row[0] or 0), float(row[1] or 0), float(row[2] or 0), row[3]
        if count == before or rest <= 0:
            return c or 1.0
        c, before = max(keep * total - held, 0.0) / rest, count


def mix(measured: DataFrame, temper: dict[str, float] = TEMPER, rounds: int = ROUNDS, keep: float = KEEP, seed: str = SEED) -> DataFrame:
    """measured (doc_id, tokens and the dimensions of temper; see measure) with weight, probability, sampled.

    weight is the document's part of its cell's raked tokens. Null sources or languages are a value of their own; documents without
    tokens have weight 0 and aren't sampled. Rows with one doc_id share their draw. An empty table stays empty. Columns that have
    these names are replaced. measured is read twice, so write it without texts first where they aren't needed.
    """
    rows = measured.drop("weight", "probability", "sampled")
    dims = list(temper)
    counts = materialize(rows.groupBy(*dims).agg(F.sum("tokens").alias("tokens")), "counts")
    cells = rake(counts, temper, rounds)
    c = calibrate(cells, keep)
    factor = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    placed = cells.select(*(F.col(d).alias(f"__{d}") for d in dims), factor.alias("__factor"))
    same = reduce(lambda a, b: a & b, (rows[d].eqNullSafe(placed[f"__{d}"]) for d in dims))
    chance = F.least(F.lit(1.0), F.lit(c) * F.col("__factor"))
    joined = rows.join(placed, same).withColumns({"weight": F.col("__factor") * F.col("tokens"), "probability": F.when(F.col("tokens") > 0, chance).otherwise(0.0)})
    return joined.withColumn("sampled", uniform(F.col("doc_id"), seed) < F.col("probability")).drop("__factor", *(f"__{d}" for d in dims))


def oracle_sql(temper: dict[str, float] = TEMPER, rounds: int = ROUNDS, keep: float = KEEP, seed: str = SEED) -> str:
    share = lambda chars: f"(length(t) - length(regexp_replace(t, '[{chars}]', '', 'g'))) / length(t)"
    dims = ", ".join(temper)
    sums = ", ".join(f"sum(tokens) over (partition by {d}) as s_{d}" for d in temper)
    norms = ", ".join(f"(select sum(pow(s, {p})) from (select sum(tokens)::double as s from c group by {d})) as n_{d}" for d, p in temper.items())
    targets = ", ".join(f"pow(s_{d}::double, {p}) / n_{d} * total as t_{d}" for d, p in temper.items())
    steps, last = [], "r"
    for k in range(rounds):
        for d in temper:
            new = f"r{k}_{d}"
            steps.append(f"{new} as (select * replace (case when sum(w) over (partition by {d}) > 0 then w * (t_{d} / sum(w) over (partition by {d})) else 0 end as w) from {last})")
            last = new
    return f"""
with recursive d as (select doc_id, source, lang, coalesce(text, '') as t from documents),
e as (select doc_id, source, lang,
    case when length(t) = 0 then 'empty' when {share('|')} > 0.02 then 'table' when {share('#$%&*!')} > 0.05 then 'symbols'
         when {share('0-9')} > 0.05 then 'numbers' else 'prose' end as topic,
    len(list_filter(string_split_regex(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> ''))::bigint as tokens from d),
c as (select {dims}, sum(tokens)::bigint as tokens from e group by all),
n as (select *, {sums}, sum(tokens) over () as total, {norms} from c),
r as (select *, tokens::double as w, {targets} from n),
{', '.join(steps)},
f as (select {dims}, tokens as n, w, case when tokens > 0 then w / tokens else 0 end as factor from {last}),
o as (select *, sum(n) over (order by factor desc, source, lang, topic) - n as before, sum(w) over (order by factor, source desc, lang desc, topic desc) as after,
      sum(n) over () as total from f where n > 0),
k as (select max(({keep} * total - before) / after) as c from o where ({keep} * total - before) / after * factor < 1)
select doc_id, source, lang, topic, tokens, tokens * factor as weight, case when tokens > 0 then least(1.0, c * factor) else 0.0 end as probability,
    ('0x' || substr(sha256('{seed}:' || doc_id), 1, 13))::bigint / {1 << 52}.0 < case when tokens > 0 then least(1.0, c * factor) else 0.0 end as sampled
from e join f using ({dims}), k
""".replace("from e join f using", "from (select * from e) e join (select * exclude (n, w) from f) f using")
