"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""

import random

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())

WORDS = "the of and to in for with on by at from this that are was be have not you all one can had her out day get has him his how man new now old see two way who boy did its let put say she too use".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def texts(seed=1, n=60):
    rnd = random.Random(seed)
    base = [prose(rnd, rnd.randrange(1, 80)) for _ in range(n)]
    copies = [base[0], base[0].upper(), base[1] + " ", base[2] + " extra", base[3]]
    odd = [None, "", " \n\t", "x", "É éK K k", "a b c", "\x1c\x1d a", "😀" * 50, "1" * 5000, "word " * 20_000, "'s 't it's ''s  \n\n x", "\u0000nul"]
    return [*base, *copies, *odd]


def documents(spark, seed=1, n=60, extra=True):
    """doc_id, text, lang, source, and columns whose names the operators use inside."""
    rows = [(k * 3, t, ["en", "de", None][k % 3], f"src{k % 4 if k % 5 else 0}" if k % 11 else None) for k, t in enumerate(texts(seed, n))]
    rows += [rows[4], rows[4], (None, "no id here", "en", "src1"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    if extra:
        for name in ("block", "words", "ids", "codes", "word", "idx", "digest", "fp", "h", "line", "part", "node", "keep_id"):
            df = df.selectExpr("*", f"'clash' as {name}")
    return df


def empty(spark):
    return documents(spark).limit(0)
