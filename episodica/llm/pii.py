"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Only DataFrame functions are used. Positions come from splitting the text at the pattern: the n-th match begins after the first n
pieces and the n - 1 matches before it. All offsets are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import text_or_empty

#: Characters before a span in which context words are looked for, and what they add to its score.
CONTEXT_CHARS = 48
CONTEXT_BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """pattern proposes (leftmost, non-overlapping), valid confirms a match, hint is a cheap necessary test of a text."""

    name: str
    pattern: str
    valid: object
    score: float
    context: str
    hint: str


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits, its first four moved to the end and letters read as 10 to 35, leave 1 modulo 97."""
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: step(a, c)) == 1


def _small_parts(m: Column) -> Column:
    bare = lambda x: F.regexp_replace(x, "^0+", "")
    return F.forall(F.split(m, r"\."), lambda x: (F.char_length(bare(x)) <= 3) & (F.coalesce(bare(x).try_cast("int"), F.lit(0)) <= 255))


def _card(m: Column) -> Column:
    return F.when(F.char_length(_digits(m)).between(14, 19), luhn(_digits(m))).otherwise(False)


def _iban(m: Column) -> Column:
    bare = F.replace(m, F.lit(" "), F.lit(""))
    return F.when(F.char_length(bare).between(15, 34), mod97(bare)).otherwise(False)


# The length of an account number (IBAN) by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
IBAN = "|".join(rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}" for length, names in IBAN_LENGTHS.items())

# A match of these patterns can't begin within a run of its first characters, unless the match before it ended there; saying so
# (look-behind and \G) and possessive quantifiers keep them linear on very long runs without changing what they match.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.7, "mail|contact|address|write|reach|kontakt|correo|courriel", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _small_parts, 0.6, r"\bip\b|server|host|address|login|network", "."),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", _card, 0.7, "card|credit|visa|master|payment|karte|tarjeta|carte", ""),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.char_length(_digits(m)).between(10, 15), 0.6, "phone|tel|call|mobile|fax|telefon|contact", "+"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})(?![A-Za-z0-9])", _iban, 0.7, "iban|account|bank|konto|cuenta|compte", ""),
)
BASE = ("email", "ip", "card", "phone")

SPANS = "array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>"


def spans_of(kind: Kind, number: int, text: Column, found: Column) -> Column:
    """The confirmed spans of one kind; found: its matches."""
    pieces = F.arrays_zip(F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found)).alias("p"), found.alias("m"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,m:string>>").alias("spans"))

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["p"])
        return F.struct((start + F.char_length(x["m"])).alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), x["m"].alias("m")))).alias("spans"))

    placed = F.aggregate(pieces, empty, place)["spans"]
    confirmed = F.filter(placed, lambda x: kind.valid(x["m"]))

    def scored(x: Column) -> Column:
        begin = F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0))
        near = F.lower(F.substring(text, begin + 1, x["start"] - begin)).rlike(kind.context)
        return F.struct(x["start"].alias("start"), F.lit(number).alias("kind_no"), (x["start"] + F.char_length(x["m"])).alias("end"), F.lit(kind.name).alias("kind"), (F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)).alias("score"))

    return F.when(F.size(found) > 0, F.transform(confirmed, scored)).otherwise(F.array().cast(SPANS))


def find(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """docs (doc_id, text) to doc_id, text, found: the spans (start, kind_no, end, kind, score) by start, then kind.

    Null texts count as empty and have no spans. Rows are independent: repeated ones and null ids are kept.
    """
    own = docs.select("doc_id", text_or_empty().alias("text"))
    text = F.col("text")
    none = F.array().cast("array<string>")
    proposed = own.select("*", *(F.when(F.contains(text, F.lit(k.hint)), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"m_{k.name}") for k in kinds))
    spans = proposed.select("doc_id", "text", *(spans_of(k, i, text, F.col(f"m_{k.name}")).alias(f"s_{k.name}") for i, k in enumerate(kinds)))
    return spans.select("doc_id", "text", F.array_sort(F.concat(*(f"s_{k.name}" for k in kinds))).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, base_sha256, spans, and the best score."""
    own = F.col("found")
    shown = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda name: F.size(F.filter(own, lambda x: x["kind"] == name)).cast("bigint").alias(f"n_{name}")
    base = F.filter(own, lambda x: x["kind"].isin(*BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(shown(base), 256).alias("base_sha256"), shown(own).alias("spans"), F.coalesce(F.array_max(F.transform(own, lambda x: x["score"])), F.lit(0.0)).alias("score"))
