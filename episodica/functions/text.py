"""Text and time expressions shared by the transcript operators. All are Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(text: Column) -> Column:
    """Whether a text is empty or Unicode white space alone."""
    return ~text.rlike(r"(?U)\S")


def trim_unicode(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+\z", "")


def compact(text: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def preview(text: Column, chars: int) -> Column:
    """The compact text, cut to chars code points with an ellipsis."""
    short = compact(text)
    return F.when(F.char_length(short) <= chars, short).otherwise(F.concat(F.substring(short, 1, chars), F.lit("...")))


def normalize_text(text: Column) -> Column:
    """Lines without trailing white space, the whole trimmed."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda line: F.regexp_replace(line, r"(?U)\s+\z", ""))
    return trim_unicode(F.array_join(lines, "\n"))


def role_of(kind: Column) -> Column:
    return F.when(kind == "user_msg", "user").when(kind.isin("assistant_msg", "response_item", "tool_call"), "assistant").when(kind == "tool_result", "tool").otherwise("system")


def _stamp(ts: Column, zone: str) -> Column:
    micros = F.unix_micros(ts)
    shown = lambda fraction: F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss{fraction}{zone}")
    return F.when(micros % 1_000_000 == 0, shown("")).when(micros % 1000 == 0, shown(".SSS")).otherwise(shown(".SSSSSS"))


def rfc3339(ts: Column) -> Column:
    """2026-02-25T10:00:00+00:00, with as many of 0, 3 or 6 fractional digits as needed."""
    return _stamp(ts, "xxx")


def rfc3339_z(ts: Column) -> Column:
    """The same with Z, as in serialised events."""
    return _stamp(ts, "XXX")


#: What a timestamp must look like before Spark's more lenient parser sees it.
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def parse_rfc3339(text: Column) -> Column:
    return F.when(text.rlike(RFC3339), F.try_to_timestamp(F.upper(text)))


def debug_string(text: Column) -> Column:
    """A quoted string with backslash escapes, as in debug output of lists."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), text, F.lit('"'))


def debug_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def format_bytes(n: Column) -> Column:
    """B, KiB, MiB or GiB; two decimals, rounded half to even, above bytes."""
    scaled = lambda power, unit: F.format_string(f"%.2f {unit}", F.bround(n / float(1024**power), 2))
    return F.when(n >= 1024**3, scaled(3, "GiB")).when(n >= 1024**2, scaled(2, "MiB")).when(n >= 1024, scaled(1, "KiB")).otherwise(F.concat(n.cast("string"), F.lit(" B")))


def semver(text: Column) -> Column:
    """(major, minor, patch) of a version, what follows a hyphen left out; parts that are missing or no numbers are 0."""
    parts = F.split(F.substring_index(F.regexp_replace(F.trim(text), "^v+", ""), "-", 1), r"\.")
    part = lambda k, name: F.coalesce(F.get(parts, F.lit(k)).try_cast("bigint"), F.lit(0)).alias(name)
    return F.struct(part(0, "major"), part(1, "minor"), part(2, "patch"))


def is_newer(candidate: Column, current: Column) -> Column:
    return semver(candidate) > semver(current)


def wrap_int32(n: Column) -> Column:
    """The low 32 bits of a long, sign extended."""
    low = n.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    return F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int")
