"""Redaction of secrets and personal data, the residual detector, and the report."""

from __future__ import annotations

import json
import re
import shutil
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce
from operator import or_
from pathlib import Path, PurePath

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.ship import ship_package


@dataclass(frozen=True)
class Rule:
    """pattern is the rule. LINEAR has another form of some, which matches the same spans in time linear in the text."""

    name: str
    pattern: str
    replacement: str
    counter: str


# The redaction rules in their order of application.
RULES = (
    Rule("token", r"""(?i)(api[_-]?key|access[_-]?key|token|secret|authorization|password|passwd)\s*[:=]\s*[^\s,"']+""", "$1=[REDACTED]", "secret"),
    Rule("bearer", r"(?i)\b(authorization:?\s*bearer)\s+[A-Za-z0-9\-._~+/=]{8,}", "$1 [REDACTED]", "secret"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\b", "[REDACTED_JWT]", "secret"),
    Rule("pem", r"(?s)-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----.*?-----END [A-Z0-9 ]*PRIVATE KEY-----", "[REDACTED_PEM]", "secret"),
    Rule("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[REDACTED_EMAIL]", "email"),
    Rule("ip", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[REDACTED_IP]", "ip"),
    Rule("path", r"(?i)(?:/Users/[^/\s]+|/home/[^/\s]+|/root/[^/\s]*|[A-Za-z]:[\\/](?:[^\\/\s]+[\\/])*[^\\/\s]+)", "[REDACTED_PATH]", "path"),
    Rule("user_host", r"\b[A-Za-z0-9._-]{2,32}@[A-Za-z0-9._-]{2,64}\b", "[REDACTED_USERHOST]", "secret"),
    Rule("host_assignment", r"(?i)\b(hostname|host|user|username)\s*[:=]\s*([A-Za-z0-9._-]{2,64})", "$1=[REDACTED_USERHOST]", "secret"),
    Rule("url_query", r"(https?://[^\s?]+)\?[^\s]+", "$1?[REDACTED_QUERY]", "secret"),
)
ENTROPY_REPLACEMENT = "[REDACTED_ENTROPY]"
# The markers that the detector overlooks.
MARKERS = (
    "[REDACTED]", "[REDACTED_EMAIL]", "[REDACTED_IP]", "[REDACTED_PATH]", "[REDACTED_QUERY]",
    "[REDACTED_GITLEAKS]", "[REDACTED_JWT]", "[REDACTED_PEM]", "[REDACTED_USERHOST]", "[REDACTED_ENTROPY]",
)
COUNTERS = ("secret", "email", "ip", "path")

# A whole token between white space: 24 of the charset with an upper, a lower and a digit, or 32; not all hexadecimal.
ENTROPY = (
    r"(?U)(?<!\S)(?![0-9A-Fa-f]+(?!\S))(?:(?=\S*[A-Z])(?=\S*[a-z])(?=\S*[0-9])[A-Za-z0-9_~+/=\-]{24,}|[A-Za-z0-9_~+/=\-]{32,})(?!\S)"
)
#: What a token of high entropy needs at least.
ENTROPY_RUN = r"[A-Za-z0-9_~+/=\-]{24}"
DETECTOR_SEPARATORS = r"""(?U)[\s"',;()\[\]]+"""

#: Explicit opt-in beyond the default rules: quoted secrets, and bearer tokens that follow a redacted header.
STRICT_RULES = (
    Rule("quoted_secret", r"""(?i)\b(api[_-]?key|access[_-]?key|token|secret|password|passwd)\s*[:=]\s*("[^"\n]+"|'[^'\n]+')""", "$1=[REDACTED]", "secret"),
    Rule("bearer_rest", r"(?i)(authorization=\[REDACTED\])\s+[A-Za-z0-9\-._~+/=]{8,}", "$1", "secret"),
)


def rule_pack(name: str = "default") -> tuple[Rule, ...]:
    if name == "default":
        return RULES
    if name == "strict":
        return (STRICT_RULES[0], RULES[0], STRICT_RULES[1], *RULES[1:])
    raise ValueError(f"unknown rule pack: {name}")


_EMAIL_CHAR, _JWT_CHAR = "[A-Za-z0-9._%+-]", "[A-Za-z0-9_-]"
_PEM_BEGIN = "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"

#: By rule: a form without retries, and its replacement. A run of characters that fails once is left at once: a match begins at the
#: run's first candidate (found in an atomic group, and put back by the replacement), as all candidates of a run end alike. \\G
#: stands for a run whose beginning the match before took. Loops are possessive, so that the stack doesn't grow with the text.
LINEAR = {
    "jwt": (rf"(?:(?<!{_JWT_CHAR})|\G)(?>({_JWT_CHAR}*?)\beyJ){_JWT_CHAR}{{8,}}+\.{_JWT_CHAR}{{8,}}+\.{_JWT_CHAR}{{8,}}\b", "$1[REDACTED_JWT]"),
    "pem": (rf"(?s)\G(?>(.*?)(?={_PEM_BEGIN})){_PEM_BEGIN}.*?-----END [A-Z0-9 ]*PRIVATE KEY-----", "$1[REDACTED_PEM]"),
    "email": (rf"(?:(?<!{_EMAIL_CHAR})|\G)(?>({_EMAIL_CHAR}*?)\b){_EMAIL_CHAR}++@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}\b", "$1[REDACTED_EMAIL]"),
    "path": (r"(?i)(?:/Users/[^/\s]+|/home/[^/\s]+|/root/[^/\s]*|[A-Za-z]:[\\/][^\\/\s]++(?:[\\/][^\\/\s]++)*+)", "[REDACTED_PATH]"),
    "url_query": (r"(?<![^\s?])((?>[^\s?]*?https?://)[^\s?]++)\?\S++", "$1?[REDACTED_QUERY]"),
}
#: By rule: texts one of which must occur for a match. Looking for them is far cheaper than the pattern.
NEEDS = {
    "token": (":", "="), "quoted_secret": (":", "="), "bearer_rest": ("=",), "jwt": ("eyJ",), "pem": ("-----BEGIN ",), "email": ("@",),
    "ip": (".",), "path": ("/", "\\"), "user_host": ("@",), "host_assignment": (":", "="), "url_query": ("://",),
}


def java(pattern: str) -> str:
    """The pattern with Unicode classes, word boundaries and case folding."""
    return f"(?U){pattern}"


def scan_form(rule: Rule) -> tuple[str, str]:
    """The pattern by which Spark looks for a rule, and its replacement."""
    pattern, replacement = LINEAR.get(rule.name, (rule.pattern, rule.replacement))
    return java(pattern), replacement


def may_match(rule: Rule, text: Column) -> Column:
    """Whether text holds what a match of the rule needs."""
    found = [text.contains(part) for part in NEEDS.get(rule.name, ())]
    return reduce(or_, found) if found else F.lit(True)


def is_high_entropy(token: Column) -> Column:
    mixed = token.rlike("[A-Z]") & token.rlike("[a-z]") & token.rlike("[0-9]")
    return (F.octet_length(token) >= 24) & ~token.rlike(r"^[0-9A-Fa-f]*$") & token.rlike(r"^[A-Za-z0-9_~+/=\-]*$") & (mixed | (F.octet_length(token) >= 32))


def has_high_entropy_token(text: Column) -> Column:
    """Cheap necessary test first: 24 characters of the charset in a row."""
    return text.rlike(ENTROPY_RUN) & F.exists(F.split(text, DETECTOR_SEPARATORS), is_high_entropy)


def is_sensitive(text: Column) -> Column:
    """The residual detector: markers are deleted first, then any rule or high-entropy token that is left counts."""
    clean = text
    for marker in MARKERS:
        clean = F.replace(clean, F.lit(marker), F.lit(""))
    clean = F.when(text.contains("[REDACTED"), clean).otherwise(text)
    tests = lambda t: [may_match(rule, t) & t.rlike(scan_form(rule)[0]) for rule in RULES]
    # one element: so the text without markers is computed once for all tests
    return F.exists(F.array(clean), lambda t: reduce(or_, tests(t)) | has_high_entropy_token(t))


def redacted(text: Column, pack: str = "default") -> Column:
    """The text after all rules and the entropy rule, as one expression."""
    for rule in rule_pack(pack):
        text = F.regexp_replace(text, *scan_form(rule))
    return F.regexp_replace(text, ENTROPY, ENTROPY_REPLACEMENT)


def _once(column: str, f: Callable[[Column], Column]) -> Column:
    """f of a column that is named only once, so that filters pushed through many projections don't multiply it."""
    return F.transform(F.array(column), f)[0]


def redact(df: DataFrame, column: str = "text", pack: str = "default") -> DataFrame:
    """df with column redacted, and n_secret, n_email, n_ip, n_path, n_total.

    Each count is taken on the text as the rule before left it, so one span can count twice. One projection for each rule keeps
    Catalyst from nesting the counts; a null text stays null and counts nothing.
    """
    counts: dict[str, list[Column]] = {name: [] for name in COUNTERS}
    taken = [(*scan_form(rule), rule.counter, partial(may_match, rule)) for rule in rule_pack(pack)]
    taken.append((ENTROPY, ENTROPY_REPLACEMENT, "secret", lambda t: t.rlike(ENTROPY_RUN)))
    for k, (pattern, replacement, counter, needed) in enumerate(taken):
        hit = f"__n{k}"
        count = _once(column, lambda t: F.when(needed(t), F.regexp_count(t, F.lit(pattern))).otherwise(0))  # noqa: B023
        clean = _once(column, lambda t: F.when(needed(t), F.regexp_replace(t, pattern, replacement)).otherwise(t))  # noqa: B023
        df = df.withColumns({hit: count, column: clean})
        counts[counter].append(F.col(hit))
    total = {f"n_{name}": sum(cols[1:], cols[0]).cast("bigint") for name, cols in counts.items()}
    df = df.withColumns(total | {"n_total": sum((F.col(f"__n{k}") for k in range(1, len(taken))), F.col("__n0")).cast("bigint")})
    return df.drop(*(f"__n{k}" for k in range(len(taken))))


def report(redacted_df: DataFrame) -> DataFrame:
    """One row of totals over the output of redact()."""
    return redacted_df.agg(*(F.coalesce(F.sum(f"n_{name}"), F.lit(0)).alias(f"{name}_redactions") for name in ("total", *COUNTERS)))


def samples(before: DataFrame, after: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first n changed texts by order (which must identify rows)."""
    old = before.select(*order, F.col("text").alias("__old"))
    return after.join(old, order).filter("text <> __old").orderBy(*order).limit(n).select(*order, "text")


def find_scanner(name: str = "gitleaks") -> Callable[[list[str]], list[list[str]]] | None:
    """The outside secret scanner of that name on the path, as a function for apply_scanner; None where there is none."""
    program = shutil.which(name)
    return partial(scan_with, program) if program else None


def scan_with(program: str, texts: list[str]) -> list[list[str]]:
    """The secrets that the program reports for each text. It reads files, which are gone when it has ended."""
    found: list[list[str]] = [[] for _ in texts]
    with tempfile.TemporaryDirectory() as folder:
        for k, text in enumerate(texts):
            (Path(folder) / f"event-{k}.txt").write_text(text)
        report = Path(folder) / "report.json"
        subprocess.run([program, "detect", "--no-git", "--source", folder, "--report-format", "json", "--report-path", str(report)], capture_output=True, check=False)
        # it ends with an error where it found something, so only the report counts
        listed = json.loads(report.read_text() or "[]") if report.exists() else []
    for finding in listed:
        m = re.fullmatch(r"event-(\d+)\.txt", PurePath(finding.get("File") or "").name)
        if m and int(m[1]) < len(texts) and finding.get("Secret"):
            found[int(m[1])].append(finding["Secret"])
    return found


def apply_scanner(df: DataFrame, scan: Callable[[list[str]], list[list[str]]] | None, column: str = "text") -> DataFrame:
    """df after an outside secret scanner: scan(texts) gives for each text the secrets it reports, each of which is replaced wherever
    it stands, and counts once in n_secret and n_total where df has these. Without a scanner df stays; a scanner's failures leave
    texts as they are."""
    if scan is None:
        return df
    counters = [c for c in ("n_secret", "n_total") if c in df.columns]

    def rows(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index(column)).to_pylist()
            try:
                found = scan([t or "" for t in texts])
            except Exception:  # noqa: BLE001  an outside tool's failure must not stop the run
                found = [[] for _ in texts]
            hits = [0] * len(texts)
            for k, secrets in enumerate(found):
                for secret in secrets:
                    if secret and texts[k] and secret in texts[k]:
                        texts[k] = texts[k].replace(secret, "[REDACTED_GITLEAKS]")
                        hits[k] += 1
            fresh = {column: pa.array(texts, pa.string())} | {c: pc.add(batch.column(batch.schema.names.index(c)), pa.array(hits, pa.int64())) for c in counters}
            yield pa.RecordBatch.from_arrays([fresh.get(name, batch.column(i)) for i, name in enumerate(batch.schema.names)], batch.schema.names)

    ship_package(df.sparkSession)
    return df.mapInArrow(rows, df.schema)
