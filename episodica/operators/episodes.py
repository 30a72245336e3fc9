"""Episodes: turn windows over sessions, their summaries or raw content, the residual gate, and derived records."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.blake3 import content_digest
from episodica.functions.text import blank, debug_list, debug_string, preview, rfc3339, role_of
from episodica.operators.redact import is_sensitive

#: Events of a window at most.
WINDOW_EVENTS = 300
LOW_SIGNAL = ("event_msg", "turn_context", "session_meta")
REPLIES = ("assistant_msg", "response_item")


def is_turn_boundary(kind: Column, text: Column) -> Column:
    return (kind == "turn_context") | ((kind == "user_msg") & ~blank(text))


def with_windows(events: DataFrame, max_events: int = WINDOW_EVENTS) -> DataFrame:
    """events with turn and part: a window ends before a turn boundary, or when it holds max_events (at least 50).

    Both are running expressions over one partitioning and order (path, seq), so Spark shuffles and sorts once. An event before
    the first boundary is in turn 0, which needn't exist.
    """
    order = W.partitionBy("path").orderBy("seq")
    turn = F.sum(F.coalesce(is_turn_boundary(F.col("kind"), F.col("text")), F.lit(False)).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))
    return with_parts(events.withColumn("turn", turn.cast("bigint")), max_events)


def with_parts(events: DataFrame, max_events: int = WINDOW_EVENTS) -> DataFrame:
    """events that have turn, with part."""
    place = F.row_number().over(W.partitionBy("path", "turn").orderBy("seq"))
    return events.withColumn("part", F.floor((place - 1) / max(max_events, 50)).cast("bigint"))


def collect_windows(events: DataFrame, max_events: int = WINDOW_EVENTS, in_turns: bool = False) -> DataFrame:
    """path, turn, part, session_id (that of the path's first event, for all its windows) and ev: the window's events in order.

    A window holds at most max_events events, so its array is bounded. in_turns: events have turn and the path's session_id already.
    """
    first = F.first("session_id").over(W.partitionBy("path").orderBy("seq"))
    step = F.struct("seq", "ts", "kind", "text", "tool", "meta")
    windows = with_parts(events, max_events) if in_turns else with_windows(events.withColumn("session_id", first), max_events)
    return windows.groupBy("path", "turn", "part").agg(F.first("session_id").alias("session_id"), F.array_sort(F.collect_list(step)).alias("ev"))


# ---- expressions over a window's events ------------------------------------------------------------------------------


def _of(ev: Column, test) -> Column:
    return F.filter(ev, test)


def _count(ev: Column, test) -> Column:
    return F.size(F.filter(ev, test)).cast("string")


def _replies(e: Column) -> Column:
    return e["kind"].isin(*REPLIES)


def _meaningful(e: Column) -> Column:
    return ~e["kind"].isin(*LOW_SIGNAL) | ~blank(e["text"])


def _first_text(events: Column) -> Column:
    return F.coalesce(F.get(events, F.lit(0))["text"], F.lit(""))


def _last_text(events: Column) -> Column:
    return F.coalesce(F.try_element_at(events, F.lit(-1))["text"], F.lit(""))


def raw_prompt(ev: Column) -> Column:
    return _first_text(_of(ev, lambda e: e["kind"] == "user_msg"))


def raw_result(ev: Column) -> Column:
    return _last_text(_of(ev, _replies))


def raw_context(ev: Column) -> Column:
    texts = lambda kind: F.transform(_of(ev, lambda e: e["kind"] == kind), lambda e: e["text"])
    part = lambda label, items: F.when(F.size(items) > 0, F.concat(F.lit(f"{label}: "), F.array_join(items, " | ")))
    return F.concat_ws("\n", part("errors", texts("error")), part("system", F.slice(texts("system"), 1, 5)))


def raw_trace(ev: Column) -> Column:
    return F.transform(ev, lambda e: F.struct(role_of(e["kind"]).alias("role"), e["text"].alias("content"), e["tool"]["name"].alias("name"), rfc3339(e["ts"]).alias("ts")))


def tool_names(ev: Column) -> Column:
    return F.transform(_of(ev, lambda e: e["tool"]["name"].isNotNull()), lambda e: e["tool"]["name"])


def histogram(ev: Column) -> Column:
    """The kinds in order with their counts, in debug notation."""
    kinds = F.transform(ev, lambda e: e["kind"])
    pairs = F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.concat(debug_string(k), F.lit(": "), F.size(F.filter(kinds, lambda x: x == k)).cast("string")))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def _summary(label: str, chosen: Column, chars: int, otherwise: Column) -> Column:
    """label and the start of the chosen text, unless there is none or that is sensitive."""
    shown = F.concat(F.lit(f"{label}: "), preview(chosen, chars))
    return F.when(chosen.isNotNull() & ~is_sensitive(shown), shown).otherwise(otherwise)


def summary_prompt(ev: Column) -> Column:
    asked = F.get(_of(ev, lambda e: (e["kind"] == "user_msg") & ~blank(e["text"])), F.lit(0))["text"]
    counted = F.concat(F.lit("summary: user_messages="), _count(ev, lambda e: e["kind"] == "user_msg"), F.lit(" meaningful_events="), _count(ev, _meaningful), F.lit(" (raw prompt omitted)"))
    return _summary("summary_user_prompt", asked, 220, counted)


def summary_result(ev: Column) -> Column:
    said = F.try_element_at(_of(ev, lambda e: _replies(e) & ~blank(e["text"])), F.lit(-1))["text"]
    counted = F.concat(F.lit("summary: assistant_messages="), _count(ev, _replies), F.lit(" error_events="), _count(ev, lambda e: e["kind"] == "error"), F.lit(" (raw result omitted)"))
    return _summary("summary_assistant_result", said, 260, counted)


def summary_context(ev: Column) -> Column:
    tools = F.transform(F.array_sort(F.array_distinct(tool_names(ev))), debug_string)
    codes = F.transform(_of(ev, lambda e: e["meta"]["exit_code"].isNotNull()), lambda e: e["meta"]["exit_code"].cast("string"))
    parts = ["summary: tools=", debug_list(tools), " exit_codes=", debug_list(codes), " events_by_kind=", histogram(ev), " error_events=", _count(ev, lambda e: e["kind"] == "error")]
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def duration_seconds(ev: Column) -> Column:
    """Whole seconds from the first event to the last by position, not below zero."""
    micros = F.unix_micros(F.try_element_at(ev, F.lit(-1))["ts"]) - F.unix_micros(F.get(ev, F.lit(0))["ts"])
    return F.greatest(F.lit(0), F.floor(micros / 1_000_000)).cast("bigint")


def summary_trace(ev: Column) -> Column:
    def step(role: Column, content: Column, name: Column, ts: Column) -> Column:
        return F.struct(role.alias("role"), content.alias("content"), name.alias("name"), ts.alias("ts"))

    start = rfc3339(F.get(ev, F.lit(0))["ts"])
    nobody, system = F.lit(None).cast("string"), F.lit("system")
    totals = F.concat(F.lit("summary: total_events="), F.size(ev).cast("string"), F.lit(" duration_secs="), duration_seconds(ev).cast("string"), F.lit(" source_kinds_compacted=true"))
    kinds = F.concat(F.lit("summary: by_kind="), histogram(ev))
    size = lambda text: F.coalesce(F.octet_length(text), F.lit(0)).cast("string")

    def shown(e: Column) -> Column:
        parts = ["summary_event: kind=", e["kind"], " chars=", size(e["text"]), " tool_args_bytes=", size(e["tool"]["args_json"]), " tool_result_bytes=", size(e["tool"]["result_json"]), ' preview="', preview(e["text"], 140), '"']
        return step(role_of(e["kind"]), F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)), e["tool"]["name"], rfc3339(e["ts"]))

    head = F.array(step(system, totals, nobody, start), step(system, kinds, nobody, start))
    return F.concat(head, F.transform(F.slice(_of(ev, _meaningful), 1, 10), shown))


# ---- records ---------------------------------------------------------------------------------------------------------

DEFAULTS = {"source_tool": "manual_scan", "accepted_at": "", "consent_version": "", "license": "CC0-1.0", "policy_version": "", "sanitizer_version": "", "os": "linux"}


def build_episodes(events: DataFrame, include_raw: bool = False, profile: str = "blake3", gate: bool = True, max_events: int = WINDOW_EVENTS, in_turns: bool = False, **constants: str) -> DataFrame:
    """One episode record for each window of events, with path, turn and part before its 16 fields.

    With include_raw the prompt, context, trace and result are the texts themselves, else summaries. Episodes whose prompt, context
    or result still look sensitive are dropped by the gate (the trace isn't looked at). content_hash covers the compact JSON of
    seven fields with sorted keys; the id is derived from it.
    """
    given = DEFAULTS | constants
    ev = F.col("ev")
    windows = collect_windows(events, max_events, in_turns)
    if include_raw:
        content = {"prompt": raw_prompt(ev), "context": raw_context(ev), "trace": raw_trace(ev), "result": raw_result(ev)}
    else:
        content = {"prompt": summary_prompt(ev), "context": summary_context(ev), "trace": summary_trace(ev), "result": summary_result(ev)}
    rows = windows.withColumns(
        content
        | {
            "source_tool": F.lit(given["source_tool"]),
            "ts_start": rfc3339(F.get(ev, F.lit(0))["ts"]),
            "ts_end": rfc3339(F.try_element_at(ev, F.lit(-1))["ts"]),
        }
    )
    if gate:
        # summaries show only what was found clean, and their other forms are counts
        looked_at = ("prompt", "context", "result") if include_raw else ("context",)
        rows = rows.filter(~reduce(or_, (is_sensitive(F.col(c)) for c in looked_at)))
    steps = F.transform("trace", lambda s: F.struct(s["content"].alias("content"), s["name"].alias("name"), s["role"].alias("role"), s["ts"].alias("ts")))
    preimage = F.to_json(F.struct("prompt", "result", "session_id", "source_tool", steps.alias("trace"), "ts_end", "ts_start"), {"ignoreNullFields": "false"})
    rows = rows.withColumn("content_hash", content_digest(preimage, profile))
    rows = rows.withColumn("id", content_digest(F.concat(F.lit("episode|"), F.col("content_hash")), profile))
    errors = F.transform(_of(ev, lambda e: e["kind"] == "error"), lambda e: e["kind"])
    code = F.try_element_at(_of(ev, lambda e: e["meta"]["exit_code"].isNotNull()), F.lit(-1))["meta"]["exit_code"]
    unknown, text = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    signals = F.struct(unknown.alias("tests_passed"), code.alias("exit_code"), unknown.alias("lint_fixed"))
    meta = F.struct(text.alias("lang"), tool_names(ev).alias("tool_names"), errors.alias("error_types"), text.alias("repo_fingerprint"), F.lit(given["os"]).alias("os"), text.alias("editor"), F.lit(include_raw).alias("raw_content_included"))
    consent = F.struct(F.lit(given["accepted_at"]).alias("accepted_at"), F.lit(given["consent_version"]).alias("consent_version"), F.lit(True).alias("public_searchable"), F.lit(True).alias("trainable"))
    return rows.select(
        "path", "turn", "part", "id", "source_tool", "session_id", "ts_start", "ts_end", "prompt", "context", "trace", "result",
        F.struct((F.size(errors) == 0).alias("success"), signals.alias("signals")).alias("outcome"),
        meta.alias("meta"), consent.alias("consent"), F.lit(given["license"]).alias("license"),
        F.lit(given["policy_version"]).alias("policy_version"), F.lit(given["sanitizer_version"]).alias("sanitizer_version"), "content_hash",
    )


RECORD = "id source_tool session_id ts_start ts_end prompt context trace result outcome meta consent license policy_version sanitizer_version content_hash".split()


def derive_sft(episodes: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Instruction records; keys are columns of episodes that stand before them."""
    return episodes.select(*keys, "id", F.col("prompt").alias("instruction"), F.col("context").alias("input"), F.col("result").alias("output"), "meta", "license", "consent")


def derive_tooltrace(episodes: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    messages = F.transform("trace", lambda s: F.struct(s["role"].alias("role"), s["content"].alias("content"), s["name"].alias("name")))
    return episodes.select(*keys, "id", messages.alias("messages"), "meta", "license", "consent")
