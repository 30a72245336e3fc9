"""Driver tables as canonical events, and the ordering that all session operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOOL = T.StructType([T.StructField("name", T.StringType()), T.StructField("args_json", T.StringType()), T.StructField("result_json", T.StringType())])
META = T.StructType(
    [
        T.StructField("cwd", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("exit_code", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)
#: A canonical event; path and seq say where it stands, since order is positional throughout.
EVENT = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("tool", TOOL),
        T.StructField("meta", META),
        T.StructField("ts_inferred", T.BooleanType()),
    ]
)


def _shape(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT.fields))


def from_conversations(conversations: DataFrame) -> DataFrame:
    """A session for each conversation, an event for each turn; ts is a fixed day plus a second a turn."""
    kind = F.when(F.col("role") == "user", "user_msg").when(F.col("role") == "assistant", "assistant_msg").otherwise("system")
    return _shape(
        conversations.select(
            F.col("conv_id").cast("string").alias("path"),
            F.col("turn").alias("seq"),
            F.lit("conversations").alias("source"),
            F.col("conv_id").cast("string").alias("session_id"),
            F.timestamp_seconds(F.lit(1_767_225_600) + F.col("turn")).alias("ts"),
            kind.alias("kind"),
            F.col("text"),
            F.lit(None).alias("tool"),
            F.lit(None).alias("meta"),
            F.lit(False).alias("ts_inferred"),
        )
    )


def from_activity(events: DataFrame) -> DataFrame:
    """A session for each user of the events table. Purchases are calls of a tool, sign-ups open a turn, errors are errors."""
    kind = (
        F.when(F.col("event_type") == "signup", "user_msg")
        .when(F.col("event_type") == "purchase", "tool_call")
        .when(F.col("event_type") == "view", "assistant_msg")
        .when(F.col("event_type") == "error", "error")
        .otherwise("event_msg")
    )
    code = F.get_json_object("props", "$.k").cast("int")
    is_tool = F.col("event_type") == "purchase"
    tool = F.when(is_tool, F.struct(F.concat(F.lit("shop"), (code % 3).cast("string")).alias("name"), F.col("props").alias("args_json"), F.lit(None).cast("string").alias("result_json")))
    none = F.lit(None).cast("string")
    meta = F.struct(none.alias("cwd"), none.alias("repo"), F.when(F.col("event_type").isin("error", "purchase"), code).alias("exit_code"), none.alias("model"), F.array().cast("array<string>").alias("tags"))
    return _shape(
        events.select(
            F.col("user_id").cast("string").alias("path"),
            F.col("event_id").alias("seq"),
            F.lit("activity").alias("source"),
            F.col("user_id").cast("string").alias("session_id"),
            F.col("ts"),
            kind.alias("kind"),
            F.concat_ws(" ", "event_type", F.format_string("%.2f", "value")).alias("text"),
            tool.alias("tool"),
            meta.alias("meta"),
            F.lit(False).alias("ts_inferred"),
        )
    )
