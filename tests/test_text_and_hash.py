"""Text, time and hash functions against literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from episodica.functions import text as tx
from episodica.functions.blake3 import content_digest, digests, first_byte


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("length", "digest"),
    [
        (0, "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262"),
        (1, "2d3adedff11b61f14c886e35afa036736dcd87a74d27b5c1510225d0f592e213"),
        (1024, "42214739f095a406f3fc83deb889744ac00df831c10daa55189b5d121c855af7"),
        (1025, "d00278ae47eb27b34faecf67b4fe263f82d5412916c1ffd97c8cb7fb814b8444"),
        (2048, "e776b6028c7cd22a4d0ba182a8bf62205d2ef576467e838ed6f2529b85fba24a"),
    ],
)
def test_blake3_published_vectors(length, digest):
    assert digests([bytes(i % 251 for i in range(length))]) == [digest]


def test_blake3_batches_agree_with_single_messages():
    messages = [bytes([n % 256]) * n for n in (0, 5, 64, 65, 1023, 3000, 9000)]
    assert digests(messages) == [digests([m])[0] for m in messages]


def test_digest_profiles(spark):
    assert one(spark, content_digest(F.col("x")), x="abc") == "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85"
    assert one(spark, first_byte(content_digest(F.col("x"), "sha256")), x="abc") == 0xBA
    with pytest.raises(ValueError):
        content_digest(F.lit("x"), "md4")


def test_preview_counts_characters_after_compacting(spark):
    assert one(spark, tx.preview(F.col("x"), 3), x="  é b \n cd ") == "é b..."
    assert one(spark, tx.preview(F.col("x"), 9), x=" a  b ") == "a b"


def test_blank_is_unicode_aware(spark):
    assert one(spark, tx.blank(F.col("x")), x="  \n")
    assert not one(spark, tx.blank(F.col("x")), x=" .")


def test_normalize_text(spark):
    assert one(spark, tx.normalize_text(F.col("x")), x="\n a  \r\nb\t\n\n") == "a\nb"


@pytest.mark.parametrize(("micros", "shown"), [(0, "10:00:00+00:00"), (120_000, "10:00:00.120+00:00"), (1, "10:00:00.000001+00:00")])
def test_rfc3339_widths(spark, micros, shown):
    ts = dt.datetime(2026, 2, 25, 10, 0, 0, micros, tzinfo=dt.UTC)
    assert one(spark, tx.rfc3339(F.col("x")), x=ts) == f"2026-02-25T{shown}"
    assert one(spark, tx.rfc3339_z(F.col("x")), x=ts).endswith("Z")


def test_rfc3339_parse_is_strict(spark):
    assert one(spark, tx.parse_rfc3339(F.col("x")), x="2026-02-25") is None
    assert one(spark, tx.parse_rfc3339(F.col("x")), x="2026-02-25T10:00:00+01:00") == dt.datetime(2026, 2, 25, 9, 0)


@pytest.mark.parametrize(("n", "shown"), [(12, "12 B"), (1536, "1.50 KiB"), (1152, "1.12 KiB"), (10_810_412, "10.31 MiB"), (3 << 30, "3.00 GiB")])
def test_format_bytes(spark, n, shown):
    assert one(spark, tx.format_bytes(F.col("x")), x=n) == shown


def test_versions(spark):
    assert one(spark, tx.is_newer(F.col("x"), F.lit("0.9.10")), x="v0.10.0")
    assert not one(spark, tx.is_newer(F.col("x"), F.lit("0.9.10")), x="nonsense")


@pytest.mark.parametrize(("n", "wrapped"), [(1, 1), (-1, -1), (2**31, -(2**31)), (2**32 + 5, 5)])
def test_wrap_int32(spark, n, wrapped):
    assert one(spark, tx.wrap_int32(F.col("x").cast("bigint")), x=n) == wrapped


def test_debug_string(spark):
    assert one(spark, tx.debug_string(F.col("x")), x='a"b\\c\n') == '"a\\"b\\\\c\\n"'


def test_staged_tables_can_be_cleared(spark):
    from pathlib import Path

    from episodica.functions import staging

    one, two = staging.materialize(spark.range(3), "one"), staging.materialize(spark.range(4), "two")
    assert one.count() + two.count() == 7
    staging.discard(one)
    assert not Path(one._staged).exists() and Path(two._staged).exists()
    staging.clear(spark)
    assert not Path(two._staged).exists()
