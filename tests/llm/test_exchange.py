"""The exchange of items between blocks and parts: any depth gives the same, and rows for a block are bounded."""

import random

import public_tokenizers
import pytest
from data import documents
from pyspark.sql import functions as F

from episodica.llm import blocks as bl
from episodica.llm import bpe, lm
from episodica.llm.queries import BPE_VOCABULARY

SIZES = [{}, {"part_items": 40, "fan": 3, "merge": 50}, {"part_items": 5, "fan": 4, "merge": 1}]


@pytest.mark.parametrize("sizes", SIZES)
def test_depths_agree(spark, sizes):
    docs = documents(spark)
    whole = lambda df: sorted(map(str, df.collect()))
    encode = lambda **more: whole(bpe.encode(docs, BPE_VOCABULARY, public_tokenizers.PATTERN, 4000, True, **more))
    assert encode(**sizes) == encode()
    score = lambda **more: whole(lm.score(docs, shard_bytes=20_000, **more).drop("score"))
    assert score(**sizes) == score()


def test_rows_of_a_block_are_bounded(spark):
    """Ten times the blocks, as many rows for each, of a bounded size."""
    rnd = random.Random(3)
    found = {}
    for blocks in (4, 40):
        docs = spark.createDataFrame([(k, " ".join(f"w{rnd.randrange(3000)}" for _ in range(300))) for k in range(blocks)], "doc_id long, text string").repartition(2)
        packed = bl.pack(docs, bl.SpaceBuilder, 1)
        assert packed.count() == blocks
        exchange = bl.Exchange.of(packed, part_items=100, fan=8, merge=400)
        sent = exchange.send_words(packed)
        rows = sent.count()
        items = sent.select(F.col("counts")).rdd.map(lambda r: int(bl.unsqueeze(r[0]).sum())).collect()
        assert sum(items) == exchange.items and max(items) <= 400 + 300
        found[blocks] = (exchange.deep, rows / blocks)
    assert found[40][0] and found[40][1] <= max(found[4][1], 3 * 8)


def test_scores_do_not_depend_on_partitions(spark):
    docs = documents(spark)
    rows = lambda df: sorted(map(str, lm.score(df, shard_bytes=5_000).collect()))
    assert rows(docs.repartition(1)) == rows(docs.repartition(5))


def test_answers_come_back_to_their_items():
    import numpy as np

    items = bl.Items(np.array([7, 7, 9, 9, 9]), np.arange(5, dtype=np.uint32), [b"a", b"b", b"a", b"c", b""], np.arange(5))
    rows = bl.cut(items, np.array([1, 0, 1, 1, 0]))
    assert [r[0] for r in rows] == [0, 1]
    back = bl.joined([bl.unpack(r[2:]) for r in rows])
    assert sorted(zip(back.block.tolist(), back.idx.tolist(), back.words, back.n.tolist(), strict=True)) == [(7, 0, b"a", 0), (7, 1, b"b", 1), (9, 2, b"a", 2), (9, 3, b"c", 3), (9, 4, b"", 4)]
    answers = bl.Items(np.array([1, 1, 2]), np.arange(3, dtype=np.uint32), lens=np.array([2, 0, 1]), vals=np.array([5, 6, 7]))
    turned = answers.take(np.array([2, 1, 0]))
    assert turned.lens.tolist() == [1, 0, 2] and turned.vals.tolist() == [7, 5, 6]


def test_an_id_beyond_the_vocabulary_is_an_error(spark):
    from array import array

    encoded = spark.createDataFrame([(1, 1, bytearray(array("I", [4_000_000]).tobytes()))], bpe.SCHEMA)
    with pytest.raises(Exception, match="vocabulary lacks"):
        bpe.decode(encoded, BPE_VOCABULARY).collect()
