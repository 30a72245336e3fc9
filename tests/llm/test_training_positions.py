"""Training reaches every position of a text."""

from episodica.llm import lm


def test_every_position_is_learned_from(spark):
    """Texts of 16 positions: a stride of 8 or 16 always meets the same ones."""
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(15))) for k in range(3000)], "doc_id long, text string")
    got = lm.score(docs).filter("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert got[0] > 0.5 * got[1]
