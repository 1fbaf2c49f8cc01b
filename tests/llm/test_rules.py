"""The target of op3_rules."""

from spanloom.llm import queries


def test_every_trusted_document_counts(spark, tmp_path):
    rows = 20_100
    ids = spark.range(rows).withColumnRenamed("id", "doc_id")
    ids.selectExpr("doc_id", "concat('word', doc_id) AS text").write.parquet(f"{tmp_path}/documents.parquet")
    ids.selectExpr("doc_id", "1 AS quality").write.parquet(f"{tmp_path}/labels.parquet")
    scores = {r["score"] for r in queries.op3_rules(spark, str(tmp_path)).select("score").distinct().collect()}
    assert scores == {0.0}  # target and corpus are the same
