from shelfwise.llm.common import table


def test_a_reader_decodes_few_rows_of_texts_at_once(spark, tmp_path):
    spark.range(3000).selectExpr("id AS doc_id", "repeat('x', 10) AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    plan = table(spark, str(tmp_path), "documents")._jdf.queryExecution()
    assert plan.toRdd().count() == 3000
    batches = plan.executedPlan().children().head().metrics().apply("numInputBatches").value()
    assert batches >= 3000 / 512
