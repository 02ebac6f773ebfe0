"""The pipeline keeps clean documents and drops copies on a small folder of tables."""

import corpus_pipeline


def test_stages(spark, tmp_path):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    rows = [(1, text, "en", "a", len(text)), (2, text, "en", "b", len(text)), (3, "a clean line of words", "en", "a", 21), (4, None, "en", "a", 0), (5, "12 34", "en", "a", 5)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = corpus_pipeline.stored(out, name)
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 3]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, 3}


def test_rows_that_share_an_id_stay(spark, tmp_path):
    """Unlinked texts of one id are documents of their own; linked rows go, whatever their ids."""
    a, b = (" ".join(f"{p}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) for p in ("left", "right"))
    rows = [(1, a, "en", 7), (1, b, "en", 8), (None, a, "en", 9), (2, b + " more", "en", 10), (3, "", "en", 11), (3, "", "en", 12), (4, None, "en", 13)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, __row string, row int").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    kept = corpus_pipeline.jaccard_join(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(r["row"] for r in kept.collect()) == [7, 8, 11, 12, 13]
    assert corpus_pipeline.jaccard_join(spark, docs.limit(0), str(tmp_path)).count() == 0
