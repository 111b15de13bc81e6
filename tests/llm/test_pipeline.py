import corpus_pipeline
import __spark_entry__
from tests.llm.data import edited, frame, odd_documents, prose, words


def test_stages(spark, tmp_path):
    bench = spark.createDataFrame([(0, prose(40, 500))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = odd_documents() | {900: prose(60, 1) + "\n" + prose(40, 500)}
    line = " ".join(words(200, 50))  # near copies without an equal line
    texts |= {901 + i: edited(line, 70 + i, i) for i in range(3)}
    docs = frame(spark, texts, extra=False)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == list(corpus_pipeline.COLUMNS), name
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 900 not in ids  # leak
    assert not ids & {0, 1, 2, 3, 4, 19}  # no words, too few, too repetitive
    assert ids & {901, 902, 903} == {901}  # near copies
    assert {30 + i for i in range(80)} <= ids  # clean documents
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
    assert [n for n, _ in corpus_pipeline.STAGES] and "pipeline" in __spark_entry__.queries()


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, odd_documents(), extra=False).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
