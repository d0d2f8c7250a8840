"""Stages of the pipeline over repeated and null ids."""

import corpus_pipeline

A = "one text that stands alone and has no copy among the others here"
B = "many words of a text that comes again under some other id or none"


def kept(spark, documents, rows):
    docs = documents(rows)
    out = corpus_pipeline.without_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_namesake_of_a_near_copy_stays(spark, documents):
    assert kept(spark, documents, [(5, A), (5, B), (3, B)]) == sorted([(5, A), (3, B)], key=repr)


def test_one_row_of_a_group_stays(spark, documents):
    rows = [(7, B), (7, B), (None, B), (None, A), (None, A), (1, None), (None, ""), (1, None)]
    assert kept(spark, documents, rows) == sorted([(7, B), (None, A), (1, None), (1, None), (None, "")], key=repr)


def test_stages_get_small_batches_and_the_session_its_own_again(spark, tmp_path, monkeypatch):
    """Far more rows than a batch: no task is handed more at a time, and settings are as before when the run has ended."""
    spark.range(5000).selectExpr("id doc_id", "'some text' text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(spark, docs, sf_dir):
        return docs.select("doc_id").mapInArrow(
            lambda batches: (type(b).from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    before = {k: spark.conf.get(k, None) for k in corpus_pipeline.BATCH}
    found = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(found) == 5000 and max(found) <= 2048
    assert before == {k: spark.conf.get(k, None) for k in corpus_pipeline.BATCH}
