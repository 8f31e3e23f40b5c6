import corpus_pipeline
import pytest

from tabspark.llm import near_text, pii, queries

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            after = {r.doc_id: r.text for r in out.collect()}
            assert set(after) <= set(before)
            if name == "near_duplicates":
                classes = {r.doc_id: r.class_id for r in near_text.near_duplicates(docs).collect()}
                assert set(after) == {c for c in classes.values()}
            if name == "personal_data":
                assert set(after) == set(before) and all(not pii.base_spans(t or "") for t in after.values())
            before = after
        docs = out
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(before)


def test_stages_on_an_empty_table_and_nulls(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, None, None, None, None), (-2, "", "en", None, 0),
                                 (-3, "mail a@b.cd", None, "s", None), (-3, "mail a@b.cd", None, "s", None)], docs.schema)
    for rows, n in ((docs.limit(0), 0), (odd, 4)):
        kept = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns
        assert kept.count() == n
        assert corpus_pipeline.STAGES[-1][1](spark, kept, SF).select("doc_id").distinct().count() == min(n, 4)


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns[:2] == ["doc_id", "start"]


@pytest.mark.parametrize("n", range(1, 11))
def test_every_operator_has_one_query(n):
    assert sum(q.startswith(f"op{n}_") for q in queries.queries()) == 1
