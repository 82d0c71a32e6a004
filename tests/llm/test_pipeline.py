"""The pipeline's stages on rows with every awkward case, and its registration."""

import corpus_pipeline as pipeline
from labelloom.llm import queries
from tests.llm.conftest import SCHEMA


def _folder(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i * 3, 1, 0) for i in range(30)] + [(15, 0, 0), (18, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    bench = spark.createDataFrame([(1, "ends here"), (2, None)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_keep_columns_and_take_effect(spark, docs, doc_rows, tmp_path):
    folder = _folder(spark, tmp_path, docs)
    by_name = dict(pipeline.STAGES)
    assert len(pipeline.STAGES) == 5
    for name, step in pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes, name
        assert step(spark, docs.limit(0), folder).count() == 0, name
    kept = sorted(r.doc_id for r in by_name["near-duplicates"](spark, docs, folder).collect())
    assert len(kept) == len(set(kept)) and 24 in kept and not {27, 30, 12, 18, 21} & set(kept)
    clean = {r.doc_id for r in by_name["benchmark decontamination"](spark, docs, folder).collect()}
    assert {r[0] for r in doc_rows} - clean == {1000}
    redacted = {r.doc_id: r for r in by_name["secret scan"](spark, docs, folder).collect()}
    last = max(r[0] for r in doc_rows if r[0] < 1000)
    assert redacted[last].text.endswith("[secret] [secret]'") and redacted[last].n_chars == len(redacted[last].text)
    assert redacted[24].text == {r[0]: r[1] for r in doc_rows}[24] and redacted[0].text is None


def test_run(spark, docs, tmp_path):
    folder = _folder(spark, tmp_path, docs)
    rows = pipeline.run(spark, folder).collect()
    assert rows and all(len(r.ids) == 4 * r.n_tokens for r in rows)


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and pipeline.ORACLE_SQL is None
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_schema_constant():
    assert SCHEMA.startswith("doc_id long, text string")
