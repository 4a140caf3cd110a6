"""The corpus pipeline, stage by stage, and the registration."""

import corpus_pipeline
from reelstack.llm import decontamination, near_dedup, quality_rules
from reelstack.session import materialize
from tests.conftest import SF001
from tests.llm import edge
from tests.llm.test_native_ops import secrets, targets


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, states = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(materialize(stage(spark, states[-1], SF001), "s"))
    for df in states[:-1]:
        assert df.columns == columns
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in states]
    good = {r.doc_id for r in quality_rules.quality_rules(states[0]).filter("kept").collect()}
    assert ids[1] == good < ids[0]
    classes = near_dedup.near_dedup(states[1]).collect()
    assert ids[2] == {r.class_id for r in classes} and states[2].count() == len(ids[2])
    bad = {r.doc_id for r in decontamination.contaminated(states[2], spark.read.parquet(f"{SF001}/benchmark.parquet")).collect()}
    assert ids[3] == ids[2] - bad and bad
    text = {r.doc_id: r.text for r in states[3].collect()}
    for r in states[4].collect():
        assert not secrets(r.text) and (r.text == text[r.doc_id]) == (not secrets(text[r.doc_id]))
        assert r.n_chars == len(r.text)
    rows = [(r.doc_id, r.text, r.lang, r.source, 0) for r in states[4].collect()]
    _, target = targets(rows)
    last = states[5].collect()
    assert len(last) == len(rows) and all(abs(r.target - target[r.source]) < 1e-6 for r in last)
    run = corpus_pipeline.run(spark, SF001).collect()
    assert sorted(map(str, run)) == sorted(map(str, last))


def test_awkward_documents_pass_all_stages(spark, tmp_path):
    edge.frame(spark, clash=True).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "an item of six short words"), (2, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    edge.frame(spark, []).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
