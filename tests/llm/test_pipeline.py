"""The pipeline's stages on small tables: each keeps what it should, and all decisions take effect."""

from collections import Counter

import corpus_pipeline
from postlytics.llm import minhash, secret_scan, toxicity

from ..conftest import MEDIUM
from .data import documents, odd_texts
from .test_text_operators import components, regex_spans


def test_stages(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-duplicates", "secrets", "mixing", "packing"]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, MEDIUM), name)
        rows[name] = (docs, out)
        if name != "packing":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        docs = out
    before, clean = rows["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{MEDIUM}/labels.parquet"))
    expect = {r.doc_id for r in toxicity.score(before, model).collect() if r.predicted == 0}
    assert {r.doc_id for r in clean.collect()} == expect
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    gone = {r.doc_id for r in before.collect()} - expect
    assert gone and all(labels.get(i) != 0 for i in gone)  # no document labelled clean goes
    _, unique = rows["near-duplicates"]
    texts = [(r.doc_id, r.text) for r in clean.collect()]
    assert {r.doc_id for r in unique.collect()} == {i for i, _, _, kept in components(texts, words=5) if kept}
    _, redacted = rows["secrets"]
    before = {r.doc_id: r.text for r in unique.collect()}
    after = {r.doc_id: r.text for r in redacted.collect()}
    assert set(before) == set(after) and not any(regex_spans(t) for t in after.values())
    assert any(regex_spans(t) for t in before.values())
    assert sum(before[i] != after[i] and not regex_spans(before[i]) for i in before) <= 0.01 * len(before)
    _, mixed = rows["mixing"]
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= set(after) and max(counts.values()) <= 3
    _, packed = rows["packing"]
    pieces = packed.where("start = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == counts


def test_stages_on_awkward_rows(spark, tmp_path):
    """Null and empty texts, rows without an id, repeated rows, long texts, columns whose names clash."""
    texts = [*odd_texts(), (30, None), (31, ""), (31, "")]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (None, 1, 1), (9, 0, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, rows = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, str(tmp_path)), name)
        if name != "packing":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        rows[name], docs = [(r.doc_id, getattr(r, "text", None)) for r in out.collect()], out
    assert sorted(rows["toxicity"], key=str) == sorted(texts, key=str)  # no label says toxic: all stay
    unique = rows["near-duplicates"]
    kept = {i for i, _, _, k in components(texts, words=5) if k and i is not None}
    assert {i for i, _ in unique if i is not None} == kept
    assert unique.count((15, "same row")) == 1 and unique.count((31, "")) == 1 and unique.count((0, None)) == 1
    assert len(set(unique)) == len(unique)
    redacted = dict(rows["secrets"])
    assert len(rows["secrets"]) == len(unique) and redacted[0] is None and not any(regex_spans(t or "") for _, t in rows["secrets"])
    counts = Counter(rows["mixing"])
    assert set(counts) <= set(rows["secrets"]) and all(c <= 3 for c in counts.values())
    pieces = docs.where("start = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == dict(Counter(i for i, _ in rows["mixing"]))
    null = docs.where("doc_id = 0").collect()
    assert all((r.length, r.doc_tokens) == (1, 1) for r in null)


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{MEDIUM}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert minhash and secret_scan  # operators of the stages, imported without error swallowing
