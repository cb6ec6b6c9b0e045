"""The stages one after another, each held against what its input says."""

import corpus_pipeline
from wellspring.llm import toxicity
from wellspring.llm.catalog import ORACLE_SQL, QUERIES

from .test_mixing import reshared
from .test_ngram_join import brute as groups
from .test_packing import check as packed
from .test_repeats import brute as cut

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")] == list(range(1, 14))
    assert QUERIES["pipeline"] is corpus_pipeline.run and set(ORACLE_SQL) < set(QUERIES)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    stages = dict(corpus_pipeline.STAGES)

    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    out = stages["toxicity"](spark, docs, SF)
    assert out.columns == columns
    kept = out.collect()
    assert sorted(kept) == sorted(r for r in rows if scores[r.doc_id] < 0.5)

    docs = spark.createDataFrame(kept, docs.schema)
    out = stages["near_duplicates"](spark, docs, SF)
    group = {i: c for i, (_, c) in groups({r.doc_id: r.text for r in kept}, 5, "8/10").items()}
    kept = [r for r in kept if group[r.doc_id] == r.doc_id]
    assert out.columns == columns and sorted(out.collect()) == sorted(kept)

    docs = spark.createDataFrame(kept, docs.schema)
    out = stages["repeats"](spark, docs, SF).collect()
    expected = {i: k.decode("utf-8", "ignore") for i, _, k, _ in cut([(r.doc_id, r.text) for r in kept], 400)}
    assert {r.doc_id: r.text for r in out} == expected
    assert all(r.n_chars == len(r.text) for r in out)

    docs = spark.createDataFrame(out, docs.schema)
    mixed = stages["mixing"](spark, docs, SF).collect()
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    target = reshared(sizes)
    for r in out:
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(rate) <= sum(m.doc_id == r.doc_id for m in mixed) <= int(rate) + 1
    assert {tuple(m) for m in mixed} <= {tuple(r) for r in out}

    docs = spark.createDataFrame(mixed, docs.schema)
    packed(stages["packing"](spark, docs, SF).collect(), [(r.doc_id, r.text) for r in mixed], 2048)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns[:3] == ["doc_id", "start", "length"] and rows.count() > 0
