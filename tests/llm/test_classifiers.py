import zlib

import numpy as np
import pyarrow as pa
import pytest

from wellspring.llm import quality, toxicity

from .cases import corpus, frame

SF = "/root/testdata/sf0.01"


def folds(rows):
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1


@pytest.mark.parametrize(("query", "label", "limit", "at_least"), [(quality.op1_quality, "quality", 0.3, 0.95), (toxicity.op5_toxicity, "toxic", 0.5, 0.9)])
def test_held_out_accuracy(spark, query, label, limit, at_least):
    rows = query(spark, SF).collect()
    folds(rows)
    assert all(r.predicted == (r.score >= limit) for r in rows)
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.predicted, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    assert len(held) > 40
    assert np.mean([p == m for p, m in held]) >= at_least


def test_insults_with_and_without_a_group(spark):
    """Only the pair is toxic, neither word alone; the pair's own term says so."""
    rng = np.random.default_rng(1)
    rows, marks = [], []
    for i in range(3000):
        has = rng.random(2) < 0.4
        text = " ".join([*rng.choice(["one", "two", "three", "four"], 5), *(["insult"] * int(has[0])), *(["group"] * int(has[1]))])
        rows.append((i, text))
        marks.append((i, int(has.all())))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    found = {r.doc_id: r.score >= 0.5 for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([found[i] == bool(m) for i, m in marks]) > 0.99
    (insult, _), (group, _) = (toxicity.features(pa.array([w], pa.large_string()), model.bits) for w in ("insult", "group"))
    assert model.v[insult[0]] @ model.v[group[0]] > 0


def fitted(spark, rows, marks):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    return model, {r.doc_id: r.score >= 0.5 for r in toxicity.score_toxicity(docs, model).collect()}


def test_a_term_that_makes_insults_harmless(spark):
    """Insults are toxic unless the text quotes; quoting alone says nothing."""
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(3000):
        insult, quoted = rng.random(2) < 0.3
        text = " ".join([*rng.choice([f"word{k}" for k in range(50)], 8), *(["insult"] * int(insult)), *(["quoted"] * int(quoted))])
        rows.append((i, text))
        marks.append((i, int(insult and not quoted)))
    _, found = fitted(spark, rows, marks)
    toxic = [found[i] for i, m in marks if m]
    clean = [found[i] for i, m in marks if not m]
    assert np.mean(toxic) > 0.98 and np.mean(clean) < 0.01


def test_a_group_that_says_nothing_by_itself(spark):
    """An insult is toxic with the group, harmless without; the group's own share is the common one."""
    rng = np.random.default_rng(5)
    rows, marks = [], []
    for i in range(6000):
        insult, group = rng.random(2) < (0.3, 0.4)
        toxic = insult and group or (not group and not insult and rng.random() < 0.43)
        text = " ".join([*rng.choice([f"word{k}" for k in range(50)], 8), *(["insult"] * int(insult)), *(["group"] * int(group)), *(["vile"] * int(toxic and not insult))])
        rows.append((i, text))
        marks.append((i, int(toxic)))
    shares = [np.mean([m for (i, t), (_, m) in zip(rows, marks) if ("group" in t.split()) == has]) for has in (True, False)]
    assert abs(shares[0] - shares[1]) < 0.03
    _, found = fitted(spark, rows, marks)
    assert np.mean([found[i] == bool(m) for i, m in marks]) > 0.98


def test_toxic_documents_are_found(spark):
    """Recall among all labelled toxic documents, and held-out ranking."""
    rows = {r.doc_id: r for r in toxicity.op5_toxicity(spark, "/root/testdata/sf0.1").collect()}
    marks = [(rows[r.doc_id], r.toxic) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if r.doc_id in rows and r.toxic is not None]
    held = [(r, m) for r, m in marks if r.held_out]
    assert np.mean([r.predicted for r, m in marks if m]) >= 0.9
    assert np.mean([r.predicted for r, m in held if m]) >= 0.75
    assert np.mean([r.predicted for r, m in held if not m]) <= 0.02


def test_margins_are_sums_over_pairs():
    rng = np.random.default_rng(6)
    model = toxicity.FactorizationMachine(bits=8, factors=5)
    model.w[:], model.w0 = rng.normal(size=256), 0.3
    docs = [np.sort(rng.choice(256, n, replace=False)) for n in (0, 1, 2, 9, 30)]
    found, _ = model.margins(np.concatenate(docs).astype(np.int64), np.repeat(np.arange(5), [len(d) for d in docs]), 5)
    for i, d in enumerate(docs):
        pairs = sum(float(model.v[a] @ model.v[b]) for k, a in enumerate(d) for b in d[k + 1 :])
        assert abs(found[i] - (model.w0 + model.w[d].sum() + pairs)) < 1e-4


def test_edge_cases(spark):
    texts = corpus(5, 20)
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in texts] + [(1, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    trees = quality.fit_quality(docs, labels)
    machine = toxicity.fit_toxicity(docs, labels)
    for scored in (quality.score_quality(docs, trees), toxicity.score_toxicity(docs, machine)):
        rows = scored.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (3000, 3001)}) == 1
    kept = toxicity.drop_toxic(docs, machine)
    assert kept.dtypes == docs.dtypes
    nothing = labels.limit(0)
    assert {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, nothing)).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, nothing)).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), machine).count() == 0
    assert quality.score_quality(docs.limit(0), trees).count() == 0


def test_trees_split_like_a_scan_over_all_borders():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 1] > 0.3).astype(float)
    model = quality.BoostedTrees(trees=1, depth=1, bins=64).fit(x, y)
    assert model.feature[0, 0] == 1 and abs(model.border[0, 0] - 0.3) < 0.1
    assert ((model.scores(x) > y.mean()) == (y > 0)).mean() > 0.95
