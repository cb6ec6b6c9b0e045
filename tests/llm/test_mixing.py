import re

import duckdb
import pytest

from wellspring.llm import mixing

SF = "/root/testdata/sf0.001"


def reshared(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0) -> dict:
    """Targets by the rule itself: share by weight, cut at the ceiling, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s.encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: cap * sizes[s] for s in above}
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


def check(rows, texts):
    sizes = {}
    for doc, (text, source) in texts.items():
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = reshared(sizes)
    assert len(rows) == len(texts)
    for r in rows:
        text, source = texts[r.doc_id]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source])
        assert r.taken <= 2 * r["size"]


def test_targets_follow_the_rule(spark):
    texts = {i: ("w " * (1 + i * 7 % 50), "abc"[i % 3] if i % 10 < 7 else None) for i in range(200)}
    texts |= {900: (None, "a"), 901: ("", "empty"), 902: ("x y z", "z\U0001F600")}
    docs = spark.createDataFrame([(d, t, s) for d, (t, s) in texts.items()], "doc_id long, text string, source string")
    check(mixing.mixing_rates(docs).select("doc_id", "size", "source_size", "target", "taken").collect(), texts)


def test_query_follows_the_rule_and_comes_near_its_targets(spark):
    rows = mixing.op3_mixing(spark, SF).collect()
    read = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    check(rows, {d: (t, s) for d, t, s in read})
    assert rows == mixing.op3_mixing(spark, SF).collect()
    total = sum(r["size"] for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * total, rel=0.1)


def test_emitted_rows(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", i, "x") for i in range(50)] + [(7, "a b c", "s", 7, "x")], "doc_id long, text string, source string, size int, copies string")
    rates = mixing.mixing_rates(docs.drop("size", "copies"))
    out = mixing.mix_sources(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert out.count() == sum(r.copies for r in rates.collect())
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(7) % 2 == 0  # the repeated row is taken as often as its twin
    assert mixing.mix_sources(docs.limit(0)).count() == 0
