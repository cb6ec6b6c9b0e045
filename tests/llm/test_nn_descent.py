import numpy as np
import pytest

from wellspring.llm import nn_descent

SF = "/root/testdata/sf0.001"


def brute(vectors: dict, queries: list, k: int = 10) -> list:
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    out = []
    for q in queries:
        d = np.sqrt(((x - np.array(vectors[q], float)) ** 2).sum(1))
        d[ids == q] = np.inf
        best = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out += [(q, r + 1, int(ids[j]), d[j]) for r, j in enumerate(best)]
    return out


def same(rows, expected, at_least=1.0):
    assert len(rows) == len(expected)
    found = {(r.query_id, r.vec_id) for r in rows}
    assert len(found & {(e[0], e[2]) for e in expected}) >= at_least * len(expected)
    for q in {r.query_id for r in rows}:
        mine = sorted((r.rank, r.score, r.vec_id) for r in rows if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    good = {i: [float(np.float32(v)) for v in rng.normal(size=6)] for i in range(700)}
    for i in range(100, 180):
        good[i] = good[100]  # copies of a query
    rows = [(i, v) for i, v in good.items()] + [(5, good[5])]
    rows += [(1000, None), (1100, [0.0] * 6), (1200, [float("nan")] * 6), (1300, [None] + [1.0] * 5), (1400, [1.0] * 5), (1500, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    out = nn_descent.nearest_neighbours(df, lambda c: c % 100 == 0).collect()
    expected = brute(good, [i for i in good if i % 100 == 0])
    same(out, expected)
    assert [r.vec_id for r in sorted(out, key=lambda r: r.rank) if r.query_id == 100] == list(range(101, 111))


def test_few_rows_large_numbers_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1e30, 0.0]), (7, [2e30, 1.0]), (9, [0.0, 1e-30])], "vec_id long, embedding array<float>")
    out = nn_descent.nearest_neighbours(df, lambda c: c % 100 == 0).collect()
    assert sorted((r.rank, r.vec_id) for r in out) in ([(1, 7), (2, 9)], [(1, 9), (2, 7)])
    assert nn_descent.nearest_neighbours(df.limit(0), lambda c: c % 100 == 0).collect() == []


def test_recall_of_the_descent(spark, monkeypatch):
    """Leaves too small to hold the answers: links and search must find them."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 24))
    good = {i: [float(np.float32(v)) for v in centres[i % 40] + 0.7 * rng.normal(size=24)] for i in range(3000)}
    df = spark.createDataFrame(list(good.items()), "vec_id long, embedding array<float>")
    monkeypatch.setattr(nn_descent, "LEAF", 64)
    out = nn_descent.nearest_neighbours(df, lambda c: c % 100 == 0, beam=120).collect()
    same(out, brute(good, [i for i in good if i % 100 == 0]), 0.9)


def test_descent_goes_on_until_few_links_change(spark):
    """Three trees of small leaves are a start that two rounds do not make good enough."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, vector array<float>")
    nodes = nn_descent._packed(df, 1.0).cache()
    forest = nn_descent.Forest(8, 4, 3).fit(x[:500])
    graph = nn_descent.neighbour_graph(nodes, forest, leaf=16, neighbours=12, sample=6).collect()
    d = ((x[:, None, :].astype(float) - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    best = np.argsort(d, axis=1)[:, :12]
    assert len(graph) == len(x)
    assert np.mean([len(set(r.nodes) & set(best[r.id])) / 12 for r in graph]) > 0.9


def test_one_huge_row_leaves_the_other_distances(spark):
    rng = np.random.default_rng(8)
    good = {i: [float(np.float32(v)) for v in rng.normal(size=12)] for i in range(1, 1500)}
    good[0] = [float(np.float32(1e25))] + [0.0] * 11
    df = spark.createDataFrame(list(good.items()), "vec_id long, embedding array<float>")
    out = nn_descent.nearest_neighbours(df, lambda c: c % 100 == 0).collect()
    ids = [i for i in good if i % 100 == 0 and i]
    same([r for r in out if r.query_id], brute(good, ids), 0.95)


def test_a_node_without_links_finds_itself(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(c) for c in rng.normal(size=4)]) for i in range(400)], "id long, vector array<float>")
    nodes = nn_descent._packed(df, 1.0).cache()
    graph = spark.createDataFrame([], "id long, nodes array<long>")
    found = nn_descent.greedy_search(nodes, graph, nodes, nn_descent.Forest(4, 0, 1)).collect()
    assert len(found) == 400 and all(r.nodes[0] == r.query for r in found)


def test_query_recall(spark):
    rows = nn_descent.op8_neighbours(spark, SF).collect()
    read = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    expected = brute(read, [i for i in read if i % 100 == 0])
    same(rows, expected, 0.9)
    exact = {(e[0], e[2]): e[3] for e in brute(read, [i for i in read if i % 100 == 0], len(read))}
    for r in rows:
        assert r.score == pytest.approx(exact[r.query_id, r.vec_id], abs=1e-12)


def test_rounds_of_a_small_table_take_few_tasks(spark, monkeypatch):
    """However many shuffle partitions the session has, what a round writes comes from the tasks that its vectors need."""
    rng = np.random.default_rng(10)
    good = {i: [float(np.float32(v)) for v in rng.normal(size=6)] for i in range(1200)}
    df = spark.createDataFrame(list(good.items()), "vec_id long, embedding array<float>")
    files = []

    def cut(rows, cut=nn_descent.cut_lineage):
        out = cut(rows)
        if {"fresh", "expanded"} & set(out.columns):
            files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(nn_descent, "cut_lineage", cut)
    many = {"spark.sql.shuffle.partitions": str(4 * spark.sparkContext.defaultParallelism), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        out = nn_descent.nearest_neighbours(df, lambda c: c % 100 == 0).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    same(out, brute(good, [i for i in good if i % 100 == 0]), 0.95)
    assert files and max(files) <= spark.sparkContext.defaultParallelism
