"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

*Start.*  Random hyperplanes with the medians of a bounded sample as thresholds
give every vector one code per tree; vectors with one code are a leaf, and leaves above
``leaf`` vectors are dealt into parts by hash.  Inside a leaf all distances are computed,
and every vector keeps its ``neighbours`` nearest of all trees.

*Descent.*  In each round every vector gathers some of its neighbours and of
those that have it as one, new links first; Spark joins bring their vectors
together, every pair with a new link is measured, and the graph keeps the
nearest.  Rounds end when the links that the last one found are less than ``delta``
of all.  Every stage shuffles at most ``2 * sample`` vectors for each vector.

*Search.*  A query starts at its own node, leaf mates and a few fixed nodes and keeps its
``beam`` nearest nodes; in each round all that are not yet expanded send for
their neighbours.  Distances are computed where the nodes are: for each round and
block a query's vector travels once, with the list of nodes to measure.  It ends when
no query finds anything nearer.  What is found is measured again exactly, in double
precision, on the original vectors.

Equal vectors are one node, and each found node stands for its members with the
smallest ids, so a vector with many copies is one node and its answers exact.
Vectors travel as float32 with a unit of their own and are measured in double
precision, so very large rows do not flatten the distances of others.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, neither as query nor as answer; rows with a null id
neither; an id with several vectors counts with the smallest of them; equal
distances go to the smaller id; fewer candidates than ``k`` are all
returned; an empty table gives no rows; only the id and vector columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

TREES = 12
LEAF = 512
NEIGHBOURS = 24
SAMPLE = 12
#: Rounds end when a smaller share of the links is new (the value of the NN-descent paper).
DELTA = 0.001
BEAM = 400
ENTRIES = 8
FIXED_ENTRIES = 64
#: Medians of the projections come from at most this many vectors.
MEDIAN_ROWS = 10_000
#: Rounds run in so many tasks that each gathers about this many bytes of vectors.
TASK_BYTES = 16 << 20
#: Nodes of one search block; the search asks one block at a time for a query's distances.
BLOCK_ROWS = 4096


def _usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of equally long vectors, each its unit and its float32 multiples."""
    if not len(column):
        return np.zeros((0, 0))
    raw = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in column])
    return raw[:, 8:].copy().view("<f4") * raw[:, :8].copy().view("<f8")


def _sorted_by(rows: DataFrame, key: str, *more: str, tasks: int | None) -> DataFrame:
    """``rows`` with whole groups of ``key`` in a partition, sorted.  Where the session has more shuffle partitions
    than ``tasks``, tasks read several of them; every round is a few shuffles of tables that fit fewer tasks."""
    dealt = rows.repartition(key)
    return (dealt.coalesce(tasks) if tasks else dealt).sortWithinPartitions(key, *more)


def _packed(docs: DataFrame, scale: float) -> DataFrame:
    """(id, vector) with the vector, divided by ``scale``, as bytes: a power of two near its
    largest component, and float32 multiples of that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float) / scale
            x = flat.reshape(batch.num_rows, len(flat) // max(batch.num_rows, 1))
            unit = np.ldexp(1.0, np.frexp(np.abs(x).max(1, initial=0))[1]).astype("<f8")
            rows = [u.tobytes() + r.tobytes() for u, r in zip(unit, (x / unit[:, None]).astype("<f4"), strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary())], ["id", "vector"])

    return docs.mapInArrow(run, "id long, vector binary")


def _groups(batches: Iterator[pa.RecordBatch], least: int = 1) -> Iterator[pa.Table]:
    """Runs of rows sorted by the first column, whole groups, of ``least`` rows or more where possible."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))  # the last group may go on
        if held and (cut or key[0] != held[-1].column(0)[-1].as_py()):
            last = held[-1].column(0)[-1].as_py()
            whole = int(np.searchsorted(key, last, side="right"))
            if whole < len(key) and count + whole >= least:
                yield pa.Table.from_batches([*held, batch.slice(0, whole)])
                held, count = [], 0
                batch = batch.slice(whole)
                cut -= whole
        if cut > 0 and count + cut >= least:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, count = [], 0
            batch = batch.slice(cut)
        held.append(batch)
        count += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(-1)[..., :, None] + (y * y).sum(-1)[..., None, :] - 2 * x @ np.swapaxes(y, -1, -2), 0)


def _lists(owner: np.ndarray, node: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    """(id, nodes, distances) from triples sorted by owner."""
    begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    offsets = pa.array(np.r_[begin, len(owner)].astype(np.int32))
    nodes = pa.ListArray.from_arrays(offsets, pa.array(node))
    distances = pa.ListArray.from_arrays(offsets, pa.array(distance.astype(np.float64)))
    return pa.record_batch([pa.array(owner[begin]), nodes, distances], ["id", "nodes", "distances"])


_LISTS = "id long, nodes array<long>, distances array<double>"


class Forest:
    """Codes of vectors: for each tree, which side of each of its hyperplanes."""

    def __init__(self, width: int, bits: int, trees: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bits, self.trees = bits, trees
        self.planes = rng.normal(size=(width, trees * bits)).astype(np.float32)
        self.medians = np.zeros(trees * bits)

    def fit(self, sample: np.ndarray) -> Forest:
        if len(sample):
            self.medians = np.median(sample @ self.planes, axis=0)
        return self

    def codes(self, x: np.ndarray) -> np.ndarray:
        sides = (x @ self.planes > self.medians).reshape(len(x), self.trees, self.bits)
        return sides @ (1 << np.arange(self.bits, dtype=np.int64)) + (np.arange(self.trees, dtype=np.int64) << 40)


def _coded(nodes: DataFrame, forest: Forest) -> DataFrame:
    """(id, vector, leaf): one row per tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = forest.codes(_matrix(batch.column(1)))
                rows = pa.array(np.repeat(np.arange(batch.num_rows), forest.trees))
                yield pa.record_batch([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(codes.ravel())], ["id", "vector", "leaf"])

    return nodes.mapInArrow(run, "id long, vector binary, leaf long")


def _leaf_neighbours(coded: DataFrame, leaf: int, neighbours: int, tasks: int | None = None) -> DataFrame:
    """Lists of the nearest inside each leaf; large leaves are dealt into parts by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            keys, ids = table["key"].to_numpy(), table["id"].to_numpy()
            x = _matrix(table["vector"].combine_chunks())
            for a, b in _runs(keys):
                if b - a < 2:
                    continue
                d = _squares(x[a:b], x[a:b])
                np.fill_diagonal(d, np.inf)
                k = min(neighbours, b - a - 1)
                near = np.argpartition(d, k - 1, axis=1)[:, :k]
                yield _lists(np.repeat(ids[a:b], k), ids[a:b][near].ravel(), np.take_along_axis(d, near, 1).ravel())

    sizes = coded.groupBy("leaf").agg(F.ceil(F.count("*") / leaf).alias("parts"))
    key = F.xxhash64("leaf", F.pmod(F.xxhash64("id", "leaf"), F.col("parts")))
    dealt = coded.join(sizes, "leaf").select(key.alias("key"), "id", "vector")
    return _sorted_by(dealt, "key", tasks=tasks).mapInArrow(run, _LISTS)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(keys):
        begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        yield from zip(begin, np.r_[begin[1:], len(keys)], strict=True)


def _nearest(lists: DataFrame, neighbours: int, tasks: int | None = None) -> DataFrame:
    """(id, nodes, distances, fresh): the nearest different nodes of all lists of an id.
    ``fresh`` marks the links that no list marked as old (fresh = false) had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 2000):
            sizes = table["nodes"].combine_chunks().value_lengths().to_numpy()
            owner = np.repeat(table["id"].to_numpy(), sizes)
            fresh = np.repeat(table["fresh"].to_numpy(), sizes)
            node = table["nodes"].combine_chunks().flatten().to_numpy()
            distance = table["distances"].combine_chunks().flatten().to_numpy()
            order = np.lexsort((fresh, node, owner))  # an old link before its new copy
            owner, node, distance, fresh = owner[order], node[order], distance[order], fresh[order]
            first = np.r_[True, (owner[1:] != owner[:-1]) | (node[1:] != node[:-1])] if len(owner) else np.zeros(0, bool)
            owner, node, distance, fresh = owner[first], node[first], distance[first], fresh[first]
            order = np.lexsort((node, distance, owner))
            owner, node, distance, fresh = owner[order], node[order], distance[order], fresh[order]
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
            keep = rank < neighbours
            batch_out = _lists(owner[keep], node[keep], distance[keep])
            marks = pa.ListArray.from_arrays(batch_out.column(1).offsets, pa.array(fresh[keep]))
            yield pa.record_batch([*batch_out.columns, marks], ["id", "nodes", "distances", "fresh"])

    dealt = lists.select("id", "nodes", "distances", "fresh")
    return _sorted_by(dealt, "id", tasks=tasks).mapInArrow(run, _LISTS + ", fresh array<boolean>")


def _round(nodes: DataFrame, graph: DataFrame, sample: int, neighbours: int, seed: int, tasks: int | None = None) -> DataFrame:
    """One round of NN-descent."""
    links = graph.select("id", F.explode(F.arrays_zip("nodes", "fresh")).alias("l")).select("id", F.col("l.nodes").alias("node"), F.col("l.fresh").alias("fresh"))
    # new links first, then by hash; Spark limits each group before the shuffle, so hubs stay small
    order = [F.col("fresh").desc(), F.xxhash64(F.lit(seed), "center", "member")]
    ways = links.select(F.col("id").alias("center"), F.col("node").alias("member"), "fresh", F.lit(0).alias("way")).unionByName(
        links.select(F.col("node").alias("center"), F.col("id").alias("member"), "fresh", F.lit(1).alias("way"))
    )
    some = ways.withColumn("rank", F.row_number().over(Window.partitionBy("center", "way").orderBy(*order))).where(F.col("rank") <= sample)
    some = some.groupBy("center", "member").agg(F.max("fresh").alias("fresh"))
    reach = nodes.join(graph.select("id", F.element_at("distances", -1).alias("reach")), "id")
    gathered = some.join(reach, some["member"] == reach["id"]).select("center", "member", "fresh", "reach", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 2000):
            keys, ids = table["center"].to_numpy(), table["member"].to_numpy()
            fresh, far = table["fresh"].to_numpy(), table["reach"].to_numpy()
            x = _matrix(table["vector"].combine_chunks())
            found: list[list[np.ndarray]] = [[], [], []]
            for a, b in _runs(keys):
                d = _squares(x[a:b], x[a:b])
                useful = (fresh[a:b, None] | fresh[None, a:b]) & (d < far[a:b, None])
                np.fill_diagonal(useful, False)
                i, j = np.nonzero(useful)
                for column, values in zip(found, (ids[a + i], ids[a + j], d[i, j]), strict=True):
                    column.append(values)
            owner, node, distance = map(np.concatenate, found)
            order = np.argsort(owner, kind="stable")
            yield _lists(owner[order], node[order], distance[order])

    measured = _sorted_by(gathered, "center", tasks=tasks).mapInArrow(run, _LISTS)
    old = graph.withColumn("fresh", F.lit(False))
    return _nearest(old.unionByName(measured.withColumn("fresh", F.lit(True))), neighbours, tasks)


def neighbour_graph(
    nodes: DataFrame, forest: Forest, leaf: int = LEAF, neighbours: int = NEIGHBOURS, sample: int = SAMPLE, delta: float = DELTA, tasks: int | None = None
) -> DataFrame:
    """(id, nodes, distances): the links of each node, to and from, at most ``2 * neighbours``."""
    start = _leaf_neighbours(_coded(nodes, forest), leaf, neighbours, tasks).withColumn("fresh", F.lit(True))
    graph = cut_lineage(_nearest(start, neighbours, tasks))
    new = F.sum(F.size(F.filter("fresh", lambda x: x))) / F.sum(F.size("fresh"))
    for seed in itertools.count():
        if (graph.agg(new).first()[0] or 0) < delta:
            break
        graph = cut_lineage(_round(nodes, graph, sample, neighbours, seed, tasks))
    links = graph.select("id", F.explode(F.arrays_zip("nodes", "distances")).alias("l")).select("id", F.col("l.nodes").alias("node"), F.col("l.distances").alias("distance"))
    back = links.select(F.col("node").alias("id"), F.col("id").alias("node"), "distance")
    back = back.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("distance", "node"))).where(F.col("rank") <= neighbours)
    both = links.unionByName(back.select("id", "node", "distance"))
    return cut_lineage(both.groupBy("id").agg(F.collect_set("node").alias("nodes")))


_BEAM = "query long, vector binary, nodes array<long>, distances array<double>, expanded array<boolean>, news int"


def _merged(beams: DataFrame, beam: int, tasks: int | None = None) -> DataFrame:
    """One beam per query from lists of measured nodes (query, vector, nodes, distances, expanded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            rows = []
            queries = table["query"].to_numpy()
            for a, b in _runs(queries):
                part = table.slice(a, b - a)
                vector = part["vector"][0].as_py()
                node = part["nodes"].combine_chunks().flatten().to_numpy()
                distance = part["distances"].combine_chunks().flatten().to_numpy()
                expanded = part["expanded"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
                order = np.lexsort((~expanded, node))
                node, distance, expanded = node[order], distance[order], expanded[order]
                first = np.r_[True, node[1:] != node[:-1]] if len(node) else np.zeros(0, bool)
                node, distance, expanded = node[first], distance[first], expanded[first]
                order = np.lexsort((node, distance))[:beam]
                rows.append((int(queries[a]), vector, node[order], distance[order], expanded[order], int((~expanded[order]).sum())))
            yield pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.list_(pa.float64())),
                    pa.array([r[4] for r in rows], pa.list_(pa.bool_())),
                    pa.array([r[5] for r in rows], pa.int32()),
                ],
                ["query", "vector", "nodes", "distances", "expanded", "news"],
            )

    return _sorted_by(beams, "query", tasks=tasks).mapInArrow(run, _BEAM)


def _measure(asked: DataFrame, vectors: DataFrame, nodes: DataFrame, blocks: int, tasks: int | None = None) -> DataFrame:
    """(query, vector, nodes, distances, expanded = false) of ``asked`` (query, node) and the queries'
    ``vectors`` (query, vector): the nodes of a block meet, once each, the queries that ask for some of them."""
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("long")
    requests = asked.groupBy("query", block(F.col("node")).alias("block")).agg(F.collect_set("node").alias("nodes")).join(vectors, "query")
    home = nodes.select(block(F.col("id")).alias("block"), F.lit(-1).cast("long").alias("query"), "vector", F.array("id").alias("nodes"), F.lit(0).alias("kind"))
    together = home.unionByName(requests.select("block", "query", "vector", "nodes", F.lit(1).alias("kind")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, x, size = None, np.zeros(0, np.int64), np.zeros((0, 0)), None
        chunks: list = []
        for batch in batches:
            out: list[tuple] = []
            kinds, keys = batch.column(4).to_numpy(), batch.column(0).to_numpy()
            edges = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])]) if len(keys) else []
            for a, b in zip(edges, np.r_[edges[1:], len(keys)].astype(int), strict=True):
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    if keys[a] != here:
                        here, chunks = keys[a], []
                    chunks.append((part.column(3).flatten().to_numpy(), _matrix(part.column(2))))
                    size = None
                    continue
                if keys[a] != here:
                    here, chunks, size = keys[a], [], None
                if size is None:
                    ids = np.concatenate([c[0] for c in chunks]) if chunks else np.zeros(0, np.int64)
                    order = np.argsort(ids)
                    ids = ids[order]
                    x = np.concatenate([c[1] for c in chunks])[order] if chunks else x[:0]
                    size = len(ids)
                vectors = _matrix(part.column(2))
                for query, raw, q, asked_nodes in zip(part.column(1).to_pylist(), part.column(2), vectors, part.column(3), strict=True):
                    wanted = asked_nodes.values.to_numpy()
                    at = np.searchsorted(ids, wanted)
                    d = ((x[at] - q) ** 2).sum(1)
                    out.append((query, raw.as_py(), wanted, d, np.zeros(len(wanted), bool)))
            types = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())]
            yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["query", "vector", "nodes", "distances", "expanded"])

    return _sorted_by(together, "block", "kind", tasks=tasks).mapInArrow(run, "query long, vector binary, nodes array<long>, distances array<double>, expanded array<boolean>")


def greedy_search(
    nodes: DataFrame, graph: DataFrame, queries: DataFrame, forest: Forest, beam: int = BEAM, blocks: int = 1, entries: int = ENTRIES, tasks: int | None = None
) -> DataFrame:
    """(query, nodes): the ``beam`` nearest nodes found for each of ``queries`` (id, vector)."""
    place = Window.partitionBy("leaf").orderBy(F.xxhash64("id"))
    mates = _coded(nodes, forest).select("id", "leaf").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= entries)
    fixed = nodes.select("id").orderBy(F.xxhash64("id")).limit(FIXED_ENTRIES)
    start = _coded(queries, forest).select("id", "leaf").join(mates.select("leaf", F.col("id").alias("node")), "leaf").select(F.col("id").alias("query"), "node")
    start = start.unionByName(queries.select(F.col("id").alias("query")).join(F.broadcast(fixed.select(F.col("id").alias("node")))))
    start = start.unionByName(queries.select(F.col("id").alias("query"), F.col("id").alias("node")))
    state = cut_lineage(_merged(_measure(start, queries.select(F.col("id").alias("query"), "vector"), nodes, blocks, tasks), beam, tasks))
    done = None
    while not state.where("news > 0").isEmpty():
        ended = state.where("news = 0")
        done = ended if done is None else done.unionByName(ended)
        active = state.where("news > 0")
        links = active.select("query", F.explode(F.arrays_zip("nodes", "expanded")).alias("l")).where("not l.expanded")
        asked = links.select("query", F.col("l.nodes").alias("id")).join(graph, "id").select("query", F.explode("nodes").alias("node")).distinct()
        known = active.select("query", F.explode("nodes").alias("node"))
        asked = asked.join(known, ["query", "node"], "left_anti")
        old = active.drop("news").withColumn("expanded", F.transform("expanded", lambda x: F.lit(True)))
        state = cut_lineage(_merged(old.unionByName(_measure(asked, active.select("query", "vector"), nodes, blocks, tasks)), beam, tasks))
    done = state if done is None else done.unionByName(state)
    return done.select("query", "nodes")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row whose id
    satisfies ``is_query``, itself excepted; score is the Euclidean distance."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(F.col("id").isNotNull() & _usable(F.col("vector")))
    width = rows.agg(F.mode(F.size("vector"), deterministic=True)).first()[0]
    rows = rows.where(F.size("vector") == F.lit(width or 0)).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast("float")))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    groups = rows.groupBy("vector").agg(F.min("id").alias("node"))
    members = cut_lineage(rows.join(groups, "vector").select("id", "node", "vector"))
    one = members.where("id = node").select("node", "vector")
    scale = one.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    nodes = cut_lineage(_packed(one.select(F.col("node").alias("id"), "vector"), float(scale or 1)))
    count = nodes.count()
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / LEAF))))
    sample = nodes.orderBy(F.xxhash64("id")).limit(MEDIAN_ROWS).select("vector").toArrow() if bits else None
    forest = Forest(int(width or 1), bits, TREES if bits else 1)
    if sample is not None:
        forest.fit(_matrix(sample["vector"].combine_chunks()))
    tasks = max(spark.sparkContext.defaultParallelism, count * 2 * SAMPLE * 4 * int(width or 1) // TASK_BYTES)
    graph = neighbour_graph(nodes, forest, tasks=tasks)

    asking = members.where(is_query(F.col("id"))).select("node", "id")
    queries = cut_lineage(nodes.join(asking.select(F.col("node").alias("id")).distinct(), "id"))
    blocks = max(1, count // BLOCK_ROWS, min(count // 512, spark.sparkContext.defaultParallelism))
    found = greedy_search(nodes, graph, queries, forest, beam, blocks, tasks=tasks)

    # exact distances between the nodes, then their members with the smallest ids
    near = found.select("query", F.explode(F.slice("nodes", 1, 4 * k)).alias("near"))
    difference = F.zip_with("_x", "_y", lambda a, b: a.cast("double") - b.cast("double"))
    distance = F.sqrt(F.aggregate(difference, F.lit(0.0), lambda s, x: s + x * x))
    measured = (
        near.join(one.select(F.col("node").alias("query"), F.col("vector").alias("_x")), "query")
        .join(one.select(F.col("node").alias("near"), F.col("vector").alias("_y")), "near")
        .select("query", "near", distance.alias("score"))
    )
    first = Window.partitionBy("node").orderBy("id")
    smallest = members.select("node", "id").withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    answers = (
        asking.select(F.col("id").alias("query_id"), F.col("node").alias("query"))
        .join(measured, "query")
        .join(smallest.select(F.col("node").alias("near"), F.col("id").alias("vec_id")), "near")
        .where(F.col("vec_id") != F.col("query_id"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(vectors, lambda c: c % 100 == 0)
