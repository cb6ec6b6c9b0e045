"""Exact Jaccard join of documents on word n-grams, as a metric-space join.

Jaccard distance is a metric, but between unrelated documents it is 1 whatever
the pivot, so pivots over whole sets separate nothing.  The join therefore goes
down in three steps, each exact:

1. *Regions.*  The universe of shingles is cut by hash into more classes than
   two linked sets of this size can differ in.  In at least one class their
   parts are then equal: distance 0 in that class's own Jaccard space, where
   every distinct part is a pivot and its Voronoi cell needs no window.  A
   cell (region) with one set is done.  Parts that are empty in both sets say
   nothing: a set with so few parts that all it has in common with a linked one may
   be empty ones has each of its shingles as a class of its own too.
2. *Pivots.*  In each region the set with most neighbours in its cells is
   the pivot; all sets of the region are measured against it.  Those within the
   radius are linked.  Regions whose sets are one component are done.
3. *Recursion.*  Larger open regions are split: a few pivots, each set goes to
   the Voronoi cell of the nearest and, by the triangle inequality, also to every
   cell whose pivot is at most two radii farther.  In what remains, only pairs
   of different components are compared whose distances to a pivot differ by at
   most the radius, and whose sketches, a bit or two of parity for each shingle, differ in
   no more bits than the shingles of a link.

Equal sets are one node per task and class, so copies are never paired with
each other.  Sets are compared by 64-bit shingle hashes.

Defined cases: a null or empty text, or one without words, has no shingles and
is linked with nothing; fewer words than the width make one shingle of all; a
null id is returned with a null component and linked with nothing; rows with equal ids
count as one document; an empty table gives no rows; only the id and text
columns are read.
"""

from __future__ import annotations

import gc
import hashlib
import uuid
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_scratch, scratch_path
from .components import connected_components
from .textops import SMALL_SLICE, distinct_per_document, giving_back, mixed, shingle_hashes, slices, word_hashes

BAND_RATIO = 2
#: Regions up to this many sets are compared directly; larger ones are split by this many pivots.
LEAF = 4096
PIVOTS = 8
#: Regions of a set in one row of the table of sets.
KEYS_PER_ROW = 64
#: Bits of the filter that keeps most regions of a single set from being shuffled: 16 MB at every size of the input.
FILTER_BITS = 1 << 27
#: Regions that pivots did not make smaller in so many rounds are compared directly.
SPLITS = 3
_SLACK = 1e-9
_PARTS_BITS = 32
#: Marks the ``parts`` of regions that are single shingles.
_SINGLE = 1 << 48


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct word shingles, sorted by document and hash."""
    hashes, doc, _ = word_hashes(texts)
    return distinct_per_document(*shingle_hashes(hashes, doc, len(texts), width))


def band_starts(limit: int) -> np.ndarray:
    """Smallest set size of each size band: 1, 2, 4, 8 ... beyond ``limit``."""
    starts = [1]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_RATIO)))
    return np.array(starts)


def classes_of_band(last: int, similarity: Fraction) -> int:
    """One more than the shingles by which two linked sets of at most ``last`` can differ."""
    return int(2 * last * (1 - similarity) / (1 + similarity)) + 1


def most_differing(sizes: np.ndarray, others: np.ndarray, similarity: Fraction) -> np.ndarray:
    """The shingles by which linked sets of these two sizes can differ."""
    p, q = similarity.numerator, similarity.denominator
    return (sizes + others) * (q - p) // (q + p)


def region_keys(h: np.ndarray, doc: np.ndarray, sizes: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(region, document, size band and number of the document's regions in it) of documents given
    by their shingles, sorted by document.  A set is in its own size band and in those of larger sets it may link to.

    Two linked sets have a common region in the band of the larger one unless both have no more parts
    there than shingles can differ, for then all equal parts may be empty.  Such sets
    also have one region for each shingle, the same in all bands."""
    starts = band_starts(int(sizes.max(initial=1) / similarity) + 1)
    classes = np.array([classes_of_band(int(b) - 1, similarity) for b in starts[1:]])
    own = np.searchsorted(starts, sizes, side="right") - 1
    largest = np.array([int(s / similarity) for s in sizes], np.int64)
    top = np.searchsorted(starts, largest, side="right") - 1
    out_keys, out_doc, out_parts = [], [], []
    single = np.zeros(len(sizes), bool)
    for extra in range(int((top - own).max(initial=0)) + 1):
        band = own + extra
        has = (band <= top) & (sizes > 0)
        pick = has[doc]
        if not pick.any():
            break
        hh, dd = h[pick], doc[pick]
        m = classes[band[dd]].astype(np.uint64)
        part = ((hh >> np.uint64(32)) % m).astype(np.int64)
        # the sum over a part's shingles is its fingerprint; sums of empty parts are not keys
        slot = np.r_[0, np.cumsum(np.where(has, classes[np.minimum(band, len(classes) - 1)], 0))]
        at = slot[dd] + part
        order = np.argsort(at, kind="stable")
        at, value = at[order], mixed(hh[order])
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        total = np.add.reduceat(value, begin)
        d = dd[order][begin]
        key = mixed(total + mixed((at[begin] - slot[d]).astype(np.uint64) * np.uint64(1_000_003) + band[d].astype(np.uint64)))
        parts = np.bincount(d, minlength=len(sizes))
        out_keys.append(key)
        out_doc.append(d)
        out_parts.append(parts[d] | band[d] << _PARTS_BITS)
        last = starts[np.minimum(band, len(classes) - 1) + 1] - 1
        single |= has & (parts <= most_differing(sizes, np.minimum(largest, last), similarity))
    pick = single[doc]
    if pick.any():
        out_keys.append(mixed(h[pick] + np.uint64(1_000_003)))
        out_doc.append(doc[pick])
        out_parts.append(sizes[doc[pick]] | _SINGLE)
    if not out_keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_keys), np.concatenate(out_doc), np.concatenate(out_parts)


def _sets(docs: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """(doc_id, n_shingles, set_id, is_first, keys, parts) of every document, with one row or several
    after another.  ``keys`` are the regions of the set, ``parts`` the size band of each and how many the set
    has in it; a task gives them for the first document of each set that it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for first, n, texts in slices(batch, "text", SMALL_SLICE):
                h, doc = shingle_sets(texts, width)
                sizes = np.bincount(doc, minlength=n)
                ends = np.cumsum(sizes)
                raw = np.ascontiguousarray(h).view(np.uint8)
                ids = batch.column(0).slice(first, n)
                set_ids: list[bytes | None] = [None] * n
                new = np.zeros(n, bool)
                for i in np.flatnonzero(sizes):
                    set_ids[i] = name = hashlib.md5(raw[8 * (ends[i] - sizes[i]) : 8 * ends[i]]).digest()
                    if name not in met and ids[i].is_valid:
                        met.add(name)
                        new[i] = True
                keep = new[doc]
                keys, of, parts = region_keys(h[keep], doc[keep], sizes * new, similarity)
                order = np.argsort(of, kind="stable")
                # rows of few keys, so that no batch of rows is large
                ends_of = np.searchsorted(of[order], np.arange(n), side="right")
                pieces = np.maximum(-(-np.diff(ends_of, prepend=0) // KEYS_PER_ROW), 1)
                row = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin = np.concatenate([[0], ends_of[:-1]])[row] + piece * KEYS_PER_ROW
                offsets = pa.array(np.concatenate([begin, [len(of)]]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (keys.view(np.int64), parts)]
                columns = [ids.take(pa.array(row)), pa.array(sizes[row].astype(np.int64)), pa.array(set_ids, pa.binary()).take(pa.array(row)), pa.array(piece == 0), *lists]
                yield pa.record_batch(columns, ["doc_id", "n_shingles", "set_id", "is_first", "keys", "parts"])

    return docs.mapInArrow(giving_back(run), _SETS)


_SETS = "doc_id long, n_shingles long, set_id binary, is_first boolean, keys array<long>, parts array<long>"


def _free(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written: it does so
    when their plans are collected as garbage, which a driver with free memory puts off."""
    gc.collect()
    spark._jvm.System.gc()


def _filter_words(shared: DataFrame) -> np.ndarray:
    """The bits of the shared regions, one for each by its last bits; aggregated by words, ``FILTER_BITS / 64`` rows at most."""
    at = shared.select(F.col("region").bitwiseAND(FILTER_BITS - 1).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _shared_cells(sets: DataFrame) -> tuple[DataFrame, Broadcast]:
    """((region, count, node, n, parts) for the regions that more than one set has, the filter they come through).

    The filter, of fixed size, lets all shared regions pass and few others while these are few; the join
    with the shared regions is what decides.
    """
    spark = sets.sparkSession
    shared = cut_lineage(
        sets.select(F.explode("keys").alias("region")).groupBy("region").agg(F.count("*").cast("int").alias("count")).where("count > 1")
    )
    passing = spark.sparkContext.broadcast(_filter_words(shared))
    _free(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = passing.value
        for batch in batches:
            keys = batch.column(2)
            region = keys.flatten().to_numpy()
            at = region & (FILTER_BITS - 1)
            hit = np.flatnonzero(words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            if not len(hit):
                continue
            row = pa.array(np.repeat(np.arange(batch.num_rows), keys.value_lengths().to_numpy())[hit])
            columns = [pa.array(region[hit]), batch.column(0).take(row), batch.column(1).take(row), batch.column(3).flatten().take(pa.array(hit))]
            yield pa.record_batch(columns, ["region", "node", "n", "parts"])

    cells = sets.select("doc_id", "n_shingles", "keys", "parts").mapInArrow(giving_back(run), "region long, node long, n long, parts long")
    return cells.join(shared, "region"), passing


def sketches(h: np.ndarray, doc: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of 64 bits, number of words of each document): for each set the parity of its shingles at each
    place, the hash's last bits; two to four places for a shingle.  The number of words is a power of two, so
    that the halves of a sketch, one upon the other, are the sketch of half as many places."""
    words = np.left_shift(1, np.ceil(np.log2(np.maximum(sizes / 32, 1))).astype(np.int64))
    begin = np.cumsum(words) - words
    place = (h & (64 * words[doc] - 1).astype(np.uint64)).astype(np.int64) + 64 * begin[doc]
    odd = (np.bincount(place, minlength=64 * int(words.sum())) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8"), words


def _shingles(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, sketch, shingles) with the distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, texts in slices(batch, "text", SMALL_SLICE):
                h, doc = shingle_sets(texts, width)
                offsets = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))
                bits, words = sketches(h, doc, np.diff(offsets))
                sketch = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(words)].astype(np.int32)), pa.array(bits.view(np.int64)))
                columns = [batch.column(0).slice(first, n), pa.array(np.diff(offsets)), sketch, lists]
                yield pa.record_batch(columns, ["doc_id", "n", "sketch", "shingles"])

    return docs.mapInArrow(giving_back(run), "doc_id long, n int, sketch array<long>, shingles array<long>")


def _by_node(shingles: DataFrame) -> tuple[DataFrame, str]:
    """The sets written in buckets of their node, and the name of that table: joins on the node shuffle the pairs only."""
    spark = shingles.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"wellspring_shingles_{uuid.uuid4().hex}"
    dealt = shingles.repartition(buckets, "doc_id").write.bucketBy(buckets, "doc_id").sortBy("doc_id")
    dealt.option("path", scratch_path(spark, "shingles")).saveAsTable(name)
    return spark.table(name), name


def _measured(pairs: DataFrame, shingles: DataFrame, similarity: Fraction) -> DataFrame:
    """Distinct ``pairs`` (a, b) with ``distance`` and ``linked``, written once."""
    x = shingles.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_x"))
    y = shingles.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    counted = pairs.distinct().join(x, "a").join(y, "b").select("a", "b", both.alias("_i"), (F.size("_x") + F.size("_y")).alias("_s"))
    union = F.col("_s") - F.col("_i")
    linked = F.col("_i").cast("long") * similarity.denominator >= union.cast("long") * similarity.numerator
    return cut_lineage(counted.select("a", "b", (1 - F.col("_i") / union).alias("distance"), linked.alias("linked")))


def _open_regions(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows (region, node, ...) of regions with several components, with ``label``, the component."""
    labels = connected_components(links).withColumnRenamed("component", "label")
    labelled = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = labelled.groupBy("region").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count("*").alias("size"))
    return labelled.join(several.where("_lo <> _hi").drop("_lo", "_hi"), "region")


def _split(rows: DataFrame, shingles: DataFrame, similarity: Fraction, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the Voronoi cells with their windows, links found) of regions given as (region, node)."""
    radius = float(1 - similarity)
    order = F.xxhash64(F.lit(seed), "node")
    pivots = rows.groupBy("region", F.pmod(order, F.lit(PIVOTS)).alias("_j")).agg(F.min_by("node", order).alias("pivot"))
    paired = rows.select("region", "node").join(pivots.select("region", "pivot"), "region")
    measured = _measured(paired.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")), shingles, similarity)
    far = paired.join(measured, (paired["node"] == measured["a"]) & (paired["pivot"] == measured["b"]), "left").select(
        "region", "node", "pivot", F.coalesce("distance", F.lit(0.0)).alias("distance")
    )
    nearest = far.groupBy("region", "node").agg(F.min("distance").alias("_least"))
    cells = far.join(nearest, ["region", "node"]).where(F.col("distance") <= F.col("_least") + 2 * radius + _SLACK)
    cells = cells.select(F.xxhash64("region", "pivot").alias("region"), "node", "distance")
    return cells, measured.where("linked").select("a", "b")


def _pairs(rows: DataFrame, shingles: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b) of nodes of a region that have different labels, whose distances to the region's
    pivot differ by the radius at most and which neither sizes nor sketches exclude: at each place where two
    sketches differ there is a shingle that one of the sets has alone."""
    sketched = shingles.select(F.col("doc_id").alias("node"), "n", "sketch")
    known = rows.select("region", "node", "label", "distance").join(sketched, "node")
    x = known.select("region", *[F.col(c).alias("_x" + c) for c in known.columns if c != "region"])
    y = known.select("region", *[F.col(c).alias("_y" + c) for c in known.columns if c != "region"])
    words, longer = F.least(F.size("_xsketch"), F.size("_ysketch")), F.greatest(F.size("_xsketch"), F.size("_ysketch"))

    def folded(sketch: str) -> Column:
        halves = F.zip_with(F.slice(sketch, F.lit(1), words), F.slice(sketch, words + 1, words), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(sketch) > words, halves).otherwise(F.col(sketch))

    unlike = F.zip_with(folded("_xsketch"), folded("_ysketch"), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    differing = F.aggregate(unlike, F.lit(0), lambda total, c: total + c).cast("long")
    p, q = similarity.numerator, similarity.denominator
    near = differing * (q + p) <= (F.col("_xn") + F.col("_yn")).cast("long") * (q - p)
    alike = F.least("_xn", "_yn").cast("long") * q >= F.greatest("_xn", "_yn").cast("long") * p
    window = F.abs(F.col("_xdistance") - F.col("_ydistance")) <= float(1 - similarity) + _SLACK
    other = (F.col("_xnode") < F.col("_ynode")) & (F.col("_xlabel") != F.col("_ylabel"))
    cond = (x["region"] == y["region"]) & other & window & alike & ((longer > 2 * words) | near)
    return x.join(y, cond).select(F.col("_xnode").alias("a"), F.col("_ynode").alias("b"))


def _members(cells: DataFrame, similarity: Fraction) -> DataFrame:
    """(node, parts, n, regions, leading) for each set and size band; ``regions`` in one order for all
    sets, small regions first.

    Two linked sets differ in no more classes than shingles, so they have
    ``parts - (differing shingles)`` regions in common at least, where no more than
    those of the largest partner in the band differ, and of regions that are single shingles
    ``similarity * n``: sets with fewer shared regions are linked with nothing, and the first
    common region of two linked sets is among the ``leading`` ones of both; regions that no
    other set has come first of all.  Where the parts promise none, all regions are leading,
    for the other set may be one whose parts promise one.
    """
    code = F.shiftleft(F.least("count", F.lit((1 << 18) - 1)).cast("long"), 45).bitwiseOR(F.col("region").bitwiseAND((1 << 45) - 1))
    per = cells.groupBy("node", "parts").agg(F.max("n").alias("n"), F.sort_array(F.collect_set(code)).alias("regions"))
    lasts = F.array(*[F.lit(int(b) - 1) for b in band_starts(1 << 48)[1:]])
    last = F.get(lasts, F.shiftright("parts", _PARTS_BITS).cast("int"))
    partner = F.least(F.floor(F.col("n") * (float(1 / similarity) + _SLACK)), last)
    most = F.floor((F.col("n") + partner) * (float((1 - similarity) / (1 + similarity)) + _SLACK))
    of_parts = F.col("parts").bitwiseAND((1 << _PARTS_BITS) - 1) - most
    of_shingles = F.ceil(F.col("n") * (float(similarity) - _SLACK))
    least = F.greatest(F.when(F.col("parts") < _SINGLE, of_parts).otherwise(of_shingles), F.lit(1))
    leading = F.size("regions") - least + 1
    return per.withColumn("leading", leading.cast("int")).where("leading > 0")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: str | float = "0.8") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; ids are whole numbers."""
    at_least = Fraction(str(similarity))
    radius = float(1 - at_least)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    path = scratch_path(spark, "sets")
    _sets(texts, width, at_least).write.parquet(path)
    cells, passing = _shared_cells(spark.read.schema(_SETS).parquet(path))
    # 1. regions with more than one set
    rows = cut_lineage(_members(cells, at_least).select(F.explode(F.slice("regions", 1, F.col("leading"))).alias("region"), "node"))
    passing.destroy()
    _free(spark)
    sets = cut_lineage(spark.read.schema(_SETS).parquet(path).where("is_first").select("doc_id", "n_shingles", "set_id", (F.size("keys") > 0).alias("is_node")))
    drop_scratch(spark, path)
    _free(spark)

    wanted = cut_lineage(rows.select(F.col("node").alias("doc_id")).distinct())
    shingles, table = _by_node(_shingles(texts.join(wanted, "doc_id", "left_semi"), width))
    _free(spark)

    # equal sets: every node to the smallest id of its set
    classes = sets.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("class_id"))
    nodes = sets.where("is_node").select("set_id", F.col("doc_id").alias("node"))
    links = nodes.join(classes, "set_id").where("node <> class_id").select(F.col("node").alias("a"), F.col("class_id").alias("b"))

    # 2. one pivot for each region: the set that meets most others
    sizes = rows.groupBy("region").agg(F.count("*").alias("size"))
    crowd = rows.join(sizes, "region").groupBy("node").agg(F.sum("size").alias("crowd"))
    pivots = rows.join(crowd, "node").groupBy("region").agg(F.max_by("node", F.struct("crowd", "node")).alias("pivot"))
    rows = cut_lineage(rows.join(pivots, "region"))
    _free(spark)
    measured = _measured(rows.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")), shingles, at_least)
    links = cut_lineage(links.unionByName(measured.where("linked").select("a", "b")))
    _free(spark)
    distances = rows.join(measured, (rows["node"] == measured["a"]) & (rows["pivot"] == measured["b"]), "left")
    distances = distances.select(rows["region"], rows["node"], F.coalesce("distance", F.lit(0.0)).alias("distance"))

    # 3. open regions: split the large ones, compare what is left
    waiting = cut_lineage(_open_regions(distances, links))
    _free(spark)
    pairs = _pairs(waiting.where(F.col("size") <= LEAF), shingles, at_least)
    large = waiting.where(F.col("size") > LEAF)
    for seed in range(SPLITS):
        if large.isEmpty():
            break
        cells, found = _split(large, shingles, at_least, seed)
        links = cut_lineage(links.unionByName(found))
        parts = cut_lineage(_open_regions(cells, links))
        pairs = pairs.unionByName(_pairs(parts.where(F.col("size") <= LEAF), shingles, at_least))
        large = parts.where(F.col("size") > LEAF)
    else:
        pairs = pairs.unionByName(_pairs(large, shingles, at_least))
    last = _measured(pairs, shingles, at_least).where("linked").select("a", "b")
    spark.sql(f"DROP TABLE {table}")  # its files stay in the shared folder, as those of all written steps
    _free(spark)

    components = connected_components(links.unionByName(last)).withColumnRenamed("node", "class_id")
    return (
        sets.select("doc_id", "n_shingles", "set_id")
        .join(classes, "set_id", "left")
        .join(components, "class_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id"),
        )
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: str | float = "0.8") -> DataFrame:
    """``docs`` without the documents that have a linked one with a smaller id.

    A document is a text with its id: rows that repeat both go but one, while different texts under one id
    are judged apart, each by its own links.  Of linked texts with the same smallest id one stays.  Rows with a null id stay.
    """
    number = F.col(id_col).cast("long")
    hashed = docs.where(number.isNotNull()).select(number.alias("__id"), F.xxhash64(text_col).alias("__hash"))
    several = cut_lineage(
        hashed.groupBy("__id").agg(F.count("*").alias("__rows"), (F.min("__hash") != F.max("__hash")).alias("__differ")).where("__rows > 1")
    )
    # the key of a document is its id, but for ids with different texts a hash of both
    keyed = docs.join(several, number == F.col("__id"), "left").withColumn("__key", F.when(F.coalesce("__differ", F.lit(False)), F.xxhash64(number, text_col)).otherwise(number))
    groups = jaccard_components(keyed, "__key", text_col, width, similarity).where("doc_id is not null").select(F.col("doc_id").alias("__key"), "component_id")
    named = groups.distinct().join(keyed.where("__differ").select("__key", number.alias("__own")).distinct(), "__key", "left")
    named = cut_lineage(named.withColumn("__own", F.coalesce("__own", "__key")))
    first = named.groupBy("component_id").agg(F.min(F.struct("__own", "__key"))["__key"].alias("__first"))
    gone = cut_lineage(named.join(first, "component_id").where("__key <> __first").select("__key"))
    kept = keyed.join(gone, "__key", "left_anti")
    # texts are shuffled only where a document is there twice
    again = F.coalesce(F.col("__rows") > 1, F.lit(False))
    return kept.where(~again).unionByName(kept.where(again).dropDuplicates(["__key"])).select(*docs.columns)


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, width=3, similarity="0.9")
