"""Removal of long byte strings that occur more than once in a corpus.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same document or another; judged on the input.  The strings
("windows") are found exactly, without shuffling every suffix:

1. *Anchors.*  Among the 64-byte strings inside a window, the one with the
   smallest hash is its anchor.  Equal windows have equal anchors, so only windows
   whose anchor occurs twice can repeat.  Neighbouring windows with one anchor
   make a segment; equal texts are one text.
2. *Arrays.*  Segments with equal content are one segment with a count: with
   two occurrences all its windows repeat.  The different segments of an anchor
   meet in one shard; a shard of a few MB gets a suffix array by induced sorting
   and permuted common prefixes, and a window repeats when it shares ``length``
   bytes with its neighbour in the array.
3. *Hot anchors.*  The segments of an anchor with more bytes than a task should
   hold are cut finer: windows are dealt by their place relative to the anchor and
   the bytes that all windows of such a place range have in common, in ranges of
   42, 6 and at last 1 places, where counting equal windows decides.  No group is
   dropped or cut off.

Defined cases: a null text is an empty one; texts shorter than ``length`` keep
all bytes; copies of a text (repeated rows too) lose everything if they have
``length`` bytes; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .suffix_array import permuted_common_prefixes, suffix_array
from .textops import INVERSES, SMALL_SLICE, buffers, giving_back, mixed, prefix_sums, slices

LENGTH = 400
GRAM = 64
SHARD_BYTES = 2 << 20
#: Place ranges that hot anchors are cut into, the last of them single windows.
_PLACES = (42, 6, 1)
_PIECE = 1 << 23
_PLACE_BITS = np.uint64(24)


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, place of the anchor, hash of the anchor) of each segment;
    places count from the start of ``data``."""
    span = length - GRAM + 1
    found = []
    for start in range(0, max(1, len(data) - length + 1), _PIECE):
        piece = data[start : start + _PIECE + length - 1]
        windows = len(piece) - length + 1
        if windows <= 0:
            break
        sums = prefix_sums(piece)
        grams = len(piece) - GRAM + 1
        hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * INVERSES.upto(grams))
        ranked = hashes >> _PLACE_BITS << _PLACE_BITS | np.arange(grams, dtype=np.uint64)
        rows = -(-grams // span)
        padded = np.full(rows * span, np.uint64(2**64 - 1))
        padded[:grams] = ranked
        padded = padded.reshape(rows, span)
        ahead = np.minimum.accumulate(padded, 1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
        anchor = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
        doc = np.searchsorted(offsets, np.arange(start, start + windows), side="right") - 1
        inside = np.flatnonzero(np.arange(start, start + windows) + length <= offsets[doc + 1])
        if not len(inside):
            continue
        of, at = doc[inside], anchor[inside]
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1) | (of[1:] != of[:-1])])
        found.append((of[new], inside[new] + start, np.diff(np.r_[new, len(inside)]), at[new] + start, hashes[at[new]].view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _text_ids(texts: pa.Array) -> list[bytes]:
    data, offsets = buffers(texts)
    return [hashlib.md5(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _texts(docs: DataFrame, id_col: str, length: int) -> DataFrame:
    """(doc_id, text_id, n_bytes, sha256, anchors, own) per row.  ``anchors`` are the distinct
    anchors of the text, ``own`` those it has twice; a task gives them once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for first, n, texts in slices(batch, "text", SMALL_SLICE):
                data, offsets = buffers(texts)
                names = _text_ids(texts)
                new = np.array([name not in met and not met.add(name) for name in names], bool)
                of, _, _, _, hashes = _anchors(data, offsets, length)
                keep = new[of]
                of, hashes = of[keep], hashes[keep]
                order = np.lexsort((hashes, of))
                of, hashes = of[order], hashes[order]
                again = np.r_[False, (of[1:] == of[:-1]) & (hashes[1:] == hashes[:-1])] if len(of) else np.zeros(0, bool)
                lists = []
                for pick in (~again, again):
                    ends = np.searchsorted(of[pick], np.arange(n + 1)).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[pick])))
                shas = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                columns = [batch.column(0).slice(first, n), pa.array(names, pa.binary()), pa.array(np.diff(offsets)), pa.array(shas), *lists]
                yield pa.record_batch(columns, ["doc_id", "text_id", "n_bytes", "sha256", "anchors", "own"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), "text").mapInArrow(
        giving_back(run), f"doc_id {kind}, text_id binary, n_bytes long, sha256 string, anchors array<long>, own array<long>"
    )


def _first_texts(docs: DataFrame) -> DataFrame:
    """(text_id, text): every text once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            for _, _, texts in slices(batch, "text", SMALL_SLICE):
                names = _text_ids(texts)
                new = pa.array([name not in met and not met.add(name) for name in names], pa.bool_())
                yield pa.record_batch([pa.array(names, pa.binary()).filter(new), texts.cast(pa.string()).filter(new)], ["text_id", "text"])

    return docs.select("text").mapInArrow(giving_back(run), "text_id binary, text string")


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """One row per occurrence of a shared anchor's segment in (text_id, text, shared):
    text_id, start, windows, anchor, segment_id, place (of the anchor in the segment)
    and, the first time in a task, the segment's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            names = batch.column(0)
            for first, n, texts in slices(batch, "text", SMALL_SLICE):
                data, offsets = buffers(texts)
                of, start, windows, place, hashes = _anchors(data, offsets, length)
                shared = batch.column(2).slice(first, n)
                owner = np.repeat(np.arange(n), pc.list_value_length(shared).to_numpy())
                wanted = np.column_stack([owner, pc.list_flatten(shared).to_numpy()])
                # (document, anchor) pairs that are shared: a sorted merge
                both = np.concatenate([wanted, np.column_stack([of, hashes])])
                tag = np.r_[np.zeros(len(wanted), np.int8), np.ones(len(of), np.int8)]
                order = np.lexsort((tag, both[:, 1], both[:, 0]))
                ordered = both[order]
                group = np.cumsum(np.r_[True, (ordered[1:] != ordered[:-1]).any(1)]) - 1 if len(order) else np.zeros(0, np.int64)
                has = np.zeros(len(order) + 1, bool)
                has[group[tag[order] == 0]] = True
                keep = np.zeros(len(of), bool)
                chosen = order[has[group] & (tag[order] == 1)] - len(wanted)
                keep[chosen] = True
                rows = np.flatnonzero(keep)
                raw = data.tobytes()
                ids, pieces = [], []
                for a, w in zip(start[rows].tolist(), windows[rows].tolist(), strict=True):
                    piece = raw[a : a + w + length - 1]
                    ids.append(name := hashlib.md5(piece).digest())
                    pieces.append(None if name in met else piece)
                    met.add(name)
                yield pa.record_batch(
                    [
                        names.slice(first, n).take(pa.array(of[rows])),
                        pa.array(start[rows] - offsets[of[rows]]),
                        pa.array(windows[rows]),
                        pa.array(hashes[rows]),
                        pa.array(ids, pa.binary()),
                        pa.array((place - start)[rows].astype(np.int32)),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["text_id", "start", "windows", "anchor", "segment_id", "place", "segment"],
                )

    schema = "text_id binary, start long, windows long, anchor long, segment_id binary, place int, segment binary"
    return texts.mapInArrow(giving_back(run), schema)


def repeated_in_shard(segments: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Ranges (first, end) of the window starts of each segment that repeat in the shard,
    by a suffix array and its permuted common prefixes."""
    symbols = np.concatenate([np.r_[np.frombuffer(s, np.uint8).astype(np.uint16) + 2, np.uint16(1)] for s in segments] + [np.zeros(1, np.uint16)])
    prefix, neighbour = permuted_common_prefixes(symbols, suffix_array(symbols, 258))
    sizes = np.array([len(s) for s in segments])
    begins = np.cumsum(np.r_[0, sizes[:-1] + 1])
    room = np.zeros(len(symbols), np.int64)
    for b, size in zip(begins, sizes, strict=True):
        room[b : b + size] = np.arange(size, 0, -1)
    hit = np.flatnonzero((prefix >= length) & (room >= length))
    repeats = np.zeros(len(symbols) + 1, bool)
    repeats[hit] = True
    repeats[neighbour[hit]] = True
    out = []
    for b, size in zip(begins, sizes, strict=True):
        edges = np.flatnonzero(np.diff(np.r_[False, repeats[b : b + size], False].astype(np.int8)))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
    return out


_RANGES = "array<struct<first: long, end: long>>"


def _by_arrays(segments: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(anchor, segment_id, ranges) of segments (anchor, segment_id, segment): whole groups of
    an anchor, each smaller than a shard, are put together into shards."""
    ranges = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            found = repeated_in_shard([r[2] for r in rows], length)
            kept = [(r, [{"first": a, "end": b} for a, b in f]) for r, f in zip(rows, found, strict=True) if f]
            return pa.record_batch(
                [pa.array([r[0] for r, _ in kept], pa.int64()), pa.array([r[1] for r, _ in kept], pa.binary()), pa.array([f for _, f in kept], ranges)],
                ["anchor", "segment_id", "ranges"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= shard_bytes and row[0] != rows[-1][0]:
                    yield shard()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
        if rows:
            yield shard()

    dealt = segments.select("anchor", "segment_id", "segment").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(giving_back(run), f"anchor long, segment_id binary, ranges {_RANGES}")


def _finer(segments: DataFrame, places: int, length: int) -> DataFrame:
    """Segments (anchor, segment_id, segment, place) cut into those of ``places`` neighbouring
    places of the window relative to the anchor; their anchor names the bytes that
    all such windows share.  parent and shift lead back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for anchor, name, segment, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                windows = len(segment) - length + 1
                for k in range((place - windows + 1) // places, place // places + 1):
                    lowest, highest = place - (k + 1) * places + 1, place - k * places  # window starts
                    core = segment[highest : lowest + length]  # inside every window of these places
                    first, last = max(lowest, 0), min(highest, windows - 1)
                    piece = segment[first : last + length]
                    key = hashlib.md5(anchor.to_bytes(8, "little", signed=True) + k.to_bytes(4, "little", signed=True) + core).digest()
                    out.append((int.from_bytes(key[:8], "little", signed=True), hashlib.md5(piece).digest(), piece, place - first, anchor, name, first))
            names = ["anchor", "segment_id", "segment", "place", "parent", "parent_id", "shift"]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    columns = segments.select("anchor", "segment_id", "segment", "place")
    return columns.mapInArrow(giving_back(run), "anchor long, segment_id binary, segment binary, place int, parent long, parent_id binary, shift long")


def _resolve(segments: DataFrame, length: int, shard_bytes: int, level: int = 0) -> DataFrame:
    """(anchor, segment_id, ranges) of the distinct ``segments`` (anchor, segment_id, segment,
    place, n): the window starts that repeat."""
    windows = F.octet_length("segment").cast("long") - length + 1
    everything = F.array(F.struct(F.lit(0).cast("long").alias("first"), windows.alias("end")))
    found = segments.where("n > 1").select("anchor", "segment_id", everything.alias("ranges"))
    groups = (
        segments.groupBy("anchor")
        .agg(F.count("*").alias("_k"), F.sum(F.octet_length("segment").cast("long")).alias("_bytes"))
        .where("_k > 1")
    )
    open_segments = segments.join(groups, "anchor")
    small = open_segments.where(F.col("_bytes") <= shard_bytes)
    found = found.unionByName(_by_arrays(small, length, shard_bytes))
    large = open_segments.where(F.col("_bytes") > shard_bytes)
    if level == len(_PLACES) or groups.where(F.col("_bytes") > shard_bytes).isEmpty():
        return found
    parts = cut_lineage(_finer(large, _PLACES[level], length))
    below = _resolve(cut_lineage(_distinct(parts)), length, shard_bytes, level + 1)
    lifted = parts.drop("segment", "place").join(below, ["anchor", "segment_id"])
    shifted = F.transform("ranges", lambda r: F.struct((r["first"] + F.col("shift")).alias("first"), (r["end"] + F.col("shift")).alias("end")))
    return found.unionByName(lifted.select(F.col("parent").alias("anchor"), F.col("parent_id").alias("segment_id"), shifted.alias("ranges")))


def _distinct(occurrences: DataFrame) -> DataFrame:
    """(anchor, segment_id, segment, place, n): each different segment once, with its occurrences."""
    return occurrences.groupBy("anchor", "segment_id").agg(
        F.first("segment", ignorenulls=True).alias("segment"), F.first("place").alias("place"), F.count("*").alias("n")
    )


def _edited(texts: DataFrame) -> DataFrame:
    """(text_id, n_removed, n_spans, kept) of (text_id, text, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                at = end = 0
                parts, count = [], 0
                for a, b in sorted((x["from"], x["to"]) for x in found):
                    if a > end or not count:
                        parts.append(raw[at:a] if count == 0 else raw[end:a])
                        count += 1
                    end = max(end, b)
                parts.append(raw[end:])
                left = b"".join(parts)
                kept.append(left)
                removed.append(len(raw) - len(left))
                spans.append(count)
            columns = [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.record_batch(columns, ["text_id", "n_removed", "n_spans", "kept"])

    return texts.mapInArrow(giving_back(run), "text_id binary, n_removed long, n_spans long, kept binary")


def _whole_characters(name: str) -> Column:
    """The bytes as text, without those of characters that were cut apart."""

    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    return decoded(name)


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: rows (doc_id, text_id, n_bytes, sha256), one per document; copies (text_id) of
    texts that occur more than once and go whole; edits (text_id, n_removed, n_spans, kept)
    of other and of such texts that share a part.  text_id is the MD5 of the text."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = cut_lineage(_texts(texts, "doc_id", length))

    number = F.xxhash64("text_id")
    met = rows.select(F.explode("anchors").alias("anchor"), number.alias("_n"))
    shared = met.groupBy("anchor").agg(F.min("_n").alias("_lo"), F.max("_n").alias("_hi")).where("_lo <> _hi").select("anchor")
    shared = shared.unionByName(rows.select(F.explode("own").alias("anchor"))).distinct()
    wanted = (
        rows.select("text_id", F.explode("anchors").alias("anchor"))
        .join(shared, "anchor")
        .groupBy("text_id")
        .agg(F.collect_set("anchor").alias("shared"))
    )
    candidates = cut_lineage(_first_texts(texts).join(cut_lineage(wanted), "text_id").dropDuplicates(["text_id"]))

    occurrences = cut_lineage(_segments(candidates.select("text_id", "text", "shared"), length))
    ranges = _resolve(cut_lineage(_distinct(occurrences)), length, shard_bytes)
    spans = (
        occurrences.select("text_id", "start", "anchor", "segment_id")
        .join(ranges, ["anchor", "segment_id"])
        .select("text_id", "start", F.explode("ranges").alias("r"))
        .groupBy("text_id")
        .agg(F.collect_set(F.struct((F.col("start") + F.col("r.first")).alias("from"), (F.col("start") + F.col("r.end") - 1 + length).alias("to"))).alias("spans"))
    )
    edits = _edited(candidates.select("text_id", "text").join(spans, "text_id").select("text_id", "text", "spans"))
    copies = rows.where(F.col("n_bytes") >= length).groupBy("text_id").count().where("count > 1").select("text_id")
    return rows.select("doc_id", "text_id", "n_bytes", "sha256"), copies, edits


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text_col`` (characters cut apart go whole);
    all rows and columns stay, and ``n_chars``, if there is one, counts the new text."""
    _, copies, edits = find_repeats(docs, id_col, text_col, length)
    edits = edits.select(F.col("text_id").alias("__edited"), _whole_characters("kept").alias("__kept"))
    copies = copies.select(F.col("text_id").alias("__copied"))
    name = F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")))
    new = F.when(F.col("__copied").isNotNull(), F.lit("")).otherwise(F.coalesce("__kept", F.col(text_col)))
    out = (
        docs.withColumn("__name", name)
        .join(edits, F.col("__name") == F.col("__edited"), "left")
        .join(copies, F.col("__name") == F.col("__copied"), "left")
        .withColumn("__new", new)
    )
    kept = {text_col: F.col("__new")}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.when(F.col("__new").isNotNull(), F.length("__new").cast(docs.schema["n_chars"].dataType))
    return out.withColumns(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_repeats(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, copies, edits = find_repeats(docs)
    edits = edits.select("text_id", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    copies = copies.withColumn("copied", F.lit(True))
    whole = F.col("copied").isNotNull()
    return (
        rows.join(edits, "text_id", "left")
        .join(copies, "text_id", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        )
    )
