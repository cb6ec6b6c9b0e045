"""Language-model scores by context-tree weighting over bytes.

The byte after a context is coded as eight binary decisions; each decision has,
at every context depth from 0 to ``depth`` bytes, a node with the counts of its zeros and
ones and the Krichevsky-Trofimov estimate of them.  A node weighs its own estimate
against the product of its one-byte-longer contexts, half and half a priori:
``Pw = 1/2 Pe + 1/2 prod Pw(longer)``, and ``Pw = Pe`` at full depth.  After training
the decision's probability is the mixture of the estimates along the path, with the
weights that the training text left: ``1/2 Pe / Pw`` stops at a node, the rest goes on.  The
deepest node that was seen takes all that is left, so that every byte has a probability
above 0 and those of all bytes add up to 1.

A text is the sequence of its words, A-Z lower-cased, with one space between,
closed by a byte that UTF-8 never has; ``score`` is the log10 probability of that
sequence and ``bits_per_byte`` its code length per byte.  ``base_score`` is the score of single
words: the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over words and the closing.

How it runs.  All training texts are counted; nothing is sampled.

1. Documents are taken in blocks of about ``block_bytes``.  A block knows its distinct
   strings of ``depth + 1`` bytes and its distinct words with their counts in training texts,
   and sends them, packed, to buckets: words by hash, strings by the last ``depth - 2`` bytes
   of their context, so that a bucket has whole subtrees of depth 3.
2. A bucket adds up the counts and builds its subtrees from the leaves; nodes at
   the subtrees' roots go on to the upper tree, one aggregate for each depth.
3. The upper tree (depths 0 to ``depth - 3``) goes to all tasks.  By default it has contexts of at most two
   bytes: 1 + 256 + 65,536 of 255 nodes each, however large the corpus.  The buckets answer each
   block's strings with log10 probabilities and its words with counts.
4. The answers meet their block's documents, which look up each of their bytes and words.

Rows between steps are arrays of one block and bucket.  ``buckets`` is
``spark.sql.shuffle.partitions`` unless given: the width the cluster chose for its data.
Words are told apart by 64-bit hashes.

Defined cases: a null or empty text is the closing alone; a null id is in training; repeated rows count each;
without training texts every byte has 1/256; an empty table gives no rows; only the id and text
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path
from .textops import buffers, mixed, prefix_sums, slices, substring_hashes, words

DEPTH = 5
BLOCK_BYTES = 16 << 20
#: Of five folds by the CRC-32 of the id as text, this one is not learned from.
FOLDS, HELD_OUT = 5, 1
END = 0xFF
_END_WORD = np.array([0xFFFFFFFFFFFFFFFF], np.uint64)
_LN2, _LN10 = float(np.log(2)), float(np.log(10))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


# -- texts -----------------------------------------------------------------------------------
def normalised(texts: pa.Array) -> list[bytes]:
    """Each text as its words with one space between, A-Z lower-cased."""
    data, offsets = buffers(texts)
    raw = data.tobytes()
    return [b" ".join(raw[a:b].lower().split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def strings(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) of every byte of the bodies and of their ends.  A key has the context's bytes,
    the last one highest, above the byte itself; before a text there are ends."""
    pad = bytes([END]) * depth
    data = np.frombuffer(b"".join(pad + b + pad[:1] for b in bodies), np.uint8)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1
    begin = np.cumsum(sizes + depth) - sizes
    doc = np.repeat(np.arange(len(bodies)), sizes)
    at = np.arange(len(doc)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    wide = data.astype(np.uint64)
    keys = wide[at]
    for k in range(1, depth + 1):
        keys |= wide[at - k] << np.uint64(8 * (depth + 1 - k))
    return keys, doc


def word_keys(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word; the end of each body is one too."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    offsets = np.r_[0, np.cumsum(np.fromiter(map(len, bodies), np.int64, len(bodies)))]
    starts, ends, doc = words(data, offsets)
    h = np.minimum(substring_hashes(prefix_sums(data), starts, ends), _END_WORD - np.uint64(1))
    return np.concatenate([h, np.repeat(_END_WORD, len(bodies))]), np.concatenate([doc, np.arange(len(bodies))])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[begin], np.add.reduceat(counts[order], begin) if len(begin) else counts[:0]


def packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values, highest bytes of all first: planes that are alike compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, ::-1].T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T[:, ::-1]).view("<u8").ravel().astype(np.uint64)


class Counter:
    """Distinct keys and their counts, merged a few million at a time."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > (1 << 20) + len(self.keys):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            parts = [(self.keys, self.counts), *self.waiting]
            self.keys, self.counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            self.waiting, self.held = [], 0
        return self.keys, self.counts


def bucket_of(keys: np.ndarray, what: int, depth: int, buckets: int) -> np.ndarray:
    """Words by hash; strings by the last ``depth - 2`` bytes of the context."""
    chosen = keys if what == WORDS else keys >> np.uint64(8 * 3)
    return (mixed(chosen + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


STRINGS, WORDS = 0, 1


# -- the tree ---------------------------------------------------------------------------------
def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x > 0 (Stirling's series above 8)."""
    y = x + 8
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    a, b = zeros.astype(float), ones.astype(float)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


class Level:
    """The nodes of one depth and one decision: sorted keys (context, bits before), counts, log Pe and log Pw."""

    def __init__(self, keys, zeros, ones, longer: Level | None = None, log_weighted=None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_estimate(zeros, ones)
        if log_weighted is None:
            log_weighted = own
            if longer is not None:
                # a longer context's key without the context's first byte is its parent's
                low = longer.bits
                parent = longer.keys >> np.uint64(8 + low) << np.uint64(low) | longer.keys & np.uint64((1 << low) - 1)
                beyond = np.bincount(np.searchsorted(keys, parent), longer.log_weighted, len(keys))
                log_weighted = np.logaddexp(own, beyond) - _LN2
                self.stop = np.exp(own - _LN2 - log_weighted)
            else:
                self.stop = np.ones(len(keys))
        self.log_weighted = log_weighted
        self.one = (ones + 0.5) / (zeros + ones + 1.0)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are there, their places)."""
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        return (self.keys[at] == wanted if len(self.keys) else np.zeros(len(wanted), bool)), at


def decisions(keys: np.ndarray, counts: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node keys, zeros, ones) of decision ``bit`` for sorted (context, byte) keys."""
    node = keys >> np.uint64(8 - bit)
    begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    if not len(begin):
        return node, counts, counts
    ones = np.add.reduceat(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), counts, 0), begin)
    return node[begin], np.add.reduceat(counts, begin) - ones, ones


def at_depth(keys: np.ndarray, d: int, depth: int) -> np.ndarray:
    """Keys of full depth as those of depth d."""
    return keys >> np.uint64(8 * (depth + 1 - d)) << np.uint64(8) | keys & np.uint64(0xFF)


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[list[Level]]:
    """Levels [d - top][bit] of the depths ``top`` to ``depth`` over keys whose subtrees of depth ``top`` are whole."""
    tree: list[list[Level]] = []
    for d in range(depth, top - 1, -1):
        k, c = summed(at_depth(keys, d, depth), counts)
        levels = []
        for bit in range(8):
            level = Level(*decisions(k, c, bit), longer=tree[0][bit] if tree else None)
            level.bits = bit
            levels.append(level)
        tree.insert(0, levels)
    return tree


class Upper:
    """The upper tree, from rows (depth, context, node, zeros, ones, log_weighted, stop); for each decision the mixture so far."""

    def __init__(self, table: pa.Table, deepest: int):
        column = {n: table[n].to_numpy() for n in table.column_names}
        self.levels = []
        for bit in range(8):
            lowest = np.uint64(1 << bit)
            per_depth: list[tuple] = []
            for d in range(deepest + 1):
                pick = (column["depth"] == d) & (column["node"] >= 1 << bit) & (column["node"] < 2 << bit)
                key = column["context"][pick].astype(np.uint64) << np.uint64(bit) | column["node"][pick].astype(np.uint64) - lowest
                order = np.argsort(key)
                key = key[order]
                zeros, ones, stop = (column[n][pick][order] for n in ("zeros", "ones", "stop"))
                one = (ones + 0.5) / (zeros + ones + 1.0)
                so_far, left = np.zeros(len(key)), np.ones(len(key))
                if per_depth:
                    parent = key >> np.uint64(8 + bit) << np.uint64(bit) | key & (lowest - np.uint64(1))
                    at = np.searchsorted(per_depth[-1][0], parent)
                    so_far, left = per_depth[-1][1][at], per_depth[-1][2][at]
                per_depth.append((key, so_far + left * stop * one, left * (1 - stop), one))
            self.levels.append(per_depth)

    def mixture(self, keys: np.ndarray, bit: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mixture so far, weight left, estimate of the deepest node seen) of full-depth keys."""
        so_far, left, last = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), 0.5)
        for d, (known, a, r, one) in enumerate(self.levels[bit]):
            if not len(known):
                continue
            wanted = at_depth(keys, d, depth) >> np.uint64(8 - bit)
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            hit = known[at] == wanted
            so_far, left, last = np.where(hit, a[at], so_far), np.where(hit, r[at], left), np.where(hit, one[at], last)
        return so_far, left, last


def log10_probability(keys: np.ndarray, tree: list[list[Level]], upper: Upper, depth: int, top: int) -> np.ndarray:
    """Of the byte of each key after its context."""
    total = np.zeros(len(keys))
    for bit in range(8):
        so_far, left, last = upper.mixture(keys, bit, depth)
        for d in range(top, depth + 1):
            level = tree[d - top][bit]
            hit, at = level.find(at_depth(keys, d, depth) >> np.uint64(8 - bit))
            if not len(level.keys):
                continue
            one, stop = level.one[at], level.stop[at]
            so_far = np.where(hit, so_far + left * stop * one, so_far)
            left = np.where(hit, left * (1 - stop), left)
            last = np.where(hit, one, last)
        p = so_far + left * last
        total += np.log(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), p, 1 - p))
    return total / _LN10


# -- the Spark job ------------------------------------------------------------------------------
_PARTS = "kind string, block long, doc_id {id}, body binary, held_out boolean, bucket long, what int, keys binary, counts binary"
_MODEL = "kind string, bucket long, what int, keys binary, counts binary, context long, node int, zeros long, ones long, log_weighted double"


def _blocks(docs: DataFrame, depth: int, buckets: int, block_bytes: int) -> DataFrame:
    """Documents with their block, and each block's messages to the buckets."""
    id_type = docs.schema["doc_id"].dataType
    types = [pa.string(), pa.int64(), to_arrow_type(id_type), pa.binary(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["kind", "block", "doc_id", "body", "held_out", "bucket", "what", "keys", "counts"]

    def rows(n: int, **given) -> pa.RecordBatch:
        columns = [given.get(name) for name in names]
        return pa.record_batch([pa.nulls(n, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        counters = [Counter(), Counter()]
        for batch in batches:
            for first, n, texts in slices(batch, "text"):
                bodies = normalised(texts)
                held = batch.column(2).slice(first, n)
                learned = ~held.to_numpy(zero_copy_only=False)
                yield rows(n, kind=["doc"] * n, block=[block] * n, doc_id=batch.column(0).slice(first, n), body=bodies, held_out=held)
                for counter, (keys, doc) in zip(counters, (strings(bodies, depth), word_keys(bodies)), strict=True):
                    counter.add(*_counted(keys, learned[doc]))
                size += sum(map(len, bodies))
                if size >= block_bytes:
                    yield _messages(rows, block, counters, depth, buckets)
                    block, size, counters = block + 1, 0, [Counter(), Counter()]
        if counters[WORDS].waiting or len(counters[WORDS].keys):
            yield _messages(rows, block, counters, depth, buckets)

    return docs.mapInArrow(run, _PARTS.format(id=id_type.simpleString()))


def _counted(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many of each are ``learned``; two plain sorts."""
    everything, trained = np.sort(keys), np.sort(keys[learned])
    distinct = everything[np.flatnonzero(np.r_[True, everything[1:] != everything[:-1]])] if len(everything) else everything
    return distinct, np.searchsorted(trained, distinct, side="right") - np.searchsorted(trained, distinct)


def _messages(rows, block: int, counters: list[Counter], depth: int, buckets: int) -> pa.RecordBatch:
    out: list[list] = [[], [], [], []]
    for what, counter in enumerate(counters):
        keys, counts = counter.merge()
        bucket = bucket_of(keys, what, depth, buckets)
        order = np.argsort(bucket, kind="stable")
        borders = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(borders)).tolist():
            own = order[borders[b] : borders[b + 1]]
            for column, value in zip(out, (b, what, packed(keys[own]), packed(counts[own])), strict=True):
                column.append(value)
    n = len(out[0])
    return rows(n, kind=["message"] * n, block=[block] * n, bucket=out[0], what=out[1], keys=out[2], counts=out[3])


def _bucket_models(messages: DataFrame, depth: int) -> DataFrame:
    """Of each bucket its counts (kind 'counts') and the roots of its subtrees (kind 'root')."""
    top = depth - 2
    names = [c.split()[0] for c in _MODEL.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]

    def rows(n: int, **given) -> pa.RecordBatch:
        return pa.record_batch([pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names)

    def finished(bucket: int, what: int, counter: Counter) -> Iterator[pa.RecordBatch]:
        keys, counts = counter.merge()
        keys, counts = keys[counts > 0], counts[counts > 0]
        # zeros and ones of words rows: tokens and distinct words
        yield rows(1, kind=["counts"], bucket=[bucket], what=[what], keys=[packed(keys)], counts=[packed(counts)], zeros=[int(counts.sum())], ones=[len(keys)])
        if what == STRINGS:
            for bit, level in enumerate(subtrees(keys, counts, depth, top)[0]):
                n = len(level.keys)
                context = (level.keys >> np.uint64(bit)).astype(np.int64)
                node = (level.keys & np.uint64((1 << bit) - 1)).astype(np.int32) + (1 << bit)
                yield rows(n, kind=["root"] * n, bucket=[bucket] * n, context=context, node=node, zeros=level.zeros, ones=level.ones, log_weighted=level.log_weighted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counter = None, Counter()
        for batch in batches:
            for bucket, what, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != (bucket, what):
                    if at:
                        yield from finished(*at, counter)
                    at, counter = (bucket, what), Counter()
                counter.add(unpacked(keys), unpacked(counts).astype(np.int64))
        if at:
            yield from finished(*at, counter)

    dealt = messages.select("bucket", "what", "keys", "counts").repartition("bucket").sortWithinPartitions("bucket", "what")
    return dealt.mapInArrow(run, _MODEL)


def _upper_tree(roots: DataFrame, top: int) -> DataFrame:
    """(depth, context, node, zeros, ones, log_weighted, stop) of the depths above ``top``, from the nodes at ``top``."""
    schema = "depth int, context long, node int, zeros long, ones long, log_weighted double, stop double"

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zeros, ones, beyond = (batch[n].to_numpy(zero_copy_only=False) for n in ("zeros", "ones", "beyond"))
            own = log_estimate(zeros, ones)
            total = np.logaddexp(own, beyond) - _LN2
            yield pa.record_batch([*batch.columns[:5], pa.array(total), pa.array(np.exp(own - _LN2 - total))], schema.replace(",", "").split()[::2])

    out, level = None, roots
    for d in range(top - 1, -1, -1):
        # sums of decimals do not depend on the order of the rows
        beyond = F.sum(F.col("log_weighted").cast("decimal(28,9)")).cast("double").alias("beyond")
        grouped = level.groupBy(F.lit(d).alias("depth"), F.shiftright("context", 8).alias("context"), "node")
        level = grouped.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), beyond).mapInArrow(weighted, schema)
        out = level if out is None else out.unionByName(level)
    return out


def _answers(model: DataFrame, messages: DataFrame, upper, depth: int) -> DataFrame:
    """(block, what, keys, values): the blocks' strings with log10 probabilities, their words with counts."""
    top = depth - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = upper.value
        at, known, counts, tree = None, np.zeros(0, np.uint64), np.zeros(0, np.int64), None
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for bucket, what, block, keys, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != (bucket, what):
                    at, known, counts, tree = (bucket, what), np.zeros(0, np.uint64), np.zeros(0, np.int64), None
                wanted = unpacked(keys)
                if block is None:
                    known, counts = wanted, unpacked(own).astype(np.int64)
                    continue
                if what == STRINGS:
                    tree = tree or subtrees(known, counts, depth, top)
                    values = log10_probability(wanted, tree, above, depth, top).astype("<f4")
                else:
                    place = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
                    values = np.where(known[place] == wanted, counts[place], 0).astype("<f8") if len(known) else np.zeros(len(wanted))
                for column, value in zip(out, (block, what, keys, values.tobytes()), strict=True):
                    column.append(value)
            if out[0]:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["block", "what", "keys", "values"])

    counted = model.select("bucket", "what", F.lit(None).cast("long").alias("block"), "keys", "counts")
    asked = messages.select("bucket", "what", "block", "keys", F.lit(None).cast("binary").alias("counts"))
    dealt = counted.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "what", F.col("block").asc_nulls_first())
    return dealt.mapInArrow(run, "block long, what int, keys binary, values binary")


def _scores(docs: DataFrame, answers: DataFrame, tokens: int, distinct: int, depth: int) -> DataFrame:
    """The documents with the answers of their block."""
    id_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
    schema = f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    share = float(np.log10(tokens + 0.5 * (distinct + 1)))

    def values(known: list[tuple], keys: np.ndarray) -> np.ndarray:
        k, v = known
        place = np.minimum(np.searchsorted(k, keys), len(k) - 1)
        if not (k[place] == keys).all():
            raise ValueError("a block's documents are not those that asked")
        return v[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, known = None, [[], []], None
        for batch in batches:
            whats = batch.column(1).to_pylist()
            at = 0
            while at < batch.num_rows:
                own = batch.column(0)[at].as_py()
                if own != block:
                    block, parts, known = own, [[], []], None
                if whats[at] is not None:
                    raw = batch.column(3)[at].as_py()
                    kind = "<f4" if whats[at] == STRINGS else "<f8"
                    parts[whats[at]].append((unpacked(batch.column(2)[at].as_py()), np.frombuffer(raw, kind).astype(float)))
                    at += 1
                    continue
                if known is None:
                    known = []
                    for part in parts:
                        k, v = np.concatenate([k for k, _ in part]), np.concatenate([v for _, v in part])
                        order = np.argsort(k, kind="stable")
                        known.append((k[order], v[order]))
                    parts = [[], []]
                end, size = at, 0
                while end < batch.num_rows and size < 2 << 20 and whats[end] is None and batch.column(0)[end].as_py() == block:
                    size += len(batch.column(5)[end].as_buffer())
                    end += 1
                yield scored(batch.slice(at, end - at), known)
                at = end

    def scored(batch: pa.RecordBatch, known: list) -> pa.RecordBatch:
        bodies, n = batch.column(5).to_pylist(), batch.num_rows
        keys, doc = strings(bodies, depth)
        n_bytes = np.bincount(doc, minlength=n)
        score = np.bincount(doc, values(known[STRINGS], keys), n)
        keys, doc = word_keys(bodies)
        counts = values(known[WORDS], keys)
        base = np.bincount(doc, np.log10(counts + 0.5) - share, n)
        n_tokens = np.bincount(doc, minlength=n)
        columns = [batch.column(4), batch.column(6), n_tokens, np.bincount(doc, counts > 0, n).astype(np.int64), np.full(n, tokens), base, score, n_bytes, -score * (_LN10 / _LN2) / n_bytes]
        return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    texts = docs.select("block", F.lit(None).cast("int").alias("what"), *[F.lit(None).cast("binary").alias(n) for n in ("keys", "values")], "doc_id", "body", "held_out")
    told = answers.select("block", "what", "keys", "values", F.lit(None).cast(id_type).alias("doc_id"), F.lit(None).cast("binary").alias("body"), F.lit(None).cast("boolean").alias("held_out"))
    dealt = told.unionByName(texts).repartition("block").sortWithinPartitions("block", F.col("what").asc_nulls_last())
    return dealt.mapInArrow(run, schema)


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    buckets: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    is_held_out: Column | None = None,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every
    document; the model learns from those that are not ``is_held_out`` (a column; by default one fold of the ids)."""
    if not 3 <= depth <= 7:
        raise ValueError("depth must be 3 to 7")
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = held_out(F.col(id_col)) if is_held_out is None else is_held_out
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    parts, models = scratch_path(spark, "blocks"), scratch_path(spark, "counts")
    _blocks(picked, depth, buckets, block_bytes).write.partitionBy("kind").option("compression", "zstd").parquet(parts)
    schema = _PARTS.format(id=docs.schema[id_col].dataType.simpleString())
    read = spark.read.schema(schema).parquet(parts)
    texts, messages = read.where("kind = 'doc'"), read.where("kind = 'message'")

    _bucket_models(messages, depth).write.partitionBy("kind").option("compression", "zstd").parquet(models)
    model = spark.read.schema(_MODEL).parquet(models)
    counts = model.where("kind = 'counts'")
    n, v = counts.where(F.col("what") == WORDS).agg(F.coalesce(F.sum("zeros"), F.lit(0)), F.coalesce(F.sum("ones"), F.lit(0))).first()
    upper = Upper(_upper_tree(model.where("kind = 'root'"), depth - 2).toArrow(), depth - 3)
    answers = _answers(counts, messages, spark.sparkContext.broadcast(upper), depth)
    return _scores(texts, answers, n, v, depth)


def op11_scores(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_documents(docs)
