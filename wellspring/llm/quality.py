"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics (``STATISTICS``) are counted vectorised from the bytes, words, lines
and word shingles of whole texts.  The trees are grown on a bounded,
documented sample of labelled rows (``max_rows``): every statistic is cut into
at most ``bins`` quantile bins, gradients and Hessians are summed into
histograms, and each level splits all its nodes at the best bin border.
Complete trees are stored as flat arrays (node k has the children 2k+1 and
2k+2), so scoring moves all documents one level down per numpy step.
Scoring is one pass over the documents without a shuffle.

Defined cases: a null text is an empty one and its statistics are 0; whole
texts are read; repeated rows score alike; without any labelled row the score
is 0.5; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import MAX_ROWS, held_out, sample_labels, sampled_documents
from .textops import LOWER, buffers, prefix_sums, shingle_hashes, slices, substring_hashes, words

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_length", "line_length",
    "lower", "upper", "digit", "space", "newline", "stop", "mark", "symbol", "control", "other",
    "distinct_words", "commonest_word", "short_words", "long_words", "symbol_words", "upper_words", "one_byte_words",
    "distinct_lines", "commonest_line", "distinct_shingles",
)

_CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "symbol", "control", "other")
CLASS = np.full(256, _CLASSES.index("other"), np.uint8)
CLASS[:128] = _CLASSES.index("symbol")
CLASS[:32] = CLASS[127] = _CLASSES.index("control")
for _chars, _class in (
    ("abcdefghijklmnopqrstuvwxyz", "lower"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"),
    ("0123456789", "digit"),
    (" \t\r", "space"),
    ("\n", "newline"),
    (".?", "stop"),
    (",;:'\"-()!", "mark"),
):
    CLASS[list(_chars.encode())] = _CLASSES.index(_class)
_IS_NEWLINE = np.zeros(256, bool)
_IS_NEWLINE[ord("\n")] = True


def _repeats(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: number of values, of distinct values, and times of the commonest."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    runs = np.diff(np.r_[begin, len(h)])
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc[begin], runs)
    return np.bincount(doc, minlength=n), np.bincount(doc[begin], minlength=n), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    data, offsets = buffers(texts)
    n = len(texts)
    sizes = np.diff(offsets)
    doc_of_byte = np.repeat(np.arange(n, dtype=np.int64), sizes)
    kinds = CLASS[data]
    by_class = np.bincount(doc_of_byte * len(_CLASSES) + kinds, minlength=n * len(_CLASSES)).reshape(n, -1)
    lowered = LOWER[data]
    sums = prefix_sums(lowered)

    starts, ends, doc = words(data, offsets)
    lengths = ends - starts
    hashes = substring_hashes(sums, starts, ends)
    n_words, distinct, most = _repeats(hashes, doc, n)
    share = lambda mask: np.bincount(doc, mask, n) / np.maximum(n_words, 1)
    letters = np.zeros((2, len(data) + 1), np.int64)
    for row, kind in zip(letters, ("upper", "symbol"), strict=True):
        np.cumsum(kinds == _CLASSES.index(kind), out=row[1:])
    uppers, symbols = (row[ends] - row[starts] for row in letters)

    line_starts, line_ends, line_doc = words(data, offsets, _IS_NEWLINE)
    n_lines, distinct_lines, most_lines = _repeats(substring_hashes(sums, line_starts, line_ends), line_doc, n)
    n_shingles, distinct_shingles, _ = _repeats(*shingle_hashes(hashes, doc, n, 3), n)

    columns = {
        "log_bytes": np.log1p(sizes),
        "log_words": np.log1p(n_words),
        "log_lines": np.log1p(n_lines),
        "word_length": np.bincount(doc, lengths, n) / np.maximum(n_words, 1),
        "line_length": np.log1p(sizes / np.maximum(n_lines, 1)),
        "distinct_words": distinct / np.maximum(n_words, 1),
        "commonest_word": most / np.maximum(n_words, 1),
        "short_words": share(lengths <= 3),
        "long_words": share(lengths >= 12),
        "symbol_words": share(symbols > 0),
        "upper_words": share((uppers > 1) & (2 * uppers > lengths)),
        "one_byte_words": share(lengths == 1),
        "distinct_lines": distinct_lines / np.maximum(n_lines, 1),
        "commonest_line": most_lines / np.maximum(n_lines, 1),
        "distinct_shingles": distinct_shingles / np.maximum(n_shingles, 1),
    }
    columns |= {name: by_class[:, k] / np.maximum(sizes, 1) for k, name in enumerate(_CLASSES)}
    return np.column_stack([columns[name] for name in STATISTICS])


class BoostedTrees:
    """Binary classifier; ``feature``, ``border`` and ``value`` are (trees, nodes) arrays."""

    def __init__(self, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.1, ridge: float = 2.0, min_hessian: float = 3.0):
        self.trees, self.depth, self.bins, self.rate, self.ridge, self.min_hessian = trees, depth, bins, rate, ridge, min_hessian
        self.base = 0.0
        self.feature = np.zeros((0, 0), np.int64)
        self.border = np.zeros((0, 0))
        self.value = np.zeros((0, 0))

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        borders = [np.unique(np.quantile(x[:, f], quantiles)) for f in range(width)]
        binned = np.column_stack([np.searchsorted(borders[f], x[:, f], side="left") for f in range(width)])
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
        self.base = float(np.log(share / (1 - share)))
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.border = np.full((self.trees, inner), np.inf)  # unsplit nodes send all to the left
        self.value = np.zeros((self.trees, leaves))
        margin = np.full(n, self.base)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                best = np.full(count, 1e-6)
                for f in range(width):
                    if not len(borders[f]):
                        continue
                    slot = (node - first) * self.bins + binned[:, f]
                    sums_g = np.bincount(slot, g, count * self.bins).reshape(count, -1).cumsum(1)
                    sums_h = np.bincount(slot, h, count * self.bins).reshape(count, -1).cumsum(1)
                    all_g, all_h = sums_g[:, -1:], sums_h[:, -1:]
                    gain = sums_g**2 / (sums_h + self.ridge) + (all_g - sums_g) ** 2 / (all_h - sums_h + self.ridge) - all_g**2 / (all_h + self.ridge)
                    gain[(sums_h < self.min_hessian) | (all_h - sums_h < self.min_hessian)] = 0
                    gain = gain[:, : len(borders[f])]
                    at = gain.argmax(1)
                    found = gain[np.arange(count), at]
                    better = np.flatnonzero(found > best)
                    best[better] = found[better]
                    self.feature[t, first + better] = f
                    self.border[t, first + better] = borders[f][at[better]]
                node = self.step(x, t, node)
            leaf = node - inner
            sum_g, sum_h = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
            self.value[t] = self.rate * sum_g / (sum_h + self.ridge)
            margin += self.value[t, leaf]
        return self

    def step(self, x: np.ndarray, tree: int, node: np.ndarray) -> np.ndarray:
        right = x[np.arange(len(x)), self.feature[tree, node]] > self.border[tree, node]
        return 2 * node + 1 + right

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        for tree in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = self.step(x, tree, node)
            margin += self.value[tree, node - self.feature.shape[1]]
        return 1 / (1 + np.exp(-margin))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> BoostedTrees:
    """Trees from at most ``max_rows`` labelled documents; the driver gets their statistics, not their texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, texts in slices(batch, "text"):
                flat = pa.array(statistics(texts).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(STATISTICS)), flat)
                yield pa.record_batch([batch.column(0).slice(first, n), batch.column(2).slice(first, n), lists], ["doc_id", "label", "x"])

    chosen = sample_labels(labels, label, id_col, max_rows)
    kind = docs.schema[id_col].dataType.simpleString()
    sample = sampled_documents(docs, chosen, id_col, text_col).select("doc_id", "text", "label")
    table = sample.mapInArrow(counted, f"doc_id {kind}, label int, x array<double>").toArrow()
    if not table.num_rows:
        return BoostedTrees()
    table = table.sort_by([("doc_id", "ascending")])
    x = table["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    return BoostedTrees().fit(x, (table["label"].to_numpy() > 0).astype(float))


def score_quality(docs: DataFrame, model: BoostedTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, texts in slices(batch, "text"):
                yield pa.record_batch([batch.column(0).slice(first, n), pa.array(model.scores(statistics(texts)))], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(score, f"doc_id {kind}, score double")


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
