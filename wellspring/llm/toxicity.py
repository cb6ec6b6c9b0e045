"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms (runs of letters and digits, A-Z
lower-cased), each hashed to one of ``2**bits`` features with value 1.  The
score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)

so pairs of terms count, which additive weights miss.  The model is fitted
with Adagrad on a bounded, documented sample of labelled rows (``max_rows``).
Labels are noisy and most terms are rare, so only features that say something
about the label (in at least ``min_docs`` documents, with a share that is ``min_z`` standard errors
above or below the common one) get weights and factors; the others stay 0 and cannot be
learned by heart.  A term may say nothing by itself but change what others say: a group
that is insulted, a quotation.  So a first model is fitted, and terms that say something among the
documents it scores above the common share are taken too.  Scoring is one pass over the
documents in Arrow batches, without a shuffle.

Defined cases: null and empty texts have no terms and get the score of the
bias; whole texts are read; repeated rows score alike; without any labelled row
the score is 0; an empty table gives no rows; only the id and text columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import MAX_ROWS, held_out, sample_labels, sampled_documents
from .textops import LOWER, SMALL_SLICE, SPACE, buffers, distinct_per_document, give_back, giving_back, prefix_sums, slices, substring_hashes, words

BITS = 16
FACTORS = 8
MIN_DOCS = 8
MIN_Z = 4.0

#: Between terms: white space and ASCII characters that are no letters or digits.
BETWEEN = SPACE.copy()
BETWEEN[:128] = True
for _first, _last in ("09", "AZ", "az"):
    BETWEEN[ord(_first) : ord(_last) + 1] = False


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, document) pairs, distinct, ordered by document."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    starts, ends, doc = words(data, offsets, BETWEEN)
    h = substring_hashes(prefix_sums(data), starts, ends) >> np.uint64(64 - bits)
    return distinct_per_document(h, doc)


def _log_odds(labels: np.ndarray) -> float:
    share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6))
    return float(np.log(share / (1 - share)))


class FactorizationMachine:
    def __init__(self, bits: int = BITS, factors: int = FACTORS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bits = bits
        self.w0 = 0.0
        self.w = np.zeros(1 << bits, np.float32)
        self.v = rng.normal(0, 0.05, (1 << bits, factors)).astype(np.float32)

    def margins(self, feature: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(margin per document, sum of the factors per document)."""
        linear = np.bincount(doc, self.w[feature], n)
        vx = self.v[feature]
        sums = np.zeros((n, self.v.shape[1]))
        squares = np.zeros(n)
        if len(doc):
            begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            sums[doc[begin]] = np.add.reduceat(vx, begin, axis=0, dtype=np.float64)
            squares[doc[begin]] = np.add.reduceat((vx * vx).sum(1), begin, dtype=np.float64)
        return self.w0 + linear + 0.5 * ((sums**2).sum(1) - squares), sums

    def informative(self, rows: list[np.ndarray], labels: np.ndarray, min_docs: int, min_z: float) -> np.ndarray:
        """Whether each feature's documents have the label clearly more or less often than all."""
        if not len(rows):
            return np.zeros(len(self.w), bool)
        everything = np.concatenate(rows)
        seen = np.bincount(everything, minlength=len(self.w))
        hits = np.bincount(everything, np.repeat(labels, [len(r) for r in rows]), len(self.w))
        share = labels.mean()
        z = (hits - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
        return (seen >= min_docs) & (np.abs(z) >= min_z)

    def fit(
        self,
        rows: list[np.ndarray],
        labels: np.ndarray,
        min_docs: int = MIN_DOCS,
        min_z: float = MIN_Z,
        steps: int = 2000,
        batch: int = 256,
        rate: float = 0.3,
        decay: float = 1e-5,
        seed: int = 11,
    ) -> FactorizationMachine:
        """rows: the distinct features of each document."""
        known = self.informative(rows, labels, min_docs, min_z)
        start = self.v.copy()
        self._fit(rows, labels, known, max(1, steps // 4), batch, rate, decay, seed)
        suspect = np.flatnonzero(self._margins_of(rows) > _log_odds(labels))
        within = self.informative([rows[i] for i in suspect], labels[suspect], min_docs, min_z)
        self.w[:], self.v = 0, start
        return self._fit(rows, labels, known | within, steps, batch, rate, decay, seed)

    def _margins_of(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[self.margins(np.concatenate(some), np.repeat(np.arange(len(some)), [len(r) for r in some]), len(some))[0] for some in (rows[k : k + 1024] for k in range(0, len(rows), 1024))]])

    def _fit(self, rows, labels, known, steps: int, batch: int, rate: float, decay: float, seed: int) -> FactorizationMachine:
        """Whole epochs, ``steps`` batches at least, over the ``known`` features."""
        n = len(rows)
        self.v[~known] = 0
        rows = [r[known[r]] for r in rows]
        self.w0 = _log_odds(labels)
        g0, gw, gv = 1e-6, np.full(self.w.shape, 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32)
        rng = np.random.default_rng(seed)
        for _ in range(-(-steps // max(1, -(-n // batch)))):
            order = rng.permutation(n)
            for at in range(0, n, batch):
                some = order[at : at + batch]
                feature = np.concatenate([rows[i] for i in some])
                doc = np.repeat(np.arange(len(some)), [len(rows[i]) for i in some])
                margin, sums = self.margins(feature, doc, len(some))
                slope = (1 / (1 + np.exp(-margin)) - labels[some]) / len(some)
                slope_of = slope[doc].astype(np.float32)
                touched, back = np.unique(feature, return_inverse=True)
                dw = np.bincount(back, slope_of, len(touched)).astype(np.float32) + decay * self.w[touched]
                each = slope_of[:, None] * (sums[doc].astype(np.float32) - self.v[feature])
                dv = np.stack([np.bincount(back, each[:, f], len(touched)) for f in range(self.v.shape[1])], 1).astype(np.float32)
                dv += decay * self.v[touched]
                gw[touched] += dw * dw
                gv[touched] += dv * dv
                self.w[touched] -= rate * dw / np.sqrt(gw[touched])
                self.v[touched] -= 0.2 * rate * dv / np.sqrt(gv[touched])
                d0 = float(slope.sum())
                g0 += d0 * d0
                self.w0 -= 0.1 * rate * d0 / np.sqrt(g0)
        return self

    def scores(self, texts: pa.Array) -> np.ndarray:
        feature, doc = features(texts, self.bits)
        margin = self.margins(feature.astype(np.int64), doc, len(texts))[0]
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS, bits: int = BITS) -> FactorizationMachine | None:
    """The model, from at most ``max_rows`` labelled documents; None without any.  What
    comes to the driver are those rows' hashed features, not their texts."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, texts in slices(batch, "text", SMALL_SLICE):
                feature, doc = features(texts, bits)
                offsets = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32)))
                yield pa.record_batch([batch.column(0).slice(first, n), batch.column(2).slice(first, n), lists], ["doc_id", "label", "features"])

    chosen = sample_labels(labels, label, id_col, max_rows)
    kind = docs.schema[id_col].dataType.simpleString()
    sample = sampled_documents(docs, chosen, id_col, text_col).select("doc_id", "text", "label")
    table = sample.mapInArrow(giving_back(hashed), f"doc_id {kind}, label int, features array<int>").toArrow()
    if not table.num_rows:
        return None
    rows = sorted(zip(table["doc_id"].to_pylist(), table["label"].to_pylist(), (np.asarray(x.values, np.int64) for x in table["features"]), strict=True), key=lambda r: (str(r[0]), len(r[2])))
    return FactorizationMachine(bits).fit([r[2] for r in rows], np.array([r[1] > 0 for r in rows], float))


def score_toxicity(docs: DataFrame, model: FactorizationMachine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, texts in slices(batch, "text", SMALL_SLICE):
                found = model.scores(texts) if model else np.zeros(n)
                yield pa.record_batch([batch.column(0).slice(first, n), pa.array(found)], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(giving_back(score), f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: FactorizationMachine | None, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents that score below ``limit``, all columns as they were."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for first, n, texts in slices(batch, text_col, SMALL_SLICE):
                found = model.scores(texts) if model else np.zeros(n)
                yield batch.slice(first, n).filter(pa.array(found < limit))

    return docs.mapInArrow(giving_back(keep), docs.schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
