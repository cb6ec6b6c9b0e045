import math
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wellspring.llm import context_tree as ct

from .cases import corpus, frame, words

SF = "/root/testdata/sf0.001"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def sequence(text):
    return " ".join(words(text)).encode() + b"\xff"


class Brute:
    """Context-tree weighting by the recursion over all nodes, one bit at a time."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, Counter()
        for text in texts:
            s = b"\xff" * depth + sequence(text)
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    for bit in range(8):
                        self.counts[s[i - d : i], bit, s[i] >> (8 - bit), s[i] >> (7 - bit) & 1] += 1
        self.longer = {}
        for context, bit, prefix, _ in self.counts:
            if context:
                self.longer.setdefault((context[1:], bit, prefix), set()).add(context)

    def pair(self, context, bit, prefix):
        return self.counts[context, bit, prefix, 0], self.counts[context, bit, prefix, 1]

    @cache
    def own(self, context, bit, prefix):
        a, b = self.pair(context, bit, prefix)
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @cache
    def weighted(self, context, bit, prefix):
        own = self.own(context, bit, prefix)
        if len(context) == self.depth:
            return own
        beyond = sum(self.weighted(c, bit, prefix) for c in sorted(self.longer[context, bit, prefix]))
        return np.logaddexp(own, beyond) - math.log(2)

    def probability(self, context, bit, prefix):
        """Of a one, for the last ``depth`` bytes."""
        p, left, last = 0.0, 1.0, 0.5
        for d in range(self.depth + 1):
            c = context[len(context) - d :]
            a, b = self.pair(c, bit, prefix)
            if not a + b:
                break
            last = (b + 0.5) / (a + b + 1)
            stop = math.exp(self.own(c, bit, prefix) - math.log(2) - self.weighted(c, bit, prefix)) if d < self.depth else 1.0
            p, left = p + left * stop * last, left * (1 - stop)
        return p + left * last

    def score(self, text):
        s, total = b"\xff" * self.depth + sequence(text), 0.0
        for i in range(self.depth, len(s)):
            for bit in range(8):
                p = self.probability(s[i - self.depth : i], bit, s[i] >> (8 - bit))
                total += math.log10(p if s[i] >> (7 - bit) & 1 else 1 - p)
        return total


@pytest.mark.parametrize(("depth", "buckets", "block_bytes"), [(5, 7, 4000), (3, 1, 1 << 24), (4, 3, 1)])
def test_against_the_recursion(spark, depth, buckets, block_bytes):
    texts = {i: t for i, t in corpus(8, 30).items() if len(t or "") < 4000} | {4000: "abracadabra " * 9, 4001: "Zebra \U0001F600", 4002: "zz \t\x0b Q"}
    docs = frame(spark, texts)
    rows = ct.score_documents(docs, depth=depth, buckets=buckets, block_bytes=block_bytes).collect()
    given = [(r.doc_id, r.text) for r in docs.collect()]
    trained = [t for i, t in given if not held(i)]
    model = Brute(trained, depth)
    tokens = Counter(w for t in trained for w in [*words(t), None])
    n, v = sum(tokens.values()), len(tokens)
    expected = []
    for i, t in given:
        own = [*words(t), None]
        base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        expected.append((str(i), held(i), len(own), sum(tokens[w] > 0 for w in own), n, round(base, 4), len(sequence(t)), model.score(t)))
    found = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), r.n_bytes, r.score) for r in rows]
    assert [x[:-1] for x in sorted(found)] == [x[:-1] for x in sorted(expected)]
    for x, y in zip(sorted(found), sorted(expected), strict=True):
        assert abs(x[-1] - y[-1]) < 1e-5 * max(1, abs(y[-1])), (x, y)
    for r in rows:
        assert abs(r.bits_per_byte + r.score * math.log2(10) / r.n_bytes) < 1e-9


def test_bytes_add_up_to_one():
    """After any context, seen or not, the probabilities of all bytes add up to 1."""
    keys, _ = ct.strings([b"abracadabra", b"abba"], 5)
    k, c = ct.summed(keys, np.ones(len(keys), np.int64))
    tree = ct.subtrees(k, c, 5, 0)
    empty = ct.Upper(pa.table({n: pa.array([], pa.int64()) for n in ("depth", "context", "node", "zeros", "ones", "log_weighted", "stop")}), -1)
    for context in (k[0] >> np.uint64(8), k[-1] >> np.uint64(8), np.uint64(0x6162737172)):
        every = context << np.uint64(8) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** ct.log10_probability(every, tree, empty, 5, 0)).sum() - 1) < 1e-9


def test_log_gamma():
    x = np.r_[0.5, 1, 1.5, 2, 10, 123.5, 1e6, 1e12]
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


def test_empty_tables_and_no_training(spark):
    docs = frame(spark, corpus(9, 10))
    assert ct.score_documents(docs.limit(0), buckets=4).count() == 0
    rows = ct.score_documents(docs, buckets=4, is_held_out=F.lit(True)).collect()
    for r in rows:
        assert r.held_out and r.n_known == 0 and r.train_tokens == 0
        assert abs(r.score + r.n_bytes * math.log10(256)) < 1e-3 * r.n_bytes
        assert abs(r.base_score - r.n_tokens * math.log10(0.5 / 0.5)) < 1e-9


def test_query(spark):
    """Held-out texts are likelier than by single words on a corpus of some size; both folds are there."""
    rows = ct.op11_scores(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    out = [r for r in rows if r.held_out]
    assert 0.15 < len(out) / len(rows) < 0.25 and all(r.held_out == held(r.doc_id) for r in rows)
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    junk = [r.bits_per_byte for r in rows if r.n_bytes > 200]
    assert 1 < np.median(junk) < 3
