import bisect
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from wellspring.llm import bm25, token_counts

from .cases import corpus, frame, words


def brute(texts, k=10):
    """texts: list of (id, text); every query against every document."""
    counts = [(i, Counter(words(t))) for i, t in texts]
    n = len(counts)
    mean = sum(sum(c.values()) for _, c in counts) / n
    df = Counter(w for _, c in counts for w in c)
    out = {}
    for q, qc in {i: c for i, c in counts if i is not None and i % 100 == 0}.items():
        scores = []
        for d, c in counts:
            if d in (None, q):
                continue
            size = sum(c.values())
            s = sum(m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w, m in qc.items() if w in c)
            if s > 0:
                scores.append((-s, d))
        out[q] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize(("shard_bytes", "round_terms", "block"), [(8 << 20, 2_000_000, 1), (20_000, 300, 3), (8 << 20, 300, 1)])
def test_search_against_all_documents(spark, monkeypatch, shard_bytes, round_terms, block):
    monkeypatch.setattr(bm25, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(bm25, "ROUND_TERMS", round_terms)
    monkeypatch.setattr(bm25, "BLOCK", block)
    texts = corpus(6, 120)
    texts[100] = texts[4] + " the an ou"
    texts |= {4000 + 100 * i: texts[i] for i in range(3)}
    docs = frame(spark, texts, repeated=())
    rows = bm25.top_documents(docs, lambda c: c % 100 == 0).collect()
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    found = {}
    for r in sorted(rows, key=lambda r: r.rank):
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == {q for q, s in expected.items() if s}
    for q, own in found.items():
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert np.allclose([r.score for r in own], [-s for s, _ in expected[q]])
        assert [r.doc_id for r in own] == [d for _, d in expected[q]]
    assert bm25.top_documents(docs.limit(0), lambda c: c % 100 == 0).count() == 0


def test_a_search_task_has_many_shards(spark, monkeypatch):
    """What one shard has found spares work in the next, so small inputs of many files do not make a task each."""
    monkeypatch.setattr(bm25, "TASKS_PER_CORE", 1)
    docs = frame(spark, corpus(6, 400), repeated=()).repartition(64)
    plan = bm25.top_documents(docs, lambda c: c % 100 == 0)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {spark.sparkContext.defaultParallelism}, false" in plan


def test_shard_without_any_term_of_the_queries(spark):
    docs = spark.createDataFrame([(100, "a b"), (1, "c d")], "doc_id long, text string").repartitionByRange(2, "doc_id")
    assert bm25.top_documents(docs, lambda c: c % 100 == 0).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_against_offsets(spark, rule):
    texts = corpus(7, 20) | {4000: "a\n\n\nb\n", 4001: "\n", 4002: "café\n\U0001F600\U0001F600\n   x"}
    docs = frame(spark, texts)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = token_counts.count_tokens(docs, ranks, public_tokenizers.PATTERN, fields=("source", "text"), rule=rule).collect()
    encoding = token_counts._encoding(ranks, public_tokenizers.PATTERN)[0]
    assert isinstance(encoding, tiktoken.Encoding)
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    for doc, text in texts.items():
        if doc == 3:  # twice in the table
            continue
        record = "s\n" + (text or "")
        raw = record.encode()
        begins = [0, 2] + [2 + i + 1 for i, b in enumerate(raw[2:]) if b == 10 and 2 + i + 1 < len(raw)]
        counts, at = [0] * len(begins), 0
        for token in encoding.encode_ordinary(record):
            size = len(encoding.decode_single_token_bytes(token))
            own = [bisect.bisect_right(begins, p) - 1 for p in range(at, at + size)]
            best = {"start": own[0], "end": own[-1], "most": max(sorted(set(own)), key=own.count)}[rule]
            counts[best] += 1
            at += size
        own = sorted(found[doc], key=lambda r: r.start)
        if text:
            assert [(r.start, r.tokens) for r in own] == list(zip(begins, counts))
        assert sum(r.tokens for r in own) == sum(counts) and sum(r.length for r in own) == len(raw)
    assert token_counts.count_tokens(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_query_agrees_with_another_tokenizer_library(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    found = {}
    for r in token_counts.op6_token_counts(spark, sf).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.tokens))
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = r.text or ""
        begins = [0] + [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)]
        counts = [0] * len(begins)
        for start, _ in tokenizer.encode(text, add_special_tokens=False).offsets:
            counts[bisect.bisect_right(begins, start) - 1] += 1
        assert sorted(found[r.doc_id]) == list(enumerate(counts))
