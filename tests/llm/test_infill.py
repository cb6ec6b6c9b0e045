import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from wellspring.llm import infill
from wellspring.llm.textops import buffers

from .cases import corpus, frame, prose

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
TEXTS = {4000: "a<P>b", 4001: "x" * 5000 + "1" + "y" * 5000, 4002: "日本語 é\U0001F600 ab" * 200, 4003: "ab" * 3000, 4004: "\n", 4005: "1234567890" * 300, 4006: "é"}


def brute(i, text):
    """(n, form, prefix, middle, output) by cutting the list of tokens."""
    text = text or ""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(tokens), "plain", None, None, text
    low, high = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    spm = h4 % 100 < 20
    return len(tokens), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("memo_bytes", [32 << 20, 3000])
def test_against_lists_of_tokens(spark, memo_bytes):
    docs = frame(spark, corpus(6, 60) | TEXTS | {5000 + i: "A b1. " * 40 + prose(np_rng(i), 90) for i in range(60)})
    out = infill.fill_in_middle(docs, memo_bytes=memo_bytes)
    rows = out.withColumn("restored", infill.restored(out["output"], out["form"])).collect()
    given = docs.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in rows) == sorted(
        (str(r.doc_id), *(x if k not in (2, 3) else str(x) for k, x in enumerate(brute(r.doc_id, r.text)))) for r in given
    )
    assert sorted(r.restored for r in rows) == sorted(r.text or "" for r in given)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(docs.limit(0)).count() == 0


def np_rng(seed):
    import random

    return random.Random(seed)


def test_chunks_follow_the_content_and_hits_are_verified():
    """A passage has the same chunks after any beginning; the memo answers for them."""
    rng = np_rng(1)
    passage = prose(rng, 2000)
    texts = [prose(rng, 30 + 7 * k) + passage for k in range(6)]
    data, offsets = buffers(pa.array(texts, pa.large_string()))
    ends = infill.chunk_ends(data, offsets)
    memo = infill.Memo()
    for i, text in enumerate(texts):
        own = ends[(ends > offsets[i]) & (ends <= offsets[i + 1])] - offsets[i]
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip([0, *own[:-1]], own)) == raw
        n, borders = infill.token_borders(raw, own.tolist(), memo)
        places = np.cumsum([0] + [len(t.encode()) for t in TOKEN.findall(text)])
        assert n == len(places) - 1 and [borders.after(k) for k in range(n + 1)] == places.tolist()
    assert memo.hits > 3 * memo.misses


def test_runs_of_one_character_make_few_chunks():
    for text in ("a" * 100_000, " " * 100_000, "ab" * 50_000):
        data, offsets = buffers(pa.array([text], pa.large_string()))
        assert len(infill.chunk_ends(data, offsets)) <= 50_001


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({infill.ORACLE_SQL})").fetchall()
    rows = infill.op12_infill(spark, SF).select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(expected)
