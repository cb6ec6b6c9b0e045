import hashlib
from collections import Counter

import pytest

from wellspring.llm import repeats

from .cases import corpus, frame


def brute(texts, length):
    """id -> (kept bytes, spans) by looking at every window."""
    raw = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        end, spans, kept, at = -1, 0, b"", 0
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                if p > end or spans == 0:
                    kept += b[max(at, 0) : p] if p > at else b""
                    spans += 1
                end = at = p + length
        out.append((i, len(b), kept + b[max(at, 0) :], spans))
    return out


def found(docs, **options):
    rows, copies, edits = repeats.find_repeats(docs, **options)
    copied = {bytes(r.text_id) for r in copies.collect()}
    cut = {bytes(r.text_id): r for r in edits.collect()}
    out = []
    for r in rows.collect():
        name = bytes(r.text_id)
        if name in copied:
            out.append((r.doc_id, r.n_bytes, hashlib.sha256(b"").hexdigest(), 1))
        elif name in cut:
            out.append((r.doc_id, r.n_bytes, hashlib.sha256(bytes(cut[name].kept)).hexdigest(), cut[name].n_spans))
        else:
            out.append((r.doc_id, r.n_bytes, r.sha256, 0))
    return out


@pytest.mark.parametrize("shard_bytes", [repeats.SHARD_BYTES, 2500])  # the second cuts every larger group finer
def test_against_every_window(spark, shard_bytes):
    texts = corpus()
    docs = frame(spark, texts)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    expected = [(i, n, hashlib.sha256(k).hexdigest(), s) for i, n, k, s in brute(given, 400)]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(found(docs, shard_bytes=shard_bytes), key=key) == sorted(expected, key=key)


def test_cut_documents(spark):
    texts = corpus(2, 20)
    docs = frame(spark, texts)
    out = repeats.cut_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    given = [(r.doc_id, r.text) for r in docs.collect()]
    expected = sorted((str(i), k.decode("utf-8", "ignore") if s else ("" if t is None else t)) for (i, _, k, s), (_, t) in zip(brute(given, 400), given))
    rows = out.collect()
    assert sorted((str(r.doc_id), r.text or "") for r in rows) == expected
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None and r.doc_id is not None)
    assert repeats.cut_repeats(docs.limit(0)).count() == 0


def test_suffix_array_and_prefixes():
    import numpy as np

    from wellspring.llm.suffix_array import permuted_common_prefixes, suffix_array

    rng = np.random.default_rng(1)
    for trial in range(300):
        x = rng.integers(1, rng.integers(2, 6), rng.integers(1, 60))
        if trial % 3 == 0:
            x = np.tile(x[: max(1, len(x) // 4)], 5)
        t = np.r_[x, 0].astype(np.uint16)
        order = sorted(range(len(t)), key=lambda i: list(t[i:]))
        assert list(suffix_array(t, int(t.max()) + 1)) == order
        prefix, neighbour = permuted_common_prefixes(t, np.array(order))
        for i, j in zip(order[1:], order[:-1]):
            shared = 0
            while max(i, j) + shared < len(t) and t[i + shared] == t[j + shared]:
                shared += 1
            assert (neighbour[i], prefix[i]) == (j, shared)
