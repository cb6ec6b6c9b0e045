import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wellspring.llm import packing

from .cases import corpus, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, window):
    """texts: list of (id, text); every token in one piece, sequences gapless, no padding."""
    tokenizer = Tokenizer.from_file(PATH)
    expected = sorted((str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in texts)
    pieces = {}
    for r in rows:
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
    total = {}
    for i, ids in expected:
        total.setdefault((i, len(ids)), []).append(ids)
    assert set(pieces) == set(total)
    for key, own in pieces.items():
        copies = total[key]
        assert sum(r.length for r in own) == len(copies) * key[1]
        for r in own:
            assert any(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in copies)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        size = sum(n for _, n in spans)
        assert size <= window and size & (size - 1) == 0  # full, or a power of two: no padding


@pytest.mark.parametrize(("window", "max_open"), [(2048, 512), (256, 3)])
def test_against_the_tokenizer(spark, window, max_open):
    texts = corpus(4, 30) | {4000: "A <|endoftext|> b", 4001: "It's ÉTÉ, ok... ẛ̣ x́,y 3.14'll", 4002: "tabs\tand\r\nfeeds\x0bx y　z"}
    docs = frame(spark, texts)
    rows = packing.pack_documents(docs, PATH, window=window, max_open=max_open).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], window)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_sum_of_squares_rule():
    """Each placement makes the sum of the squared level counts smallest."""
    rng = np.random.default_rng(2)
    packer = packing.Packer(16, 10**6)
    for _ in range(300):
        size = int(rng.integers(1, 16))
        before = packer.counts.copy()
        packer.add(0, np.zeros(size, np.uint32))
        options = []
        for level in [0, *np.flatnonzero(before)]:
            if level + size <= 16:
                after = before.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 16
                options.append((after**2).sum())
        assert (packer.counts**2).sum() == min(options)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = packing.op4_packing(spark, sf).collect()
    check(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], 2048)
