"""Token counts of sections, by offsets.

A record (one or more text fields joined by a line feed) is encoded once, as
a whole.  The tokens of a byte-level vocabulary cover its bytes without gaps, so the
sums of their lengths are their spans.  The spans are joined to the sections,
intervals of the same bytes, by one sorted search a document.

A token that crosses a section border is allocated by an explicit rule:
``start`` (the section of its first byte), ``end`` (of its last byte) or ``most``
(of the most bytes; ties to the earlier).  Every token counts once, so the counts
of a document add up to its token count.

Sections are the fields, cut further at line feeds with ``lines``; a line feed belongs to
the line that it ends, the one between two fields to the former.  Defined
cases: null fields are empty; an empty field is one section of no bytes and no
tokens; null ids are kept; repeated rows are counted each; an empty table gives
no rows; only the named columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import slices, text_column

RULES = ("start", "end", "most")
_ENCODINGS: dict[str, tuple] = {}


def _encoding(path: str, pattern: str) -> tuple:
    """(encoding, bytes of each id) of a rank file; made once a worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _ENCODINGS[path] = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _ENCODINGS[path]


def allocate(sizes: np.ndarray, begins: np.ndarray, total: int, rule: str) -> np.ndarray:
    """Tokens of each section: ``sizes`` are the tokens' bytes in order, ``begins`` the sections' first
    bytes, rising; a section without bytes gets none."""
    ends = np.cumsum(sizes)
    first = np.searchsorted(begins, ends - sizes, side="right") - 1
    if rule != "start" and len(sizes):
        last = np.searchsorted(begins, ends - 1, side="right") - 1
        if rule == "end":
            first = last
        else:
            borders = np.r_[begins, total]
            for i in np.flatnonzero(first != last):
                own = range(first[i], last[i] + 1)
                shares = [min(ends[i], borders[s + 1]) - max(ends[i] - sizes[i], borders[s]) for s in own]
                first[i] = own[int(np.argmax(shares))]
    return np.bincount(first, minlength=len(begins))


def count_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    fields: tuple[str, ...] = ("text",),
    lines: bool = True,
    rule: str = "start",
) -> DataFrame:
    """(doc_id, field, section, start, length, tokens): one row per section; section counts from 0
    in its field, start and length are bytes in the whole record."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    kind = docs.schema[id_col].dataType.simpleString()
    columns = [f"f{k}" for k in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, token_bytes = _encoding(ranks_path, pattern)
        for batch in batches:
            texts = [text_column(batch, c) for c in columns]
            record = texts[0] if len(texts) == 1 else pc.binary_join_element_wise(*texts, pa.scalar("\n", pa.large_string()))
            whole = pa.record_batch([record], ["record"])
            for first, n, part in slices(whole, "record"):
                out: list[list] = [[], [], [], [], [], []]
                for i in range(n):
                    text = part[i].as_py()
                    ids = encoding.encode_to_numpy(text)
                    raw = np.frombuffer(text.encode(), np.uint8)
                    begins, field_of, section_of = _sections([texts[k][first + i].as_py().encode() for k in range(len(fields))], lines)
                    counts = allocate(token_bytes[ids], begins, len(raw), rule)
                    out[0].append(np.full(len(begins), i))
                    out[1].append(field_of)
                    out[2].append(section_of)
                    out[3].append(begins)
                    out[4].append(np.diff(np.r_[begins, len(raw)]))
                    out[5].append(counts)
                rows = [np.concatenate(x).astype(np.int64) for x in out]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, n).take(pa.array(rows[0])),
                        pa.array(fields).take(pa.array(rows[1])),
                        *[pa.array(x) for x in rows[2:]],
                    ],
                    ["doc_id", "field", "section", "start", "length", "tokens"],
                )

    picked = docs.select(F.col(id_col).alias("doc_id"), *[F.col(f).cast("string").alias(c) for f, c in zip(fields, columns, strict=True)])
    return picked.mapInArrow(run, f"doc_id {kind}, field string, section long, start long, length long, tokens long")


def _sections(values: list[bytes], lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, field, number in the field) of the sections of the fields, one after another."""
    begins, field_of, section_of, at = [], [], [], 0
    for k, value in enumerate(values):
        own = [0]
        if lines:
            feeds = np.flatnonzero(np.frombuffer(value, np.uint8) == 10) + 1
            own += feeds[feeds < len(value)].tolist()
        begins += [at + b for b in own]
        field_of += [k] * len(own)
        section_of += range(len(own))
        at += len(value) + 1
    return np.array(begins), np.array(field_of), np.array(section_of)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("field")
