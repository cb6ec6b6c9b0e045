"""Fill-in-the-middle transformation with a memo of content-defined chunks.

A document of n tokens (``[A-Za-z]+|[^A-Za-z]``) is cut at two of its n + 1
token borders into prefix, middle and suffix, and written with marks in the order
prefix, suffix, middle (psm) or suffix, prefix, middle (spm), or left as it is (plain).
Cuts and form follow from a hash of the seed and the id.

Where the k-th token begins needs a count over the whole text.  A rolling hash
over the last bytes cuts texts into chunks wherever the content says so: passages
that documents share give equal chunks, whatever stands before them.  A task
remembers, by the bytes of the chunk themselves (so that a hit is verified), its summary:
tokens, characters, and whether it begins and ends inside a run of letters.  Two
neighbouring chunks that meet inside a run share a token.  The running sums of
the summaries give n and the chunk that holds a cut; only that chunk is read
again to find the cut.

The memo holds ``memo_bytes`` of chunk text at most and begins anew beyond; no result depends on it.

Defined cases: a null text is an empty one; a null id is written as nothing in the
hashed seed; repeated rows are treated alike, each; an empty table gives no rows; only the
id and text columns are read; texts that contain a mark stay plain.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .textops import buffers, prefix_sums, slices, substring_hashes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Per cent of the documents that are transformed, and of those that get the order spm.
RATE, SPM_RATE = 90, 20
#: Bytes that the rolling hash sees, and the mean length of a chunk (a power of two).
SEEN, CHUNK = 16, 256
MEMO_BYTES = 32 << 20
#: What a remembered chunk takes besides its text.
_ENTRY = 200

_TOKEN = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*")
_LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks end: at the ends of texts and where the hash of the last bytes of the same
    text says so, before a whole character; of adjoining such places the first counts."""
    n = len(data)
    here = np.zeros(n + 1, bool)
    if n > SEEN:
        starts = np.arange(n - SEEN + 1)
        hit = substring_hashes(prefix_sums(data), starts, starts + SEEN) & np.uint64(CHUNK - 1) == 0
        hit[1:] &= ~hit[:-1]
        here[SEEN:] = hit
        here[:n] &= data & 0xC0 != 0x80
        # a window that reaches into the text before is none
        begin = np.repeat(offsets[:-1], np.diff(offsets))
        here[1:] &= np.arange(1, n + 1) - begin >= SEEN
    here[offsets[1:]] = True
    here[0] = False
    return np.flatnonzero(here)


class Memo:
    """Summaries (tokens, characters, begins with a letter, ends with a letter) by chunk."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.known, self.size, self.hits, self.misses = limit, {}, 0, 0, 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.known.get(chunk)
        if found is None:
            self.misses += 1
            if self.size > self.limit:
                self.known.clear()
                self.size = 0
            found = (len(_TOKEN.findall(chunk)), len(chunk.decode()), chunk[0] in _LETTERS, chunk[-1] in _LETTERS)
            self.known[chunk] = found
            self.size += len(chunk) + _ENTRY
        else:
            self.hits += 1
        return found


def token_borders(raw: bytes, ends: list[int], memo: Memo) -> tuple[int, "TokenBorders"]:
    """(number of tokens, places of token borders) of one text given the ends of its chunks."""
    begins = [0, *ends][: len(ends)]
    totals, before, inside = [0], 0, False
    for a, b in zip(begins, ends, strict=True):
        tokens, _, first, last = memo.summary(raw[a:b])
        before += tokens - (inside and first)
        inside = last
        totals.append(before)
    return before, TokenBorders(raw, begins, ends, totals)


class TokenBorders:
    """Byte places at which the k-th token of a text ends, from running totals of chunks."""

    def __init__(self, raw: bytes, begins: list[int], ends: list[int], totals: list[int]):
        self.raw, self.begins, self.ends, self.totals = raw, begins, ends, np.array(totals)

    def after(self, k: int) -> int:
        """Bytes of the first k tokens."""
        if k == 0:
            return 0
        # the chunk in which token k begins
        c = int(np.searchsorted(self.totals, k)) - 1
        a, b = self.begins[c], self.ends[c]
        joined = a > 0 and self.raw[a - 1] in _LETTERS and self.raw[a] in _LETTERS
        wanted = k - int(self.totals[c]) + joined  # its number among the chunk's own tokens
        for number, token in enumerate(_TOKEN.finditer(self.raw, a, b), 1):
            if number == wanted:
                break
        end = token.end()
        if end == b and self.raw[b - 1] in _LETTERS:  # the run may go on in the next chunks
            while end < len(self.raw) and self.raw[end] in _LETTERS:
                end += 1
        return end


def seeded(seed: int, name: str) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of the seed and the name."""
    h = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return tuple(int(h[8 * k : 8 * k + 8], 16) for k in range(4))


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document."""
    id_type = docs.schema[id_col].dataType
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(memo_bytes)
        for batch in batches:
            for first, n, texts in slices(batch, "text"):
                ids = batch.column(0).slice(first, n)
                data, offsets = buffers(texts)
                ends = chunk_ends(data, offsets)
                own = np.searchsorted(ends, offsets, side="right")
                hashed = pc.fill_null(batch.column(2).slice(first, n), "").to_pylist()
                rows = [[], [], [], [], []]
                everything = data.tobytes()
                for i in range(n):
                    at = int(offsets[i])
                    raw = everything[at : int(offsets[i + 1])]
                    tokens, borders = token_borders(raw, (ends[own[i] : own[i + 1]] - at).tolist(), memo)
                    for column, value in zip(rows, _cut(raw, tokens, borders, seeded(seed, hashed[i]), marks, rate, spm_rate), strict=True):
                        column.append(value)
                out = pa.array(rows[4], pa.large_binary()).cast(pa.large_string())
                yield pa.record_batch([ids, *[pa.array(c, t) for c, t in zip(rows[:4], types[1:5], strict=True)], out], names)

    schema = f"doc_id {id_type.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("name"))
    return picked.mapInArrow(run, schema)


def _cut(raw: bytes, n: int, borders: TokenBorders, h: tuple, marks: list[bytes], rate: int, spm_rate: int) -> tuple:
    """(n, form, characters of the prefix, of the middle, output) of one text."""
    if not raw or h[2] % 100 >= rate or any(m in raw for m in marks):
        return n, "plain", None, None, raw
    low, high = sorted((borders.after(h[0] % (n + 1)), borders.after(h[1] % (n + 1))))
    prefix, middle, suffix = raw[:low], raw[low:high], raw[high:]
    p, s, m = marks
    spm = h[3] % 100 < spm_rate
    output = b"".join([s, suffix, p, prefix, m, middle] if spm else [p, prefix, s, suffix, m, middle])
    return n, "spm" if spm else "psm", len(prefix.decode()), len(middle.decode()), output


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from the output and its form."""
    parts = F.split(output, "<[PSM]>", -1)
    one, two, three = F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)


def op12_infill(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS toks,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), k AS (
  SELECT *, CAST(len(toks) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (len(toks) + 1)::UBIGINT AS u1,
         CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (len(toks) + 1)::UBIGINT AS u2,
         CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 AS h3,
         CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 AS h4
  FROM t
), f AS (
  SELECT doc_id, text, n, h4 < 20 AS spm,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 AS plain,
         array_to_string(toks[1:least(u1, u2)::BIGINT], '') AS p,
         array_to_string(toks[least(u1, u2)::BIGINT + 1:greatest(u1, u2)::BIGINT], '') AS m,
         array_to_string(toks[greatest(u1, u2)::BIGINT + 1:], '') AS s
  FROM k
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m
                   ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""
