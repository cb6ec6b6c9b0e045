import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from wellspring.llm import spelling

from .cases import LOW, corpus, frame

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, factor=5):
    """word -> (n, n_near, form, form_n, root) by comparing all pairs."""
    out = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        out[w] = (n, len(others), best if best and counts[best] >= factor * n else None)
    def root(w):
        return root(out[w][2]) if out[w][2] else w
    return {w: (n, k, f, counts[f] if f else None, root(w)) for w, (n, k, f) in out.items()}


def rows_of(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    """Words of two letters, so that nearly all are near and runs of equal letters abound; ties in n."""
    rng = random.Random(seed)
    counts = {}
    while len(counts) < 150:
        word = "".join(rng.choice("abé") for _ in range(rng.randint(1, 7)))
        counts[word] = rng.choice([1, 2, 10, 50, 51, 1000])
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert rows_of(spelling.spelling_variants(vocab)) == brute(counts)


def test_chains_of_forms(spark):
    counts = {"aaaaaa"[:k] + "b" * (8 - k): 6**k for k in range(1, 7)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows_of(spelling.spelling_variants(vocab))
    assert got == brute(counts) and len({r[4] for r in got.values()}) == 1
    assert spelling.spelling_variants(vocab.limit(0)).count() == 0
    assert rows_of(spelling.spelling_variants(spark.createDataFrame([("einzig", 5)], "word string, n long"))) == {"einzig": (5, 0, None, None, "einzig")}


def slipped(i, run):
    w = run.translate(LOW)
    h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
    at = h % len(w)
    return w[:at] + w[at + 1 :] if h % 199 == 0 else w


def test_runs_and_vocabulary(spark):
    texts = corpus(7, 40) | {4000: "Ärger\u00d7x ÄRGER a1b _c l'\u00ff\u0100e İstanbul"}
    docs = frame(spark, texts)
    expected = Counter(slipped(r.doc_id, w) for r in docs.collect() for w in RUN.findall(r.text or ""))
    found = Counter(r.word for r in spelling.runs(docs).collect())
    assert found == expected
    vocab = {r.word: r.n for r in spelling.vocabulary(spelling.runs(docs)).collect()}
    assert vocab == {w: n for w, n in expected.items() if len(w) >= 6 and n >= 5}
    assert spelling.runs(docs, slip=None).count() == sum(expected.values())
    assert spelling.runs(docs.limit(0)).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({spelling.ORACLE_SQL})").fetchall()
    rows = spelling.op13_spelling(spark, SF).select(*names).collect()
    assert len(rows) > 500 and sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
