import random
from fractions import Fraction

import numpy as np
import pytest

from wellspring.llm import ngram_join
from wellspring.llm.components import connected_components

from .cases import corpus, frame, prose, words


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(texts, width, similarity):
    at_least = Fraction(similarity)
    sets = {i: shingles(t, width) for i, t in texts.items()}
    group = {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and both >= at_least * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in texts}


def family(n, edits, seed):
    """Many near copies of one text, each with its own changes."""
    rng = random.Random(seed)
    base = prose(rng, 120).split(" ")
    out = {}
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
        out[5000 + i] = " ".join(copy)
    return out


@pytest.mark.parametrize(("width", "similarity"), [(3, "9/10"), (5, "8/10")])
def test_against_all_pairs(spark, width, similarity):
    texts = corpus() | family(90, 6, 5)
    docs = frame(spark, texts)
    rows = ngram_join.jaccard_components(docs, width=width, similarity=similarity).collect()
    assert len(rows) == docs.count()
    expected = brute(texts, width, similarity)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_large_regions_are_split(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", 6)
    monkeypatch.setattr(ngram_join, "PIVOTS", 3)
    texts = family(80, 9, 6) | {i + 100: t for i, t in family(40, 4, 7).items()}
    rows = ngram_join.jaccard_components(frame(spark, texts, (), ()), width=3, similarity="9/10").collect()
    expected = brute(texts, 3, "9/10")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected


@pytest.mark.parametrize(("width", "similarity"), [(3, "9/10"), (5, "8/10")])
def test_near_copies_of_few_words(spark, width, similarity):
    """Sets of few shingles, whose equal classes are often empty ones."""
    rng = random.Random(width)
    texts, expected = {}, {}
    for seed in range(6000):
        first = [f"s{seed}w{i}" for i in range(rng.randint(5, 60))]
        second = first + [f"s{seed}x{i}" for i in range(rng.randint(0, 3))]
        if rng.random() < 0.4:
            second[rng.choice([0, rng.randrange(len(second))])] = f"s{seed}y"
        pair = {2 * seed: " ".join(first), 2 * seed + 1: " ".join(second[rng.randint(0, 2) :])}
        texts |= pair
        expected |= brute(pair, width, similarity)
    rows = ngram_join.jaccard_components(frame(spark, texts, (), ()), width=width, similarity=similarity).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected


def test_linked_sets_share_a_leading_region():
    """Random sets around the last sizes of a band, where no class is to spare."""
    rng = np.random.default_rng(3)
    for similarity in (Fraction(9, 10), Fraction(8, 10)):
        for seed in range(3000):
            union = int(rng.integers(4, 140))
            h = rng.integers(0, 2**63, union).astype(np.uint64)
            most = int(union * (1 - similarity))
            cut = int(rng.integers(0, most + 1))
            sets = [np.sort(h[cut:]), np.sort(h[: union - (most - cut)])]
            keys, doc, parts = ngram_join.region_keys(np.concatenate(sets), np.repeat([0, 1], [len(x) for x in sets]), np.array([len(x) for x in sets]), similarity)
            assert set(keys[doc == 0]) & set(keys[doc == 1]), (similarity, seed, union, cut)


def test_one_per_group(spark):
    texts = corpus(3, 20)
    docs = frame(spark, texts)
    out = ngram_join.one_per_group(docs)
    assert out.columns == docs.columns
    kept = sorted(str(r.doc_id) for r in out.collect())
    expected = {c for _, c in brute(texts, 5, "8/10").values()}
    assert kept == sorted([*map(str, expected), "None"])
    assert ngram_join.one_per_group(docs.limit(0)).count() == 0


def test_one_id_with_different_texts(spark):
    """Texts under one id are judged apart: a copy of another document goes, the others stay."""
    rng = random.Random(8)
    w, v, x, y = (prose(rng, 40) for _ in range(4))
    rows = [(1, w), (1, v), (2, v), (3, x), (3, x), (4, y), (4, x), (5, None), (5, None), (None, w), (None, w)]
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, component_id string, set_id int").repartition(3)
    out = ngram_join.one_per_group(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, w), (1, v), (3, x), (4, y), (5, None), (None, w), (None, w)], key=str)


def test_regions_pass_a_full_filter(spark, monkeypatch):
    """A filter in which every bit is set keeps nothing out, and the result is the same."""
    texts = family(60, 5, 8)
    monkeypatch.setattr(ngram_join, "FILTER_BITS", 64)
    rows = ngram_join.jaccard_components(frame(spark, texts, (), ()), width=3, similarity="9/10").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, 3, "9/10")


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299)]
    out = connected_components(spark.createDataFrame(links, "a long, b long"))
    found = {r.node: r.component for r in out.collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 4000, np.uint64, endpoint=False)
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in (1, 5, 31, 32, 33, 64, 65, 700, 1400, 2600)]
    sizes = np.array([len(s) for s in sets])
    bits, words = ngram_join.sketches(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes)
    assert words.tolist() == [1, 1, 1, 1, 2, 2, 4, 32, 64, 128]
    parts = np.split(bits, np.cumsum(words)[:-1])
    for x, s in zip(parts, sets, strict=True):
        for y, t in zip(parts, sets, strict=True):
            while len(x) > len(y):
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            while len(y) > len(x):
                y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            differing = sum(int(w).bit_count() for w in x ^ y)
            assert differing <= len(set(s) ^ set(t))
            assert differing % 2 == len(set(s) ^ set(t)) % 2
