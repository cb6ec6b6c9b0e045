"""Inputs that the operators must take: nulls, empties, long texts, ties, repeated rows, clashing names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def prose(rng, n):
    return " ".join("".join(rng.choice(["an", "the", "ou", "ß", "é", "ing"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(seed=1, n=60):
    """id -> text, with copies, near copies, shared passages, junk and edge cases."""
    rng = random.Random(seed)
    texts = {i: prose(rng, rng.choice([3, 40, 150, 300])) for i in range(n)}
    passage = prose(rng, 120)
    for i in range(0, n, 7):
        texts[i] += "\n" + passage + "\n" + prose(rng, 20)
    for i in range(1, n, 9):
        texts[1000 + i] = texts[i]
        near = texts[i].split(" ")
        near[len(near) // 2] = "changed"
        texts[2000 + i] = " ".join(near)
    texts |= {3000: None, 3001: "", 3002: " \n\t", 3003: "One", 3004: "one", 3005: "a" * 3000, 3006: "ab" * 900, 3007: prose(rng, 20000), 3008: "日本語 " * 300}
    return texts


def frame(spark, texts, repeated=(3,), null_ids=("lost text",)):
    """The texts with clashing extra columns, some rows twice and some without an id."""
    rows = [(i, t, "en", "s", len(t or ""), 0.5, "x", 1) for i, t in texts.items()]
    rows += [r for r in rows if r[0] in repeated]
    rows += [(None, t, None, None, None, None, None, None) for t in null_ids]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, text_id string, size int"
    ).repartition(3)
