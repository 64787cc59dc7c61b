"""Plain versions of the operators, and a corpus of edge cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from tablewarden.llm.common import load
from tests.comparison import folder

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"wort{i * 7919 % 4001}" for i in range(30_000))
EDGES = [
    (None, "a row without an id but with words enough to count as one", "en"),
    (900001, None, None),
    (900002, "", "en"),
    (900003, " \n\t ", "en"),
    (900004, "two words", "xx"),
    (900005, "two words", "xx"),
    (900006, LONG, "en"),
    (900007, LONG + " more", "en"),
    (900008, "ab" * 400, "de"),
    (900009, "same id first text with a few words", "fr"),
    (900009, "same id another text with some other words", "fr"),
    (900010, "a repeated row with its words and more", "es"),
    (900010, "a repeated row with its words and more", "es"),
    (900011, "naïve Ünïcode \u00a0 text\u2028with odd\u3000spaces 😀 and more of it", "en"),
]


def corpus(spark, sf="0.001"):
    """The documents of a test table, edge cases and columns with clashing names."""
    given = load(spark, folder(sf), "documents").select("doc_id", "text", "lang")
    edges = spark.createDataFrame(EDGES, "doc_id long, text string, lang string")
    extra = ["n", "key", "token", "score", "component", "start", "n_words", "kind", "digest"]
    return given.union(edges).select("*", *(F.lit("x").alias(c) for c in extra)).repartition(5).cache()


def empty(spark):
    return corpus(spark).limit(0)


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def words(text):
    return SPACE.findall(text or "")


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def near_components(docs):
    sets = [(i, shingle_set(t)) for i, t in docs]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i is None or j is None or not s or not t:
                continue
            if min(len(s), len(t)) * 100 < 75 * max(len(s), len(t)):
                continue
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return Counter((i, len(s), find(i) if i is not None else None) for i, s in sets)


def removed(docs, length=200):
    seen = Counter()
    data = [(i, (t or "").encode()) for i, t in docs]
    for _, b in data:
        seen.update(hashlib.md5(b[k : k + length]).digest() for k in range(len(b) - length + 1))
    out = Counter()
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[hashlib.md5(b[k : k + length]).digest()] > 1:
                gone[k : k + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def quality(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)
