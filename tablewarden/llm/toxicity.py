"""Toxicity: a noisy channel is undone before the text is scored.

Writers hide words by look-alike characters (1d10t), by spacing (i d i o t, i.d.i.o.t) and
by repetition (idiooot). Such a span is a lattice: every character offers the letters it
may stand for, or nothing. A Viterbi search finds the likeliest path under a character
trigram model of all documents and the channel's own costs. Words of letters that no other
follows twice have one path only, so they are left as they are; every other token is decoded
whole, whatever its length. Where plain reading and decoded one differ, both are kept: words
with a doubled letter, parts of compounds, and marks at an edge that are look-alikes too
(``!diot``, ``stop!``). The restored words are scored.

The scorer knows words and word beginnings that are significantly more frequent in toxic
documents (a likelihood ratio test over labelled documents, corrected for the number of
features), and a logistic model over four sums of their weights. It keeps all significant ones.
The character model reads every document. The scorer is fitted on a sample of the labelled ids by
their hash, of about ``LABELLED`` ids, and on all of them if there are no more; so what is learnt
from, and the ids that are broadcast to find its texts, do not grow with the corpus.

Null and empty texts score like a text without known words. Repeated rows are scored one by
one; a document with several label rows counts as toxic if one of them says so.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load

LABELLED = 16_384  # labelled ids that the scorer is fitted on
SHARES = 1 << 30  # of which a sample takes some, by hash
PREFIXES = (4, 5, 6, 7)
SLICE = 1000  # documents of a batch that leave a task together
THRESHOLD = 0.7
CRITICAL = 30.0  # G2 for p < 1e-7, one sided

# fixed values: what a character may stand for
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "aeiou",
}
SEPARATORS = set(" .-_*~'·​‌‍⁠﻿\t")
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
SPACED_HINT = re.compile(r"\s\S\s\S\s\S(?!\S)")
TRIPLE = re.compile(r"(.)\1\1")
DOUBLE = re.compile(r"(.)\1")
EDGE = "\"'`.,;:?!()[]{}<>«»„“”‘’…-–—_/\\&%~^="

MARKS = "".join(c for c in EDGE if c not in LOOK_ALIKES)  # edges that stand for no letter
JOINTS = re.compile("[" + re.escape("".join(sorted((SEPARATORS | set(EDGE)) - set(LOOK_ALIKES)))) + "]")

# --- the character model -------------------------------------------------------------

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
CODES = np.zeros(256, np.uint32)  # 0: everything else, which is also a word's edge
for _i, _c in enumerate(LETTERS, 1):
    CODES[ord(_c)] = _i
BITS = 6  # letters and the edge fit 64 codes, so a model has 2**18 cells at most


def trigram_counts(texts: list[str]) -> np.ndarray:
    joined = "  ".join(texts).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < 256, CODES[np.minimum(points, 255)], 0)
    codes = np.concatenate([np.zeros(2, np.uint32), codes, np.zeros(2, np.uint32)])
    return np.bincount((codes[:-2] << (2 * BITS)) | (codes[1:-1] << BITS) | codes[2:], minlength=1 << (3 * BITS))


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a letter after two others, from every text. 2**18 floats."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << (3 * BITS), np.int64)
        for batch in batches:
            for k in range(0, len(batch), 200):
                total += trigram_counts([t for t in batch.iloc[k : k + 200, 0] if t])
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells.astype(np.int32), "n": total[cells]})

    table = np.zeros(1 << (3 * BITS))
    rows = docs.select("text").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for cell, n in rows.collect():  # no more rows than cells
        table[cell] = n
    one = table.reshape(64, 64, 64).sum((0, 1)) + 1.0
    one /= one.sum()
    two = table.reshape(64, 64, 64).sum(0) + 4.0 * one
    two /= two.sum(1, keepdims=True)
    three = table.reshape(64, 64, 64) + 8.0 * two
    three /= three.sum(2, keepdims=True)
    return np.log(three).astype(np.float32).ravel()


# --- the lattice ---------------------------------------------------------------------

SUBSTITUTE, DELETE, REPEAT, DOUBLED, SPLIT = -1.0, -1.5, -0.5, -7.0, -3.0


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Per position, the letters it may stand for and the channel's log probability."""
    steps: list[list[tuple[str, float]]] = []
    i, n = 0, len(span)
    while i < n:
        c = span[i]
        j = i
        while j < n and span[j] == c:
            j += 1
        run = j - i
        options: list[tuple[str, float]] = []
        if c.isalpha():
            # two are mostly meant, more never are
            options = [(c, (0.0, DOUBLED, REPEAT)[min(run, 3) - 1])]
            if run > 1:
                options.append((c * 2, 0.0 if run == 2 else REPEAT))
        else:
            for letter in LOOK_ALIKES.get(c, ""):
                options.append((letter, SUBSTITUTE))
                if run > 1:
                    options.append((letter * 2, SUBSTITUTE))
            if c in SEPARATORS or not options:
                options.append(("", DELETE))
            if c.isspace():
                options.append((" ", SPLIT))
        steps.append(options)
        i = j
    return steps


LETTER_CODES = {c: i for i, c in enumerate(LETTERS, 1)}


def decode(span: str, model: list[float]) -> str:
    """The likeliest reading of a span: words of letters, separated by blanks."""
    # a state's text is a chain of pieces, so the work grows with the length alone
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in [*lattice(span), [(" ", 0.0)]]:
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, text) in states.items():
            for piece, cost in options:
                x, y, s = a, b, score + cost
                for c in piece:
                    z = LETTER_CODES.get(c, 0)
                    s += model[(x << (2 * BITS)) | (y << BITS) | z]
                    x, y = y, z
                if (x, y) not in following or s > following[x, y][0]:
                    following[x, y] = (s, (text, piece))
        states = following
    chain, pieces = max(states.values(), key=lambda state: state[0])[1], []
    while chain:
        chain, piece = chain
        pieces.append(piece)
    return "".join(reversed(pieces)).strip()


class Restorer:
    """Restores tokens; remembers what it did."""

    LIMIT = 75_000  # of the latest tokens; as many of those before are kept beside them
    LONG = 64  # longer tokens are not remembered

    def __init__(self, model: np.ndarray):
        self.model, self.known, self.older = model.tolist(), {}, {}

    def token(self, token: str) -> tuple[str, ...]:
        found = self.known.get(token)
        if found is None:
            found = self.older.get(token) or tuple(dict.fromkeys(self._token(token)))
            if len(token) <= self.LONG:
                if len(self.known) >= self.LIMIT:
                    self.known, self.older = {}, self.known
                self.known[token] = found
        return found

    def _token(self, token: str) -> list[str]:
        if token.isalpha() and not DOUBLE.search(token):
            return [token]
        bare = token
        while len(bare) > 2 and not bare[-1].isalnum() and bare[-1] == bare[-2] == bare[-3]:
            bare = bare.rstrip(bare[-1])  # a run of one mark is decoration
        bare = bare.strip(EDGE)
        core = token.strip(MARKS)
        found = self._readings(bare)
        if core == bare or len(set(core)) < 2:
            return found
        # what was taken off stands for letters on either side: none of it, all, or the run next to the word
        at = core.find(bare) if bare else len(core)
        lead, tail = core[:at], core[at + len(bare) :]
        near = lead[len(lead.rstrip(lead[-1:])) :] if lead else "", tail[: len(tail) - len(tail.lstrip(tail[:1]))] if tail else ""
        leads, tails = ({"", whole, run if run[:1] in LOOK_ALIKES else ""} for whole, run in zip((lead, tail), near, strict=True))
        for span in sorted({a + bare + b for a in leads for b in tails} - {bare}):
            found += decode(span, self.model).split()
        return found

    def _readings(self, bare: str) -> list[str]:
        """Plain words of a token without its edges, and what its lattice reads."""
        if bare.isalpha() and not DOUBLE.search(bare):
            return [bare]
        if not any(c.isalpha() or c in LOOK_ALIKES for c in bare):
            return []
        # parts of a compound are words of their own; its reading as a whole comes on top
        found = [p for p in re.split(r"[^\w]|_", bare) if len(p) > 2 and p.isalpha() and not TRIPLE.search(p)]
        for part in JOINTS.split(bare):
            if 2 < len(part) < len(bare):
                found += self.token(part)
        return found + decode(bare, self.model).split()

    def words(self, text: str | None) -> set[str]:
        """The distinct restored words of a whole text, in lower case."""
        if not text:
            return set()
        low = text.lower()
        found: set[str] = set()
        for token in set(low.split()):
            found.update(self.token(token))
        if SPACED_HINT.search(low) or SPACED_HINT.search(" " + low[:12]):
            for match in SPACED.finditer(low):
                found.update(decode(match.group(), self.model).split())
        return found


# --- the scorer ----------------------------------------------------------------------


def features(words: set[str]) -> set[str]:
    found = set(words)
    for word in words:
        found.update(word[:k] + "*" for k in PREFIXES if len(word) > k)
    return found


@dataclass
class Scorer:
    """Weights of words and beginnings, and the logistic model over their sums."""

    model: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    betas: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    bias: float = -3.0

    def word(self, word: str) -> float:
        get = self.weights.get
        best = get(word, 0.0)
        for k in PREFIXES:
            if len(word) > k:
                best = max(best, get(word[:k] + "*", 0.0))
        return best

    def sums(self, words: set[str], known: dict[str, float]) -> tuple[float, float, float, float]:
        top = second = total = 0.0
        for word in words:
            w = known.get(word)
            if w is None:
                w = known[word] = self.word(word)
            if w:
                total += w
                if w > top:
                    top, second = w, top
                elif w > second:
                    second = w
        return top, second, min(total, 40.0), total / math.sqrt(len(words) + 1.0)

    def score(self, sums: tuple[float, ...]) -> float:
        z = self.bias + sum(b * s for b, s in zip(self.betas, sums, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def _scored(docs: DataFrame, scorer: Scorer, keep: list[str], only_sums: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, known = Restorer(scorer.model), {}
        for batch in parts(batches):
            sums = []
            for text in batch["text"]:
                sums.append(scorer.sums(restorer.words(text), known))
                if len(known) > 150_000:
                    known.clear()
            out = batch[keep].astype({c: object for c in keep if batch[c].dtype == "str"})
            if only_sums:
                out["sums"] = [list(s) for s in sums]
            else:
                out["score"] = np.array([scorer.score(s) for s in sums], dtype=float)
            yield out

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from (batch.iloc[k : k + SLICE] for k in range(0, len(batch), SLICE))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInPandas(run, f"{schema}, " + ("sums array<double>" if only_sums else "score double"))


def feature_counts(labelled: DataFrame, model: np.ndarray) -> DataFrame:
    """(feature, toxic, clean): in how many documents of either label it occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pd.DataFrame:
            names = list(seen[0].keys() | seen[1].keys())
            out = pd.DataFrame(
                {"feature": names, "clean": [seen[0][x] for x in names], "toxic": [seen[1][x] for x in names]}
            )
            seen[0].clear(), seen[1].clear()
            return out.astype({"feature": object, "clean": "int64", "toxic": "int64"})

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen[int(toxic)].update(features(restorer.words(text)))
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield flush()
        yield flush()

    return (
        labelled.select("text", "toxic")
        .mapInPandas(run, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )


def _significant(counted: DataFrame, clean: int, toxic: int) -> dict[str, float]:
    def term(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    n = float(clean + toxic)
    both = a + b
    g2 = 2 * (
        term(a, both * toxic / n)
        + term(b, both * clean / n)
        + term(F.lit(float(toxic)) - a, (n - both) * toxic / n + 1e-9)
        + term(F.lit(float(clean)) - b, (n - both) * clean / n + 1e-9)
    )
    rows = (
        counted.filter("toxic >= 3")
        .withColumn("weight", F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (clean + 1.0)))
        .withColumn("g2", g2)
        .filter((F.col("weight") > 1.0) & (F.col("g2") > CRITICAL))
        .select("feature", "weight")
    )
    return {r.feature: r.weight for r in rows.collect()}  # each is in three of a bounded number of texts


def train(docs: DataFrame, labels: DataFrame, labelled_ids: int = LABELLED) -> Scorer:
    """Fit on about ``labelled_ids`` of ``labels`` (doc_id, toxic); the character model reads all of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    scorer = Scorer(character_model(docs))
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
    marks = scratch.save(marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "marks")
    share = SHARES * labelled_ids // max(marks.count(), 1)
    sample = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)) < F.lit(share))
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    labelled = scratch.save(labelled, "labelled")
    sizes = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return scorer  # nothing to learn from
    scorer.weights = _significant(feature_counts(labelled, scorer.model), clean, toxic)
    if scorer.weights:
        rows = scratch.save(_scored(labelled, scorer, ["toxic"], only_sums=True), "sums")
        fit = LogisticRegression(labelCol="toxic", regParam=0.001, maxIter=30).fit(
            rows.select("toxic", array_to_vector("sums").alias("features"))
        )
        scorer.betas, scorer.bias = tuple(map(float, fit.coefficients)), float(fit.intercept)
    else:
        scorer.bias = math.log(toxic / clean)
    return scorer


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs``, and score and predicted, which replace columns of those names."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = _scored(docs, scorer, keep, only_sums=False)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op2_toxicity(spark, folder: str) -> DataFrame:
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    scorer = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score(docs.select("doc_id", "text"), scorer)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
