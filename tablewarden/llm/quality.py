"""Quality rules with risk-controlled thresholds.

Every rule is a measure of a document and a cutoff above which the document is rejected.
Cutoffs are not set by hand: for each stratum (language) and rule, documents labelled good
say how often a cutoff rejects good documents. The cutoffs of a rule are tested in a fixed
order, loosest first, each by the exact binomial test of "the rate of false rejections
exceeds the limit"; the first one that is not refuted ends the order, and the last one before
it is used. Where the loosest fails the rule is off. To go wrong, the first cutoff over the
limit must be refuted, so an order needs no correction for its length: the level is divided
by the number of orders, (stratum, rule). The limit is shared out over the rules, so
that all rules together reject no more than ``max_false_rejection`` of the good documents
of any stratum, with probability 1 - ``error``.

Null and empty texts have no words and fail the base rules. Repeated rows are judged one by
one. Without labels only the base rules act.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, WordHashes, load, windows

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STRATA = ("de", "en", "es", "fr")

# measure, as SQL over the counts below
MEASURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
}
CUTOFFS = tuple(round(0.01 * i, 2) for i in range(1, 20)) + tuple(round(0.05 * i, 2) for i in range(4, 20))

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long"


def counts(text: str | None, hashes: WordHashes) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    if not text:
        return (0,) * 8
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at ASCII white space only
    repeated = 0
    if len(words) > WINDOW:
        h = windows(hashes.of(words), WINDOW)
        _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[inverse] > 1)
        if len(starts):
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + WINDOW, -1)
            repeated = int((np.cumsum(step) > 0).sum())
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, SPACES.encode()))),
        len(raw) - len(raw.translate(None, SYMBOLS.encode())),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(raw) - len(raw.translate(None, UPPER)),
        text.count("!") + text.count("?"),
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and the counts of each text."""
    keep = [c for c in docs.columns if c != text and c not in {x.split()[0] for x in COUNTS.split(", ")}]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        names = [x.split()[0] for x in COUNTS.split(", ")]
        for batch in batches:
            found = pd.DataFrame([counts(t, hashes) for t in batch.iloc[:, -1]], columns=names, dtype="int64")
            kept = batch.iloc[:, :-1].reset_index(drop=True)
            kept = kept.astype({c: object for c in kept.columns if kept[c].dtype == "str"})
            yield pd.concat([kept, found], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInPandas(run, f"{schema}, {COUNTS}")


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact up to rounding.

    Terms are added from k away from the mean n p, so they fall and end soon, whatever n.
    """
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    upper = k > n * p  # then the terms above k are fewer
    i = k + 1 if upper else k
    first = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    term, total = 1.0, 0.0
    while term > total * 1e-18:
        total += term
        if upper:
            term *= (n - i) / (i + 1) * p / (1 - p)
            i += 1
        else:
            term *= i / (n - i + 1) * (1 - p) / p
            i -= 1
    tail = math.exp(first) * total
    return max(0.0, 1 - tail) if upper else min(1.0, tail)


def strictest(rejected: Sequence[int], n: int, limit: float, level: float) -> int | None:
    """The index of the cutoff to use, of the good rows ``rejected`` by each of ``CUTOFFS``."""
    chosen = None
    for i in reversed(range(len(rejected))):
        if rejected[i] > limit * n or binomial_cdf(rejected[i], n, limit) > level:
            break
        chosen = i
    return chosen


def stratum(lang: Column, strata: Sequence[str] = STRATA) -> Column:
    return F.when(lang.isin(*strata), lang).otherwise("other")


def thresholds(
    labelled: DataFrame,
    max_false_rejection: float = 0.02,
    error: float = 0.05,
    strata: Sequence[str] = STRATA,
) -> dict[tuple[str, str], float]:
    """(stratum, measure) to cutoff. ``labelled`` holds measures and stratum of good rows.

    Spark counts; the driver gets a row of len(MEASURES) x len(CUTOFFS) counts for each of
    the fixed strata.
    """
    sums = [
        F.sum((F.col(m) > c).cast("long")).alias(f"{m}_{i}") for m in MEASURES for i, c in enumerate(CUTOFFS)
    ]
    limit = max_false_rejection / len(MEASURES)
    level = error / (len(MEASURES) * (len(strata) + 1))
    chosen = {}
    for row in labelled.groupBy("stratum").agg(F.count("*").alias("n"), *sums).collect():
        for m in MEASURES:
            at = strictest([row[f"{m}_{i}"] for i in range(len(CUTOFFS))], row["n"], limit, level)
            if at is not None:
                chosen[row["stratum"], m] = CUTOFFS[at]
    return chosen


def assess(
    docs: DataFrame,
    labels: DataFrame,
    max_false_rejection: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """doc_id, the counts, base_failed, kept and stratum of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    base = measured(docs.select("doc_id", stratum(F.col("lang")).alias("stratum"), "text"))
    table = scratch.save(base, "counts").withColumns({m: F.expr(sql) for m, sql in MEASURES.items()})
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    table = table.withColumn("base_failed", failed)
    good = labels.filter("quality = 1").select("doc_id").distinct()
    # rows that the base rules reject anyway say nothing about the cutoffs
    chosen = thresholds(table.filter("NOT base_failed").join(good, "doc_id"), max_false_rejection, error)
    bad = F.lit(False)
    for (s, m), cutoff in sorted(chosen.items()):
        bad = bad | ((F.col("stratum") == s) & (F.col(m) > cutoff))
    return table.withColumn("kept", ~F.col("base_failed") & ~bad)


def op8_quality_rules(spark, folder: str) -> DataFrame:
    found = assess(load(spark, folder, "documents"), load(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum"
    )
