"""Filter interaction audit: what each order of five filters keeps, removes and costs.

A document that fails some of the filters survives every subset that holds none of them. Which
of the 32 subsets those are is its truth-table word, bit s standing for subset s. Positional
popcounts of these words (how many have bit s) per part and label answer every question about
every order: what is kept after a step is the survivors of the filters so far, what a step
removes is a difference of two such counts, and so are overlaps and Shapley shares.

The popcounts are carry-save: full adders turn three words of one weight into a sum word of that
weight and a carry word of twice the weight, so only a few words per weight are left whose bits
are counted one by one. Equal texts of one part and label share a word; their number enters bit
by bit, bit k at weight 2**k.

Plan: one scan of the texts leaves a narrow row per document (id, part, digest, the four
verdicts a text decides by itself). These are joined with the labels by id, counted by (digest,
part, label), which makes one row of any number of copies, and the least id of a digest is a
window over those counts. No text is shuffled, no key gathers rows before they are counted, and
of all words only 32 counters per part, label and task reach the last shuffle.

Edge cases: a null text counts as empty and equals an empty one. A null source is the part "". A
row without an id is judged, has no labels and is never later than another. Rows that repeat id
and text do not fail E for each other. If labels repeat an id, any 1 counts. An empty table has
no parts and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")  # the filter that no text decides by itself
GOOD, TOXIC = 1, 2  # bits of a label
PARTS_HELD = 4096  # parts that a task counts at a time
STEPS = [(list(order), i) for order in permutations(range(len(FILTERS))) for i in range(len(FILTERS))]
# truth-table word of a document that fails the filters of a mask
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32)


def text_failures(data: bytes, points: int) -> int:
    """The filters among A to D that a text of UTF-8 ``data`` and so many code points fails, as bits."""
    words = data.split()  # at exactly the blanks \x20 and \x09 to \x0d
    upper = len(data) - len(data.translate(None, UPPER))
    fails = (
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * upper > 5 * points,
        len(data.translate(None, SYMBOLS)) < len(data),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, fails) of every document, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, fails = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                data = text.encode()
                digests.append(hashlib.blake2b(data, digest_size=16).digest())
                fails.append(text_failures(data, len(text)))
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(fails, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "digest", "fails"])

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    text = F.col("text").cast("string").alias("text")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, text)
    return source.mapInArrow(run, "doc_id long, part string, digest binary, fails int")


def groups(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, label, fails, n): documents by part, label and the filters they fail; several rows per key."""
    bits = F.when(F.col("quality") == 1, GOOD).otherwise(0) + F.when(F.col("toxic") == 1, TOXIC).otherwise(0)
    known = labels.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), bits.alias("label"))
    known = known.groupBy("doc_id").agg(F.bit_or("label").alias("label"))
    # counted by id, which the join has brought together, so that a least id is met once
    key = ("digest", "part", "label", "fails")
    label = F.coalesce("label", F.lit(0)).alias("label")
    named = rows.filter("doc_id IS NOT NULL").join(known, "doc_id", "left").select("doc_id", "digest", "part", "fails", label)
    named = named.groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("n"))
    nameless = rows.filter("doc_id IS NULL").withColumn("label", F.lit(0)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    counted = (
        named.unionByName(nameless, allowMissingColumns=True)
        .groupBy(*key)
        .agg(
            F.min("doc_id").alias("least"),
            F.min_by("n", "doc_id").alias("n_least"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_nameless"),
            F.sum("n").alias("n"),
        )
    )
    first = F.min("least").over(W.partitionBy("digest"))
    not_later = F.when(F.col("least") == first, F.col("n_least")).otherwise(0) + F.col("n_nameless")
    both = F.array(
        F.struct("fails", F.col("not_later").alias("n")),
        F.struct((F.col("fails") + COPY).alias("fails"), (F.col("n") - F.col("not_later")).alias("n")),
    )
    return counted.withColumn("not_later", not_later).select("part", "label", F.inline(both)).filter("n > 0")


def positional_popcounts(words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each of the 32 bits, the weights of the words that have it, added up (int64)."""
    levels: list[list[np.ndarray]] = []
    width = max(1, -(-len(words) // 16))
    for k in range(int(weights.max(initial=0)).bit_length()):
        chosen = words[(weights >> k) & 1 == 1]
        lanes = np.zeros(-(-len(chosen) // width) * width, np.uint32)
        lanes[: len(chosen)] = chosen
        levels.append(list(lanes.reshape(-1, width)))
    total, k = np.zeros(SUBSETS, np.int64), 0
    while k < len(levels):
        level = levels[k]
        while len(level) > 2:  # a full adder for every bit of every lane
            a, b, c = level.pop(), level.pop(), level.pop()
            half = a ^ b
            level.append(half ^ c)
            if k + 1 == len(levels):
                levels.append([])
            levels[k + 1].append((a & b) | (half & c))
        for lane in level:
            total += ((lane[:, None] >> np.arange(SUBSETS, dtype=np.uint32)) & 1).sum(0, dtype=np.int64) << k
        k += 1
    return total


def survivors(grouped: DataFrame) -> DataFrame:
    """(part, every, good, toxic): survivors of each of the 32 subsets, of all documents and by label."""
    names = ["every", "good", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            parts = list(held)
            table = [pa.array([held[p][i].tolist() for p in parts], pa.list_(pa.int64())) for i in range(3)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), *table], names=["part", *names])

        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            label, fails, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3))
            words, place = WORDS[fails], codes.indices.to_numpy()
            order = np.argsort(place, kind="stable")
            bounds = np.searchsorted(place[order], np.arange(len(codes.dictionary) + 1))
            for i, part in enumerate(codes.dictionary.to_pylist()):
                own = order[bounds[i] : bounds[i + 1]]
                counts = held.setdefault(part, np.zeros((3, SUBSETS), np.int64))
                for j, has in enumerate((slice(None), label[own] & GOOD > 0, label[own] & TOXIC > 0)):
                    counts[j] += positional_popcounts(words[own][has], n[own][has])
                if len(held) >= PARTS_HELD:
                    yield flush()
        yield flush()

    counted = grouped.select("part", "label", "fails", "n").mapInArrow(
        run, "part string, " + ", ".join(f"{c} array<long>" for c in names)
    )
    columns = [F.sum(F.get(c, F.lit(s))).alias(f"{c}_{s}") for c in names for s in range(SUBSETS)]
    arrays = [F.array(*(F.col(f"{c}_{s}") for s in range(SUBSETS))).alias(c) for c in names]
    return counted.groupBy("part").agg(*columns).select("part", *arrays)


def audit(survived: DataFrame) -> DataFrame:
    """A row per part, order and step, from the survivors of all subsets."""
    before = [sum(1 << f for f in order[:i]) for order, i in STEPS]
    own = [1 << order[i] for order, i in STEPS]
    names = ["".join(FILTERS[f] for f in order) for order, _ in STEPS[:: len(FILTERS)]]
    k, size = F.col("k"), len(FILTERS)

    def of(counts: str, subset):
        return F.get(counts, subset.cast("int"))

    def lost(counts: str, done, bit):
        """What a filter removes of what is left after others."""
        return of(counts, done) - of(counts, done.bitwiseOR(bit))

    done, bit = F.get(F.lit(before), k), F.get(F.lit(own), k)
    removed = lost("every", done, bit)
    others = F.lit(SUBSETS - 1).bitwiseXOR(bit)

    def share(f: int):
        """Removed by a filter, over all orders: by the set of filters before it, and how many orders have it."""
        sets = [s for s in range(SUBSETS) if not s >> f & 1]
        orders = {s: factorial(s.bit_count()) * factorial(size - 1 - s.bit_count()) for s in sets}
        return reduce(lambda a, b: a + b, (lost("every", F.lit(s), F.lit(1 << f)) * orders[s] for s in sets))

    shares = survived.select("*", F.array(*(share(f) for f in range(size))).alias("shares"))
    steps = shares.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(STEPS) - 1))).alias("k"))
    return steps.select(
        "part",
        F.get(F.lit(names), F.floor(k / size).cast("int")).alias("filter_order"),
        (k % size + 1).cast("int").alias("step"),
        of("every", done.bitwiseOR(bit)).alias("kept"),
        removed.alias("removed"),
        (of("every", F.lit(0)) - of("every", bit) - removed).alias("redundant"),
        lost("every", others, bit).alias("unique_fails"),
        lost("good", done, bit).alias("good_lost"),
        lost("toxic", done, bit).alias("toxic_lost"),
        F.get("shares", F.log2(bit.cast("double")).cast("int")).alias("shapley"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of documents (doc_id, text, source) with labels (doc_id, quality, toxic)."""
    rows = Scratch(docs.sparkSession).save(judged(docs), "judged")
    return audit(survivors(groups(rows, labels)))


def op11_filter_interaction_audit(spark, folder: str) -> DataFrame:
    return filter_interactions(load(spark, folder, "documents"), load(spark, folder, "labels"))


# Every document is led through every order, step by step.
ORACLE = r"""
WITH judged AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failing AS (
    SELECT j.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
        concat(CASE WHEN len(words) < 50 THEN 'A' END,
            CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
            CASE WHEN 100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * len(body) THEN 'C' END,
            CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' END,
            CASE WHEN j.doc_id > min(j.doc_id) OVER (PARTITION BY body) THEN 'E' END) AS fails
    FROM judged j LEFT JOIN known k USING (doc_id)),
alike AS (SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
led AS (SELECT *, coalesce(list_min([strpos(filter_order, f) FOR f IN string_split(fails, '') IF f <> '']), 6) AS out_at
    FROM alike, orders),
steps AS (SELECT unnest(range(1, 6))::INT AS step),
counted AS (
    SELECT part, filter_order, step, filter_order[step] AS own,
        sum(n) FILTER (WHERE out_at > step) AS kept,
        sum(n) FILTER (WHERE out_at = step) AS removed,
        sum(n) FILTER (WHERE out_at < step AND contains(fails, filter_order[step])) AS redundant,
        sum(n) FILTER (WHERE fails = filter_order[step]) AS unique_fails,
        sum(n) FILTER (WHERE out_at = step AND good = 1) AS good_lost,
        sum(n) FILTER (WHERE out_at = step AND toxic = 1) AS toxic_lost
    FROM led, steps GROUP BY ALL)
SELECT part, filter_order, step,
    coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
    coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counted
"""
