"""Helpers shared by the operators: reading, scratch tables, hashing, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.sources.store import shared_root

FACTOR = np.uint64(0x9E3779B97F4A7C15)  # of the hashes of windows
ROUNDS = 100  # of the component search, which needs a few; more means a fault


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


class Scratch:
    """Written tables that cut lineage, in a new folder below the shared one.

    A table outlives its executor, and Spark knows its size when it plans a join.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_root(spark)}-{uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch of the jobs that run meanwhile, for rows that hold
    texts or sets; executor and Python worker hold a batch each, in a few copies."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class WordHashes(dict):
    """Word (bytes) to a signed 64-bit hash, kept for the words seen lately."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)).view(np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    v = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        v ^= v >> np.uint64(30)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v ^= v >> np.uint64(27)
        v *= np.uint64(0x94D049BB133111EB)
        v ^= v >> np.uint64(31)
    return v


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` words; none for fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # a polynomial in FACTOR; powers of two of the words at once
    with np.errstate(over="ignore"):
        h, length, run, step, power = np.full(n, size, np.uint64), 0, words, 1, FACTOR
        while True:
            if size & step:
                h = h * power + run[length : length + n]
                length += step
            if 2 * step > size:
                break
            run = run[:-step] * power + run[step:]
            step, power = 2 * step, power * power
    return mixed(h)


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating star contraction: each round points the neighbours of a node to the least
    of them, larger ones first and smaller ones next, until every node points to its root.
    Every aggregate is a minimum, so a hub is combined before it is shuffled; the joins
    have one row per node on one side, so Spark can split a hub's edges on the other.
    """
    spark = scratch.spark
    node = F.col
    current = scratch.save(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        f"{name}_0",
    )
    last = None
    for turn in range(1, ROUNDS):
        both = current.union(current.select(node("v"), node("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(node("v").alias("u"), node("m").alias("v"))
        large = scratch.save(large.filter("u <> v").distinct(), f"{name}_{turn}_large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(node("v").alias("u"), node("m").alias("v")).union(
            least.select(node("u"), node("m").alias("v"))
        )
        following = scratch.save(small.filter("u <> v").distinct(), f"{name}_{turn}")
        state = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}_{turn}_large")
        scratch.drop(f"{name}_{turn - 1}")
        current = following
        if tuple(state) == last:
            break
        last = tuple(state)
    else:
        raise RuntimeError("the component search does not settle")
    roots = current.select(node("v").alias("node"), node("v").alias("component")).distinct()
    return scratch.save(current.select(node("u").alias("node"), node("v").alias("component")).union(roots), name)
