"""Ranked lexical search: the best documents of each item, by a dual-tree search.

A document is a vector of impacts over the items' terms, an item one of term weights, a score
their inner product. In a task, documents are taken in batches and laid into a tree whose nodes
hold the maxima of each coordinate; the items form such a tree as well. A pair of nodes is
bounded by the inner product of their maxima. Where that is below the weakest k-th score among
the node's items, no document of the one can enter the list of any item of the other, and the
pair goes with all below it. The rest descends; pairs of leaves are scored exactly. Scores and
bounds are whole numbers, in doubles while sums stay below 2**53 and in 64-bit integers beyond,
so pruning and ranks are exact.

Plan: one scan of the texts leaves, per document, its length and its counts of the items' terms
(written: the statistics need all of them before anything can be scored). A first search over a
sixteenth of the documents, which may miss any number of good ones, yields for each item a score
that the k-th is not below. The search over all documents starts from it, so a task sends few
rows, at most k per item, to the final ranking. The stated items go block by block; the driver and
a task hold the terms and vectors of one block, of at most ``CELLS`` cells or one item.

Edge cases: a null or empty text has no terms: as a document it counts nowhere, as an item it has
no rows. Every row is a document and every row of the items is an item, repeated ones too. Equal
scores rank by doc_id, null last; repeated rows in any order. Empty tables give no rows. Ids are
read as long; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load

TOP = 50
CELLS = 1 << 22  # of a block's item vectors, and of a batch's document vectors
SLICE = 1 << 20  # bytes of a text whose terms are held at a time
LEAF_DOCS, LEAF_ITEMS = 8, 4  # also the nodes under a node
SEED_SHARE, SEED_KEPT = 16, 4  # one of so many documents is in the first search; rows per item and task
LARGEST_ID = (1 << 63) - 1
TOP_IMPACT = 1_000_000  # what an impact lies below

# lower-cases A-Z and turns what is in no term into blanks
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
COUNTS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, item_id long, doc_id long, score long"


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs; a long text is split slice by slice."""
    data = (text or "").encode().translate(TERM_BYTES)
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE) if at + SLICE < len(data) else -1
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


@dataclass
class Block:
    """Items that are searched together, and the numbers of their terms."""

    first: int
    item_ids: list[int | None] = field(default_factory=list)
    terms: list[list[int]] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)

    def add(self, item_id: int | None, terms: Counter[bytes]) -> None:
        self.item_ids.append(item_id)
        self.terms.append([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms])


def blocks(items: DataFrame, cells: int = CELLS) -> Iterator[Block]:
    """The rows of ``items`` (item_id, text) that have terms, one block at a time."""
    block = Block(0)
    for item_id, text in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        terms = term_counts(text)
        if not terms:
            continue
        if block.terms and (len(block.terms) + 1) * len(block.vocabulary | terms) > cells:
            yield block
            block = Block(block.first + len(block.terms))
        block.add(item_id, terms)
    if block.terms:
        yield block


def document_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with terms: their number, and which of the vocabulary occur how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, terms, counts, bounds = [], [], [], [], [0]
            for row, value in enumerate(batch.column(1)):
                found = term_counts(value.as_py())
                if not found:
                    continue
                rows.append(row)
                lengths.append(found.total())
                for term in found.keys() & vocabulary.keys():
                    terms.append(vocabulary[term])
                    counts.append(found[term])
                bounds.append(len(terms))
            offsets = pa.array(bounds, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (terms, counts)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, COUNTS)


def maxima(vectors: np.ndarray, fan: int) -> list[np.ndarray]:
    """Coordinate maxima of the nodes of a tree over rows in order, from the root down to the leaves' parents."""
    levels = [vectors]
    while len(levels) == 1 or len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), fan), axis=0))
    return levels[:0:-1]


class Search:
    """The best documents of each item among those seen, in one task."""

    def __init__(self, block: Block, weights: np.ndarray, docs: int, length: int, top: int, floors: dict[int, tuple]):
        self.docs, self.length, self.top = docs, length, top
        kind = np.float64 if int(weights.sum()) * TOP_IMPACT < 1 << 53 else np.int64
        vectors = np.zeros((len(block.terms), len(weights)), kind)
        for i, terms in enumerate(block.terms):
            vectors[i, terms] = weights[terms]
        # items that share their heaviest term become neighbours
        self.order = np.lexsort((vectors.max(1), vectors.argmax(1)))
        self.items = vectors[self.order]
        self.levels = maxima(self.items, LEAF_ITEMS)
        n = len(self.items)
        self.scores, self.ids = np.zeros((n, top), np.int64), np.full((n, top), LARGEST_ID)
        given = [floors.get(int(i), (0, LARGEST_ID)) for i in self.order]
        self.floor_scores = np.array([g[0] for g in given], np.int64)
        self.floor_ids = np.array([g[1] for g in given], np.int64)
        self.weights, self.scored = weights, 0

    def weakest(self) -> np.ndarray:
        """The score that a document must reach, for every item."""
        return np.maximum(np.maximum(self.floor_scores, self.scores[:, -1]), 1)

    def add(self, ids: np.ndarray, n: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """Search a batch: documents with ids and lengths, and the counts of terms in its rows."""
        m = 100 - 50 + (50 * n * self.docs) // self.length
        impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * m[rows])
        # documents that share their strongest term become neighbours
        strength = impacts * self.weights[terms]
        by_row = np.lexsort((-strength, rows))
        strongest = np.full(len(ids), -1)
        heads = by_row[np.flatnonzero(np.diff(rows[by_row], prepend=-1))]
        strongest[rows[heads]] = terms[heads]
        order = np.argsort(strongest, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        vectors = np.zeros((len(ids), len(self.weights)), self.items.dtype)
        vectors[place[rows], terms] = impacts
        self._descend(ids[order], vectors)

    def _descend(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        docs, items = maxima(vectors, LEAF_DOCS), self.levels
        weakest = self.weakest()
        floors = [weakest]
        for _ in items:
            floors.append(np.minimum.reduceat(floors[-1], np.arange(0, len(floors[-1]), LEAF_ITEMS)))
        floors = floors[:0:-1]
        alive = np.ones((1, 1), bool)
        for depth in range(max(len(docs), len(items))):
            d, i = docs[min(depth, len(docs) - 1)], items[min(depth, len(items) - 1)]
            if 0 < depth < len(docs):
                alive = alive.repeat(LEAF_DOCS, 0)[: len(d)]
            if 0 < depth < len(items):
                alive = alive.repeat(LEAF_ITEMS, 1)[:, : len(i)]
            rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
            if not len(rows):
                return
            floor = floors[min(depth, len(items) - 1)][columns]
            alive[np.ix_(rows, columns)] &= d[rows] @ i[columns].T >= floor
        alive = alive.repeat(LEAF_DOCS, 0)[: len(vectors)].repeat(LEAF_ITEMS, 1)[:, : len(self.items)]
        rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(rows):
            return
        scores = (vectors[rows] @ self.items[columns].T).astype(np.int64)
        scores[~alive[np.ix_(rows, columns)]] = 0
        self.scored += int(alive.sum())
        for item, own in zip(columns.tolist(), scores.T, strict=True):
            hit = np.flatnonzero(own >= weakest[item])
            if len(hit):
                self._enter(item, own[hit], ids[rows[hit]])

    def _enter(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = self.floor_scores[item]
        good = (scores > floor) | ((scores == floor) & (ids <= self.floor_ids[item]))
        scores = np.concatenate((self.scores[item], scores[good]))
        ids = np.concatenate((self.ids[item], ids[good]))
        best = np.lexsort((ids, -scores))[: self.top]
        self.scores[item], self.ids[item] = scores[best], ids[best]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, ids and scores of the lists."""
        at, rank = np.nonzero(self.scores > 0)
        return self.order[at], self.ids[at, rank], self.scores[at, rank]


def search(
    counted: DataFrame, block: Block, weights: np.ndarray, stats: tuple[int, int], top: int, floors: dict[int, tuple]
) -> DataFrame:
    """The best ``top`` documents of each item in each task; ``floors`` (score, id) by item must be reached."""
    batch_rows = max(64, CELLS // len(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Search(block, weights, *stats, top, floors)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                ids = part.column(0).fill_null(LARGEST_ID).to_numpy()
                sizes = np.diff(part.column(2).offsets.to_numpy())
                rows = np.repeat(np.arange(part.num_rows), sizes)
                terms, counts = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
                task.add(ids, part.column(1).to_numpy(), rows, terms, counts)
        items, ids, scores = task.found()
        columns = [
            pa.array(items.astype(np.int32)),
            pa.array([block.item_ids[i] for i in items.tolist()], pa.int64()),
            pa.array(ids, mask=ids == LARGEST_ID),
            pa.array(scores),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

    return counted.mapInArrow(run, FOUND)


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def best_of_block(docs: DataFrame, block: Block, top: int, scratch: Scratch) -> DataFrame:
    name = f"counts_{block.first}"
    counted = scratch.save(document_counts(docs, block.vocabulary), name)
    n, length = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = np.zeros(len(block.vocabulary), np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holding[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)
    stats = n, length or 1
    sample = counted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SEED_SHARE)) == 0)
    seeds = ranked(search(sample, block, weights, stats, min(top, SEED_KEPT), {}), top).filter(F.col("rank") == top)
    last = F.coalesce("doc_id", F.lit(LARGEST_ID))
    floors = {r.item: (r.score, r.last) for r in seeds.select("item", "score", last.alias("last")).toLocalIterator()}
    found = ranked(search(counted, block, weights, stats, top, floors), top)
    kept = scratch.save(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), f"best_{block.first}")
    scratch.drop(name)
    return kept


def best_documents(docs: DataFrame, items: DataFrame, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    parts = [best_of_block(docs, block, top, scratch) for block in blocks(items, cells)]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, parts)


def op13_ranked_lexical_search(spark, folder: str) -> DataFrame:
    return best_documents(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


ORACLE = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
stats AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM lengths),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weighted AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counted, stats GROUP BY term, docs),
scored AS (
    SELECT item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // len)))))::BIGINT AS score
    FROM asked JOIN weighted USING (term) JOIN counted USING (term) JOIN lengths USING (doc_id), stats
    GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""
