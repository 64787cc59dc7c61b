"""N-gram Jaccard join by signature trees: exact links and their components.

A document is the set of its distinct 5-word shingles; two link when their Jaccard
similarity is at least ``PERCENT`` / 100. No link is lost:

1. Documents with equal sets collapse to the smallest id.
2. Prefix filter: with all shingles in one common order, two linked sets share a shingle
   among the first n - ceil(0.75 n) + 1 of each. Documents meet in the groups of these
   shingles. The order is rarest first, by a sketch of counts over all documents, so what
   many documents share makes no groups. (Any common order is right; this one is fast.)
   Let a pair's first common shingle have r and s shingles from its place to the ends of the
   sets: the pair needs an overlap of 3/7 of its sizes' sum, so r and s are no less. Groups
   without a member whose place would allow this with any other are left out.
3. Each document is compared with three others first: of the smallest members, the largest
   members and the hubs of its groups those it meets most often. What this joins into one component needs
   no further comparison. It settles families of copies in linear work.
4. In groups that still hold several components, members without any partner of another
   component whose size and place would do are put aside, before bitmaps are shipped. For
   the others signature trees find the links: nodes hold the OR of token bitmaps, the range
   of set sizes, places and components. Two trees are walked
   together; a pair of nodes is dropped when its maximum possible overlap is too small for
   its sizes, or when both hold the same single component. Large groups are cut into blocks
   and every pair of blocks is a task of its own, so that no task gets a whole group. A family
   in which many pairs may link would make a candidate of each; a component brings its ``BEST``
   likeliest ones only, and groups with more are searched again with the components found since
   and four times as many, until none is held back.
5. Candidates are verified on the whole sets.

Shingles are compared by 64-bit hashes. Null, empty and wordless texts have empty sets and
link with nothing. A null doc_id links with nothing and has no component. Rows that repeat
a doc_id are one node of the graph and keep a row each.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tablewarden.llm.common import Scratch, WordHashes, components, load, small_batches, windows

SIZE = 5
PERCENT = 75
CELLS = 1 << 22  # counters of the sketch, a byte each where it is shipped
PART = 1 << 16  # counters in a row of a written sketch
HOT = 4096  # shingles in cells with more are aggregated before they are shuffled
BLOCK = 4096  # members of a group in one block
SLICE = 1000  # documents of a batch worked on at a time, and rows of a batch that hold sets
LEAF, FAN = 32, 8
BEST = 8  # candidates of a component in a pair of blocks, in the first search
HELD = 1 << 20  # candidates that a task holds
BROADCAST_IDS = 1_000_000  # ids, 8 bytes each


def needed(n: int) -> int:
    """The least overlap of a set of n shingles with any set it links to."""
    return -(-PERCENT * n // 100)


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    if not text:
        return np.empty(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(hashes.of(words), min(SIZE, len(words))))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bit for each token, in a width of at least four bits per token, a power of two."""
    width = 64
    while width < 4 * len(tokens):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Narrow bitmaps (rows) to ``words`` 64-bit words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes below 128, four steps to a doubling."""
    return np.minimum(np.rint(4 * np.log2(1 + counts)), 127).astype(np.uint8)


def _sketch_rows(counts: dict[int, np.ndarray]) -> pd.DataFrame:
    packed = [zlib.compress(_coded(c).tobytes(), 1) for c in counts.values()]
    return pd.DataFrame({"kind": 1, "doc_id": None, "n": None, "digest": None, "part": list(counts), "cells": packed})


SETS = "kind int, doc_id long, n long, digest binary, part int, cells binary"


def _sets(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: a document's set size and digest (0), a task's sketch of counts (1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, counts = WordHashes(), None
        for whole in batches:
            for k in range(0, len(whole), SLICE):
                batch = whole.iloc[k : k + SLICE]
                sets = [shingles(text, hashes) for text in batch["text"]]
                if counts is None:
                    counts = np.zeros(CELLS, np.uint32)
                np.add.at(counts, (np.concatenate(sets) & np.uint64(CELLS - 1)).astype(np.int64), np.uint32(1))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                ns = [len(s) for s in sets]
                yield pd.DataFrame(
                    {"kind": 0, "doc_id": batch["doc_id"], "n": ns, "digest": digests, "part": None, "cells": None}
                )
        if counts is not None:
            yield _sketch_rows(dict(enumerate(counts.reshape(-1, PART))))

    return docs.select("doc_id", "text").mapInPandas(run, SETS)


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of sketches, part by part. Steps of codes are rough, which changes the order of
    shingles a little, for all documents alike."""
    value = np.exp2(np.arange(128) / 4) - 1
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(batch["part"], batch["cells"], strict=True):
            counts = value[np.frombuffer(zlib.decompress(cells), np.uint8)]
            sums[part] = sums[part] + counts if part in sums else counts
    if sums:
        yield _sketch_rows(sums)


def _sketch(rows: DataFrame) -> np.ndarray:
    """The codes of all cells over all documents: CELLS bytes, whatever the corpus.

    Sketches of tasks are added in two steps, the first one salted; a task holds one sum a part.
    """
    for keys in ([F.col("part"), F.pmod(F.xxhash64("cells"), F.lit(64))], [F.col("part")]):
        rows = rows.repartition(*keys).mapInPandas(_added, SETS)
    codes = np.zeros((CELLS // PART, PART), np.uint8)
    for row in rows.select("part", "cells").collect():
        codes[row.part] = np.frombuffer(zlib.decompress(row.cells), np.uint8)
    return codes.ravel()


def _ordered(s: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A set in the common order, rarest first: the code of a shingle's cell above 56 bits of its
    hash, so that greater numbers come later."""
    code = codes[(s & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((code << np.uint64(56)) | (s & np.uint64((1 << 56) - 1))).view(np.int64)


def _shapes(docs: DataFrame, codes: np.ndarray) -> DataFrame:
    """Set size, bitmap and prefix of each document, the rare shingles of the prefix first."""
    usual = np.exp2(codes / 4.0).mean() if len(codes) else 0
    hot = int(_coded(np.array([max(HOT, 4 * usual)]))[0]) << 56

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for whole in batches:
            for k in range(0, len(whole), SLICE):
                batch = whole.iloc[k : k + SLICE]
                ns, bits, common, frequent = [], [], [], []
                for text in batch["text"]:
                    s = shingles(text, hashes)
                    n = len(s)
                    prefix = _ordered(s, codes)[: n - needed(n) + 1 if n else 0]
                    rare = int(np.searchsorted(prefix, hot))
                    ns.append(n)
                    bits.append(bitmap(s).tobytes())
                    common.append(prefix[:rare])
                    frequent.append(prefix[rare:])
                yield pd.DataFrame(
                    {"rep": batch["doc_id"], "n": ns, "bits": bits, "common": common, "frequent": frequent}
                )

    return docs.select("doc_id", "text").mapInPandas(
        run, "rep long, n long, bits binary, common array<long>, frequent array<long>"
    )


def _encoded(docs: DataFrame) -> DataFrame:
    """Whole sets, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            yield pd.DataFrame(
                {"rep": batch["doc_id"], "tokens": [shingles(t, hashes).tobytes() for t in batch["text"]]}
            )

    return docs.select("doc_id", "text").mapInPandas(run, "rep long, tokens binary")


@F.pandas_udf(BooleanType())
def _plausible(m: pd.Series, a: pd.Series, n: pd.Series, b: pd.Series) -> pd.Series:
    """Whether sets of these sizes and bitmaps may link."""

    def one(m: int, a: bytes, n: int, b: bytes) -> bool:
        if 100 * min(m, n) < PERCENT * max(m, n):
            return False
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        words = min(len(x), len(y))
        x, y = fold(x, words), fold(y, words)
        both = int(np.bitwise_count(x & y).sum())
        # a bit that only one set has stands for a token that only it has
        most = min(m - int(np.bitwise_count(x).sum()), n - int(np.bitwise_count(y).sum())) + both
        return (100 + PERCENT) * most >= PERCENT * (m + n)

    return pd.Series([one(*x) for x in zip(m, a, n, b, strict=True)], dtype=bool)


@F.pandas_udf(BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x: bytes, y: bytes) -> bool:
        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if 100 * min(len(p), len(q)) < PERCENT * max(len(p), len(q)):
            return False
        both = len(np.intersect1d(p, q, assume_unique=True))
        return 100 * both >= PERCENT * (len(p) + len(q) - both)

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


def _verified(pairs: DataFrame, docs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) that link. Only texts of documents in a pair are encoded."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = scratch.save(ids, f"{name}_ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    # a doc_id with several texts takes part with each of them
    with small_batches(scratch.spark, SLICE):
        sets = scratch.save(_encoded(docs.join(few, "doc_id", "left_semi")).distinct(), f"{name}_sets")
    left = sets.select(F.col("rep").alias("b"), F.col("tokens").alias("_y"))
    right = sets.select(F.col("rep").alias("a"), F.col("tokens").alias("_x"))
    linked = pairs.join(left, "b").join(right, "a").filter(_linked("_x", "_y")).select("a", "b")
    with small_batches(scratch.spark, SLICE):
        links = scratch.save(linked, name)
    scratch.drop(f"{name}_sets")
    return links


# --- signature trees -----------------------------------------------------------------


class Tree:
    """Members of one bitmap width, sorted by size; nodes with ORs and ranges."""

    def __init__(self, reps, labels, sizes, rests, bits):
        order = np.lexsort((reps, labels, sizes))
        self.reps, self.labels, self.sizes, self.bits = reps[order], labels[order], sizes[order], bits[order]
        self.rests = rests[order]
        self.ones = np.bitwise_count(self.bits).sum(1, dtype=np.int64)
        self.levels = [[self._leaf(k) for k in range(0, len(reps), LEAF)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._join(below[k : k + FAN], k) for k in range(0, len(below), FAN)])

    def _leaf(self, k: int) -> dict:
        part = slice(k, k + LEAF)
        return {
            "rows": part,
            "or": np.bitwise_or.reduce(self.bits[part], 0),
            "size": (self.sizes[part].min(), self.sizes[part].max()),
            "label": (self.labels[part].min(), self.labels[part].max()),
            "rest": self.rests[part].max(),
            "slack": (self.sizes[part] - self.ones[part]).max(),
            "below": (),
        }

    @staticmethod
    def _join(nodes: list[dict], first: int) -> dict:
        return {
            "or": np.bitwise_or.reduce([x["or"] for x in nodes], 0),
            "size": (min(x["size"][0] for x in nodes), max(x["size"][1] for x in nodes)),
            "label": (min(x["label"][0] for x in nodes), max(x["label"][1] for x in nodes)),
            "rest": max(x["rest"] for x in nodes),
            "slack": max(x["slack"] for x in nodes),
            "below": nodes,
        }

    @property
    def root(self) -> dict:
        return self.levels[-1][0]


def may_link(a: dict, b: dict) -> bool:
    """Whether some member of node a can link to one of b, with the group's shingle as the
    first one that they share.

    They share no more than the ``rest`` of either set, from that shingle on. A set has at most ``slack`` tokens more than bits, so sets of the two nodes share at
    most slack + |OR a & OR b| tokens. Sizes x, y need an overlap of 3/7 (x + y).
    """
    if a["label"][0] == a["label"][1] == b["label"][0] == b["label"][1]:
        return False
    (a0, a1), (b0, b1) = a["size"], b["size"]
    if 100 * a1 < PERCENT * b0 or 100 * b1 < PERCENT * a0:
        return False
    words = min(len(a["or"]), len(b["or"]))
    common = int(np.bitwise_count(fold(a["or"], words) & fold(b["or"], words)).sum())
    # folding merges bits, so the slack of the folded side is only bounded by its size
    slack = min(a["slack"] if len(a["or"]) == words else a1, b["slack"] if len(b["or"]) == words else b1)
    return (100 + PERCENT) * min(slack + common, a["rest"], b["rest"]) >= PERCENT * (a0 + b0)


def walk(s: Tree, t: Tree) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs of members of different components whose overlap may suffice: the members, their
    components and the overlap at most by the sum of sizes."""
    stack = [(s.root, t.root)]
    while stack:
        a, b = stack.pop()
        if not may_link(a, b):
            continue
        if a["below"] or b["below"]:
            if a is b:  # each pair of children once
                below = a["below"]
                stack.extend((below[i], below[j]) for i in range(len(below)) for j in range(i, len(below)))
            elif a["below"] and (not b["below"] or len(a["below"]) >= len(b["below"])):
                stack.extend((x, b) for x in a["below"])
            else:
                stack.extend((a, x) for x in b["below"])
            continue
        p, q = a["rows"], b["rows"]
        words = min(s.bits.shape[1], t.bits.shape[1])
        x, y = fold(s.bits[p], words), fold(t.bits[q], words)
        nx, ny = s.sizes[p][:, None], t.sizes[q][None, :]
        both = np.bitwise_count(x[:, None, :] & y[None, :, :]).sum(2, dtype=np.int64)
        px, py = (np.bitwise_count(v).sum(1, dtype=np.int64) for v in (x, y))
        # a bit that only one set has stands for a token that only it has
        most = np.minimum(nx - px[:, None] + both, ny - py[None, :] + both)
        most = np.minimum(most, np.minimum(s.rests[p][:, None], t.rests[q][None, :]))
        fits = ((100 + PERCENT) * most >= PERCENT * (nx + ny)) & (s.labels[p][:, None] != t.labels[q][None, :])
        i, j = np.nonzero(fits)
        if len(i):
            share = (most / (nx + ny))[i, j]
            yield s.reps[p][i], t.reps[q][j], s.labels[p][i], t.labels[q][j], share


def _trees(group: pd.DataFrame) -> dict[int, Tree]:
    by: dict[int, list[int]] = {}
    for k, b in enumerate(group["bits"]):
        by.setdefault(len(b) // 8, []).append(k)
    rest = "rest" if "rest" in group else "n"  # a whole set may be shared
    columns = [group[c].to_numpy(np.int64) for c in ("rep", "label", "n", rest)]
    bits = group["bits"].to_numpy()
    return {
        w: Tree(*(c[rows] for c in columns), np.frombuffer(b"".join(bits[rows]), np.uint64).reshape(len(rows), w))
        for w, rows in by.items()
    }


def _best(pairs: pd.DataFrame, most: int) -> pd.DataFrame:
    """The pairs that are among the ``most`` likeliest ones of either component."""
    pairs = pairs.sort_values(["share", "a", "b"], ascending=[False, True, True])
    ends = pd.Series(pairs[["p", "q"]].to_numpy().ravel())
    place = ends.groupby(ends).cumcount().to_numpy().reshape(-1, 2)
    return pairs[place.min(1) < most]


def _candidates(group: pd.DataFrame, most: int | None = None) -> pd.DataFrame:
    """Candidate pairs of one pair of blocks (i, j) of a group, with ``most`` not all of them; the
    pair (0, 0) says that some are held back."""
    i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
    first = _trees(group[group["block"] == i])
    second = first if i == j else _trees(group[group["block"] == j])
    columns = ["a", "b", "p", "q", "share"]
    found, held, less = [pd.DataFrame({c: [] for c in columns}).astype(dict.fromkeys(columns[:4], "int64"))], 0, False

    def shorten() -> None:
        nonlocal found, held, less
        pairs = pd.concat(found)
        pairs = pairs[pairs["a"] != pairs["b"]].drop_duplicates(["a", "b"])
        kept = pairs if most is None else _best(pairs, most)
        found, held, less = [kept], 0, less or len(kept) < len(pairs)

    for w, s in first.items():
        for v, t in second.items():
            if i == j and v < w:
                continue
            for a, b, p, q, share in walk(s, t):
                turned = a > b
                ends = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, q, p), np.where(turned, p, q)
                found.append(pd.DataFrame(dict(zip(columns, (*ends, share), strict=True))))
                held += len(a)
                if held > HELD:
                    shorten()
    shorten()
    out = found[0][["a", "b"]]
    return pd.concat([out, pd.DataFrame({"a": [0], "b": [0]})]) if less else out


def _pair(rows: list[tuple]) -> pd.DataFrame:
    """The pair of a group of two, if sizes and bitmaps let it link."""
    (*_, a, p, m, r, x), (*_, b, q, n, o, y) = rows
    if p == q or not _fits(m, r, n, o):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    s, t = (np.frombuffer(v, np.uint64) for v in (x, y))
    words = min(len(s), len(t))
    s, t = fold(s, words), fold(t, words)
    most = min(m - int(np.bitwise_count(s).sum()), n - int(np.bitwise_count(t).sum())) + int(np.bitwise_count(s & t).sum())
    fits = (100 + PERCENT) * most >= PERCENT * (m + n)
    return pd.DataFrame({"a": [min(a, b)] * fits, "b": [max(a, b)] * fits}, dtype="int64")


def _fits(m: int, r: int, n: int, o: int) -> bool:
    """Whether sets of sizes m and n may link that share r or o shingles at most."""
    return 100 * min(m, n) >= PERCENT * max(m, n) and (100 + PERCENT) * min(r, o) >= PERCENT * (m + n)


def _runs(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[list[list[tuple]]]:
    """For each batch, the runs of rows with equal first three values that end in it."""
    held: list[tuple] = []
    for batch in batches:
        ended = []
        for row in zip(*(batch[c].tolist() for c in columns), strict=True):
            if held and held[0][:3] != row[:3]:
                ended.append(held)
                held = []
            held.append(row)
        yield ended
    if held:
        yield [held]


def _partnered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The members with a partner of another component whose size and place would do. A task
    holds two blocks at a time."""
    columns = ["token", "i", "j", "block", "size", "rep", "label", "n", "rest"]
    for runs in _runs(batches, columns):
        out = []
        for rows in runs:
            if len(rows) == 2:
                (*_, p, m, r), (*_, q, n, o) = rows
                if p != q and _fits(m, r, n, o):
                    out += rows
            elif len(rows) > 2:
                labels, sizes, rests = (np.array([row[k] for row in rows], np.int64) for k in (6, 7, 8))
                for k in range(0, len(rows), SLICE):
                    cut = slice(k, k + SLICE)
                    m, n = sizes[cut, None], sizes[None, :]
                    fits = 100 * np.minimum(m, n) >= PERCENT * np.maximum(m, n)
                    fits &= (100 + PERCENT) * np.minimum(rests[cut, None], rests[None, :]) >= PERCENT * (m + n)
                    fits &= labels[cut, None] != labels[None, :]
                    out += [rows[k + x] for x in np.flatnonzero(fits.any(1)).tolist()]
        if out:
            yield pd.DataFrame(out, columns=columns)[["token", "size", "rep", "label", "n", "rest"]]


def _block_pairs(most: int):
    """Trees over sorted rows: those of a pair of blocks follow one another. A task holds
    two blocks at a time. Pairs have no token; (0, 0) names that of a group with pairs held back."""
    columns = ["token", "i", "j", "block", "rep", "label", "n", "rest", "bits"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for runs in _runs(batches, columns):
            out = []
            for rows in runs:
                found = _pair(rows) if len(rows) == 2 else _candidates(pd.DataFrame(rows, columns=columns), most)
                if len(found):
                    pair = (found["a"] != found["b"]).to_numpy()
                    tokens = pd.arrays.IntegerArray(np.full(len(found), rows[0][0], np.int64), pair)
                    out.append(found.assign(token=tokens))
            if out:
                yield pd.concat(out).drop_duplicates()

    return run


# --- the join ------------------------------------------------------------------------


def _members(shapes: DataFrame) -> DataFrame:
    """(token, size, lo, hi, rep, n, rest): the groups of at least two that may hold a link; of
    groups with the same members the first one in the common order, where places are best.

    Frequent shingles are aggregated before they are shuffled and joined so that Spark can
    split them. All others cross once: their groups are counted and joined where they lie.
    """
    whole, rest = F.shiftright("place", 32), F.col("place").bitwiseAND((1 << 32) - 1)
    measures = [
        F.count("*").alias("size"),
        F.min("rep").alias("lo"),
        F.max("rep").alias("hi"),
        F.bit_xor(F.xxhash64("rep")).alias("mark"),
        # the smaller set of a link needs this
        F.max((100 + PERCENT) * rest >= 2 * PERCENT * whole).alias("early"),
    ]
    # the set's size and what is left of it from here on, in one number
    left = F.col("n") - F.col("pos") - F.when(F.col("late"), F.col("ahead")).otherwise(0)
    place = F.shiftleft("n", 32).bitwiseOR(left).alias("place")
    ahead = F.size("common").alias("ahead")
    # the filter that a join adds, so that both uses have one plan
    parts = [
        shapes.select("rep", "n", ahead, F.lit(late).alias("late"), F.posexplode(c).alias("pos", "token"))
        .select("token", "rep", place)
        .filter("token IS NOT NULL")
        for late, c in ((False, "common"), (True, "frequent"))
    ]
    common, frequent = parts[0].repartition("token"), parts[1]
    counted = [part.groupBy("token").agg(*measures).filter("lo < hi AND early") for part in (common, frequent)]
    groups = (
        counted[0]
        .union(counted[1])
        .groupBy("size", "lo", "hi", "mark")
        .agg(F.min("token").alias("token"))
        .select("token", "size", "lo", "hi")
    )
    # one job, so that its two uses of the shuffled rows are one shuffle
    members = common.join(groups, "token").union(frequent.join(groups, "token"))
    return members.select("token", "size", "lo", "hi", "rep", whole.alias("n"), rest.alias("rest"))


def _placed(members: DataFrame) -> DataFrame:
    """A row for each pair of blocks of its group that a member takes part in, pair by pair."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    return (
        members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other")
    )


def _sorted_pairs(placed: DataFrame) -> DataFrame:
    return placed.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")


def _of(small: DataFrame, ids: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The rows of ``small`` with these ids, which are broadcast where they are few."""
    ids = scratch.save(ids.distinct(), name)
    return small.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "rep", "left_semi")


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    members = members.join(label, "rep", "left")
    return members.withColumn("label", F.coalesce("component", "rep")).drop("component")


def _open(members: DataFrame) -> DataFrame:
    """The members of groups that hold several components."""
    groups = members.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    return members.join(groups.select("token"), "token")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    with small_batches(scratch.spark, SLICE):
        both = scratch.save(_sets(docs), "sets", "kind")
    sets = both.filter("kind = 0").select("doc_id", "n", "digest")
    codes = _sketch(both.filter("kind = 1"))

    filled = sets.filter("n > 0 AND doc_id IS NOT NULL")
    # written, so that Spark can split a hot digest when it joins
    smallest = scratch.save(filled.groupBy("digest").agg(F.min("doc_id").alias("rep")), "smallest")
    reps = scratch.save(filled.join(smallest, "digest").select("doc_id", "rep", "n"), "reps")
    copies = reps.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    heads = reps.filter("doc_id = rep").select("doc_id", "n").distinct()

    # copies, which are few or else joined, do without shapes
    gone = reps.filter("doc_id <> rep").select("doc_id").distinct().join(heads, "doc_id", "left_anti")
    gone = scratch.save(gone, "gone")
    named = docs.filter("doc_id IS NOT NULL")
    if gone.count() <= BROADCAST_IDS:
        shapes = _shapes(named.join(F.broadcast(gone), "doc_id", "left_anti"), codes)
    else:
        shapes = _shapes(named, codes).join(heads.select(F.col("doc_id").alias("rep")).distinct(), "rep")
    with small_batches(scratch.spark, SLICE):
        shapes = scratch.save(shapes, "shapes")
    members = scratch.save(_members(shapes), "members")
    small = shapes.select("rep", "n", "bits")

    # Hubs: the original of a family of copies shares most with the others, so it stands in
    # more and larger groups than any of its variants.
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "rep").groupBy("token").agg(F.max_by("rep", F.struct("weight", "rep")).alias("hub"))
    hubs = scratch.save(hubs, "hubs")
    ends = F.array(*(F.struct(F.lit(k).alias("side"), F.col(c).alias("end")) for k, c in enumerate(("lo", "hi", "hub"))))
    met = members.join(hubs, "token").select("rep", F.explode(ends).alias("e"))
    met = met.select("rep", "e.side", "e.end").filter("rep <> end").groupBy("rep", "side", "end").count()
    stars = met.groupBy("rep", "side").agg(F.max_by("end", F.struct("count", "end")).alias("end"))
    stars = stars.select(F.least("rep", "end").alias("a"), F.greatest("rep", "end").alias("b")).distinct()
    stars = scratch.save(stars, "met")
    some = _of(small, stars.select(F.explode(F.array("a", "b")).alias("rep")), scratch, "met_ids")
    first = some.toDF("a", "_m", "_x")
    second = some.toDF("b", "_n", "_y")
    stars = stars.join(first, "a").join(second, "b").filter(_plausible("_m", "_x", "_n", "_y")).select("a", "b")
    with small_batches(scratch.spark, SLICE):
        stars = scratch.save(stars.distinct(), "stars")
    links = _verified(stars, docs, scratch, "links")

    label = components(links, scratch, "first").withColumnRenamed("node", "rep")
    tested = scratch.save(_labelled(members.drop("lo", "hi"), label), "tested")
    scratch.drop("members")
    light = "token long, size long, rep long, label long, n long, rest long"
    partnered = _sorted_pairs(_placed(_open(tested))).mapInPandas(_partnered, light).distinct()
    partnered = scratch.save(partnered, "partnered")
    scratch.drop("tested")
    most, turn = BEST, 0
    while True:
        # texts of one doc_id and one size take part with all their bitmaps
        some = _of(small, partnered.select("rep"), scratch, f"partnered_ids_{turn}")
        heavy = _placed(partnered).join(some, ["rep", "n"])
        found = _sorted_pairs(heavy).mapInPandas(_block_pairs(most), "a long, b long, token long").distinct()
        with small_batches(scratch.spark, SLICE):
            found = scratch.save(found, f"found_{turn}")
        pairs = found.filter("a <> b").select("a", "b")
        links = links.union(_verified(pairs, docs, scratch, f"more_{turn}"))
        held_back = found.filter("token IS NOT NULL").select("token").distinct()
        if held_back.isEmpty():
            break
        most, turn = 4 * most, turn + 1
        label = components(links, scratch, f"labels_{turn}").withColumnRenamed("node", "rep")
        again = partnered.drop("label").join(held_back, "token")
        partnered = scratch.save(_open(_labelled(again, label)), f"partnered_{turn}")
    scratch.drop("shapes")
    label = components(links.union(copies), scratch, "all")
    return (
        sets.join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    )


def op6_ngram_jaccard_join(spark, folder: str) -> DataFrame:
    return near_duplicates(load(spark, folder, "documents"))
