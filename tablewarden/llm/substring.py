"""Exact substring dedup by deep-shallow suffix sorting.

A byte is removed if a ``LENGTH``-byte string that covers it starts anywhere else too, in
the same or another text; strings are judged on the input and never cross texts.

Sorting the suffixes at all bytes of a corpus is not needed. Every window of LENGTH bytes
names one anchor: its least 32-byte gram by hash, the leftmost of equal ones. Equal windows
name the same gram at the same place, so only suffixes at anchors (one in some 85 bytes)
are compared, and only those whose gram occurs at two places.

1. Equal texts collapse; a text with a copy and at least LENGTH bytes goes entirely.
2. Anchors are counted by gram; an aggregate, so frequent grams are combined first.
3. Anchors with a repeated gram get their context: the bytes before, up to LENGTH - 32, and
   the bytes from the anchor on, up to LENGTH. Equal contexts of a gram collapse, in each
   task before the shuffle and again after it.
4. The contexts of one gram are ordered twice, by what follows and by what precedes
   (reversed). Deep-shallow: multikey quicksort to depth ``SHALLOW``; groups that are still
   equal there go to a blind trie, which finds the place of a string by branching bytes
   alone and compares it with one leaf. The order's common prefixes give, for two anchors,
   the bytes l and r that they share on either side: l + r >= LENGTH is a repeated string.
5. The intervals of a text are merged and cut out.

A task holds the distinct contexts of one gram at a time, some 370 bytes each, of at most
``HOT`` places. The contexts of a gram with more places meet by longer strings instead, of
some 180 bytes, and those that share such a string with many others by whole windows, with
the same result (see ``_shared_of_hot``). Null texts are empty; rows that repeat a doc_id or a
text are judged one by one.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load, mixed

LENGTH = 200
GRAM = 32
SPAN = LENGTH - GRAM + 1  # grams in a window
SHALLOW = 48
PAIRS = 256  # contexts up to which all pairs of one gram are looked at, in 64 KB
HOT = 1 << 13  # places of a gram, or contexts of a core, that one task sorts, some 3 MB
CORES = 8  # ranges of windows by which contexts of a hot gram meet
STEP = 1 << 22
PLACE = np.uint64((1 << 24) - 1)
BYTES = mixed(np.arange(1001, 1257, dtype=np.uint64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes from each place on."""
    h, width = BYTES[data], 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            following = h[width:]
            h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width)
            h += following
            width *= 2
    return mixed(h)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Grams and places of the anchors of all windows of a text."""
    grams, places = [], []
    whole = np.frombuffer(data, np.uint8)
    for k in range(0, len(data) - LENGTH + 1, STEP):
        h = gram_hashes(whole[k : k + STEP + LENGTH - 1])
        least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if SPAN > width:
            least = np.minimum(least[: width - SPAN], least[SPAN - width :])
        at = (least & PLACE).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        grams.append(h[at])
        places.append(at + k)
    if not grams:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams, places = np.concatenate(grams), np.concatenate(places)
    keep = np.concatenate([[True], places[1:] != places[:-1]])
    return grams[keep], places[keep]


# --- deep-shallow sorting ------------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """Rows in the order of their strings, and the common prefix of each with the one before.

    A node is [depth, children by byte]; -1 stands for the end of a string. A leaf is a list
    of rows with equal strings.
    """
    root = None
    for row in rows:
        s = strings[row]
        if root is None:
            root = [row]
            leaf_of = {id(root): True}
            continue
        path, node = [], root
        while id(node) not in leaf_of:
            path.append(node)
            depth, children = node
            child = children.get(s[depth] if depth < len(s) else -1)
            node = next(iter(children.values())) if child is None else child
        n = common(s, strings[node[0]])
        if n == len(s) == len(strings[node[0]]):
            node.append(row)
            continue
        leaf = [row]
        leaf_of[id(leaf)] = True
        key = s[n] if n < len(s) else -1
        k = next((k for k, p in enumerate(path) if p[0] >= n), len(path))
        if k < len(path) and path[k][0] == n:
            path[k][1][key] = leaf
            continue
        below = path[k] if k < len(path) else node
        other = strings[node[0]]
        branch = [n, {key: leaf, (other[n] if n < len(other) else -1): below}]
        if k == 0:
            root = branch
        else:
            depth, children = path[k - 1]
            children[s[depth] if depth < len(s) else -1] = branch
    order: list[int] = []
    prefixes: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if id(node) in leaf_of:
            order.append(node[0])
            prefixes.append(shared)
            for row in node[1:]:
                order.append(row)
                prefixes.append(len(strings[row]))
        else:
            depth, children = node
            keys = sorted(children)
            stack.extend((children[c], depth) for c in reversed(keys[1:]))
            stack.append((children[keys[0]], shared))
    return order, prefixes


def deep_shallow(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings and the common prefix of each with the one before it."""
    order: list[int] = []
    groups = [(list(range(len(strings))), 0)]
    starts: list[int] = []  # places in the order where the prefix must be looked up
    prefixes: list[int] = []
    while groups:
        rows, depth = groups.pop()
        if len(rows) == 1 or depth >= SHALLOW:
            starts.append(len(order))
            found, shared = blind_trie(strings, rows) if len(rows) > 1 else (rows, [0])
            order.extend(found)
            prefixes.extend(shared)
            continue
        heads = [strings[r][depth] if depth < len(strings[r]) else -1 for r in rows]
        pivot = heads[len(heads) // 2]
        less = [r for r, h in zip(rows, heads, strict=True) if h < pivot]
        same = [r for r, h in zip(rows, heads, strict=True) if h == pivot]
        more = [r for r, h in zip(rows, heads, strict=True) if h > pivot]
        if more:
            groups.append((more, depth))
        # strings that end here are equal; the trie puts them together
        groups.append((same, SHALLOW if pivot < 0 else depth + 1))
        if less:
            groups.append((less, depth))
    for k in starts[1:]:
        prefixes[k] = common(strings[order[k - 1]], strings[order[k]])
    prefixes[0] = 0
    return np.array(order), np.array(prefixes)


def _pairwise(order: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """The common prefix of every two strings, from their order; -1 on the diagonal."""
    m = len(order)
    ranked = np.full((m, m), -1)
    for i in range(m - 1):
        shared = np.minimum.accumulate(prefixes[i + 1 :])
        ranked[i, i + 1 :] = shared
        ranked[i + 1 :, i] = shared
    out = np.empty_like(ranked)
    out[np.ix_(order, order)] = ranked
    return out


def shared_strings(lefts: list[bytes], rights: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each of the distinct contexts of a gram, the bytes before and from the anchor on
    that lie in strings it shares with another one (0 and 0: none). ``lefts`` are reversed."""
    m = len(lefts)
    if m == 2:
        l, r = common(*lefts), common(*rights)
        hit = l + r >= LENGTH
        return np.full(2, l * hit), np.full(2, r * hit)
    by_left, by_right = deep_shallow(lefts), deep_shallow(rights)
    if m <= PAIRS:
        l, r = _pairwise(*by_left), _pairwise(*by_right)
        hit = l + r >= LENGTH
        return np.where(hit, l, 0).max(1), np.where(hit, r, 0).max(1)
    low, high = np.full(m, LENGTH), np.full(m, -1)
    before, after = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(SPAN):  # windows that begin o bytes before the anchor
        before[by_left[0]] = np.cumsum(by_left[1] < o) if o else 0
        after[by_right[0]] = np.cumsum(by_right[1] < LENGTH - o)
        if o:  # a context shorter than the window has no such window
            before[[len(x) < o for x in lefts]] = -1
        key = before * (m + 1) + after
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        full = np.array([len(x) >= o for x in lefts]) & np.array([len(x) >= LENGTH - o for x in rights])
        hit = (times[inverse] > 1) & full
        low[hit] = np.minimum(low[hit], o)
        high[hit] = np.maximum(high[hit], o)
    hit = high >= 0
    return np.where(hit, high, 0), np.where(hit, LENGTH - low, 0)


# --- the job -------------------------------------------------------------------------


def _key(text):
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _anchors(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [anchors(t.encode("utf-8", "surrogatepass")) for t in batch["text"]]
            yield pd.DataFrame(
                {"key": batch["key"], "grams": [g.view(np.int64) for g, _ in found], "places": [p for _, p in found]}
            )

    return texts.select("key", "text").mapInPandas(run, "key binary, grams array<long>, places array<int>")


def _context(data: bytes, at: int) -> tuple[bytes, bytes, bytes]:
    """Digest of the context of an anchor, the bytes before it (reversed) and from it on."""
    left, right = data[max(0, at - SPAN + 1) : at][::-1], data[at : at + LENGTH]
    return hashlib.blake2b(b"%d," % len(left) + left + right, digest_size=16).digest(), left, right


def _contexts(texts: DataFrame, with_bytes: bool, hot: bool = False) -> DataFrame:
    """A row per anchor of ``texts`` (key, text, anchors): gram, digest of its context, place.

    ``with_bytes``: the contexts themselves, once per task, with how often they occur, of the
    grams that are ``hot`` or of those that are not. A context's further occurrences in a task
    follow as one row without bytes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        names = ["gram", "context", *(("left", "right", "times") if with_bytes else ("key", "place"))]
        for batch in batches:
            rows = []
            for key, text, found in zip(batch["key"], batch["text"], batch["anchors"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for a in found:
                    if with_bytes and a["hot"] != hot:
                        continue
                    at = a["place"]
                    digest, left, right = _context(data, at)
                    if not with_bytes:
                        rows.append((a["gram"], digest, key, at))
                        continue
                    if (a["gram"], digest) not in seen:
                        rows.append((a["gram"], digest, left, right, 1))
                    seen[a["gram"], digest] += 1
            yield pd.DataFrame(rows, columns=names)
        if with_bytes:
            rows = [(gram, digest, None, None, n - 1) for (gram, digest), n in seen.items() if n > 1]
            yield pd.DataFrame(rows, columns=names)

    rest = "left binary, right binary, times long" if with_bytes else "key binary, place int"
    return texts.select("key", "text", "anchors").mapInPandas(run, f"gram long, context binary, {rest}")


def _shared(contexts: DataFrame, group: str = "gram") -> DataFrame:
    """(gram, context, before, after) of the contexts that share strings. The rows of a group
    must follow one another; a group has one gram."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, list] = {}  # context to its bytes and count
        out: list[tuple] = []

        def close(gram: int | None) -> None:
            rows = list(held.items())
            before = after = np.zeros(len(rows), np.int64)
            if len(rows) > 1:
                before, after = shared_strings([x[0] for _, x in rows], [x[1] for _, x in rows])
            for (context, (left, right, times)), l, r in zip(rows, before.tolist(), after.tolist(), strict=True):
                if times > 1 and len(left) + len(right) >= LENGTH:
                    l, r = len(left), len(right)
                if r:
                    out.append((gram, context, l, r))
            held.clear()

        def taken() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=["gram", "context", "before", "after"])
            out.clear()
            return frame

        current = gram_of_it = None
        for batch in batches:
            for this, gram, context, left, right, times in zip(
                *(batch[c].tolist() for c in ("group", "gram", "context", "left", "right", "times")), strict=True
            ):
                if this != current:
                    close(gram_of_it)
                    current, gram_of_it = this, gram
                known = held.setdefault(bytes(context), [None, None, 0])
                known[2] += times
                if left is not None:
                    known[:2] = bytes(left), bytes(right)
            yield taken()
        close(gram_of_it)
        yield taken()

    return contexts.select(F.col(group).alias("group"), "gram", "context", "left", "right", "times").mapInPandas(
        run, "gram long, context binary, before int, after int"
    )


def _digest(*parts):
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _shared_of_hot(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """As ``_shared``, for hot grams.

    A window that begins o bytes before the anchor, low <= o <= high, holds the bytes from low
    before the anchor to LENGTH - high after it: its core. Contexts with a window in common
    share the core of one of ``CORES`` ranges of o, so they meet by core instead of by gram.
    What shares a core with nothing is done with. Cores of more than ``HOT`` contexts are cut
    further, into the single windows of their range, which an aggregate counts.
    """
    texts = texts.filter(F.exists("anchors", lambda a: a["hot"]))
    contexts = (
        _contexts(texts, with_bytes=True, hot=True)
        .groupBy("gram", "context")
        .agg(
            F.first("left", ignorenulls=True).alias("left"),
            F.first("right", ignorenulls=True).alias("right"),
            F.sum("times").alias("times"),
        )
    )
    contexts = scratch.save(contexts, "hot_contexts")
    before, after = F.octet_length("left"), F.octet_length("right")
    again = contexts.filter((F.col("times") > 1) & (before + after >= LENGTH)).select(
        "gram", "context", before.alias("before"), after.alias("after")
    )

    step = -(-SPAN // CORES)
    ranges = F.array(
        *(F.struct(F.lit(o).alias("low"), F.lit(min(o + step, SPAN) - 1).alias("high")) for o in range(0, SPAN, step))
    )
    keys = (
        contexts.select("gram", "context", "left", "right", F.explode(ranges).alias("o"))
        .select("gram", "context", "left", "right", "o.low", "o.high")
        .filter((before >= F.col("low")) & (after >= LENGTH - F.col("high")))
    )
    core = _digest(
        F.col("low").cast("string").cast("binary"),
        F.lit(" ").cast("binary"),
        F.col("left").substr(F.lit(1), F.col("low")),
        F.col("right").substr(F.lit(1), LENGTH - F.col("high")),
    )
    keys = scratch.save(keys.select("gram", "context", "low", "high", core.alias("core")), "cores")
    counted = scratch.save(keys.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1"), "core_counts")
    met = keys.join(counted, "core").join(contexts.select("gram", "context", "left", "right"), ["gram", "context"])

    few = met.filter(F.col("n") <= HOT).withColumn("times", F.lit(1).cast("long"))
    sortable = few.repartition("core").sortWithinPartitions("core")
    sorted_out = _shared(sortable, "core")

    windows = met.filter(F.col("n") > HOT).select(
        "gram", "context", "left", "right", F.explode(F.sequence("low", "high")).alias("o")
    )
    windows = windows.filter((before >= F.col("o")) & (after >= LENGTH - F.col("o"))).select(
        "gram",
        "context",
        "o",
        _digest(
            F.col("o").cast("string").cast("binary"),
            F.lit(" ").cast("binary"),
            F.col("left").substr(F.lit(1), F.col("o")),
            F.col("right").substr(F.lit(1), LENGTH - F.col("o")),
        ).alias("window"),
    )
    if counted.filter(F.col("n") > HOT).isEmpty():
        found = sorted_out
    else:
        windows = scratch.save(windows, "windows")
        # written, so that Spark can split the join at a window of many contexts
        repeated = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
        counted_out = windows.join(scratch.save(repeated, "repeated"), "window").select(
            "gram", "context", F.col("o").alias("before"), (LENGTH - F.col("o")).alias("after")
        )
        found = sorted_out.union(counted_out)
    return (
        found.union(again)
        .groupBy("gram", "context")
        .agg(F.max("before").alias("before"), F.max("after").alias("after"))
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _cut(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, found in zip(batch["key"], batch["text"], batch["found"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                spans = merged([(s["start"], s["stop"]) for s in found])
                kept, last = hashlib.sha256(), 0
                for start, stop in spans:
                    kept.update(data[last:start])
                    last = stop
                kept.update(data[last:])
                rows.append((key, sum(b - a for a, b in spans), spans, kept.hexdigest()))
            frame = pd.DataFrame(rows, columns=["key", "n_removed", "spans", "kept_sha256"])
            frame["spans"] = [[{"start": a, "stop": b} for a, b in s] for s in frame["spans"]]
            yield frame

    return texts.select("key", "text", "found").mapInPandas(
        run, "key binary, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string"
    )


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans, kept_sha256 of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    facts = scratch.save(
        docs.select(
            "doc_id",
            _key(F.col("text")).alias("key"),
            F.octet_length(F.col("text").cast("binary")).cast("long").alias("n_bytes"),
            F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
        ),
        "facts",
    )
    keyed = docs.filter(F.octet_length(F.col("text").cast("binary")) >= LENGTH).select(
        _key(F.col("text")).alias("key"), "text"
    )
    per_text = _anchors(keyed).dropDuplicates(["key"])
    places = per_text.select("key", F.explode(F.arrays_zip("grams", "places")).alias("a")).select(
        "key", F.col("a.grams").alias("gram"), F.col("a.places").alias("place")
    )
    places = scratch.save(places, "places")
    # written, so that the join below has no aggregate in its stage and Spark can split a hot gram
    counted = places.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    grams = scratch.save(counted.select("gram", (F.col("n") > HOT).alias("hot")), "grams")
    wanted = (
        places.join(grams, "gram")
        .groupBy("key")
        .agg(F.collect_list(F.struct("gram", "place", "hot")).alias("anchors"))
    )
    # copies meet in the map-side part of the aggregate; only one text of each crosses
    texts = scratch.save(keyed.dropDuplicates(["key"]).join(wanted, "key"), "texts")
    scratch.drop("places")

    contexts = _contexts(texts, with_bytes=True).repartition("gram").sortWithinPartitions("gram")
    shared = _shared(contexts)
    if not grams.filter("hot").isEmpty():
        shared = shared.union(_shared_of_hot(texts, scratch))
    shared = scratch.save(shared, "shared")
    spans = (
        _contexts(texts, with_bytes=False)
        .join(shared, ["gram", "context"])
        .select("key", (F.col("place") - F.col("before")).alias("start"), (F.col("place") + F.col("after")).alias("stop"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    )
    cut = scratch.save(_cut(texts.join(spans, "key")), "cut")
    copied = facts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.lit(True).alias("copied"))
    gone = F.col("copied") & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return (
        facts.join(cut, "key", "left")
        .join(copied, "key", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
            F.when(gone, F.sha2(F.lit("").cast("binary"), 256))
            .otherwise(F.coalesce("kept_sha256", "sha"))
            .alias("kept_sha256"),
        )
    )


def op7_suffix_array_dedup(spark, folder: str) -> DataFrame:
    found = repeated_bytes(load(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
