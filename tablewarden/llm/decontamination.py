"""Benchmark decontamination by templates, which catches re-parameterised questions.

A text becomes a template: words in lower case without edge punctuation, where numbers,
names (words with a capital) and units after a number are typed placeholders; a run of equal
placeholders is one. A word with a capital that begins a sentence may be a name or not, so a
text has two readings: such words plain, and such words names. The second does not depend on
what stands before the text. Windows of ``WINDOW`` template words of both readings are hashed
and joined with those of the benchmark. Places are counted in words of the text; as values
may differ in length, windows on one diagonal of a document and an item count together, and
so do those on diagonals within ``DRIFT`` / 2 of each other. A document is contaminated by an
item if the share ``SHARE`` of the item's windows, or ``ENOUGH`` of them, occur there and the
slots are consistent: equal values of the benchmark became equal values in the document.

Only windows of the benchmark leave the scan: while the benchmark has at most ``SMALL``
windows, their sorted hashes travel with the job (32 MB); beyond that every window is joined.
Templates of ``SHORTEST`` to ``WINDOW`` - 1 words are one window of their own length. Windows
with fewer than ``LITERALS`` plain words match nothing; an item without any other matches
word for word as a whole. Items of fewer than ``SHORTEST`` words cannot be told from chance
and match nothing. Null and empty texts match nothing; repeated rows of a document or an item
count once. Texts that share a doc_id, or have none, are judged each by itself, by a digest of
the text, and have rows of their own; items without an id match nothing.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load, windows

WINDOW = 8
SHORTEST = 5
LITERALS = 4
ENOUGH = 6
SHARE = 0.5
DRIFT = 16
SMALL = 1 << 22

# fixed values: number words and units
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    " sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety"
    " hundred thousand million billion dozen".split()
)
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l gal s sec ms min h hr hrs mph kph km/h m/s hz khz"
    " mhz ghz w kw mw v kv a ma j kj cal kcal pa kpa bar n kn c f k percent % dollars dollar cents cent"
    " euros euro pounds pound inches inch feet foot yards yard miles mile meters meter metres metre"
    " kilometers kilometer grams gram kilograms kilogram liters liter litres litre seconds second"
    " minutes minute hours hour days day weeks week months month years year degrees degree".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%|[a-z]{1,3})?", re.I)
EDGE = "\"'`.,;:?!()[]{}<>«»„“”‘’…-–—_/\\&*#|~^=¿¡$%"
PLAIN, NUM, NAME, UNIT = 0, 1, 2, 3
TITLE, ENDS = 8, 16  # flags beside the kind
HASHES = np.array([0, 0x6E756D, 0x6E616D65, 0x756E6974], np.uint64)


class Words(dict):
    """Raw word to (index); its hash and flags lie in growing tables."""

    LIMIT = 100_000

    def __init__(self):
        self.hash, self.flags, self.bare = array("Q"), array("B"), []

    def __missing__(self, raw: str) -> int:
        if raw.isascii() and raw.isalpha() and raw.islower():  # neither edges nor capitals
            flags = NUM if raw in NUMBER_WORDS else UNIT if raw in UNITS else PLAIN
            return self.added(raw, raw, flags)
        bare = raw.strip(EDGE)
        low = bare.lower()
        if low in NUMBER_WORDS or not bare.isalpha() and NUMBER.fullmatch(bare):
            flags = NUM
        elif low in UNITS or raw.strip(".,;:?!()") == "%":
            flags, low = UNIT, low or "%"
        else:
            flags = PLAIN
        if bare[:1].isupper() and (len(bare) == 1 or bare[1:] == bare[1:].lower()):
            flags |= TITLE
        if raw.rstrip("\"'»”’)]*#&%$")[-1:] in (".", "!", "?", ":"):
            flags |= ENDS
        return self.added(raw, low, flags)

    def added(self, raw: str, low: str, flags: int) -> int:
        value = len(self.hash)
        self.hash.append(xxhash.xxh3_64_intdigest(low) | 1 if low else 0)
        self.flags.append(flags)
        self.bare.append(low)
        self[raw] = value
        return value

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()
            self.hash, self.flags, self.bare = array("Q"), array("B"), []

    def indexes(self, raw: list[str]) -> np.ndarray:
        """Indexes of the words of a text that are not punctuation alone."""
        ids = np.fromiter(map(self.__getitem__, raw), np.int64, len(raw))
        return ids[np.frombuffer(self.hash, np.uint64)[ids] != 0]

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.hash, np.uint64)[ids]

    def readings(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Hashes with placeholders, kinds and places of the words of each reading."""
        hashes, flags = self.hashes(ids), np.frombuffer(self.flags, np.uint8)[ids]
        plain, names = _kinds(flags)
        out = [_template(hashes, plain)]
        if (plain != names).any():
            out.append(_template(hashes, names))
        return out


def _kinds(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds with the words that begin sentences plain, and as names if they have a capital."""
    kinds = flags & 7
    starts = np.ones(len(flags), bool)
    starts[1:] = (flags[:-1] & ENDS) > 0
    after_number = np.zeros(len(flags), bool)
    after_number[1:] = kinds[:-1] == NUM
    kinds = np.where((kinds == UNIT) & ~after_number, PLAIN, kinds)
    capital = (kinds == PLAIN) & ((flags & TITLE) > 0)
    return tuple(np.where(c, NAME, kinds).astype(np.uint8) for c in (capital & ~starts, capital))


def _template(hashes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.ones(len(kinds), bool)
    first[1:] = (kinds[1:] == PLAIN) | (kinds[1:] != kinds[:-1])
    places = np.flatnonzero(first)
    kinds = kinds[places]
    return np.where(kinds == PLAIN, hashes[places], HASHES[kinds]), kinds, places


def _windows(hashes: np.ndarray, kinds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that have enough plain words, and their places."""
    if len(hashes) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    plain = np.concatenate([[0], np.cumsum(kinds == PLAIN)])
    good = np.flatnonzero(plain[size:] - plain[:-size] >= min(LITERALS, size - 1))
    return windows(hashes, size)[good], good


def template_windows(
    texts: DataFrame, key: str, sizes: list[int], whole: bool, wanted: np.ndarray | None = None
) -> DataFrame:
    """(key, version, size, h, pos, slots) of the windows of each size, or of texts of that size if
    ``whole``. Negative sizes: of that many words as they are; with ``whole``, texts that have
    no other window. ``wanted``: sorted hashes; other windows are left out. ``version``: a digest
    of the text."""

    # a bit of the hash says of most windows that no other has theirs
    bits = np.uint64((1 << 20) - 1)
    if wanted is not None:
        marked = np.zeros(1 << 20, bool)
        marked[(wanted & bits).astype(np.int64)] = True

    def hit(h: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if wanted is None or not len(h):
            return h, pos
        may = np.flatnonzero(marked[(h & bits).view(np.int64)])
        h, pos = h[may], pos[may]
        if not len(h):
            return h, pos
        at = np.searchsorted(wanted, h)
        at[at == len(wanted)] = 0
        same = wanted[at] == h
        return h[same], pos[same]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            rows, versions = [], []
            for name, text in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True):
                words.trim()
                ids, before = words.indexes(text.split() if text else []), len(rows)
                for hashes, kinds, places in words.readings(ids):
                    ends = np.append(places[1:], len(ids))
                    for size in sizes:
                        if size < 0 or (whole and size < WINDOW and len(hashes) != size):
                            continue
                        h, pos = hit(*_windows(hashes, kinds, size))
                        for value, p in zip(h.view(np.int64).tolist(), pos.tolist(), strict=True):
                            slots = [
                                " ".join(words.bare[i] for i in ids[places[p + k] : ends[p + k]])
                                for k in np.flatnonzero(kinds[p : p + size])
                            ]
                            rows.append((name, size, value, int(places[p]), slots))
                if whole:
                    exact = [-len(ids)] if len(rows) == before and len(ids) >= SHORTEST else []
                else:
                    exact = [size for size in sizes if size < 0]
                for size in exact:
                    h = windows(words.hashes(ids), -size)
                    h, pos = hit(h, np.arange(len(h)))
                    rows += [(name, size, v, p, []) for v, p in zip(h.view(np.int64).tolist(), pos.tolist(), strict=True)]
                if len(rows) > before:
                    version = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                    versions += [version] * (len(rows) - before)
            out = pd.DataFrame(rows, columns=["key", "size", "h", "pos", "slots"])
            out["version"] = pd.Series(versions, dtype=object)
            yield out

    schema = f"key {texts.schema[key].dataType.simpleString()}, version binary, size int, h long, pos long, slots array<string>"
    return texts.select(key, "text").mapInPandas(run, schema)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, n_item_windows, exact) of contaminated documents."""
    scratch = Scratch(docs.sparkSession)
    sizes = list(range(SHORTEST, WINDOW + 1))
    items = scratch.save(template_windows(benchmark, "item_id", sizes, whole=True).drop("version").distinct(), "items")
    totals = items.groupBy("key").agg(F.countDistinct("pos").alias("n_item_windows"))
    wanted = None
    short = [r["size"] for r in items.select("size").distinct().collect()]  # and the lengths of items
    if items.count() <= SMALL:
        wanted = np.sort(np.array([r.h for r in items.select("h").distinct().collect()], np.int64).view(np.uint64))
        if not len(wanted):
            short, wanted = [], None
    found = template_windows(docs, "doc_id", sorted(short), whole=False, wanted=wanted)
    found = found.select(F.col("key").alias("doc_id"), "version", "size", "h", "pos", F.col("slots").alias("theirs")).distinct()
    hits = found.join(
        items.select(F.col("key").alias("item_id"), "size", "h", F.col("pos").alias("at"), F.col("slots").alias("ours")),
        ["size", "h"],
    )
    pairs = F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("ours", "theirs"))))
    diagonal = F.col("pos") - F.col("at")
    # bands of diagonals lie half over each other, so near diagonals share one of them
    bands = F.array(
        F.struct(F.lit(0).alias("kind"), diagonal.alias("at")),
        *(
            F.struct(F.lit(k).alias("kind"), F.floor((diagonal + shift) / DRIFT).cast("int").alias("at"))
            for k, shift in ((1, 0), (2, DRIFT // 2))
        ),
    )
    lines = (
        hits.withColumn("band", F.explode(bands))
        .groupBy("doc_id", "version", "item_id", "band")
        .agg(F.countDistinct("at").alias("n_windows"), pairs.alias("slots"))
        .withColumn("exact", F.forall("slots", lambda s: s["ours"] == s["theirs"]))
        .filter(F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["ours"]))))
    )
    best = lines.groupBy("doc_id", "version", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max_by("exact", F.struct("n_windows", "exact")).alias("exact")
    )
    return (
        best.join(totals.withColumnRenamed("key", "item_id"), "item_id")
        .filter(F.col("n_windows") >= F.least(F.col("n_item_windows") * SHARE, F.lit(ENOUGH)))
        .select("doc_id", "item_id", "n_windows", "n_item_windows", "exact")
    )


def op9_benchmark_decontamination(spark, folder: str) -> DataFrame:
    return contaminations(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
