"""Substring dedup by content-defined chunking.

A gear rolling hash runs over the bytes of a text, which is cut where the hash is the least
within ``REACH`` bytes on either side. A cut depends on the ``REACH`` + 16 bytes before it and
the ``REACH`` after it and on no earlier cut, so the same content is cut alike wherever it
lies, up to that distance from its ends. Only where no hash is the least (repeated bytes) do
cuts follow each other at ``MOST`` bytes.

A chunk's 128-bit digest covers the chunk and the ``CONTEXT`` bytes on either side of it, fewer
at the ends of a text, and where the chunk lies in them. So small chunks find a repeat, and an
equal digest proves that the context is repeated as well, which is taken away with the chunk;
of equal digests the first one (by doc_id, then text, then place) stays. A span counts if
it has ``LEAST`` bytes, as every chunk with its whole context has, or is a whole text: phrases that
texts have in common are shorter and stay. Every byte taken away has an equal one at an
earlier place of the input.

Counting a digest's chunks is an aggregate, so a chunk with a third of all copies is combined
before the shuffle; chunks that occur once are dropped there. Null and empty texts have no
chunks. Texts that share a doc_id, or have none, are told apart by ``part``, 64 bits of the text's
digest, and have rows of their own; a repeated row is a copy of the row before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Scratch, load, mixed

REACH, MOST = 24, 192  # bytes; chunks have some 2 REACH + 1
CONTEXT = 32  # bytes
LEAST = 2 * CONTEXT + REACH + 1  # bytes of a span: the shortest chunk between two cuts and its context
GEAR = mixed(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)
STEP = 1 << 22  # bytes hashed at a time


def gear(data: bytes) -> np.ndarray:
    """hash[i] = (hash[i - 1] << 1) + GEAR[data[i]] modulo 2**32, for all i at once."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8, 16):
        if len(h) > shift:
            h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    return h


def least_places(keys: np.ndarray) -> np.ndarray:
    """Where a key is less than the REACH before it and not more than the REACH after it."""
    n, most = len(keys), np.iinfo(keys.dtype).max
    edge = np.full(REACH, most, keys.dtype)
    # runs[i] is the least of the ``width`` keys from i on
    runs, width = np.concatenate([edge, keys, edge]), 1
    while 2 * width <= REACH:
        runs, width = np.minimum(runs[:-width], runs[width:]), 2 * width
    rest = REACH - width
    runs = np.minimum(runs[: len(runs) - rest], runs[rest:])
    return np.flatnonzero((keys < runs[:n]) & (keys <= runs[REACH + 1 : REACH + 1 + n]))


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    places: list[np.ndarray] = []
    for k in range(0, len(data), STEP):
        low = max(0, k - REACH)
        part = gear(data[max(0, low - 31) : k + STEP + REACH])[min(low, 31) :]
        # the low half depends on the last 16 bytes
        found = least_places(part & np.uint32(0xFFFF)) + low
        places.append(found[(found >= k) & (found < k + STEP)] + 1)
    ends, last = [], 0
    for place in np.concatenate(places).tolist() if places else ():
        while place - last > MOST:
            last += MOST
            ends.append(last)
        ends.append(last := place)
    while len(data) - last > MOST:
        ends.append(last := last + MOST)
    if len(data) > last:
        ends.append(len(data))
    return ends


def keyed(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(start, stop, digest) of every chunk of a text; ``stop`` and the digest with the context."""
    last = 0
    for end in cuts(data):
        start, stop = max(0, last - CONTEXT), min(len(data), end + CONTEXT)
        # two chunks are equal only if they lie alike in equal bytes
        place = b"%d,%d;" % (last - start, stop - end)
        yield last, stop, hashlib.blake2b(place + data[start:stop], digest_size=16).digest()
        last = end


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, start, stop, ends, digest) of every chunk of the whole texts; ``stop``
    is where the context stops, ``ends`` whether that is the text's end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not text:
                    continue
                data = text.encode("utf-8", "surrogatepass")
                part = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)
                rows += [(doc_id, part, a, b, b == len(data), digest) for a, b, digest in keyed(data)]
            yield pd.DataFrame(rows, columns=["doc_id", "part", "start", "stop", "ends", "digest"])

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, part long, start int, stop int, ends boolean, digest binary"
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, part, start, stop, first_doc_ids): maximal runs of repeated chunks, in bytes.

    ``first_doc_ids``: where the kept copies are.
    """
    scratch = Scratch(docs.sparkSession)
    table = scratch.save(chunks(docs), "chunks")
    spot = ["doc_id", "part", "start"]
    # written, so that the join has no aggregate in its stage and Spark can split a hot digest
    kept = scratch.save(
        table.groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct(*spot)).alias("kept"))
        .filter("n > 1")
        .select("digest", "kept"),
        "kept",
    )
    repeated = table.join(kept, "digest")
    # a repeated row of the table is at the same place as its copy; number such rows
    again = (
        repeated.groupBy(*spot, "stop", "ends", "kept")
        .agg(F.count("*").alias("times"))
        .withColumn("first", F.struct(*spot).eqNullSafe(F.col("kept")))
        .filter("NOT first OR times > 1")
        .withColumn("start", F.greatest(F.col("start") - CONTEXT, F.lit(0)))
        .select(*spot, "stop", "ends", F.col("kept.doc_id").alias("source"))
    )
    # the chunks of one text lie in one group, whose size the text bounds
    parts = again.groupBy("doc_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "ends", "source"))).alias("chunks")
    )

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, part, found in zip(batch["doc_id"], batch["part"], batch["chunks"], strict=True):
                for start, stop, ends, sources in merged((c["start"], c["stop"], c["ends"], c["source"]) for c in found):
                    if stop - start >= LEAST or (start == 0 and ends):
                        rows.append((doc_id, part, start, stop, sorted(sources)))
            yield pd.DataFrame(rows, columns=["doc_id", "part", "start", "stop", "first_doc_ids"])

    return parts.mapInPandas(joined, "doc_id long, part long, start int, stop int, first_doc_ids array<long>")


def merged(found: Iterable[tuple[int, int, bool, int | None]]) -> list[tuple[int, int, bool, set[int]]]:
    """Spans that touch or overlap as one, of (start, stop, ends, source) in order."""
    spans: list[tuple[int, int, bool, set[int]]] = []
    for start, stop, ends, source in found:
        sources = set() if source is None else {source}
        if spans and start <= spans[-1][1]:
            first, last, ended, others = spans.pop()
            spans.append((first, max(last, stop), ended or ends, others | sources))
        else:
            spans.append((start, stop, ends, sources))
    return spans


def op3_substring_dedup(spark, folder: str) -> DataFrame:
    """A row per text that loses bytes; ``part``, in hex, tells texts of one doc_id apart."""
    spans = repeated_spans(load(spark, folder, "documents"))
    found = spans.groupBy("doc_id", "part").agg(
        F.sum(F.col("stop").cast("long") - F.col("start")).alias("n_removed"),
        F.count("*").alias("n_spans"),
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_doc_ids")))).alias("first_doc_ids"),
    )
    return found.withColumn("part", F.hex("part"))
