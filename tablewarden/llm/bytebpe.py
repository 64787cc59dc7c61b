"""Byte-level BPE encoding and decoding, with pre-tokenisation by transition-function scans.

Code points become classes by one array look-up, and classes with a look-ahead of two become
nine symbols. A symbol is a function from the state before it to the state after it (``step``).
These functions and what they compose to are a small set, so a composition is one look-up in its
table, and as it is associative, prefixes of many blocks are composed at once. The state before
a code point and its symbol say whether a token starts there; no regular expression runs. The
slices between starts are looked up in a bounded cache, which merges byte pairs by rank for those
it does not hold. The byte offset of every id is kept; decoding puts the bytes of an id there.

Texts are scanned in windows of ``WINDOW`` code points that carry the state, so the arrays beside
a text and its ids are bounded. Nothing is shuffled; a lost task is repeated alone.

A null text counts as empty; it has no ids and decodes to no bytes. Null ids decode to null.
Every row is encoded, repeated ones too. ``doc_id`` keeps its type and its nulls.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import load

WINDOW = 1 << 18  # code points scanned, or ids decoded, at a time
CUT = 1 << 16  # pieces looked up at a time
BLOCKS = 1 << 11  # of a window, composed side by side; pieces merged side by side
CACHED_PIECES, CACHED_BYTES, CACHED_IDS = 160_000, 64, 1 << 22  # kept pieces, their length, and all their ids

NO_RANK = 1 << 62

STATES = FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, GLUED, ONE_MORE, TWO_MORE = range(8)
# the first five are also the classes of code points
SYMBOLS = LETTER, NUMBER, OTHER, BLANK, END, GLUE, LONE, SHORT, LONG = range(9)
SEPARATOR = "\ud800"  # a lone surrogate, which no text holds, ends each text of a group

# The white space of Unicode, and the letters and numbers that Unicode 16 added to
# the version 15.1 of ``unicodedata``.
WHITE_SPACE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A)]
WHITE_SPACE += [(0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65)]
NEW_LETTERS += [(0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E)]
NEW_LETTERS += [(0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0)]
NEW_LETTERS += [(0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED)]
NEW_LETTERS += [(0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79)]
NEW_NUMBERS += [(0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]  # after an apostrophe that starts a token


def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER), (WHITE_SPACE, BLANK)):
        for low, high in ranges:
            found[low : high + 1] = kind
    found[ord(SEPARATOR)] = END
    return found


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a token starts with it."""
    if symbol == END:
        return FRESH, True  # an empty token, which marks the end of a text
    if state in (ONE_MORE, TWO_MORE):  # inside a contraction, whose length its apostrophe knows
        return (FRESH if state == ONE_MORE else ONE_MORE), False
    if symbol == GLUE:  # the last blank of a run, which belongs to what follows
        return GLUED, True
    if symbol == LONE:  # the same of another kind, which stands alone
        return FRESH, True
    if symbol == BLANK:
        return IN_BLANKS, state != IN_BLANKS
    if symbol in (SHORT, LONG) and state not in (IN_OTHERS, GLUED):
        return (ONE_MORE if symbol == SHORT else TWO_MORE), True
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    return run, state not in (run, GLUED)


class Scanner:
    """Token starts by composition of transition functions."""

    def __init__(self):
        self.classes = classes()
        moves = [tuple(step(s, x)[0] for s in STATES) for x in SYMBOLS]
        # all functions that the symbols compose to: the first ones are the symbols
        functions = list(dict.fromkeys(moves))
        place = {f: i for i, f in enumerate(functions)}
        for f in functions:
            for g in moves:
                both = tuple(g[s] for s in f)
                if both not in place:
                    place[both] = len(functions)
                    functions.append(both)
        self.of_symbol = np.array([place[f] for f in moves], np.intp)
        self.after = np.array(functions, np.uint8)  # [function, state before]
        self.composed = np.array([[place[tuple(g[s] for s in f)] for g in functions] for f in functions], np.intp)
        self.starts = np.array([[step(s, x)[1] for x in SYMBOLS] for s in STATES])

    def symbols(self, points: np.ndarray, ahead: np.ndarray) -> np.ndarray:
        """Symbols of ``points``; ``ahead`` are up to two code points that follow them."""
        n = len(points)
        wide = np.full(n + 2, ord(SEPARATOR), np.uint32)
        wide[:n], wide[n : n + len(ahead)] = points, ahead
        found = self.classes[wide]
        ends_run = (found[:n] == BLANK) & (found[1 : n + 1] < BLANK)
        out = found[:n].copy()
        out[ends_run] = np.where(points[ends_run] == ord(" "), GLUE, LONE)
        quotes = np.flatnonzero(points == ord("'"))
        first, second = wide[quotes + 1], wide[quotes + 2]
        for letters in CONTRACTIONS:
            hit = first == ord(letters[0])
            if len(letters) == 2:
                hit &= second == ord(letters[1])
            out[quotes[hit]] = SHORT if len(letters) == 1 else LONG
        return out

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """The composition of every prefix: blocks side by side, then over the blocks' wholes."""
        n = len(functions)
        height = -(-n // BLOCKS)
        if height == 1:  # a handful: one after the other
            for i in range(1, n):
                functions[i] = self.composed[functions[i - 1], functions[i]]
            return functions
        blocks = -(-n // height)
        padded = np.full(blocks * height, functions[-1], np.intp)
        padded[:n] = functions
        grid = np.ascontiguousarray(padded.reshape(blocks, height).T)
        for row in range(1, height):
            grid[row] = self.composed[grid[row - 1], grid[row]]
        wholes = grid[-1].copy()
        for i in range(1, blocks):
            wholes[i] = self.composed[wholes[i - 1], wholes[i]]
        grid[:, 1:] = self.composed[wholes[:-1], grid[:, 1:]]
        return grid.T.reshape(-1)[:n]

    def cut(self, text: str) -> np.ndarray:
        """Byte offsets at which tokens start, with one more at each separator and at the end."""
        state, base, found = FRESH, 0, []
        for at in range(0, len(text), WINDOW):
            points = np.frombuffer(text[at : at + WINDOW + 2].encode("utf-32-le", "surrogatepass"), "<u4")
            points, ahead = points[:WINDOW], points[WINDOW:]
            symbols = self.symbols(points, ahead)
            states = self.after[self.prefixes(self.of_symbol[symbols]), state]
            before = np.concatenate((np.array([state], np.uint8), states[:-1]))
            width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            width[points == ord(SEPARATOR)] = 0
            ends = base + np.cumsum(width)
            starts = self.starts[before, symbols]
            found.append((ends - width)[starts])
            state, base = int(states[-1]), int(ends[-1])
        return np.concatenate([*found, np.array([base])]) if found else np.zeros(1, np.int64)


class Pieces:
    """Ids of pieces; merges the pairs of those that the cache does not hold, many at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._forget()
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.span = max(ranks.values()) + 1
        # every pair of tokens that joins to a token, in order of key
        joins = {
            ranks[token[:i]] * self.span + ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.keys = np.sort(np.fromiter(joins, np.int64, len(joins)))
        self.joined = np.array([joins[k] for k in self.keys.tolist()], np.int64)

    def _forget(self) -> None:
        """Start the cache anew; slot 0 is the empty piece."""
        self.slots, self.flat = {b"": 0}, np.empty(0, np.int32)
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of up to ``CUT`` pieces, one after the other, and how many each has."""
        slots = np.fromiter(map(self.slots.get, pieces, repeat(-1)), np.int64, len(pieces))
        if slots.min(initial=0) < 0:
            new = list({pieces[i] for i in np.flatnonzero(slots < 0)})
            if len(self.slots) + len(new) > CACHED_PIECES or len(self.flat) > CACHED_IDS:
                self._forget()
                new = list(set(pieces) - {b""})
            self._add(new)
            slots = np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))
            for piece in new:
                if len(piece) > CACHED_BYTES:
                    del self.slots[piece]
        sizes = self.sizes[slots]
        shift = self.starts[slots] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes

    def _add(self, pieces: list[bytes]) -> None:
        whole = [p for p in pieces if p in self.ranks]
        rest = sorted((p for p in pieces if p not in self.ranks), key=len)  # merged with others of their length
        ids, sizes = [np.array([self.ranks[p] for p in whole], np.int32)], [np.ones(len(whole), np.int64)]
        short = sum(len(p) <= CACHED_BYTES for p in rest)
        for at in range(0, short, BLOCKS):
            merged, counts = self.merged(rest[at : min(at + BLOCKS, short)])
            ids.append(merged)
            sizes.append(counts)
        for piece in rest[short:]:
            ids.append(self.merged_long(piece))
            sizes.append(np.array([len(ids[-1])]))
        added = np.concatenate(sizes)
        self.slots.update(zip(whole + rest, range(len(self.sizes), len(self.sizes) + len(added)), strict=True))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(added) - added))
        self.sizes = np.concatenate((self.sizes, added))
        self.flat = np.concatenate((self.flat, *ids))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of joined tokens, which is the id of the token they join to."""
        key = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.joined[at], NO_RANK)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Join the pair of least rank, leftmost first, until no pair has one: a step for all pieces."""
        width = max(map(len, pieces))
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        lengths = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[data], -1)
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(pieces)), np.full((len(pieces), width), -1, np.int32)
        while len(rows):
            least = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            live = ranks[np.arange(len(rows)), least] < NO_RANK if ranks.shape[1] else np.zeros(len(rows), bool)
            out[rows[~live], : ids.shape[1]] = ids[~live]
            rows, ids, ranks, least = rows[live], ids[live], ranks[live], least[live]
            every, i = np.arange(len(rows)), least[:, None]
            ids[every, least] = ranks[every, least]
            at = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, at + (at > i), 1)
            at = at[:-1]
            ranks = np.take_along_axis(ranks, at + (at >= i), 1)
            for side in (-1, 0):  # the pairs that the joined token is in
                pair = least + side
                has = (pair >= 0) & (pair < ranks.shape[1])
                r, c = every[has], pair[has]
                ranks[r, c] = self._rank(ids[r, c], ids[r, c + 1])
        return out[out >= 0], (out >= 0).sum(1)

    def merged_long(self, piece: bytes) -> np.ndarray:
        """The same for one piece in n log n steps, with the pairs in a heap."""
        rank, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i] if alive[i] else n
            if middle == n or after[middle] != end:
                continue  # one side was joined to something else
            alive[middle] = False
            after[i] = end
            if end < n:
                before[end] = i
                if (r := rank(piece[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            left = before[i]
            if left >= 0 and (r := rank(piece[left:end])) is not None:
                heapq.heappush(heap, (r, left, end))
        return np.array([self.ranks[piece[i : after[i]]] for i in range(n) if alive[i]], np.int32)


class Vocabulary:
    """Ranks of a file of base64 tokens and ranks, one pair a line."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        last = max(self.ranks.values())
        tokens = [b""] * (last + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.places = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes)[:-1]))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.sizes, self.scanner, self.pieces = vocabulary.sizes, Scanner(), Pieces(vocabulary.ranks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte offset of each in its text, and where each text's ids end."""
        cuts = self.scanner.cut(SEPARATOR.join(texts) + SEPARATOR)
        data = "".join(texts).encode()
        ids, counts = [], []
        for at in range(0, len(cuts) - 1, CUT):
            part = cuts[at : at + CUT + 1].tolist()
            found, sizes = self.pieces.of([data[a:b] for a, b in pairwise(part)])
            ids.append(found)
            counts.append(sizes)
        flat = np.concatenate(ids)
        # the empty pieces are those of the separators, one for each text
        empty = np.flatnonzero(np.diff(cuts) == 0)
        ends = np.cumsum(np.concatenate(counts))[empty]
        starts = np.cumsum(self.sizes[flat]) - self.sizes[flat]
        base = np.repeat(cuts[np.concatenate((np.zeros(1, np.int64), empty[:-1] + 1))], np.diff(ends, prepend=0))
        return flat, (starts - base).astype(np.int32), ends


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, about a window at a time."""
    group, size = [], 0
    for value in column:
        group.append(value.as_py() or "")
        size += len(group[-1]) + 1
        if size >= WINDOW:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids, offsets)``: the ids of each whole text, and the byte at which each begins."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(vocabulary))
        for batch in batches:
            at = 0
            for texts in _groups(batch.column(1)):
                ids, offsets, ends = encoder.encode(texts)
                bounds = pa.array(np.concatenate((np.zeros(1, np.int64), ends)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (ids, offsets)]
                keys = batch.column(0).slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([keys, *lists], names=["doc_id", "ids", "offsets"])
                at += len(texts)

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>")


def _decoded(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """The bytes of a text, those of each id at its offset from the first id's."""
    if not len(ids):
        return b""
    out = np.zeros(int(offsets[-1]) - int(offsets[0]) + int(vocabulary.sizes[ids[-1]]), np.uint8)
    for at in range(0, len(ids), WINDOW):
        part, place = ids[at : at + WINDOW], offsets[at : at + WINDOW].astype(np.int64) - int(offsets[0])
        sizes = vocabulary.sizes[part]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(place, sizes) + within] = vocabulary.bytes[np.repeat(vocabulary.places[part], sizes) + within]
    return out.tobytes()


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``decoded``, the bytes, in place of ``ids`` and ``offsets``; other columns stay.

    A slice of both arrays decodes to the bytes of that part of the text. Ids that the vocabulary
    lacks raise.
    """
    others = [f for f in encoded.schema.fields if f.name not in ("ids", "offsets")]
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(vocabulary)
        for batch in batches:
            ids, offsets = batch.column(0), batch.column(1)
            out = []
            for i in range(batch.num_rows):
                if not ids[i].is_valid or not offsets[i].is_valid:
                    out.append(None)
                    continue
                out.append(_decoded(known, *(np.asarray(c[i].values, np.int32) for c in (ids, offsets))))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(out, pa.binary())], names=[*names, "decoded"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "decoded binary"])
    return encoded.select("ids", "offsets", *(F.col(f"`{n}`") for n in names)).mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op12_byte_level_bpe(spark, folder: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    file = default_vocabulary()
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    encoded = encode(load(spark, folder, "documents"), file).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        "ids",
        "offsets",
    )
    return decode(encoded, file).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
