"""Packing: vector bin packing of examples into training sequences.

An example is a vector (tokens, segments, loss-bearing tokens); a sequence has a capacity
in each. The dot-product heuristic fills one sequence at a time: of the pieces that fit, it
takes the one whose vector has the largest dot product with what is left (both in shares of
the capacity). When none fits, the piece with the largest dot product is cut to what is left
and its rest stays in the pool. Texts longer than a sequence fill whole sequences first.
Within a task, examples are packed in pools of ``POOL`` pieces, so memory is bounded,
nothing is shuffled and a lost task is repeated alone. What is left of the last pool of a
task and does not fill a sequence is cut into sequences of a power of two tokens, which need
no padding either. A prompt at the start of a text and stretches within it may bear no loss; a
token with a byte of such a stretch bears none. ``closed_by`` names the limit that closed a
piece's sequence, or ``end`` for the last ones of a task.

A null text counts as empty and has the end token only. Repeated rows are packed each.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import load

TOKENS = 2048
END = 1
POOL = 512
PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
REPORT = "loss long, closed_by string"


@dataclass(frozen=True)
class Limits:
    """Capacities of one sequence. 0 switches off a limit other than tokens."""

    tokens: int = TOKENS
    segments: int = 0
    loss: int = 0


class Encoder:
    """Token ids of texts under a byte-level BPE file of the ``tokenizers`` library.

    The BPE itself runs in ``tiktoken``, which gives the same ids several times faster, on the
    ranks read from that file. A text that holds a special token goes to ``tokenizers``, and so does
    one that the other library gives up on, such as a million blanks in a row.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # byte-level vocabularies write the bytes that do not print as characters from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        back = {chr(b): b for b in shown}
        back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {
            bytes(back[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in self.special
        }
        lengths = {rank: len(token) for token, rank in ranks.items()}
        lengths |= {t["id"]: len(t["content"].encode()) for t in spec["added_tokens"]}
        self.lengths = np.zeros(max(lengths) + 1, np.int64)  # bytes of each id
        self.lengths[list(lengths)] = list(lengths.values())
        self.fast = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.array([END], "<u4")
        found = None
        if not any(s in text for s in self.special):
            try:
                found = self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # its regular expressions have a bounded stack
                pass
        if found is None:
            found = self.plain.encode(text, add_special_tokens=False).ids
        return np.append(np.asarray(found, "<u4"), np.array([END], "<u4"))

    def bearing(self, ids: np.ndarray, stretches: np.ndarray | None) -> np.ndarray:
        """Which ids of a text bear loss: 1 or 0. ``stretches``: the bytes of text that bear loss
        and that bear none, in turn."""
        out = np.ones(len(ids), np.int8)
        if stretches is not None:
            lengths = self.lengths[ids[:-1]]
            ends, bounds = np.cumsum(lengths), np.cumsum(stretches)
            first = np.searchsorted(ends, bounds[::2], side="right")
            last = np.searchsorted(ends - lengths, bounds[1::2], side="left")
            for a, b in zip(first, last, strict=True):
                out[a:b] = 0
        return out


class Packer:
    """Packs pieces (key, ids, start, doc_tokens, loss) of one task."""

    def __init__(self, limits: Limits, first: int):
        self.limits, self.next = limits, first
        self.capacity = np.array([limits.tokens, limits.segments or 1, limits.loss or 1], float)
        self.used = np.array([True, limits.segments > 0, limits.loss > 0])
        self.pool: list[tuple] = []
        self.out: list[tuple] = []
        self.opened = 0  # where the open sequence begins in ``out``

    def _place(self, piece: tuple, take: int, offset: int) -> tuple | None:
        """Write ``take`` tokens of a piece to the open sequence; the rest of the piece."""
        key, ids, start, total, loss = piece
        part = ids[:take]
        self.out.append((key, start, take, zlib.crc32(part.tobytes()), total, self.next, offset, int(loss[:take].sum())))
        return (key, ids[take:], start + take, total, loss[take:]) if take < len(ids) else None

    def _close(self, free: np.ndarray) -> None:
        """End the open sequence, which has this left."""
        full = (free < 1) & self.used
        reason = ("tokens", "segments", "loss")[int(np.argmax(full))] if full.any() else "end"
        self.out[self.opened :] = [(*row, reason) for row in self.out[self.opened :]]
        self.opened = len(self.out)
        self.next += 1

    def _fitting(self, loss: np.ndarray, free: np.ndarray) -> int:
        """How many leading tokens fit into what is free."""
        most = min(len(loss), int(free[0]))
        if self.used[2] and loss[:most].sum() > free[2]:
            most = int(np.searchsorted(np.cumsum(loss[:most]), free[2], side="right"))
        return most

    def add(self, key: tuple, ids: np.ndarray, loss: np.ndarray) -> None:
        piece = (key, ids, 0, len(ids), loss)
        while piece is not None:
            take = self._fitting(piece[4], self.capacity)
            if take < self.limits.tokens and take == len(piece[1]):
                self.pool.append(piece)
                break
            free = self.capacity - (take, 1, piece[4][:take].sum())
            piece = self._place(piece, take, 0)
            self._close(free)
        if len(self.pool) >= POOL:
            self.pack(keep=POOL // 4)

    def pack(self, keep: int = 0) -> None:
        """Fill sequences from the pool until ``keep`` pieces are left."""
        vectors = np.array([(len(p[1]), 1, p[4].sum()) for p in self.pool], float).reshape(-1, 3)
        alive = np.ones(len(self.pool), bool)
        left = len(self.pool)
        while left > keep:
            total = vectors[alive].sum(0)
            if total[0] < self.limits.tokens:
                break
            free, offset = self.capacity.copy(), 0
            while left:
                sizes = vectors / self.capacity
                gain = (sizes * (free / self.capacity) * self.used).sum(1)
                fits = alive & (vectors[:, 0] <= free[0])
                for k in (1, 2):
                    if self.used[k]:
                        fits &= vectors[:, k] <= free[k]
                cut = not fits.any()
                if cut and (free[0] < 1 or (self.used[1] and free[1] < 1) or (self.used[2] and free[2] < 1)):
                    break
                best = int(np.argmax(np.where(alive if cut else fits, gain, -1.0)))
                piece = self.pool[best]
                take = self._fitting(piece[4], free) if cut else len(piece[1])
                if not take:
                    break
                rest = self._place(piece, take, offset)
                offset += take
                free -= (take, 1, piece[4][:take].sum())
                if rest is None:
                    alive[best] = False
                    left -= 1
                else:
                    self.pool[best] = rest
                    vectors[best] = (len(rest[1]), 1, rest[4].sum())
                if free[0] < 1:
                    break
            self._close(free)
        self.pool = [p for p, a in zip(self.pool, alive, strict=True) if a]

    def finish(self) -> None:
        """Pack what is left; the last tokens go to sequences of a power of two."""
        self.pack()
        most = min(self.limits.tokens, self.limits.loss or self.limits.tokens)
        while self.pool:
            # the longest pieces first, so that a limit of segments leaves no padding
            self.pool.sort(key=lambda p: len(p[1]))
            total = sum(len(p[1]) for p in self.pool[-self.limits.segments :])
            size, offset = 1 << (min(total, most).bit_length() - 1), 0
            while offset < size:
                piece = self.pool.pop()
                take = min(len(piece[1]), size - offset)
                rest = self._place(piece, take, offset)
                offset += take
                if rest is not None:
                    self.pool.append(rest)
            self._close(self.capacity)

    def taken(self) -> list[tuple]:
        out, self.out, self.opened = self.out, [], 0
        return out


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), loss: str | None = None, stretches: str | None = None
) -> DataFrame:
    """A row per piece of the whole texts of ``docs`` (doc_id, text).

    ``loss`` names a column with the number of leading tokens that bear no loss (a prompt),
    ``stretches`` one with the bytes of text that bear loss and that bear none, in turn, or
    null; without them every token bears loss.
    """
    columns = {"doc_id": "doc_id", "text": "text"} | ({"prompt": loss} if loss else {})
    columns |= {"stretches": stretches} if stretches else {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        names = ["doc_id", *(x.split()[0] for x in f"{PIECE}, {REPORT}".split(", "))]

        def frame() -> pd.DataFrame:
            out = pd.DataFrame([(k, *rest) for k, *rest in packer.taken()], columns=names)
            return out.astype({n: "int64" for n in names[1:-1]} | {"doc_id": "Int64", names[-1]: object})

        for batch in batches:
            prompts = batch["prompt"].fillna(0) if loss else [0] * len(batch)
            turns = batch["stretches"] if stretches else [None] * len(batch)
            for key, text, prompt, turn in zip(batch["doc_id"], batch["text"], prompts, turns, strict=True):
                ids = encoder.ids(text)
                bears = encoder.bearing(ids, turn)
                bears[: int(prompt)] = 0
                packer.add(None if pd.isna(key) else int(key), ids, bears)
            yield frame()
        packer.finish()
        yield frame()

    named = docs.select(*(F.col(f"`{c}`").alias(name) for name, c in columns.items()))
    return named.mapInPandas(run, f"doc_id long, {PIECE}, {REPORT}")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_packing(spark, folder: str) -> DataFrame:
    pieces = pack(load(spark, folder, "documents"), default_tokenizer(), Limits(TOKENS, 64, TOKENS))
    return pieces.drop("loss", "closed_by")
