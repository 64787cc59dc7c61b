"""Combining many expressions or frames without deep nesting."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TypeVar

X = TypeVar("X")


def balanced(combine: Callable[[X, X], X], items: Iterable[X]) -> X:
    """Combine neighbours pairwise: hundreds of items nest a few levels, not hundreds."""
    level = list(items)
    while len(level) > 1:
        pairs = [combine(a, b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[2 * len(pairs) :]
    return level[0]
