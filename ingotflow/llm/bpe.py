"""What both BPE operators need: merge by rank, and whether two tokens may stand side by side."""

from __future__ import annotations

import math
from collections.abc import Mapping
from itertools import pairwise

def merge(symbols: list[str], rank: Mapping[str, int]) -> list[str]:
    """Merge the adjacent pair of lowest rank, leftmost first, until no pair is in the vocabulary."""
    ranks = [rank.get(a + b, math.inf) for a, b in pairwise(symbols)]
    while ranks and (best := min(ranks)) < math.inf:
        i = ranks.index(best)
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = rank.get(symbols[i - 1] + symbols[i], math.inf)
        if i < len(ranks):
            ranks[i] = rank.get(symbols[i] + symbols[i + 1], math.inf)
    return symbols


class Recent(dict):
    """A memo of bounded size: past ``limit`` entries, those not used since the last time are dropped.

    A subclass gives ``make(key)``.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit // 2:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Compatible(Recent):
    """Memo: may token ``b`` follow token ``a``, i.e. do the merges of ``a + b`` end in ``a, b``?

    A token sequence is what the merges give exactly if every adjacent pair may stand together.
    """

    def __init__(self, rank: Mapping[str, int], limit: int = 1 << 20):
        super().__init__(limit)
        self.rank = rank

    def make(self, pair: tuple[str, str]) -> bool:
        left, right = pair
        return merge(list(left + right), self.rank) == [left, right]
