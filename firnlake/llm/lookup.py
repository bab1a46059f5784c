"""Vectorised lookup of 64-bit keys, in shards of a hash table that Python workers hold."""

from __future__ import annotations

import numpy as np


class Table:
    """Values by distinct uniformly mixed 64-bit keys: the keys' top bits give a shard of a few keys, which is searched."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], [v[order] for v in values]
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32 if len(keys) < 1 << 31 else np.int64)
        self.most = int(np.diff(self.starts).max(initial=0))

    def find(self, q: np.ndarray) -> np.ndarray:
        """Each query's place among the keys, -1 if it isn't one."""
        out = np.full(len(q), -1, dtype=np.int64)
        if not len(self.keys) or not len(q):
            return out
        shard = (q >> self.shift).astype(np.int64)
        at, end, open_ = self.starts[shard].astype(np.int64), self.starts[shard + 1], np.arange(len(q))
        for _ in range(self.most):
            live = at < end
            at, end, open_ = at[live], end[live], open_[live]
            if not len(at):
                break
            hit = self.keys[at] == q[open_]
            out[open_[hit]] = at[hit]
            at, end, open_ = at[~hit] + 1, end[~hit], open_[~hit]
        return out

    def get(self, q: np.ndarray, which: int = 0, default: float = 0.0) -> np.ndarray:
        at = self.find(q)
        if not len(self.keys):
            return np.full(len(q), default)
        return np.where(at >= 0, self.values[which][at], default)
