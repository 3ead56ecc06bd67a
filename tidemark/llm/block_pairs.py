"""Pairs of packed blocks without a copy of a block on disk for every pair.

Rows that have to be compared with each other are packed into blocks, a row each, and
written once.  Every two blocks of a group then meet in a nested loop over those files:
each task reads the blocks of two parts of the table and passes their pairs on to Python
in the same stage.  Nothing is shuffled, so disk grows with the rows and not with their
pairs, and a group of any size is spread over as many tasks as its blocks have parts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS_HELD = 48  # unpacked blocks that a worker keeps


def block_pairs(blocks: DataFrame, group: list[str], condition: Column | None = None) -> DataFrame:
    """Every two of ``blocks`` (staged; block long, unique in a group, payload) with equal ``group``, once, and each with itself.

    The columns of either come as a_... and b_..., and the condition may name them."""
    a, b = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    met = F.col("a_block") <= F.col("b_block")
    for c in group:
        met &= F.col(f"a_{c}") == F.col(f"b_{c}")
    return a.join(b.hint("shuffle_replicate_nl"), met if condition is None else met & condition)


class BlockCache:
    """The blocks that a task unpacked last."""

    def __init__(self, held: int = BLOCKS_HELD):
        self.held, self.blocks = held, {}

    def two(self, batch: pa.RecordBatch, row: int, unpack: Callable, names: tuple[str, ...] = ()) -> tuple:
        """The two blocks of a row; one that meets itself is the same object twice."""
        return tuple(self._one(batch, row, side, unpack, names) for side in "ab")

    def _one(self, batch: pa.RecordBatch, row: int, side: str, unpack: Callable, names: tuple[str, ...]):
        key = (batch[f"{side}_block"][row].as_py(), *(batch[f"{side}_{c}"][row].as_py() for c in names))
        if key in self.blocks:
            self.blocks[key] = self.blocks.pop(key)  # used last
        else:
            if len(self.blocks) >= self.held:
                self.blocks.pop(next(iter(self.blocks)))
            self.blocks[key] = unpack(batch[f"{side}_payload"][row].as_py())
        return self.blocks[key]


def spread_roots(near: np.ndarray, root: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least root that each row and each column of ``near`` can reach; every one of them is near another."""
    none = np.iinfo(np.int64).max
    while True:
        up = np.minimum(root, np.where(near, other[None], none).min(axis=1))
        down = np.minimum(other, np.where(near, up[:, None], none).min(axis=0))
        if (up == root).all() and (down == other).all():
            return root, other
        root, other = up, down


def least_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges a-b in order, and the least node that each can reach."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    at = at.reshape(-1)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, root[u], least)
        np.minimum.at(new, root[v], least)
        new = new[new]
        if (new == root).all():
            return names, names[root]
        root = new
