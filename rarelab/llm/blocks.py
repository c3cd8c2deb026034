"""Comparing the rows of a group block by block inside a task: the pieces that
the two near-duplicate operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from rarelab.llm.common import column, pieces

COLUMNS = 4096  # members counted at a time


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in sorted rows, over the edges of batches."""
    held: list[pa.Table] = []
    last = None
    for piece in pieces(batches):
        piece = piece.combine_chunks()
        cols = [column(piece, k).to_pylist() for k in keys]
        tags = list(zip(*cols, strict=True))
        cuts = [0, *(i for i in range(1, len(tags)) if tags[i] != tags[i - 1]), len(tags)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if tags[lo] != last and held:
                yield pa.concat_tables(held)
                held = []
            last = tags[lo]
            held.append(piece.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks that a group's task compares; equal for a block with itself."""
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    own = group["block"].to_numpy()
    return np.flatnonzero(own == lo), np.flatnonzero(own == hi), lo == hi


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of sets of integers, each sorted and distinct; members of one set
    alone are left out of the count."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times[code] > 1
    owner, code = owner[often], code[often]
    number = np.cumsum(times > 1) - 1
    code = number[code]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = int(code[-1]) + 1 if len(code) else 0
    for at in range(0, width, COLUMNS):
        a, b = np.searchsorted(code, [at, at + COLUMNS])
        has = np.zeros((len(sets), min(COLUMNS, width - at)), np.float32)
        has[owner[a:b], code[a:b] - at] = 1
        out += has @ has.T
    return out


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all links ``(i, j)`` connect, fewer than ``n``."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out
