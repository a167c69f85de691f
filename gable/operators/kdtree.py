"""A space partition for neighbour searches: cells of bounded rows, grown from samples round by round.

A node halves its sample at the median of the widest dimension. A round grows every cell that still has too many rows, each
from a sample of its own rows in a task of its own; the number of cells follows the number of rows, what a round brings to
the driver are the new nodes. A cell whose rows are all equal cannot be halved and stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sampled rows that a cell is grown from, and the fewest of them that are halved.
SAMPLE_ROWS, LEAST_SAMPLE = 16_384, 16


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.empty((0, 0))


def flat(column: pa.Array) -> np.ndarray:
    """The rows of a column of equally long arrays."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def grown(x: np.ndarray, rows: float, cell_rows: int) -> list[tuple[int, float, int, int]]:
    """Nodes (dimension or -1, cut, left, right) of a tree over a sample that stands for ``rows`` rows; node 0 is the root."""
    nodes: list[tuple[int, float, int, int]] = [(-1, 0.0, -1, -1)]
    waiting, each = [(0, np.arange(len(x)))], rows / max(1, len(x))
    while waiting:
        node, mine = waiting.pop()
        if len(mine) < LEAST_SAMPLE or len(mine) * each <= cell_rows / 2:
            continue
        width = np.ptp(x[mine], axis=0)
        d = int(width.argmax())
        if not width[d] > 0:
            continue
        values = x[mine, d]
        cut = float(np.median(values))
        if not (values < cut).any():
            cut = float(values[values > cut].min())
        low = values < cut
        nodes[node] = (d, cut, len(nodes), len(nodes) + 1)
        waiting += [(len(nodes), mine[low]), (len(nodes) + 1, mine[~low])]
        nodes += [(-1, 0.0, -1, -1)] * 2
    return nodes


@dataclass
class Tree:
    """Inner nodes send rows below ``cut`` in ``dim`` to the left; cells have dim -1 and are named by their node."""

    dim: np.ndarray = field(default_factory=lambda: np.array([-1]))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1))
    left: np.ndarray = field(default_factory=lambda: np.array([-1]))
    right: np.ndarray = field(default_factory=lambda: np.array([-1]))

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        node = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(self.dim[node] >= 0)
        while len(inner):
            at = node[inner]
            node[inner] = np.where(x[inner, self.dim[at]] < self.cut[at], self.left[at], self.right[at])
            inner = inner[self.dim[node[inner]] >= 0]
        return node

    def within(self, x: np.ndarray, limit: np.ndarray, top: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, region) for every region, named by its ``top`` node, that may hold points no farther than a row's limit; without
        tops, for every such cell."""
        top = self.dim < 0 if top is None else top
        rows, cells = [], []
        bound = limit * limit
        waiting = [(0, np.arange(len(x)), np.zeros((len(x), x.shape[1])))]
        while waiting:
            node, row, off = waiting.pop()
            if top[node]:
                rows.append(row)
                cells.append(np.full(len(row), node))
                continue
            d = self.dim[node]
            gap = x[row, d] - self.cut[node]
            for child, beyond in ((self.left[node], gap >= 0), (self.right[node], gap < 0)):
                there = off.copy()
                there[beyond, d] = np.maximum(there[beyond, d], np.abs(gap[beyond]))
                near = (there * there).sum(axis=1) <= bound[row]
                if near.any():
                    waiting.append((child, row[near], there[near]))
        return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def totals(self, counts: dict[int, int]) -> np.ndarray:
        """Rows below each node."""
        total = np.zeros(len(self.dim), np.int64)
        for cell, n in counts.items():
            total[cell] = n
        for node in np.flatnonzero(self.dim >= 0)[::-1].tolist():  # children have larger numbers
            total[node] = total[self.left[node]] + total[self.right[node]]
        return total

    def regions(self, counts: dict[int, int], most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each node the top of the largest subtree around it with at most ``most`` rows (else its own cell), and whether
        it is such a top."""
        total, region = self.totals(counts), np.full(len(self.dim), -1)
        for node in range(len(self.dim)):
            if region[node] < 0 and (self.dim[node] < 0 or total[node] <= most):
                region[node] = node
            if region[node] >= 0 and self.dim[node] >= 0:
                region[self.left[node]] = region[self.right[node]] = region[node]
        return region, region == np.arange(len(self.dim))

    def homes(self, counts: dict[int, int], least: int) -> dict[int, list[int]]:
        """For each cell, the cells of the smallest subtree around it that has at least ``least`` rows."""
        parent, total = np.full(len(self.dim), -1), self.totals(counts)
        inner = np.flatnonzero(self.dim >= 0)
        parent[self.left[inner]] = parent[self.right[inner]] = inner
        found: dict[int, list[int]] = {}
        for cell in np.flatnonzero(self.dim < 0).tolist():
            node = cell
            while total[node] < least and parent[node] >= 0:
                node = int(parent[node])
            below, out = [node], []
            while below:
                at = below.pop()
                if self.dim[at] < 0:
                    out.append(at)
                else:
                    below += [int(self.left[at]), int(self.right[at])]
            found[cell] = [c for c in out if counts.get(c)]
        return found

    def extend(self, cell: int, nodes: list[tuple[int, float, int, int]]) -> None:
        """Put a grown tree in the place of a cell."""
        shift = len(self.dim) - 1
        d, cut, left, right = (np.array(c) for c in zip(*nodes))
        left, right = (np.where(c > 0, c + shift, -1) for c in (left, right))
        self.dim[cell], self.cut[cell], self.left[cell], self.right[cell] = d[0], cut[0], left[0], right[0]
        self.dim, self.cut = np.append(self.dim, d[1:]), np.append(self.cut, cut[1:])
        self.left, self.right = np.append(self.left, left[1:]), np.append(self.right, right[1:])


def placed(rows: DataFrame, tree: Tree, region: np.ndarray | None = None) -> DataFrame:
    """rows (with ``vector``), their cell and the region of that."""
    region = np.arange(len(tree.dim)) if region is None else region

    def run(batches):
        for b in batches:
            cell = tree.place(matrix(b["vector"])) if len(b) else np.zeros(0, np.int64)
            yield b.assign(cell=cell, region=region[cell])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{kept}, cell long, region long")


def cell_counts(rows: DataFrame, tree: Tree) -> dict[int, int]:
    """Rows per cell: one row per cell reaches the driver."""
    return {r[0]: r[1] for r in placed(rows.select("vector"), tree).groupBy("cell").agg(F.count(F.lit(1))).collect()}


def _halving(size_of: np.ndarray, cell_rows: int):
    def split(of: pd.DataFrame) -> pd.DataFrame:
        cell = int(of["cell"].iloc[0])
        nodes = grown(matrix(of["vector"]), size_of[cell], cell_rows)
        return pd.DataFrame(nodes, columns=["dim", "cut", "lower", "upper"]).assign(cell=cell, nth=range(len(nodes)))

    return split


def grow(rows: DataFrame, cell_rows: int) -> tuple[Tree, dict[int, int]]:
    """The tree over rows (id, vector) and the rows of each cell."""
    tree, final = Tree(), set()
    counts = {0: rows.count()}
    while True:
        large = {c: n for c, n in counts.items() if n > cell_rows and c not in final}
        if not large:
            return tree, counts
        size_of = np.zeros(len(tree.dim))
        size_of[list(large)] = list(large.values())
        # By hash, so that every run takes the same rows; the share of a cell follows from its rows.
        drawn = F.pmod(F.xxhash64("id", F.lit(len(tree.dim))), F.lit(1 << 30)) / F.lit(1 << 30)

        def sample(batches, tree=tree, size_of=size_of):
            for b in batches:
                cell = tree.place(matrix(b["vector"])) if len(b) else np.zeros(0, np.int64)
                kept = (size_of[cell] > 0) & (b["drawn"].to_numpy() * size_of[cell] < SAMPLE_ROWS)
                yield pd.DataFrame({"cell": cell[kept], "vector": b["vector"].to_numpy()[kept]})

        some = rows.select("vector", drawn.alias("drawn")).mapInPandas(sample, "cell long, vector array<double>")
        new = some.groupBy("cell").applyInPandas(_halving(size_of, cell_rows), "dim long, cut double, lower long, upper long, cell long, nth long").toPandas()
        halved = set()
        for cell, nodes in new.sort_values(["cell", "nth"]).groupby("cell"):
            if len(nodes) > 1:
                halved.add(int(cell))
                tree.extend(int(cell), list(nodes[["dim", "cut", "lower", "upper"]].itertuples(index=False, name=None)))
        final |= set(large) - halved
        if halved:
            counts = cell_counts(rows, tree)
