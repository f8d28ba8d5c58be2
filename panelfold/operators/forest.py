"""Regression forests on many rows: a node is split by all tasks together only while it is large.

Spark's own fit sends a histogram of every node and feature from every task, at every depth.  Here the rows are binned once,
and only nodes that one task cannot hold are split by histograms of all tasks.  The rows of every other node travel to one
task, which grows all that is below it.  Settings, candidates, stopping rules and stored nodes are those of Spark's forest;
random draws are its own, by seed, tree, block and node, so that a task that runs again draws the same.
"""

from __future__ import annotations

import gc
import math
import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.session import scratch_dir, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the tasks' code travels with them

BLOCK_ROWS = 1 << 15  # rows that are drawn and sent together
BLOCKS_A_TASK = 32
NODE_ROWS = 3 << 18  # drawn rows, repeated ones as often as they were drawn, of a node that one task grows
SENT_BYTES = 4 << 30  # of rows that travel at once, about: the trees are grown in turns of so many
COMMON_BYTES = 64 << 20  # of histograms that a task holds at once
POINTS = 4096  # values that stand for those of a column in a task
_ROWS, _NODES = 1 << 16, 1 << 10  # rows and nodes whose histograms are made at once
_ALONE, _LONG = 100, 1500  # rows from which a node is counted by itself, and from which a feature at a time
_NOISE = 1e-12  # what is lost in sums: no split gains so little a part of the impurity

_TREE = "tree int, sub int, id int, left int, right int, feature int, bin int, gain double, n double, s double, q double"


@dataclass(frozen=True)
class Settings:
    """What a task has to know of the forest."""

    seed: int
    depth: int
    bins: int
    tried: int  # features a node
    features: int
    least: float  # drawn rows on each side of a split
    gain: float
    draws: float | None  # mean draws of a row, with replacement
    share: float  # of rows drawn without

    @property
    def code(self) -> type:
        return np.uint8 if self.bins <= 1 << 8 else np.uint16 if self.bins <= 1 << 16 else np.uint32


def _tried(strategy: str, features: int, trees: int) -> int:
    """Features tried at a node, by Spark's names."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "onethird": math.ceil(features / 3), "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    try:
        return min(int(strategy), features)
    except ValueError:
        return math.ceil(float(strategy) * features)


# --- bins -------------------------------------------------------------------------------------------


def _fewer(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most about POINTS of ascending values; each stands for those after the one before, so its rank stays what it was."""
    if len(values) <= POINTS:
        return values, counts
    upto = np.cumsum(counts)
    at = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], POINTS + 1)[1:]).clip(max=len(values) - 1))
    return values[at], np.diff(upto[at], prepend=0)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return _fewer(values, np.bincount(place, np.concatenate([c for _, c in parts]), len(values)).astype(np.int64))


def _thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Between all values where they are few, otherwise next to equal shares of the rows: Spark's rule."""
    middle = values[:-1] / 2 + values[1:] / 2
    if len(middle) < bins:
        return middle
    stride, upto, out = counts.sum() / bins, np.cumsum(counts), []
    target = stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out[: bins - 1])


def _values(batch: pa.RecordBatch) -> np.ndarray:
    """The features of the rows, one row each."""
    column = batch.column(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _labels(batch: pa.RecordBatch) -> np.ndarray:
    y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
    if not np.isfinite(y).all():
        raise ValueError("a label is unknown or not finite")
    return y


def _edges(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Thresholds of each feature, from all rows."""

    def points(batches):
        kept = [[] for _ in range(features)]
        for batch in batches:
            for x, parts in zip(_values(batch).T, kept):
                parts.append(_fewer(*np.unique(x, return_counts=True)))
                if sum(len(v) for v, _ in parts) > 16 * POINTS:
                    parts[:] = [_merged(parts)]
        found = [_merged(parts) for parts in kept if parts]
        if found:
            columns = [pa.array(range(features), pa.int32()), *(pa.array([x.tobytes() for x in xs], pa.binary()) for xs in zip(*found))]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "v", "n"])

    def chosen(table: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(v, float), np.frombuffer(n, np.int64)) for v, n in zip(table["v"].to_pylist(), table["n"].to_pylist())]
        found = _thresholds(*_merged(parts), bins)
        return pa.table({"feature": table["feature"].slice(0, 1), "edges": pa.array([found.tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(points, "feature int, v binary, n binary").groupBy("feature")
    found = {r[0]: np.array(r[1], float) for r in parts.applyInArrow(chosen, "feature int, edges array<double>").collect()}  # one a feature
    return [found[i] for i in range(features)]


def _coded(rows: DataFrame, edges: list[np.ndarray], mean: float, s: Settings, parts: int) -> DataFrame:
    """(block, codes, y): the rows in blocks, each feature as the number of its bin, labels about their mean."""

    def packed(codes, y, number):
        columns = [pa.array([number], pa.int64()), pa.array([codes.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "codes", "y"])

    def block(batches):
        number, held, waiting = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                x, y = _values(some), _labels(some) - mean
                held.append((np.column_stack([np.searchsorted(e, c).astype(s.code) for e, c in zip(edges, x.T)]), y))
                waiting += len(y)
                if waiting >= BLOCK_ROWS:
                    yield packed(*map(np.concatenate, zip(*held)), number)
                    number, held, waiting = number + 1, [], 0
        if held:
            yield packed(*map(np.concatenate, zip(*held)), number)

    return stage(rows.mapInArrow(block, "block long, codes binary, y binary").repartition(parts), "forest-rows")


def _blocks(batches, s: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            block, codes, y = (batch.column(c)[i] for c in range(3))
            yield block.as_py(), np.frombuffer(codes.as_buffer(), s.code).reshape(-1, s.features), np.frombuffer(y.as_buffer())


# --- nodes ------------------------------------------------------------------------------------------


def _drawn(s: Settings, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in the tree's sample: Poisson numbers, of which none comes near 256, or none and one."""
    if s.draws is None and s.share >= 1.0:
        return np.ones(n, np.uint8)
    x = np.random.default_rng([s.seed & (1 << 64) - 1, 0, tree, block]).random(n)
    if s.draws is None:
        return (x < s.share).astype(np.uint8)
    out, k, p = np.zeros(n, np.uint8), 0, math.exp(-s.draws)
    upto = p
    while k < 64 and (more := x >= upto).any():
        out += more
        k += 1
        p *= s.draws / k
        upto += p
    return out


def _subsets(s: Settings, tree: int, root: int, level: int, nodes: int) -> np.ndarray:
    """The features tried at each node of a level below ``root``."""
    if s.tried >= s.features:
        return np.tile(np.arange(s.features), (nodes, 1))
    order = np.random.default_rng([s.seed & (1 << 64) - 1, 1, tree, root, level]).random((nodes, s.features))
    return np.sort(np.argpartition(order, s.tried, axis=1)[:, : s.tried], axis=1)


def _histograms(codes: np.ndarray, sizes: np.ndarray, w: np.ndarray, wy: np.ndarray, tried: np.ndarray, cuts: np.ndarray, bins: int) -> np.ndarray:
    """[drawn rows or their labels' sum, node, feature tried, bin] of rows in the order of their nodes, ``sizes`` rows each.

    Large nodes are counted by themselves, a feature at a time or all at once; small ones together, as a call has its price.
    """
    nodes, m = tried.shape
    out, ends, shift, alone = np.zeros((2, nodes, m, bins)), np.cumsum(sizes), np.arange(m) * bins, sizes >= _ALONE
    for i in np.flatnonzero(alone):
        own = slice(ends[i] - sizes[i], ends[i])
        x, sums = codes[own], ((out[0, i], w[own]), (out[1, i], wy[own]))
        if sizes[i] >= _LONG:
            for k, f in enumerate(tried[i]):
                two = cuts[f] == 1  # a product does
                cell = x[:, f].astype(float if two else np.intp)
                for of, v in sums:
                    if two:
                        of[k, 1] = cell @ v
                        of[k, 0] = v.sum() - of[k, 1]
                    else:
                        of[k] = np.bincount(cell, v, bins)
        else:
            cell = (x.take(tried[i], axis=1) + shift).reshape(-1)
            for of, v in sums:
                of[:] = np.bincount(cell, v.repeat(m), m * bins).reshape(m, bins)
    if alone.all():
        return out
    small = np.flatnonzero(~alone)
    if alone.any():
        rows = np.flatnonzero(np.repeat(~alone, sizes))
        codes, w, wy = codes.take(rows, axis=0), w.take(rows), wy.take(rows)
    node, flat, features = np.repeat(np.arange(len(small)), sizes[small]), codes.reshape(-1), codes.shape[1]
    for lo in range(0, len(node), _ROWS):
        at, hi = node[lo : lo + _ROWS], min(len(node), lo + _ROWS)
        a, b = at[0], at[-1] + 1
        own, first, row, some = at - a, (at - a) * bins, np.arange(lo * features, hi * features, features), tried[small[a:b]]
        for k in range(m):
            cell = first + flat.take(row + some[:, k].take(own))
            for of, x in zip(out, (w, wy)):
                of[small[a:b], k] += np.bincount(cell, x[lo:hi], (b - a) * bins).reshape(b - a, bins)
    return out


def _best(hist: np.ndarray, n: np.ndarray, t: np.ndarray, q: np.ndarray, tried: np.ndarray, cuts: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """(feature, bin, gain, drawn rows on the left) of each node's best split; the feature is -1 where none is allowed or gains."""
    left, sums = hist[0].cumsum(axis=-1)[..., :-1], hist[1].cumsum(axis=-1)[..., :-1]
    right, rest = n[:, None, None] - left, t[:, None, None] - sums
    allowed = (left >= s.least) & (right >= s.least) & (np.arange(s.bins - 1) < cuts[tried][..., None])
    with np.errstate(divide="ignore", invalid="ignore"):
        squares = np.where(allowed, sums * sums / left + rest * rest / right, -np.inf).reshape(len(n), -1)
    at = squares.argmax(axis=1)
    every = np.arange(len(n))
    gain = (squares[every, at] - t * t / n) / n
    slot, cut = np.divmod(at, s.bins - 1)
    impurity = q / n - (t / n) ** 2
    good = (gain > _NOISE * impurity) & (gain >= s.gain) & (impurity > _NOISE * q / n)
    return np.where(good, tried[every, slot], -1), np.where(good, cut, -1), np.where(good, gain, -1.0), left.reshape(len(n), -1)[every, at]


def _below(codes: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, root: int, level: int, cuts: np.ndarray, s: Settings) -> dict[str, np.ndarray]:
    """The nodes that the rows of one node make, level by level, the node itself first."""
    levels, made = [], 0
    node, nodes, cells = np.zeros(len(y), np.int64), 1, np.array([0])
    while nodes:
        wy, sizes = w * y, np.bincount(node, minlength=nodes)
        ends = np.cumsum(sizes)
        n, t, q = (np.add.reduceat(x, ends - sizes) for x in (w, wy, wy * y))
        feature, cut, gain = np.full(nodes, -1), np.full(nodes, -1), np.full(nodes, -1.0)
        if level < s.depth:
            tried = _subsets(s, tree, root, level, nodes)
            for a in range(0, nodes, _NODES):
                b = min(nodes, a + _NODES)
                lo, hi = ends[a] - sizes[a], ends[b - 1]
                hist = _histograms(codes[lo:hi], sizes[a:b], w[lo:hi], wy[lo:hi], tried[a:b], cuts, s.bins)
                feature[a:b], cut[a:b], gain[a:b], _ = _best(hist, n[a:b], t[a:b], q[a:b], tried[a:b], cuts, s)
        split = feature >= 0
        child = 2 * (np.cumsum(split) - 1)  # the place of a node's left child in the next level
        first = made + nodes
        left, right = np.where(split, first + child, -1), np.where(split, first + child + 1, -1)
        levels.append((left, right, feature, cut, gain, n, t, q))
        made, nodes, level = first, 2 * int(split.sum()), level + 1
        if nodes:
            kept = np.flatnonzero(split[node])
            of = node[kept]
            side = codes.reshape(-1).take(kept * s.features + feature[of]) > cut[of]
            node = child[of] + side
            order = _ordered(node)
            kept, node = kept[order], node[order]
            codes, y, w = codes.take(kept, axis=0), y.take(kept), w.take(kept)
    names = ("left", "right", "feature", "bin", "gain", "n", "s", "q")
    return {"id": np.arange(made), **{c: np.concatenate(x) for c, x in zip(names, zip(*levels))}}


class _Top:
    """The upper nodes of one tree.  A node is open until all tasks have counted it, sent where one task grows it, or done."""

    OPEN, SENT, DONE = range(3)

    def __init__(self) -> None:
        self.rows = {c: [] for c in ("left", "right", "feature", "bin", "gain", "n", "s", "q", "level", "state")}
        self.add(0, self.OPEN)

    def add(self, level: int, state: int) -> int:
        for c, v in zip(self.rows, (-1, -1, -1, -1, -1.0, 0.0, 0.0, 0.0, level, state)):
            self.rows[c].append(v)
        return len(self.rows["left"]) - 1

    def of(self, state: int) -> list[int]:
        return [i for i, x in enumerate(self.rows["state"]) if x == state]

    def count(self, node: int, n: float, s: float, q: float, feature: int, cut: int, gain: float, on_left: float) -> None:
        r = self.rows
        level = r["level"][node] + 1
        r["n"][node], r["s"][node], r["q"][node], r["state"][node] = n, s, q, self.DONE
        if feature >= 0:
            r["feature"][node], r["bin"][node], r["gain"][node] = feature, cut, gain
            r["left"][node], r["right"][node] = (self.add(level, self.SENT if x <= NODE_ROWS else self.OPEN) for x in (on_left, n - on_left))

    def paths(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(self.rows[c]) for c in ("feature", "bin", "left", "right"))


def _routed(codes: np.ndarray, paths: tuple[np.ndarray, ...]) -> np.ndarray:
    """The upper node each row ends in."""
    feature, cut, left, right = paths
    ends, flat = left < 0, codes.reshape(-1)
    every = np.arange(len(left))
    nexts = np.column_stack([np.where(ends, every, left), np.where(ends, every, right)]).reshape(-1)  # an end leads to itself
    tested, node, row = np.where(ends, 0, feature), np.zeros(len(codes), np.int64), np.arange(0, codes.size, codes.shape[1])
    while True:
        to = nexts.take(2 * node + (flat.take(row + tested.take(node)) > cut.take(node)))
        if np.array_equal(to, node):
            return node
        node = to


def _ordered(node: np.ndarray) -> np.ndarray:
    """The stable order by small numbers, by digits where they are short."""
    return np.argsort(node.astype(np.uint16) if node.max(initial=0) < 1 << 16 else node, kind="stable")


def _together(blocks) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Some blocks as one: their numbers and rows, codes and labels."""
    held, waiting = [], 0
    for block, codes, y in blocks:
        held.append(((block, len(y)), codes, y))
        waiting += len(y)
        if waiting >= 8 * BLOCK_ROWS:
            yield [h[0] for h in held], *(np.concatenate([h[i] for h in held]) for i in (1, 2))
            held, waiting = [], 0
    if held:
        yield [h[0] for h in held], *(np.concatenate([h[i] for h in held]) for i in (1, 2))


def _count_open(blocks: DataFrame, tops: dict[int, _Top], cuts: np.ndarray, s: Settings) -> None:
    """Split the open nodes of the trees by histograms of all tasks."""
    asked = {t: (top.paths(), np.array(top.of(top.OPEN))) for t, top in tops.items()}
    level = {t: np.array(top.rows["level"])[asked[t][1]] for t, top in tops.items()}
    tried = {t: _subsets(s, t, -1 & 0xFFFFFFFF, len(tops[t].rows["left"]), len(asked[t][1])) for t in tops}

    def count(batches):
        held = {t: [np.zeros((2, *tried[t].shape, s.bins)), np.zeros((3, len(asked[t][1])))] for t in asked}
        part = -1
        for numbers, codes, y in _together(_blocks(batches, s)):
            part = max(part, numbers[-1][0])
            for t, (paths, nodes) in asked.items():
                w = np.concatenate([_drawn(s, t, block, n) for block, n in numbers])
                kept = np.flatnonzero(w)
                some = codes.take(kept, axis=0)
                place = np.full(len(paths[0]), len(nodes))
                place[nodes] = np.arange(len(nodes))
                node = place[_routed(some, paths)]
                sizes = np.bincount(node, minlength=len(nodes) + 1)[:-1]
                if len(nodes) > 1 or sizes.sum() < len(node):
                    order = _ordered(node)[: sizes.sum()]  # rows of other nodes come last
                    kept, node, some = kept[order], node[order], some.take(order, axis=0)
                if len(kept):
                    wk, yk = w[kept].astype(float), y[kept]
                    wyk = wk * yk
                    held[t][0] += _histograms(some, sizes, wk, wyk, tried[t], cuts, s.bins)
                    held[t][1] += [np.bincount(node, x, len(nodes)) for x in (wk, wyk, wyk * yk)]
        if part >= 0:
            for t, (hist, sums) in held.items():
                columns = [pa.array([t], pa.int32()), pa.array([part], pa.int64()), pa.array([hist.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "part", "hist", "sums"])

    def split(table: pa.Table) -> pa.Table:
        t, table = table["tree"][0].as_py(), table.sort_by("part")  # sums in one order
        hist, sums = (reduce(np.add, (np.frombuffer(x.as_buffer()) for x in table[c])) for c in ("hist", "sums"))
        n, total, q = sums.reshape(3, -1)
        feature, cut, gain, on_left = _best(hist.reshape(2, *tried[t].shape, s.bins), n, total, q, tried[t], cuts, s)
        feature = np.where(level[t] < s.depth, feature, -1)
        found = {"node": asked[t][1], "n": n, "s": total, "q": q, "feature": feature, "bin": cut, "gain": gain, "on_left": on_left}
        return pa.table({"tree": pa.array([t] * len(n), pa.int32()), **{c: pa.array(x) for c, x in found.items()}})

    schema = "tree int, node long, n double, s double, q double, feature long, bin long, gain double, on_left double"
    parts = blocks.mapInArrow(count, "tree int, part long, hist binary, sums binary").groupBy("tree")
    for r in sorted(parts.applyInArrow(split, schema).collect()):  # one row an open node
        tops[r.tree].count(r.node, r.n, r.s, r.q, r.feature, r.bin, r.gain, r.on_left)


def _grow_sent(blocks: DataFrame, tops: dict[int, _Top], cuts: np.ndarray, s: Settings) -> DataFrame:
    """Nodes below the sent ones of the trees, whose rows travel to one task each."""
    asked = {t: (top.paths(), np.array(top.of(top.SENT)), np.array(top.rows["level"])) for t, top in tops.items()}
    width = s.features * np.dtype(s.code).itemsize

    def send(batches):
        for block, codes, y in _blocks(batches, s):
            for t, (paths, nodes, _) in asked.items():
                w = _drawn(s, t, block, len(y))
                kept = np.flatnonzero(w)
                node = _routed(codes.take(kept, axis=0), paths)
                order = _ordered(node)
                kept, node = kept[order], node[order]
                ends = np.searchsorted(node, nodes, "right")
                some = [(v, kept[a:b]) for v, a, b in zip(nodes, np.searchsorted(node, nodes), ends) if b > a]
                if some:
                    rows = [b"".join((y[k].tobytes(), codes[k].tobytes(), w[k].tobytes())) for _, k in some]
                    columns = [pa.array([t] * len(some), pa.int32()), pa.array([int(v) for v, _ in some], pa.int32()), pa.array([block] * len(some), pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.binary())], names=["tree", "sub", "block", "rows"])

    def grow(table: pa.Table) -> pa.Table:
        t, sub, table = table["tree"][0].as_py(), table["sub"][0].as_py(), table.sort_by("block")
        sizes = [len(x.as_buffer()) // (9 + width) for x in table["rows"]]
        total = sum(sizes)
        w, y, codes, at = np.empty(total), np.empty(total), np.empty((total, s.features), s.code), 0
        for n, x in zip(sizes, table["rows"]):
            buffer, to = x.as_buffer(), at + n
            y[at:to], w[at:to] = np.frombuffer(buffer, float, n), np.frombuffer(buffer, np.uint8, offset=(8 + width) * n)
            codes[at:to], at = np.frombuffer(buffer, s.code, n * s.features, 8 * n).reshape(n, -1), to
        del table
        made = _below(codes, y, w, t, sub, int(asked[t][2][sub]), cuts, s)
        kinds = [f.split()[1] for f in _TREE.split(", ")][2:]
        columns = {c: pa.array(x, pa.int32() if k == "int" else pa.float64()) for (c, x), k in zip(made.items(), kinds)}
        return pa.table({"tree": pa.array([t] * len(made["id"]), pa.int32()), "sub": pa.array([sub] * len(made["id"]), pa.int32()), **columns})

    tasks = max(1, min(2048, sum(len(nodes) for _, nodes, _ in asked.values())))
    sent = blocks.mapInArrow(send, "tree int, sub int, block long, rows binary").repartition(tasks, "tree", "sub")
    return sent.groupBy("tree", "sub").applyInArrow(grow, _TREE)


# --- the forest -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Grown:
    """A forest as staged tables: ``upper`` nodes of each tree and those ``below`` its sent ones, by (tree, sub, id)."""

    forest: RandomForestRegressor
    upper: DataFrame
    below: DataFrame
    edges: list[np.ndarray]
    mean: float

    def shares(self) -> list[float]:
        """Importance of each feature as Spark's models have it: the trees' gains by drawn rows, each tree's and all at last summing to 1."""
        inner = self.upper.select("tree", "feature", "gain", "n").unionByName(self.below.select("tree", "feature", "gain", "n")).where("feature >= 0")
        gains = inner.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
        trees = gains.groupBy("tree").agg(F.collect_list(F.struct("feature", "g")).alias("all"), F.sum("g").alias("total"))  # features of one tree
        each = trees.select(F.explode("all").alias("x"), "total").groupBy("x.feature").agg(F.sum(F.col("x.g") / F.col("total")).alias("g"))
        found = dict(each.collect())  # one row a feature
        total = sum(found[k] for k in sorted(found)) or 1.0
        return [found.get(i, 0.0) / total for i in range(len(self.edges))]

    def nodes(self) -> DataFrame:
        """Every node under Spark's numbers: upper ones first, then those below each sent node, which takes the first one's place."""
        sizes = self.upper.groupBy("tree").agg(F.count_if(~F.col("sent")).alias("upper")).join(
            self.below.groupBy("tree", "sub").agg(F.count(F.lit(1)).alias("size")), "tree", "left"
        )
        # one row a sent node: a tree has as many as its sample fills
        listed = sizes.groupBy("tree", "upper").agg(F.sort_array(F.collect_list(F.when(F.col("sub").isNotNull(), F.struct("sub", "size")))).alias("subs"))
        before = "aggregate(slice(subs, 1, i), CAST(upper AS BIGINT), (a, x) -> a + x.size)"
        starts = listed.select("tree", F.expr(f"explode(transform(subs, (x, i) -> struct(x.sub AS sub, {before} AS start)))").alias("x")).select("tree", "x.*")
        below = self.below.join(F.broadcast(starts), ["tree", "sub"])
        to = lambda c: F.when(F.col(c) >= 0, F.col(c) + F.col("start")).otherwise(-1)
        below = below.select("tree", to("id").alias("id"), to("left").alias("left"), to("right").alias("right"), "feature", "bin", "gain", "n", "s", "q")
        kept = self.upper.where(~F.col("sent")).select("tree", F.col("id").alias("old"), "left", "right", "feature", "bin", "gain", "n", "s", "q")
        order = self.upper.where(~F.col("sent")).groupBy("tree").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        named = order.select("tree", F.posexplode("ids").alias("new", "old")).select("tree", "old", F.col("new").cast("long").alias("new"))
        named = named.unionByName(starts.select("tree", F.col("sub").alias("old"), F.col("start").alias("new")))
        at = lambda c: F.broadcast(named.select("tree", F.col("old").alias(c), F.col("new").alias(f"{c}_at")))
        for c in ("old", "left", "right"):
            kept = kept.join(at(c), ["tree", c], "left")
        place = lambda c: F.coalesce(f"{c}_at", F.lit(-1)).alias(c)
        kept = kept.select("tree", F.col("old_at").alias("id"), place("left"), place("right"), "feature", "bin", "gain", "n", "s", "q")
        return kept.unionByName(below)

    def model(self) -> RandomForestRegressionModel:
        """The forest as Spark's model: its nodes are written in the place of those of a model with the same settings."""
        spark, width = self.upper.sparkSession, len(self.edges)
        names = (self.forest.getLabelCol(), self.forest.getFeaturesCol())
        two = spark.createDataFrame([(float(i), Vectors.dense([float(i)] * width)) for i in range(2)], list(names))
        path = os.path.join(scratch_dir(spark), f"forest-{uuid.uuid4().hex}")
        self.forest.fit(two).write().save(path)
        schema = spark.read.parquet(f"{path}/data").schema
        cuts = spark.createDataFrame([(i, j, float(x)) for i, e in enumerate(self.edges) for j, x in enumerate(e)], "feature int, bin int, cut double")
        nodes, c = self.nodes().join(F.broadcast(cuts), ["feature", "bin"], "left"), F.lit(self.mean)
        n, s, q = F.col("n"), F.col("s"), F.col("q")
        cells = {
            "id": F.col("id"), "prediction": c + s / n, "impurity": F.greatest(q / n - (s / n) * (s / n), F.lit(0.0)),
            "impurityStats": F.array(n, s + c * n, q + F.lit(2.0) * c * s + c * c * n), "rawCount": n, "gain": F.col("gain"),
            "leftChild": F.col("left"), "rightChild": F.col("right"),
            "split": F.struct(
                F.col("feature").alias("featureIndex"),
                F.when(F.col("cut").isNotNull(), F.array("cut")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                F.lit(-1).alias("numCategories"),
            ),
        }
        kind = schema["nodeData"].dataType
        data = F.struct(*[cells[f.name].cast(f.dataType).alias(f.name) for f in kind.fields])
        nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).select(*schema.names).write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestRegressionModel.load(path)


def grow(forest: RandomForestRegressor, rows: DataFrame) -> Grown:
    """``forest`` grown on all ``rows``.

    A tree's draws, features tried and splits are those of Spark's forest, its bins are of all rows and not of a sample.
    """
    spark, trees = rows.sparkSession, forest.getNumTrees()
    table = rows.select(vector_to_array(forest.getFeaturesCol()).alias("x"), F.col(forest.getLabelCol()).cast("double").alias("y"))
    n, mean = table.agg(F.count(F.lit(1)), F.avg("y")).first()
    width = table.select(F.size("x")).first()[0]
    rate = forest.getSubsamplingRate()
    s = Settings(
        forest.getSeed(), forest.getMaxDepth(), min(forest.getMaxBins(), n), _tried(forest.getFeatureSubsetStrategy(), width, trees), width,
        max(forest.getMinInstancesPerNode(), forest.getMinWeightFractionPerNode() * n), forest.getMinInfoGain(),
        rate if forest.getBootstrap() else None, rate,
    )
    edges = _edges(table, width, s.bins)
    cuts = np.array([len(e) for e in edges])
    parts = max(1, -(-n // (BLOCK_ROWS * BLOCKS_A_TASK)), min(2 * spark.sparkContext.defaultParallelism, -(-n // BLOCK_ROWS)))
    blocks = _coded(table, edges, mean, s, parts)
    tops = {t: _Top() for t in range(trees)}
    if n * rate <= NODE_ROWS:
        for top in tops.values():
            top.rows["state"][0] = top.SENT
    while some := {t: len(top.of(top.OPEN)) for t, top in tops.items() if top.of(top.OPEN)}:
        room, turn = COMMON_BYTES // (16 * s.tried * s.bins), {}
        for t, nodes in some.items():
            if turn and room < nodes:
                break
            turn[t], room = tops[t], room - nodes
        _count_open(blocks, turn, cuts, s)
    together = max(1, SENT_BYTES // (n * (9 + width * np.dtype(s.code).itemsize)))
    below = []
    for first in range(0, trees, together):
        below.append(stage(_grow_sent(blocks, {t: tops[t] for t in range(first, min(trees, first + together))}, cuts, s), "forest-nodes"))
        gc.collect()  # plans that only cycles of Python objects refer to, so that their shuffles are dropped
        spark.sparkContext._jvm.System.gc()
    upper = [(t, i, *map(float, r[5:8]), *map(int, r[:4]), float(r[4]), r[9] == _Top.SENT) for t, top in tops.items() for i, r in enumerate(zip(*top.rows.values()))]
    schema = "tree int, id int, n double, s double, q double, left int, right int, feature int, bin int, gain double, sent boolean"
    return Grown(forest, stage(spark.createDataFrame(upper, schema), "forest-upper"), reduce(DataFrame.unionByName, below), edges, mean)
