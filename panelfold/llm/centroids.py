"""Centroid clustering: Lloyd's rounds on integers, with ns-bounds.

Each vector keeps, for every centroid, its distance when that was last evaluated and the round of it.  The
history of all centroids is kept too, so a bound is that distance, loosened by the norm of the centroid's total
displacement since then (never more than the sum of its drifts round by round).  A vector whose
centroid's upper bound lies under the lower bounds of all others stays without any evaluation; otherwise its own
distance is evaluated, and then those of the centroids whose bounds still fail.  Evaluated distances are
exact integers and ties go to the smaller number, so the result is that of comparing everything.

A round is one pass without a shuffle: it writes the vectors with their bounds to the shared folder and, in
one further row a task, what the vectors that moved change in the sums of their old and new clusters.  Only these
rows are read to get the new centroids, and the round before is deleted then.  What the driver holds is the history:
rounds x clusters x components.

Defined results: vectors of another length, or NULL, or with a NULL or non-finite component are not in the
result; with fewer vectors than clusters each starts one; a repeated id is as many vectors, which start
clusters in the order of their components, and those without an id start one last; components of any size are exact, and a distance or inertia beyond
64 bits is NULL; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.llm.common import discard, stage

CLUSTERS = 8
ROUNDS = 10
_NARROW = 1 << 27  # up to here squared distances of some hundred components fit 64 bits
_LIMB = 40  # bits of a part of a sum
_SLACK = 1e-9  # of a bound, for rounding


def _floor_scaled(value: float, scale: int) -> int:
    return int(value) * scale if abs(value) >= 1 << 52 else math.floor(value * scale)


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) exactly; ``scale`` is a power of two."""
    if not x.size or np.abs(x).max() * scale <= _NARROW:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[_floor_scaled(v, scale) for v in row] for row in x.tolist()], object)


def _array(values: list) -> np.ndarray:
    """Integers as 64-bit ones where squared distances to them fit."""
    widest = max((abs(v) for row in values for v in row), default=0)
    return np.array(values, np.int64 if widest <= _NARROW else object)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    step = x - c
    return (step * step).sum(axis=1)


def _root(squared: np.ndarray) -> np.ndarray:
    if squared.dtype != object:
        return np.sqrt(squared.astype(np.float64))
    return np.array([math.sqrt(v) if v < 1 << 1000 else math.inf for v in squared.tolist()], np.float64)


class Bounds:
    """The centroids of the rounds so far, and how far each has moved since any of them."""

    def __init__(self, history: list[list[list[int]]]):
        self.now = _array(history[-1])
        self.round = len(history) - 1
        past = [_array(h) for h in history]
        # moved[t, j]: norm of centroid j's displacement since round t
        self.moved = np.array([_root(_squared(h, self.now)) for h in past]) if len(self.now) else np.zeros((1, 0))

    def assign(self, x: np.ndarray, own: np.ndarray, known: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, int]:
        """The nearest centroids, and how many distances it took; ``known`` and ``seen`` are brought up to date.

        ``known[i, j]`` is vector i's distance from centroid j in round ``seen[i, j]``; -1: never evaluated.
        """
        n, k = known.shape
        each = np.arange(n)
        moved = np.where(seen >= 0, self.moved[seen, np.arange(k)], math.inf)
        with np.errstate(invalid="ignore"):
            low = known - moved - _SLACK * (known + moved)
            high = (known + moved) * (1 + _SLACK)
            fails = ~(low > high[each, own][:, None])  # also where a bound is no number
        fails[each, own] = False
        open_ = np.nonzero(fails.any(axis=1) | (seen[each, own] < 0))[0]
        if not len(open_):
            return own, 0
        here = np.arange(len(open_))
        squared = np.empty((len(open_), k), object if x.dtype == object or self.now.dtype == object else np.int64)
        asked = np.zeros((len(open_), k), bool)
        asked[here, own[open_]] = True
        tight = np.zeros(len(open_))
        for j in range(k):
            at = np.nonzero(own[open_] == j)[0]
            squared[at, j] = _squared(x[open_[at]], self.now[j])
            tight[at] = _root(squared[at, j])
        with np.errstate(invalid="ignore"):
            asked |= fails[open_] & ~(low[open_] > (tight * (1 + _SLACK))[:, None])
        for j in range(k):
            at = np.nonzero(asked[:, j] & (own[open_] != j))[0]
            squared[at, j] = _squared(x[open_[at]], self.now[j])
        best, least = own[open_].copy(), squared[here, own[open_]]
        for j in range(k):
            at = np.nonzero(asked[:, j])[0]
            better = at[(squared[at, j] < least[at]) | ((squared[at, j] == least[at]) & (j < best[at]))]
            best[better], least[better] = j, squared[better, j]
        for j in range(k):
            at = np.nonzero(asked[:, j])[0]
            known[open_[at], j] = _root(squared[at, j])
            seen[open_[at], j] = self.round
        out = own.copy()
        out[open_] = best
        return out, int(asked.sum())


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def _lists(values: np.ndarray) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(values.ravel()))


def _limbs(cell: int, value: int):
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield {"cell": cell, "limb": limb, "value": sign * (value & ((1 << _LIMB) - 1))}
        value, limb = value >> _LIMB, limb + 1


_CHANGES = "array<struct<cell:int,limb:int,value:long>>"
_CHANGE_TYPE = pa.list_(pa.struct([("cell", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())]))


def _round(rows: DataFrame, history: list, length: int, scale: int) -> DataFrame:
    """``rows`` assigned to the last centroids; a task's last row holds what changes in the clusters' sums and counts."""
    shipped = rows.sparkSession.sparkContext.broadcast(history)
    k = len(history[-1])
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, vector {kinds['vector']}, cluster int, known array<double>, seen array<int>, evaluated long, changes {_CHANGES}"
    first = "cluster" not in rows.columns

    def run(batches):
        bounds = Bounds(shipped.value)
        sums = np.zeros((k, length + 1), object)  # the last component is the count
        kind, asked = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            kind = batch.schema
            x = _integers(_vectors(batch.column(1), length), scale)
            if first:
                own, known, seen = np.zeros(n, np.int64), np.zeros((n, k)), np.full((n, k), -1)
            else:
                own = batch.column(2).to_numpy().astype(np.int64)
                known, seen = (batch.column(c).flatten().to_numpy().reshape(n, k).copy() for c in (3, 4))
            new, evaluated = bounds.assign(x, own, known, seen)
            asked += evaluated
            for j in range(k):
                for sign, at in ((1, (new == j) & (first | (own != j))), (-1, (own == j) & (new != j) & (not first))):
                    if at.any():
                        sums[j, :-1] += sign * x[at].sum(axis=0).astype(object)
                        sums[j, -1] += sign * int(at.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(new.astype(np.int32)), _lists(known), _lists(seen.astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, _CHANGE_TYPE)],
                names=["id", "vector", "cluster", "known", "seen", "evaluated", "changes"],
            )
        if kind is not None:
            changes = [c for at in np.argwhere(sums != 0).tolist() for c in _limbs(at[0] * (length + 1) + at[1], int(sums[tuple(at)]))]
            types = [kind.field(0).type, kind.field(1).type, pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, t) for t in types], pa.array([asked], pa.int64()), pa.array([changes], _CHANGE_TYPE)],
                names=["id", "vector", "cluster", "known", "seen", "evaluated", "changes"],
            )

    return rows.mapInArrow(run, schema)


def _moved(centroids: list[list[int]], sums: list[list[int]]) -> list[list[int]]:
    """Floor of each cluster's mean; a cluster without vectors stays."""
    return [[v // row[-1] for v in row[:-1]] if row[-1] else old for row, old in zip(sums, centroids)]


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, length: int = 64, scale: int = 1024, seed: int = 3):
    """(assigned rows, centroids, distances evaluated in each round).

    The rows have ``id``, ``vector`` and ``cluster``.  First centroids are the vectors with the smallest hash of seed and key.
    """
    kind = dict(df.dtypes)[vector]
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast(kind if kind in ("array<float>", "array<double>") else "array<double>").alias("vector"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where((F.size("vector") == length) & F.coalesce(fine, F.lit(False)))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = rows.orderBy(mark.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    if not starts:
        return rows.withColumn("cluster", F.lit(0)), [], []
    history = [[[_floor_scaled(v, scale) for v in r.vector] for r in starts]]
    sums = [[0] * (length + 1) for _ in starts]
    state, evaluated = rows, []
    for t in range(rounds + 1):
        before, state = state, stage(_round(state, history, length, scale), "clusters")
        if t:
            discard(before)
        evaluated.append(state.agg(F.sum("evaluated")).first()[0] or 0)
        if t == rounds:
            break
        for cell, limb, value in state.where("changes IS NOT NULL").select(F.inline("changes")).groupBy("cell", "limb").agg(F.sum("value")).collect():
            sums[cell // (length + 1)][cell % (length + 1)] += value << (_LIMB * limb)
        history.append(_moved(history[-1], sums))
        state = state.where("vector IS NOT NULL").select("id", "vector", "cluster", "known", "seen")
    return state.where("vector IS NOT NULL").select("id", "vector", "cluster"), history[-1], evaluated


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", length: int = 64, scale: int = 1024, **how: int) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that ``fit`` keeps."""
    rows, centroids, _ = fit(df, key, vector, length=length, scale=scale, **how)
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast(centroids)

    def run(batches):
        now = _array(shipped.value)
        for batch in batches:
            if batch.num_rows:
                x, own = _integers(_vectors(batch.column(1), length), scale), batch.column(2).to_numpy()
                squared = _squared(x, now[own]).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([d if d < 1 << 63 else None for d in squared], pa.int64())], names=["id", "cluster", "distance"])

    measured = rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, cluster int, distance long")
    measured = stage(measured, "distances")
    if centroids:
        discard(rows)
    total = lambda c: F.when(F.count(c) == F.count("*"), F.sum(F.col(c).cast("decimal(38,0)")))
    each = {r[0]: r[1] for r in measured.groupBy("cluster").agg(total("distance")).collect()}
    whole = sum(each.values()) if None not in each.values() else None
    fits = lambda v: None if v is None or v >= 1 << 63 else int(v)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = [(j, fits(each[j]), fits(whole), digests[j]) for j in sorted(each)]
    of = spark.createDataFrame(of, "of int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = measured.join(F.broadcast(of), F.col("cluster") == F.col("of"))  # one row a cluster
    return out.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
