"""Embedding near-duplicates by sorted projection passes.

Each pass gives every distinct vector a key of concatenated random hyperplane signs (about the vectors' mean, so that
a common direction does not make all signs alike), orders the vectors by it and compares each with the
``NEIGHBOURS`` before it.  Vectors travel as one byte a component with the norm of what that leaves out; a
pair is a link where the cosine less the largest possible error reaches the wanted one, and is verified on the vectors
themselves where only the cosine with that error does.  Links are united within their block, and the blocks' unions are
joined across passes by connected components.  A component may be denser than a neighbour window, so the links inside
components are then counted exactly, tile against tile, without emitting pairs: no partner is lost to the window's bound.

How many passes that takes depends on the rows and on how dense they lie, not on how many links there are, so it is
measured on planted ones: about ``PLANTS`` vectors get a copy that is turned in a random direction to just above the
wanted cosine, and rounds of passes go on, with wider windows, until a share of ``RECALL`` of the copies has been linked
to the component of its vector.  Copies link nothing else: they are in no component themselves.

Equal vectors are one vector with a count.  What can be missed is a link between vectors that no chain of
found pairs connects; the share is measured and not zero for certain.

Defined results: a vector that is NULL, zero, or holds a NULL or non-finite component links with nothing
and is its own component; vectors of different lengths never link; a repeated id is as many vectors; an
empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelfold.llm.common import settle, stage
from panelfold.llm.components import components

PASSES = 16  # of a round
BITS = 60  # signs of a key
NEIGHBOURS = 32
WIDEST = 256  # window from which on only the passes grow
PLANTS = 1024
RECALL = 0.98
_LENGTHS = 16  # of vectors that are taken about their mean: the most frequent ones
TILE = 256  # vectors
_SALTS = 16
_ROWS = 4096  # vectors compared at once


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _keys(x: np.ndarray, seed: int) -> np.ndarray:
    planes = np.random.default_rng(seed).standard_normal((x.shape[1], BITS))
    return ((x @ planes) > 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _bytes_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as signed bytes, the bytes' unit, and the norm of what they leave out."""
    unit = np.abs(x).max(axis=1) / 127
    small = np.rint(x / unit[:, None]).astype(np.int8)
    return small, unit, np.sqrt(((x - small * unit[:, None]) ** 2).sum(axis=1))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place linked to each of ``n`` places by pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Mean unit vector of each frequent length."""
    lengths = [r[0] for r in vectors.groupBy("length").count().orderBy(F.desc("count"), "length").limit(_LENGTHS).collect()]

    def run(batches):
        sums = {}
        for batch in batches:
            of = batch.column(0).to_numpy(zero_copy_only=False)
            for n in np.unique(of):
                x = _unit(_matrix(batch.column(1).filter(pa.array(of == n))))
                had = sums.get(int(n), (0, 0.0))
                sums[int(n)] = had[0] + len(x), had[1] + x.sum(axis=0)
        for n, (rows, total) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, n, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, rows)), pa.array(total)], names=["length", "at", "n", "s"])

    some = vectors.where(F.col("length").isin(lengths)).select("length", "vector")
    found = some.mapInArrow(run, "length int, at int, n long, s double").groupBy("length", "at").agg((F.sum("s") / F.sum("n")).alias("mean"))
    out = {n: np.zeros(n) for n in lengths}
    for n, at, mean in found.collect():  # one a component
        out[n][at] = mean
    return out


def _planted(vectors: DataFrame, cosine: float) -> DataFrame:
    """(first, length, vector, twin): turned copies of about ``PLANTS`` vectors, under numbers no vector has."""
    n, low, high = vectors.agg(F.count("*"), F.min("first"), F.max("first")).first()
    share = min(1.0, PLANTS / max(n, 1))
    chosen = vectors.where(F.pmod(F.xxhash64(F.lit(3), "first"), F.lit(1 << 32)) < F.lit(int(share * (1 << 32)) + 1))
    free = low - 1 if n and low > -(1 << 62) else (high or 0) + 1
    sign = -1 if n and low > -(1 << 62) else 1
    to = cosine + 0.1 * (1 - cosine)

    def turn(batches):
        for batch in batches:
            firsts, lengths = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for length in np.unique(lengths):
                mine = lengths == length
                twin, x = firsts[mine], _unit(_matrix(batch.column(2).filter(pa.array(mine))))
                away = np.array([np.random.default_rng([int(t) & (2**63 - 1), int(length)]).standard_normal(int(length)) for t in twin])
                away -= np.einsum("ij,ij->i", away, x)[:, None] * x
                norm = np.sqrt((away * away).sum(axis=1))
                fine = norm > 1e-6
                made = to * x[fine] + np.sqrt(1 - to * to) * away[fine] / norm[fine][:, None]
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * int(length)), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(made), length, np.int32)), rows, pa.array(twin[fine])], names=["length", "vector", "twin"])

    rows = stage(chosen.select("first", "length", "vector").mapInArrow(turn, "length int, vector array<double>, twin long"), "planted")
    place = F.row_number().over(Window.orderBy("twin"))  # a bounded number of rows
    return rows.select((F.lit(free) + F.lit(sign) * place).cast("long").alias("first"), "length", "vector", "twin")


_LINK, _MAYBE, _MET = 0, 1, 2


def near_classes(vectors: DataFrame, cosine: float, means: dict[int, np.ndarray], passes: int = PASSES, neighbours: int = NEIGHBOURS, seed: int = 1) -> DataFrame:
    """(a, b, kind): members of blocks and the block's first vector they are linked to, pairs to verify, and copies with whom they met.

    ``vectors`` has (first, length, vector, twin) with distinct valid vectors; ``twin`` is the vector of a planted copy.
    """

    def keyed(batches):
        for batch in batches:
            lengths = batch.column(1).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                x = _unit(_matrix(part.column(2)))
                small, unit, lost = _bytes_of(x)
                x = x - means[int(length)] if int(length) in means else x
                packed = pa.array([row.tobytes() for row in small], pa.binary())
                for p in range(passes):
                    columns = [part.column(0), part.column(1), part.column(3), packed, pa.array(unit.astype(np.float32)), pa.array(lost.astype(np.float32))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(x), p, np.int32)), pa.array(_keys(x, seed * 1000 + p))], names=names)

    def compared(batches):
        before = None  # the last rows of the block before, with their pass and length
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                lengths, turns = (part.column(k).to_numpy(zero_copy_only=False) for k in (1, 6))
                cuts = np.nonzero((lengths[1:] != lengths[:-1]) | (turns[1:] != turns[:-1]))[0] + 1
                for low, high in zip([0, *cuts], [*cuts, len(turns)]):
                    some = part.slice(int(low), int(high - low))
                    ids, unit, lost = (some.column(k).to_numpy(zero_copy_only=False) for k in (0, 4, 5))
                    plant = some.column(2).is_valid().to_numpy(zero_copy_only=False)
                    x = np.frombuffer(b"".join(some.column(3).to_pylist()), np.int8).reshape(len(ids), -1) * unit[:, None]
                    block = [ids, plant, x, lost]
                    group = (int(turns[low]), int(lengths[low]))
                    if before is not None and before[0] == group:
                        block = [np.concatenate(pair) for pair in zip(before[1], block)]
                    yield from blocked(*block)
                    before = group, [c[-neighbours:] for c in block]

    def blocked(ids, plant, x, lost):
        """What one block of neighbours has; the float32 products err by less than 1e-5."""
        sure, maybe, met = [], [], []
        for step in range(1, min(neighbours, len(ids) - 1) + 1):
            a, b = slice(step, None), slice(None, -step)
            near = np.einsum("ij,ij->i", x[a], x[b])
            error = lost[a] + lost[b] + lost[a] * lost[b] + 1e-5
            hit = np.nonzero((plant[a] != plant[b]) & (near >= cosine))[0][:, None] + [0, step]
            met.append(np.where(plant[hit[:, :1]], hit, hit[:, ::-1]))
            real = ~(plant[a] | plant[b])
            linked = real & (near - error >= cosine)
            sure.append(np.nonzero(linked)[0][:, None] + [0, step])
            maybe.append(np.nonzero(real & ~linked & (near + error >= cosine))[0][:, None] + [0, step])
        if not met:
            return
        sure, maybe, met = np.concatenate(sure), np.concatenate(maybe), np.concatenate(met)
        root = _roots(len(ids), sure[:, 0], sure[:, 1])
        moved = np.nonzero(root != np.arange(len(ids)))[0]
        maybe = maybe[root[maybe[:, 0]] != root[maybe[:, 1]]]
        met = np.unique(np.column_stack([met[:, 0], root[met[:, 1]]]), axis=0)
        a, b = np.concatenate([ids[moved], ids[maybe[:, 0]], ids[met[:, 0]]]), np.concatenate([ids[root[moved]], ids[maybe[:, 1]], ids[met[:, 1]]])
        kind = np.repeat(np.array([_LINK, _MAYBE, _MET], np.int32), [len(moved), len(maybe), len(met)])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(kind)], names=["a", "b", "kind"])

    names = ["first", "length", "twin", "small", "unit", "lost", "pass", "key"]
    turns = vectors.select("first", "length", "vector", "twin").mapInArrow(
        keyed, "first long, length int, twin long, small binary, unit float, lost float, pass int, key long"
    )
    ordered = turns.repartitionByRange("pass", "length", "key", "first").sortWithinPartitions("pass", "length", "key", "first")
    return ordered.mapInArrow(compared, "a long, b long, kind int")


def _verified(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) whose vectors reach the cosine."""
    one, other = (vectors.select(F.col("first").alias(f"of_{c}"), F.col("vector").alias(f"vector_{c}")) for c in "ab")
    both = pairs.join(one, F.col("a") == F.col("of_a")).join(other, F.col("b") == F.col("of_b")).select("a", "b", "vector_a", "vector_b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                size = pc.list_value_length(batch.column(2)).to_numpy()
                keep = np.zeros(batch.num_rows, bool)
                for n in np.unique(size):
                    mine = pa.array(size == n)
                    x, y = (_unit(_matrix(batch.column(k).filter(mine))) for k in (2, 3))
                    keep[size == n] = np.einsum("ij,ij->i", x, y) >= cosine
                yield batch.filter(pa.array(keep)).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def near_components(vectors: DataFrame, cosine: float, passes: int = PASSES, neighbours: int = NEIGHBOURS, seed: int = 1) -> DataFrame:
    """(node, component) by rounds of passes, until the planted copies are met."""
    means = _means(vectors)
    planted = stage(_planted(vectors, cosine), "plants")
    n_planted = planted.count()
    both = vectors.withColumn("twin", F.lit(None).cast("long")).select("first", "length", "vector", "twin").unionAll(planted)
    known, met, turn = [], [], 0
    while True:
        found = settle(near_classes(both, cosine, means, passes, neighbours, seed + turn).distinct(), "passes")
        of = lambda kind: found.where(F.col("kind") == kind).select("a", "b")
        maybe = of(_MAYBE).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = [of(_LINK), stage(_verified(maybe, vectors, cosine), "verified"), *known]
        out = stage(components(reduce(DataFrame.unionAll, pairs)), "components")
        met.append(of(_MET))
        if _met(reduce(DataFrame.unionAll, met), planted, out) >= RECALL * n_planted:
            return out
        known = [out.select(F.col("node").alias("a"), F.col("component").alias("b"))]
        turn, neighbours = turn + 1, max(neighbours, min(2 * neighbours, WIDEST))


def _met(pairs: DataFrame, planted: DataFrame, found: DataFrame) -> int:
    """How many copies are linked to a vector of their own vector's component."""
    of = lambda c: found.select(F.col("node").alias(f"n_{c}"), F.col("component").alias(f"c_{c}"))
    both = pairs.join(F.broadcast(planted.select("first", "twin")), F.col("a") == F.col("first"))  # a bounded number of rows
    both = both.join(of("b"), F.col("b") == F.col("n_b"), "left").join(of("t"), F.col("twin") == F.col("n_t"), "left")
    return both.where(F.coalesce("c_b", "b") == F.coalesce("c_t", "twin")).agg(F.countDistinct("a")).first()[0]


def count_links(members: DataFrame, cosine: float, tile: int = TILE) -> DataFrame:
    """(first, links): for each member, how many other vectors of its component reach the cosine.

    ``members`` has (component, first, n, length, vector).  Components are cut into tiles by a hash of the
    member, and tiles meet pairwise; a hot component's pairs are spread by a salt.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    place = F.pmod(F.xxhash64("first"), F.ceil(F.col("size") / F.lit(tile))).cast("int")
    # Dealt by tile before the tiles are gathered: the join alone would leave a hot component in one task.
    placed = members.join(sizes, "component").withColumn("tile", place).repartition("component", "tile")
    tiles = placed.groupBy("component", "tile")
    tiles = stage(tiles.agg(F.collect_list(F.struct("first", "n", "length", "vector")).alias("rows")), "tiles")
    left = tiles.select("component", "tile", F.col("rows").alias("a"), (F.col("tile") % _SALTS).alias("salt"))
    right = tiles.select("component", F.col("tile").alias("other"), F.col("rows").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    met = left.join(right, ["component", "salt"]).where("tile <= other").select("a", "b", (F.col("tile") == F.col("other")).alias("same"))

    def rows_of(cell):
        part = pa.RecordBatch.from_struct_array(cell.flatten())
        lengths = part.column(2).to_numpy(zero_copy_only=False)
        return [(part.column(0).to_numpy()[lengths == n], part.column(1).to_numpy()[lengths == n], _unit(_matrix(part.column(3).filter(pa.array(lengths == n)))), n) for n in np.unique(lengths)]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(2)[k].as_py()
                others = {r[3]: r for r in rows_of(batch.column(1).slice(k, 1))}
                ids, links = [], []
                for first, n, x, length in rows_of(batch.column(0).slice(k, 1)):
                    if length in others:
                        first_b, n_b, y, _ = others[length]
                        near = x @ y.T >= cosine
                        if same:
                            np.fill_diagonal(near, False)
                        ids.append(first), links.append(near @ n_b)
                        if not same:
                            ids.append(first_b), links.append(n @ near)
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(links))], names=["first", "links"])

    return met.mapInArrow(run, "first long, links long").groupBy("first").agg(F.sum("links").alias("links"))


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, **passes: int) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; a component is the smallest key linked to it."""
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    valid = rows.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    # Scaled by the largest component, so that the length of very large and very small vectors is finite.
    largest = F.array_max(F.transform("vector", lambda v: F.abs(v)))
    classes = valid.groupBy("vector").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("length", F.size("vector")), "vectors")
    scaled = classes.withColumn("m", largest).withColumn("vector", F.transform("vector", lambda v: v / F.col("m"))).drop("m")
    found = near_components(scaled, cosine, **passes)
    members = scaled.join(found, scaled["first"] == found["node"]).select("component", "first", "n", "length", "vector")
    links = count_links(members, cosine)
    known = classes.join(found, classes["first"] == found["node"], "left").join(links, "first", "left")
    known = known.select("vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    linked = valid.join(known, "vector").select("id", "n_links", "component_id")
    alone = rows.where(F.col("id").isNull() | ~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    out = linked.unionAll(alone)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
