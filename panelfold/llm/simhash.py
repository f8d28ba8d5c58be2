"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits are cut into segments.  If two of them differ in at most ``bits`` places, some
segment differs in at most its radius, where the radii plus one sum to ``bits`` + 1.  Every distinct
fingerprint is stored under each of its segments; as a query it enumerates the Hamming ball of that radius
around each segment, fetches the table's matches by an equi-join and verifies the complete distance inside
the join.  Copies have one fingerprint and enter once, so a group of copies makes no pairs; linked
fingerprints are joined by connected components.

Defined results: NULL, empty and blank texts have no words and the fingerprint zero, which is linked like
any other; a text with fewer words than a shingle is one shingle; a repeated id belongs to the component
of each of its rows; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.llm.common import by_bytes, stage
from panelfold.llm.components import components

SEGMENTS = 3  # 21-22 bits each: sparse up to about 10^8 distinct fingerprints; take 2 beyond
_SHINGLES = 1 << 16  # hashed before their bits are summed


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words)
    if n <= shingle:
        return h(joined, seed)
    length = np.fromiter(map(len, words), np.int64, n)
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    spans = list(zip(start[: n - shingle + 1].tolist(), (start + length)[shingle - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(spans), _SHINGLES):
        part = spans[at : at + _SHINGLES]
        hashes = np.fromiter((h(joined[a:b], seed) for a, b in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans), bitorder="little").tobytes(), "little")


def with_fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``df`` with the fingerprint of each text as a signed long."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists already")
    at = df.columns.index(text)

    def run(batches):
        for batch in by_bytes(batches, at):
            prints = np.array([fingerprint(t or "", shingle, seed) for t in batch.column(at).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.LongType())]))


def _segments(count: int, bits: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment; the wide ones get the small radii."""
    width = [64 // count + (k >= count - 64 % count) for k in range(count)]
    # radii r_k with sum(r_k + 1) = bits + 1: fewer differing bits than that leave one segment within its radius
    extra = bits + 1 - count
    if extra < 0:
        return [(sum(width[:k]), width[k], 0) for k in range(bits + 1)]
    radius = [extra // count + (k < extra % count) for k in range(count)]
    return [(sum(width[:k]), width[k], radius[k]) for k in range(count)]


def _ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` bits."""
    masks, ring = [0], [0]
    for _ in range(radius):
        ring = [m | 1 << b for m in ring for b in range(m.bit_length(), width)]
        masks += ring
    return masks


def _key(column: str, first: int, width: int, segment: int) -> Column:
    value = F.shiftrightunsigned(F.col(column), first).bitwiseAND(F.lit((1 << width) - 1))
    return value.bitwiseOR(F.lit(segment << 40))


def near_pairs(prints: DataFrame, column: str = "fingerprint", bits: int = 4, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in 1 to ``bits`` places."""
    if not 0 <= bits < 64 or not 2 <= segments <= 64:
        raise ValueError("bits must be in 0..63 and segments in 2..64")
    distinct = prints.select(F.col(column).alias("a")).where("a IS NOT NULL").distinct()
    cut = _segments(segments, bits)
    probes = [_key("a", first, width, k).bitwiseXOR(F.lit(m)) for k, (first, width, radius) in enumerate(cut) for m in _ball(width, radius)]
    queries = distinct.select("a", F.explode(F.array(*probes)).alias("key"))
    table = distinct.select(F.col("a").alias("b"), F.explode(F.array(*[_key("a", f, w, k) for k, (f, w, _) in enumerate(cut)])).alias("slot"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    return queries.join(table, (F.col("key") == F.col("slot")) & near).select("a", "b").distinct()


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4, seed: int = 42, segments: int = SEGMENTS
) -> DataFrame:
    """(key, fingerprint, component_id) of every row; a component is the smallest key linked to it."""
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    prints = stage(with_fingerprints(rows, "text", "fingerprint", shingle, seed).drop("text"), "fingerprints")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    first = stage(first, "classes")
    linked = near_pairs(first, "fingerprint", bits, segments)
    a = first.select(F.col("fingerprint").alias("a"), F.col("first").alias("fa"))
    b = first.select(F.col("fingerprint").alias("b"), F.col("first").alias("fb"))
    edges = linked.join(a, "a").join(b, "b").select(F.col("fa").alias("a"), F.col("fb").alias("b"))
    # A repeated key joins the classes of its rows.
    several = prints.join(first, "fingerprint").where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    repeated = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("a"))
    edges = edges.unionAll(several.join(repeated, "a", "left_semi"))
    found = components(edges)
    classes = first.join(found, first["first"] == found["node"], "left").select(
        "fingerprint", F.coalesce("component", "first").alias("component_id")
    )
    return prints.join(classes, "fingerprint").select(F.col("doc_id").alias(key), "fingerprint", "component_id")
