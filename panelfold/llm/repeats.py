"""Removal of byte strings that occur more than once, with a run-length suffix index.

Every window of ``width`` bytes is assigned to the smallest hashed ``GRAM``-byte string inside it, so equal
windows are assigned to equal strings.  Neighbouring windows of one assignment form a run, whose bytes are
its context; a window lies in exactly one context.  Only contexts whose string occurs again are looked at.
They meet by that string's hash, each distinct context once, and are indexed in blocks of bounded size:

* the suffix array of the block's contexts, each ended by a terminator of its own;
* its Burrows-Wheeler transform in runs, keeping the text positions at the first and last place of a run
  and, for these sampled ends only, the match with the suffix before or after;
* matching statistics streamed over the text: between sampled ends they fall by one per byte, so a running
  maximum gives the longest match of every position with another one.

A window whose match covers it all starts somewhere else too.  A string that leads more than ``MOST``
distinct contexts (the surroundings of a passage that very many documents share) is split by ever longer
common parts of its windows, until at the last level equal windows alone meet; so no group meets whole in
one task and nothing is dropped.

Defined results: NULL texts are empty; texts shorter than ``width`` keep everything; repeated rows are
occurrences of each other; rows with a NULL or repeated key are told apart by their text; an empty table
gives no rows; columns of any name are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.llm.common import as_schema, by_bytes, discard, settle, temp_name, text_of

GRAM = 64
MOST = 4096  # distinct contexts of one string in one block
BLOCK = 1 << 20  # bytes indexed at once, or one string's contexts
_SEGMENT = 1 << 18  # bytes of a text looked at once
_SLICE = 1 << 20  # bytes of texts held as Python objects
_PLACE = np.uint64((1 << 23) - 1)  # places inside a segment
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_CLASSES = (34, 8, 2, 1)  # windows that share a longer common part, by level


# --- windows and their contexts ---------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    """``h`` itself, mixed."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 1):
        h ^= h >> np.uint64(33)
        h *= np.uint64(factor)
    return h


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes; ``gram`` is a power of two."""
    h, k, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while k < gram:
        h = h[:-k] * power + h[k:]
        k *= 2
        with np.errstate(over="ignore"):
            power = power * power
    return _mixed(h)


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` values in a row."""
    n, k = len(values) - span + 1, 1
    while 2 * k <= span:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[:n], values[span - k : span - k + n])


def runs_of(data: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, hash, distance) of the runs of ``valid`` windows that share a smallest string.

    ``distance`` is that of the string from the run's first window.  Equal windows have equal hashes and
    distances, whatever surrounds them.
    """
    hashes = _grams(data, GRAM)
    place = _smallest((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), width - GRAM + 1) & _PLACE
    at = np.nonzero(valid[: len(place)])[0]
    place = place[at].astype(np.int64)
    first = np.ones(len(at), bool)
    first[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    k = np.nonzero(first)[0]
    windows = np.diff(np.append(k, len(at)))
    return at[k], windows, hashes[place[k]].view(np.int64), place[k] - at[k]


def _segments(texts: list[bytes], width: int):
    """(row, offset, bytes) that together hold every window of the texts once."""
    for row, text in enumerate(texts):
        if len(text) >= width:
            for at in range(0, len(text) - width + 1, _SEGMENT):
                yield row, at, text[at : at + _SEGMENT + width - 1]


def _text_runs(texts: list[bytes], width: int):
    """Arrays (row, start, windows, hash, distance) over the texts."""
    batch, size = [], 0
    for segment in [*_segments(texts, width), None]:
        if batch and (segment is None or size + len(segment[2]) > _SEGMENT + width):
            data = np.frombuffer(b"".join(s[2] for s in batch), np.uint8)
            lengths = np.array([len(s[2]) for s in batch])
            begin = np.cumsum(lengths) - lengths
            left = np.repeat(begin + lengths, lengths) - np.arange(len(data))
            start, windows, h, distance = runs_of(data, left >= width, width)
            of = np.searchsorted(begin, start, "right") - 1
            row, offset = np.array([s[0] for s in batch]), np.array([s[1] for s in batch])
            yield row[of], start - begin[of] + offset[of], windows, h, distance
            batch, size = [], 0
        if segment is not None:
            batch.append(segment)
            size += len(segment[2])


# --- the index --------------------------------------------------------------------------------


def suffix_array(text: np.ndarray, remaining: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes by prefix doubling; 0 ends a context and ends are ordered by place.

    ``remaining`` counts the symbols up to and with the context's end.  Also gives the groups of positions
    that share their first ``shared`` symbols, the longest length of the doubling within ``width``.
    """
    n = len(text)
    packed = np.zeros(n, np.int64)
    for k in range(7):
        packed = text.astype(np.int64) << (9 * k) | np.where(text == 0, 0, np.append(packed[1:], 0))
    order = np.argsort(packed)
    ordered = packed[order]
    first = np.ones(n, bool)
    first[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    starts = np.nonzero(first)[0]
    rank[order] = starts[np.cumsum(first) - 1]
    size = np.diff(np.append(starts, n))
    open_ = order[np.repeat(size > 1, size)]
    h, groups, shared = 7, rank.copy(), 7
    while True:
        open_ = open_[remaining[open_] > h]
        if not len(open_):
            break
        key = rank[open_] * (n + 1) + rank[open_ + h] + 1
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        old = rank[open_]
        k = np.arange(len(open_))
        new_group, new_part = np.ones(len(open_), bool), np.ones(len(open_), bool)
        new_group[1:] = old[1:] != old[:-1]
        new_part[1:] = key[1:] != key[:-1]
        begin = np.maximum.accumulate(np.where(new_part, k, 0))
        rank[open_] = old + begin - np.maximum.accumulate(np.where(new_group, k, 0))
        starts = np.nonzero(new_part)[0]
        size = np.diff(np.append(starts, len(open_)))
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
        if h <= width:
            groups, shared = rank.copy(), h
    # What still ties is equal up to its end.
    tied = np.nonzero(np.bincount(rank, minlength=n)[rank] > 1)[0]
    tied = tied[np.argsort(rank[tied], kind="stable")]
    if len(tied):
        k = np.arange(len(tied))
        first = np.ones(len(tied), bool)
        first[1:] = rank[tied][1:] != rank[tied][:-1]
        rank[tied] += k - np.maximum.accumulate(np.where(first, k, 0))
    order[rank] = np.arange(n)
    return order, groups, shared


def _match(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
    """Length of the common prefix of suffix pairs that share ``known`` symbols; an end matches nothing."""
    padded = np.concatenate([text, np.zeros(16, text.dtype)])
    out = np.full(len(a), known, np.int64)
    step = np.arange(16)
    for at in range(0, len(a), 1 << 15):
        open_ = np.arange(at, min(len(a), at + (1 << 15)))
        while len(open_):
            x, y = padded[(a[open_] + out[open_])[:, None] + step], padded[(b[open_] + out[open_])[:, None] + step]
            bad = (x != y) | (x == 0)
            stop = bad.any(axis=1)
            out[open_] += np.where(stop, bad.argmax(axis=1), 16)
            open_ = open_[~stop]
    return out


def matching_statistics(contexts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Match of every position with another one, exact from ``width`` on, and where each context starts."""
    lengths = np.fromiter(map(len, contexts), np.int64, len(contexts)) + 1
    ends = np.cumsum(lengths)
    text = np.zeros(int(ends[-1]), np.int16)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int16) + 1
    remaining = np.repeat(ends, lengths) - np.arange(len(text))
    order, groups, shared = suffix_array(text, remaining, width)
    before = text[order - 1]  # the Burrows-Wheeler transform; ends differ from each other
    new_run = np.ones(len(order), bool)
    new_run[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    heads = np.nonzero(new_run)[0]
    tails = np.append(heads[1:] - 1, len(order) - 1)
    best = np.zeros(len(text), np.int64)
    heads, tails = heads[heads > 0], tails[tails < len(order) - 1]
    for sampled, other in ((order[heads], order[heads - 1]), (order[tails], order[tails + 1])):
        # Ends of runs whose match is too short to matter count as no match.
        long = (groups[sampled] == groups[other]) & (remaining[sampled] > shared) & (remaining[other] > shared)
        sampled, other = sampled[long], other[long]
        reach = np.zeros(len(text), np.int64)
        reach[sampled] = sampled + _match(text, sampled, other, shared)
        best = np.maximum(best, np.maximum.accumulate(reach) - np.arange(len(text)))
    return best, ends - lengths


def repeated_windows(contexts: list[bytes], copies: list[int], width: int) -> list[np.ndarray]:
    """For each of the distinct contexts, which of its windows occur again in it or in another one."""
    best, start = matching_statistics(contexts, width)
    out = []
    for context, n, at in zip(contexts, copies, start.tolist()):
        windows = len(context) - width + 1
        out.append(best[at : at + windows] >= width if n < 2 else np.ones(windows, bool))
    return out


# --- Spark ------------------------------------------------------------------------------------

# A run's place in its text: start, windows and distance in one number.
_PLACED = as_schema(("row", "long"), ("place", "long"), ("h", "long"), ("content", "long"))
_CONTEXT = as_schema(("h", "long"), ("content", "long"), ("distance", "int"), ("n", "long"), ("context", "binary"))
_PART = as_schema(("of_h", "long"), ("of_content", "long"), ("offset", "int"), *[(f.name, f.dataType.typeName().replace("integer", "int")) for f in _CONTEXT.fields])
_MASK = as_schema(("h", "long"), ("content", "long"), ("offset", "int"), ("windows", "int"), ("mask", "binary"))


def _content(pieces: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces), np.uint64, len(pieces)).view(np.int64)


def _batch(schema: T.StructType, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "integer": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.typeName()]) for c, f in zip(columns, schema.fields)], names=schema.names)


def _runs(docs: DataFrame, width: int) -> DataFrame:
    """(row, place, h, content) of the runs of every text."""

    def run(batches):
        for batch in by_bytes(batches, 1, _SLICE):
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for row, start, windows, h, distance in _text_runs(texts, width):
                content = _content([texts[k][a : a + n + width - 1] for k, a, n in zip(row.tolist(), start.tolist(), windows.tolist())])
                yield _batch(_PLACED, rows[row], start << 16 | windows << 8 | distance, h, content)

    return docs.select("row", "text").mapInArrow(run, _PLACED)


def _contexts(docs: DataFrame, candidates: DataFrame, width: int) -> DataFrame:
    """The distinct contexts of strings that lead several, each cut out of one of its texts."""
    each = candidates.where("mixed").groupBy("h", "content").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one"))
    wanted = each.groupBy(F.col("one.row").alias("of")).agg(F.collect_list(F.struct("one.place", "h", "content", "n")).alias("runs"))
    # Equal rows are one before they meet.
    distinct = docs.groupBy("row").agg(F.first("text").alias("text"))
    rows = distinct.join(wanted, F.col("row") == F.col("of")).select("text", "runs")

    def run(batches):
        for batch in by_bytes(batches, 0, _SLICE):
            for k in range(batch.num_rows):
                text = batch.column(0)[k].as_py().encode("utf-8", "surrogatepass")
                part = pa.RecordBatch.from_struct_array(batch.column(1).slice(k, 1).flatten())
                for at in range(0, part.num_rows, 4096):
                    place, h, content, n = (c.to_numpy() for c in part.slice(at, 4096).columns)
                    start, windows = place >> 16, place >> 8 & 255
                    pieces = [text[a : a + m + width - 1] for a, m in zip(start.tolist(), windows.tolist())]
                    # Of another text with the same row hash nothing is taken.
                    own = np.nonzero(_content(pieces) == content)[0]
                    yield _batch(_CONTEXT, h[own], content[own], (place & 255).astype(np.int32)[own], n[own], [pieces[i] for i in own])

    return rows.mapInArrow(run, _CONTEXT)


def _refined(contexts: DataFrame, level: int, width: int) -> DataFrame:
    """Contexts split into classes of windows at like distances, keyed by all that a class has in common."""
    size = _CLASSES[level]

    def run(batches):
        for batch in batches:
            rows = []
            for h, content, distance, n, context in zip(*[batch.column(f.name).to_pylist() for f in _CONTEXT.fields]):
                at, windows = 0, len(context) - width + 1
                while at < windows:
                    d = distance - at
                    low = d // size * size
                    m = min(windows - at, d - low + 1)
                    common = context[distance - low : distance - (low + size - 1) + width]
                    key = xxhash.xxh64_intdigest(common, (h + level * 1000 + low) & (2**64 - 1))
                    piece = context[at : at + m + width - 1]
                    rows.append((h, content, at, key - (key >> 63 << 64), 0, d, n, piece))
                    at += m
            if rows:
                columns = list(zip(*rows))
                columns[4] = _content(columns[7])
                yield _batch(_PART, *columns)

    return contexts.select(_CONTEXT.names).mapInArrow(run, _PART)


def _indexed(contexts: DataFrame, width: int) -> DataFrame:
    """Masks of the repeated windows of the contexts that have any, by blocks of whole strings."""

    def flush(held):
        found = repeated_windows([r[3] for r in held], [r[2] for r in held], width)
        some = [(h, c, 0, len(m), np.packbits(m).tobytes()) for (h, c, _, _), m in zip(held, found) if m.any()]
        return _batch(_MASK, *(zip(*some) if some else [[]] * 5))

    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[:2] == held[-1][:2]:
                    continue  # from a repeated row
                if size >= BLOCK and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield flush(held)

    rows = contexts.select("h", "content", "n", "context").repartition("h").sortWithinPartitions("h", "content")
    return rows.mapInArrow(run, _MASK)


def _masks(contexts: DataFrame, width: int, level: int = 0) -> DataFrame:
    """(h, content, offset, windows, mask) of distinct contexts; a context may have several, or none."""
    wide = settle(contexts.groupBy("h").agg(F.count("*").alias("width")).where(F.col("width") > MOST).select("h"), "wide-strings")
    if not wide.head(1):
        return _indexed(contexts, width)
    parts = settle(_refined(contexts.join(wide, "h", "left_semi"), level, width), "parts")
    distinct = parts.groupBy("h", "content").agg(F.sum("n").alias("n"), F.first("distance").alias("distance"), F.first("context").alias("context"))
    found = _masks(settle(distinct.select(_CONTEXT.names), "contexts"), width, level + 1)
    back = parts.select("of_h", "of_content", F.col("offset").alias("shift"), "h", "content").join(found, ["h", "content"])
    back = back.select(F.col("of_h").alias("h"), F.col("of_content").alias("content"), (F.col("shift") + F.col("offset")).alias("offset"), "windows", "mask")
    return _indexed(contexts.join(wide, "h", "left_anti"), width).unionAll(back)


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 200, kept: str = "kept", spans: str = "spans", as_text: bool = False
) -> DataFrame:
    """``df`` with the bytes that stay and the spans [start, end) of bytes that go.

    A byte goes if a string of ``width`` bytes covering it also starts anywhere else.  With ``as_text`` what
    stays is text again, without the characters that a span cuts in two.
    """
    if width < 2 * GRAM or width - GRAM > 255:
        raise ValueError(f"width must be in {2 * GRAM}..{GRAM + 255}")
    if {kept.lower(), spans.lower()} & {c.lower() for c in df.columns}:
        raise ValueError("a column of these names exists already")
    docs = df.select(_row(key, text).alias("row"), text_of(text).alias("text"))
    runs = settle(_runs(docs, width), "runs")
    again = runs.groupBy("h").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    # Written, so that the join with the runs is one of two plain shuffles, which can be split where a string is hot.
    again = settle(again.where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")), "repeated-strings")
    candidates = settle(runs.join(again, "h"), "candidates")
    discard(runs)
    masks = _masks(settle(_contexts(docs, candidates, width), "contexts"), width)
    # A string with one context is repeated whole.
    alike = candidates.where("NOT mixed").select("row", "place", "content", F.lit(0).alias("offset"), F.lit(None).cast("int").alias("windows"), F.lit(None).cast("binary").alias("mask"))
    mixed = candidates.where("mixed").join(masks, ["h", "content"]).select("row", "place", "content", "offset", "windows", "mask")
    # A set: equal rows have one hash and the same marks, which are as many as one of them has runs.
    marks = mixed.unionAll(alike).groupBy("row").agg(F.collect_set(F.struct("place", "content", "offset", "windows", "mask")).alias("marks"))
    return _cut(df, marks, _row(key, text), text, width, kept, spans, as_text)


def _row(key: str, text: str):
    """A hash of key and text.  A chance hit of another row is harmless: contents are compared before use."""
    return F.xxhash64(F.col(f"`{key}`"), text_of(text))


def _cut(df: DataFrame, marks: DataFrame, row, text: str, width: int, kept: str, spans: str, as_text: bool) -> DataFrame:
    names = [temp_name(df, n) for n in ("row", "marks")]
    marks = marks.toDF(*names)
    rows = df.join(marks, row == marks[names[0]], "left").select(*[df[f"`{c}`"] for c in df.columns], names[1])
    at, last = df.columns.index(text), len(df.columns)
    added = [T.StructField(kept, T.StringType() if as_text else T.BinaryType()), T.StructField(spans, T.ArrayType(as_schema(("start", "int"), ("end", "int"))))]

    def run(batches):
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in by_bytes(batches, at, _SLICE):
            stay, gone = [], []
            for k in range(batch.num_rows):
                data = (batch.column(at)[k].as_py() or "").encode("utf-8", "surrogatepass")
                spans = _spans(data, batch.column(last).slice(k, 1), width) if batch.column(last)[k].is_valid else np.zeros((0, 2), np.int64)
                gone.append([{"start": a, "end": b} for a, b in spans.tolist()])
                edges = [0, *spans.ravel().tolist(), len(data)]
                stay.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            left = pa.array([s.decode("utf-8", "ignore") for s in stay], pa.string()) if as_text else pa.array(stay, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], left, pa.array(gone, span_type)], names=[*batch.schema.names[:last], kept, spans_name])

    spans_name = spans
    return rows.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def _spans(data: bytes, marks: pa.Array, width: int) -> np.ndarray:
    """[start, end) of the bytes under the marked windows."""
    place, content, offset, windows, mask = pa.RecordBatch.from_struct_array(marks.flatten()).columns
    place = place.to_numpy()
    start, size = place >> 16, place >> 8 & 255
    own = _content([data[a : a + n + width - 1] for a, n in zip(start.tolist(), size.tolist())]) == content.to_numpy()
    windows = windows.fill_null(-1).to_numpy()
    whole = own & (windows < 0)
    edge = np.zeros(len(data) + 2, np.int64)  # +1 where marked windows begin, -1 behind the last of them
    np.add.at(edge, start[whole], 1)
    np.add.at(edge, start[whole] + size[whole], -1)
    marked = np.cumsum(edge)[: len(data)] > 0
    for k in np.nonzero(own & (windows >= 0))[0]:
        bits = np.unpackbits(np.frombuffer(mask[k].as_py(), np.uint8), count=windows[k]).astype(bool)
        begin = start[k] + offset[k].as_py()
        marked[begin : begin + windows[k]] |= bits
    begin = np.nonzero(marked)[0]
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    first = np.append(True, begin[1:] > begin[:-1] + width)
    return np.column_stack([begin[first], begin[np.append(first[1:], True)] + width])
