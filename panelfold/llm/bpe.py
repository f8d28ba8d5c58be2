"""Byte-level BPE encoding and decoding over length-bucketed padded numpy matrices.

A text is split by the tokenizer's pattern and every match is encoded by itself.  The distinct matches
of a batch are padded to the same width in a few length classes; in each round every row merges its
leftmost pair of minimum rank, rows without a pair left are taken out and the matrix is narrowed to its
longest row.  Pair ranks come from an open-addressing hash table in numpy.

Defined results: a NULL or empty text has no tokens; repeated rows are encoded alike; all columns of the
input are kept, and an added column whose name is taken is an error.  A match of over ``LONG`` bytes (one
endless word) is merged with a heap under the same rule, since a round per merge over so wide a row would
be quadratic.  Nothing is shuffled and no text is cut.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelfold.llm.common import by_bytes

WIDTHS = (4, 8, 16, 32, 64, 128, 256, 512, 1024)
LONG = WIDTHS[-1]
_CELLS = 1 << 21  # cells of one matrix
_KEPT = 1 << 18  # distinct matches a worker remembers; afterwards it starts anew
_CHUNK = 1 << 20  # characters split at once
_NONE = np.int32(2**31 - 1)
_FREE = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Ranks of byte strings, with the rank that each pair of tokens merges to."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = sorted(ranks, key=ranks.__getitem__)
        size = max(ranks.values()) + 1
        self.length, self.start = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = 0
        for t in tokens:
            self.length[ranks[t]], self.start[ranks[t]] = len(t), at
            at += len(t)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self._fill(np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64), np.array(merged, np.int32))

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self._bits = max(8, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self._keys = np.full(1 << self._bits, _FREE)
        self._ranks = np.full(1 << self._bits, _NONE)
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] == _FREE
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self._keys[slot[put]], self._ranks[slot[put]] = keys[put], ranks[put]
            keys, ranks, slot = keys[~put], ranks[~put], slot[~put]
            taken = self._keys[slot] != _FREE
            slot = np.where(taken, (slot + 1) & ((1 << self._bits) - 1), slot)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self._bits)).astype(np.int64)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge (padding is negative)."""
        key = a.astype(np.int64).astype(np.uint64) << np.uint64(32) | (b.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = self._slot(key)
        found = self._keys[slot]
        out = np.where(found == key, self._ranks[slot], _NONE)
        open_ = np.nonzero((found != key) & (found != _FREE))
        while open_[0].size:
            slot[open_] = (slot[open_] + 1) & ((1 << self._bits) - 1)
            found = self._keys[slot[open_]]
            hit = found == key[open_]
            out[tuple(x[hit] for x in open_)] = self._ranks[slot[open_]][hit]
            keep = ~hit & (found != _FREE)
            open_ = tuple(x[keep] for x in open_)
        out[(a < 0) | (b < 0)] = _NONE
        return out


@lru_cache(maxsize=4)
def _vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines.splitlines() if line.strip())}
    return Vocabulary(ranks, pattern)


def _merge_matrix(vocabulary: Vocabulary, pieces: list[bytes], width: int) -> list[np.ndarray]:
    """Token ids of pieces of at most ``width`` bytes."""
    n = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, n)
    ids = np.full((n, width), -1, np.int32)
    row = np.repeat(np.arange(n), lengths)
    column = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ids[row, column] = vocabulary.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    pair = vocabulary.merge(ids[:, :-1], ids[:, 1:])
    out: list[np.ndarray] = [None] * n
    at = np.arange(n)
    while len(at):
        rows = np.arange(len(at))
        m = pair.argmin(axis=1)
        best = pair[rows, m]
        go = best != _NONE
        if not go.all():
            for k in np.nonzero(~go)[0]:
                out[at[k]] = ids[k, : lengths[k]].copy()
            ids, pair, at, lengths, m, best = ids[go], pair[go], at[go], lengths[go], m[go], best[go]
            rows = np.arange(len(at))
            if not len(at):
                break
        ids[rows, m] = best
        wide = int(lengths.max()) - 1
        columns = np.arange(wide)
        ids = np.take_along_axis(ids, columns + (columns > m[:, None]), axis=1)
        lengths = lengths - 1
        if wide > 1:
            columns = np.arange(wide - 1)
            pair = np.take_along_axis(pair, columns + (columns >= m[:, None]), axis=1)
            for side in (-1, 0):
                k = m + side
                ok = (k >= 0) & (k < wide - 1)
                r, c = rows[ok], k[ok]
                inside = c + 1 < lengths[r]
                pair[r, c] = np.where(inside, vocabulary.merge(ids[r, c], ids[r, c + 1]), _NONE)
        else:
            pair = np.full((len(at), 1), _NONE, np.int32)
    return out


def _merge_long(vocabulary: Vocabulary, piece: bytes) -> np.ndarray:
    """The same rule with a heap: the smallest rank first, the leftmost among equal ranks."""
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    n = len(ids)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = vocabulary.merge(np.array(ids[:-1]), np.array(ids[1:]))
    heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(ranks.tolist()) if r != _NONE]
    heapq.heapify(heap)
    known: dict[tuple[int, int], int] = {}

    def push(i: int) -> None:
        j = following[i]
        if j < n:
            key = (ids[i], ids[j])
            if key not in known:
                known[key] = int(vocabulary.merge(np.array([key[0]]), np.array([key[1]]))[0])
            if known[key] != _NONE:
                heapq.heappush(heap, (known[key], i, *key))

    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = following[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = rank, -1
        following[i] = following[j]
        if following[i] < n:
            before[following[i]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return np.array([t for t in ids if t >= 0], np.int32)


def encode_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> list[np.ndarray]:
    """Token ids of each piece; a piece that is itself a token is that token."""
    out: list[np.ndarray] = [None] * len(pieces)
    classes: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        rank = vocabulary.ranks.get(piece)
        if rank is not None:
            out[k] = np.array([rank], np.int32)
        elif len(piece) > LONG:
            out[k] = _merge_long(vocabulary, piece)
        else:
            classes.setdefault(next(w for w in WIDTHS if w >= len(piece)), []).append(k)
    for width, members in classes.items():
        step = max(1, _CELLS // width)
        for at in range(0, len(members), step):
            part = members[at : at + step]
            for k, ids in zip(part, _merge_matrix(vocabulary, [pieces[k] for k in part], width)):
                out[k] = ids
    return out


_SAFE_CUT = regex.compile(r"\S(?=\s)")


def split_text(vocabulary: Vocabulary, text: str) -> list[str]:
    """The pattern's matches.  A long text is split at the start of white space, where a match always ends."""
    if len(text) <= 2 * _CHUNK:
        return vocabulary.pattern.findall(text)
    out, at = [], 0
    while at < len(text):
        cut = _SAFE_CUT.search(text, at + _CHUNK)
        to = cut.end() if cut else len(text)
        out += vocabulary.pattern.findall(text[at:to])
        at = to
    return out


class Encoder:
    """Encodes batches of texts, remembering the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        split = [split_text(self.vocabulary, t) for t in texts]
        pieces = [p for s in split for p in s]
        if len(self.index) > _KEPT:
            self._reset()
        new = list(set(pieces).difference(self.index))
        if new:
            ids = encode_pieces(self.vocabulary, [p.encode("utf-8", "surrogatepass") for p in new])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            starts = len(self.flat) + np.cumsum(lengths) - lengths
            self.index.update(zip(new, range(len(self.length), len(self.length) + len(new))))
            self.flat = np.concatenate([self.flat, *ids])
            self.start, self.length = np.concatenate([self.start, starts]), np.concatenate([self.length, lengths])
        codes = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        ids = gather(self.flat, self.start, self.length, codes)
        ends = np.concatenate([[0], np.cumsum(self.length[codes])])
        return ids, np.diff(ends[np.cumsum([0, *map(len, split)])])


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[start[c] : start[c] + length[c]]`` over the codes."""
    n = length[codes]
    total = int(n.sum())
    return flat[np.repeat(start[codes] - (np.cumsum(n) - n), n) + np.arange(total)]


def encode_documents(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``df`` with the token ids of its texts, packed as little-endian unsigned 32-bit integers.

    ``path`` is a file of base64 tokens and ranks on the driver; its content goes with the tasks, as a
    vocabulary is bounded by its own size.  With ``decoded`` the ids are turned back into bytes as well.
    """
    added = [c for c in (ids, decoded) if c]
    if {c.lower() for c in added} & {c.lower() for c in df.columns}:
        raise ValueError(f"a column of {added} exists already")
    with open(path, "rb") as f:
        shipped = df.sparkSession.sparkContext.broadcast(f.read())
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.BinaryType()) for c in added]])

    def run(batches):
        vocabulary = _vocabulary(shipped.value, pattern)
        encoder = Encoder(vocabulary)
        for batch in by_bytes(batches, at):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            flat, counts = encoder.encode(texts)
            columns = [*batch.columns, _packed(flat.astype("<u4"), counts)]
            if decoded:
                columns.append(decode_flat(vocabulary, flat, counts))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    return df.mapInArrow(run, schema)


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    data, ends = values.tobytes(), np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.array([data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())


def decode_flat(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Bytes of runs of ids."""
    lengths = vocabulary.length[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    size = np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])
    return _packed(gather(vocabulary.bytes, vocabulary.start, vocabulary.length, ids), size)


def decode_documents(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its packed token ids; NULL ids give empty bytes, an unknown id fails the job."""
    if decoded.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {decoded} exists already")
    with open(path, "rb") as f:
        shipped = df.sparkSession.sparkContext.broadcast(f.read())
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches):
        vocabulary = _vocabulary(shipped.value, pattern)
        for batch in by_bytes(batches, at):
            packed = [v or b"" for v in batch.column(at).to_pylist()]
            flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
            if flat.size and (flat.max() >= len(vocabulary.length) or (vocabulary.length[flat] == 0).any()):
                raise ValueError("a token id that the vocabulary does not have")
            out = decode_flat(vocabulary, flat, np.array([len(v) // 4 for v in packed], np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, decoded])

    return df.mapInArrow(run, schema)
