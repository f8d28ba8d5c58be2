"""Cross-entropy difference of two matched n-gram models.

A target and a background bigram model share one vocabulary and one list of bigrams, and are smoothed
alike, so the difference of their losses says how a text differs from the background in the target's
direction and not how rare its words are.  The background is counted over every document, the target over
those of a given list.  Every word and every pair of the corpus is in the models: what was seen once has its
discount as its whole count, so a pair seen once is its back-off exactly and needs no entry, and all other
pairs have one, however many there are.

A word is its 64-bit hash, or a small number where it is usual in a sample of ``_SAMPLE`` texts, which makes the
tables shorter.  Counts and the values made of them are Spark tables.  The most frequent words
and pairs, up to ``HEAD_WORDS`` and ``HEAD_PAIRS``, are broadcast too and scored where the text is; a
document's other distinct words and pairs are looked up in the tables, by parts of the keys, but for those that a bitmap of the tables'
keys rules out.  Those are seldom by that choice (over
``HEAD_PAIRS`` pairs are about as frequent as any of them), so no part is hot.  The head's sizes
change the cost and no result.

``most_words`` and ``most_pairs`` make models of a wanted size instead: the highest frequency classes that fit
whole, all other words as one unknown word, all other pairs by their back-off.

Counting combines ``_TOKENS`` words of a task at a time before the shuffle, and what is left of the pairs is summed in parts
of a bounded size.  Defined results: NULL and empty texts have losses
of zero; a word that the corpus lacks has the count zero and as a context says nothing; repeated rows count
and are scored each; ids of the list without a document are ignored; without target documents both models
are the background and every difference is zero.
"""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass, replace
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.llm.common import as_schema, by_bytes, discard, key_bitmap, may_hold, settle, stage, temp_name, text_of
from panelfold.llm.toxicity import _WORD, words
from panelfold.operators.sizing import join_small

HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 18
DISCOUNT = 1.0  # what was seen once says nothing, so that a text does not vouch for itself
_TOKENS = 1 << 21
_PART_WORDS = 1 << 20  # of the corpus, whose pairs one part holds
_PART_KEYS = 1 << 21  # of the table, that one part holds
_SAMPLE, _SAMPLE_CHARS, _USUAL = 4096, 1 << 14, 1 << 16
_USUAL_SLOTS = 20  # bits of a usual word's slot
_ALONE, _LAST = -1, -2  # stand before a word for the word by itself, and for the last of a text
_TABLE, _ASKED, _TEXT = range(3)  # what a row brings to its part
_START = 0  # before the first word; as a word, 0 is every word outside the vocabulary


@dataclass
class Matched:
    """Losses in nats; index 0 of the first axis is the background, 1 the target."""

    ids: dict[str, int]
    word: np.ndarray
    rest: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray

    def losses(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean loss per word of every text under both models, and its number of words."""
        ids, ends = flat_ids(self.ids, texts)
        size = self.word.shape[1]
        before = np.concatenate([[_START], ids[:-1]]) if len(ids) else ids
        starts = np.concatenate([[0], ends[:-1]])
        before[starts[starts < len(ids)]] = _START
        loss = self.rest[:, before] + self.word[:, ids]
        if len(self.pairs) and len(ids):
            key = before * size + ids
            slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            hit = self.pairs[slot] == key
            loss[:, hit] = self.pair[:, slot[hit]]
        sums = np.concatenate([np.zeros((2, 1)), np.cumsum(loss, axis=1)], axis=1)
        n = np.diff(ends, prepend=0)
        return (sums[:, ends] - sums[:, ends - n]) / np.maximum(n, 1), n


def flat_ids(ids: dict[str, int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    each = [words(t) for t in texts]
    ends = np.cumsum([len(w) for w in each]).astype(np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.fromiter((ids.get(w, 0) for ws in each for w in ws), np.int64, total), ends


@cache
def _letters() -> np.ndarray:
    """Of every code point, whether it stands in ``words``."""
    out = np.zeros(sys.maxunicode + 1, bool)
    for m in _WORD.finditer("".join(map(chr, range(len(out))))):
        out[m.start() : m.end()] = True
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit numbers mixed, in place."""
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15):
        x ^= x >> np.uint64(30)
        x *= np.uint64(by)
    x ^= x >> np.uint64(31)
    return x


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of ``words`` of all texts in a row, and the texts' ends.

    A word's hash is that of the sum of its characters', each mixed with its place in the word.
    """
    lowered = [t.lower() for t in texts]
    chars = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _letters()[chars]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in lowered])).astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.int64), ends
    first = np.cumsum(lengths) - lengths
    place = np.arange(1, lengths.sum() + 1, dtype=np.int64) - np.repeat(first, lengths)
    each = _mixed((place << 21 | chars[inside]).view(np.uint64))
    return _mixed(np.add.reduceat(each, first)).view(np.int64), ends


class _Hashes:
    """Number of a word: from 1 that of a usual one, which two with one slot leave to the more frequent, or its 64-bit hash."""

    def __init__(self, usual: np.ndarray):
        self.keys, self.numbers = np.zeros(1 << _USUAL_SLOTS, np.int64), np.zeros(1 << _USUAL_SLOTS, np.int64)
        slots = self._slots(usual)
        _, at = np.unique(slots, return_index=True)
        self.keys[slots[at]], self.numbers[slots[at]] = usual[at], at + 1

    @staticmethod
    def _slots(word: np.ndarray) -> np.ndarray:
        return word.view(np.uint64) >> np.uint64(64 - _USUAL_SLOTS)

    def of(self, word: np.ndarray) -> np.ndarray:
        slots = self._slots(word)
        return np.where(self.keys[slots] == word, self.numbers[slots], word)


def _usual_words(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Hashes of the most frequent words of about ``_SAMPLE`` texts, which change no result, and about how many words there are.

    The sample is all texts with a small hash, so no text leaves its task.
    """

    def count(batches):
        held, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in by_bytes(batches, 0):
            word, _ = _word_hashes(batch.column(0).to_pylist())
            held, n = [*held, word], [*n, np.ones(len(word), np.int64)]
            word, of = np.unique(np.concatenate(held), return_inverse=True)
            held, n = [word], [np.bincount(of, np.concatenate(n), len(word)).astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(n[0])], names=["word", "n"])

    total = rows.count()
    share = min(1.0, _SAMPLE / max(total, 1))
    chosen = rows.where(F.pmod(F.xxhash64("row", "text"), F.lit(1 << 32)) < F.lit(int(share * (1 << 32)) + 1))
    counts = chosen.select(F.substring("text", 1, _SAMPLE_CHARS).alias("text")).mapInArrow(count, "word long, n long")
    counts = stage(counts.groupBy("word").agg(F.sum("n").alias("n")), "sampled-words")
    found = counts.orderBy(F.desc("n"), "word").limit(_USUAL).select("word").toArrow()
    n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return found["word"].to_numpy().astype(np.int64), int(n_words / share)


def _hashed(hashes: _Hashes, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word before, word) of all texts in a row, and the texts' ends."""
    word, ends = _word_hashes(texts)
    word = hashes.of(word)
    before = np.roll(word, 1)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    before[starts[starts < len(word)]] = _START
    return before, word, ends


def _pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return before * np.int64(0x1E3779B97F4A7C15) + word * np.int64(0x42B2AE3D27D4EB4F)


def _word_key(word: np.ndarray) -> np.ndarray:
    return word * np.int64(0x27D4EB2F165667C5)


def _last_key(word: np.ndarray) -> np.ndarray:
    return word * np.int64(0x165667B19E3779F9) + np.int64(1)


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Head:
    """Losses in nats of frequent words and pairs, sorted by key; index 0 of the first axis is the background."""

    start: np.ndarray  # of what stands before the first word, as a context
    unseen: np.ndarray  # of a word without a count
    word_keys: np.ndarray
    word: np.ndarray
    rest: np.ndarray
    pair_keys: np.ndarray
    pair: np.ndarray  # what a pair's loss differs from its back-off by
    usual: np.ndarray
    bitmap: np.ndarray | None = None  # of the keys of the table that holds the others

    def sums(self, hashes: _Hashes, texts: list[str]):
        """Summed losses of each text by the head, its number of words, and (text, key, n) of what the tables may hold."""
        before, word, ends = _hashed(hashes, texts)
        n = np.diff(ends, prepend=0)
        text = np.repeat(np.arange(len(texts)), n)
        out = np.where(n > 0, self.start[:, None], 0.0)
        asked = []
        for keys, table in ((word, self.word_keys), (_pair_key(before, word), self.pair_keys)):
            of, each = pd.factorize(keys) if table is self.word_keys else np.unique(keys, return_inverse=True)[::-1]
            at, hit = _found(table, each)
            if table is self.word_keys:
                value = np.repeat(self.unseen[:, None], len(each), axis=1)
                value[:, hit] = (self.word + self.rest)[:, at[hit]]
                each = _word_key(each)
            else:
                value = np.zeros((2, len(each)))
                value[:, hit] = self.pair[:, at[hit]]
            for c in (0, 1):
                out[c] += np.bincount(text, value[c][of], len(texts))
            if self.bitmap is not None and len(each):
                rare = (~hit & may_hold(self.bitmap, each))[of]
                cell, times = np.unique(text[rare] * len(each) + of[rare], return_counts=True)
                asked.append((cell // len(each), each[cell % len(each)], times))
        last = ends[n > 0] - 1
        at, hit = _found(self.word_keys, word[last])
        out[:, np.nonzero(n)[0][hit]] -= self.rest[:, at[hit]]
        if self.bitmap is not None:
            asked.append((np.nonzero(n)[0][~hit], _last_key(word[last[~hit]]), np.ones((~hit).sum(), np.int64)))
        return out, n, tuple(np.concatenate([a[k] for a in asked] or [np.zeros(0, np.int64)]) for k in range(3))


@dataclass
class Whole:
    """Models of every word and pair: the head, and a table (key, v0, v1) of what the others add to it."""

    head: Head
    table: DataFrame | None
    bits: int = 0  # of a key, which number the parts that the table is dealt into


def _combined(b: np.ndarray, w: np.ndarray, n: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, ...]:
    """(b, w, n, t) with each pair once, in the order of the pairs' keys as unsigned numbers."""
    key = _pair_key(b, w).view(np.uint64)
    order = np.argsort(key)
    key = key[order]
    starts = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1]) if len(key) else np.zeros(0, np.int64)
    if not len(key):
        return b, w, n, t
    return b[order[starts]], w[order[starts]], np.add.reduceat(n[order], starts), np.add.reduceat(t[order], starts)


def _planes(values: np.ndarray) -> bytes:
    """The values' bytes, the lowest of all first: planes of zeros compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _values(blob: bytes, at: int, n: int, kind: str) -> tuple[np.ndarray, int]:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64), at + n * width


def _packed(b: np.ndarray, w: np.ndarray, n: np.ndarray, t: np.ndarray) -> bytes:
    """The columns in the order of ``b``: which words have a number, the numbers, the other words' hashes, and the counts."""
    order = np.argsort(b)
    parts = []
    for c in (b[order], w[order]):
        usual = (c >= _LAST) & (c < 1 << 24)
        parts += [np.packbits(usual).tobytes(), int(usual.sum()).to_bytes(4, "little"), _planes((c[usual] - _LAST).astype("<u4")), _planes(c[~usual].astype("<i8"))]
    kind = "<u1" if n.max(initial=0) < 256 else "<i8"
    parts += [_planes(c[order].astype(kind)) for c in (n, t)]
    return len(b).to_bytes(4, "little") + bytes([np.dtype(kind).itemsize]) + b"".join(parts)


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    rows, kind, at, out = int.from_bytes(blob[:4], "little"), {1: "<u1", 8: "<i8"}[blob[4]], 5, []
    for _ in range(2):
        size = (rows + 7) // 8
        usual = np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=rows).astype(bool)
        few = int.from_bytes(blob[at + size : at + size + 4], "little")
        c = np.empty(rows, np.int64)
        c[usual], at = _values(blob, at + size + 4, few, "<u4")
        c[usual] += _LAST
        c[~usual], at = _values(blob, at, rows - few, "<i8")
        out.append(c)
    for _ in range(2):
        c, at = _values(blob, at, rows, kind)
        out.append(c)
    return tuple(out)


def _dealt(keys: np.ndarray, bits: int, columns: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """The parts that occur, and each one's keys, in order as differences, and columns."""
    order = np.argsort(keys.view(np.uint64))
    keys, columns = keys.view(np.uint64)[order], [c[order] for c in columns]
    part = keys >> np.uint64(64 - bits)
    cuts = np.concatenate([[0], np.nonzero(part[1:] != part[:-1])[0] + 1, [len(part)]])
    blobs = [b"".join([_planes(np.diff(keys[x:y], prepend=np.uint64(0))), *[_planes(c[x:y]) for c in columns]]) for x, y in zip(cuts, cuts[1:])]
    return part[cuts[:-1]].astype(np.int32), blobs


def _undealt(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    widths = [np.dtype(kind).itemsize for kind in ("<u8", *kinds)]
    n, at, out = len(blob) // sum(widths), 0, []
    for kind, width in zip(("<u8", *kinds), widths):
        planes = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * width
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def _pair_counts(flagged: DataFrame, usual: np.ndarray, n_words: int) -> DataFrame:
    """(b, w, n, t): how often a word stands after another, by itself and last, in all texts and in the target's.

    Pairs seen once are counted and then left out, as their discount is their whole count.  A task counts ``_TOKENS``
    words at a time and deals its pairs by their key into parts, of which there are as many as keep
    one in a task's memory; a part travels as one row.
    """
    shipped = flagged.sparkSession.sparkContext.broadcast(usual)
    bits = max(4, int(np.ceil(np.log2(max(n_words, 1) / _PART_WORDS + 1))))

    def dealt(parts: list[tuple]):
        before, word, flags, last = (np.concatenate([p[k] for p in parts]) for k in range(4))
        b = np.concatenate([before, np.full(len(word), _ALONE), np.full(last.sum(), _LAST)])
        w, f = np.concatenate([word, word, word[last]]), np.concatenate([flags, flags, flags[last]])
        del before, word, flags, last
        b, w, n, t = _combined(b, w, np.ones(len(w), np.int64), f.astype(np.int64))
        part = (_pair_key(b, w).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.concatenate([[0], np.nonzero(part[1:] != part[:-1])[0] + 1, [len(part)]])
        blobs = [_packed(b[x:y], w[x:y], n[x:y], t[x:y]) for x, y in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "pairs"])

    def count(batches):
        hashes, parts, held = _Hashes(shipped.value), [], 0
        for batch in by_bytes(batches, 0, 1 << 20):
            before, word, ends = _hashed(hashes, batch.column(0).to_pylist())
            if len(word):
                flags = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                last = np.zeros(len(word), bool)
                last[ends[ends > 0] - 1] = True
                parts.append((before, word, np.repeat(flags, np.diff(ends, prepend=0)), last))
                held += len(word)
            if held >= _TOKENS:
                yield dealt(parts)
                parts, held = [], 0
        if held:
            yield dealt(parts)

    def summed(batches):
        part, held, size = None, [], 0

        def out():
            b, w, n, t = _combined(*[np.concatenate([h[k] for h in held]) for k in range(4)])
            kept = (n > DISCOUNT) | (b == _ALONE) | (b == _LAST)
            return pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (b, w, n, t)], names=["b", "w", "n", "t"])

        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part is not None and p != part:
                    yield out()
                    held, size = [], 0
                part = p
                held.append(_unpacked(blob.as_py()))
                size += len(held[-1][0])
                if size > 4 * _PART_WORDS and len(held) > 1:
                    held = [_combined(*[np.concatenate([h[k] for h in held]) for k in range(4)])]
                    size = len(held[0][0])
        if held:
            yield out()

    parts = flagged.mapInArrow(count, "part int, pairs binary").repartition(1 << bits, "part").sortWithinPartitions("part")
    return parts.mapInArrow(summed, "b long, w long, n long, t long")


def _fit_whole(rows: DataFrame, flagged: DataFrame, head_words: int, head_pairs: int) -> Whole:
    usual, n_words = _usual_words(rows)
    counts = _pair_counts(flagged, usual, n_words)
    counts = counts_staged = settle(counts, "pair-counts")
    if not counts.agg(F.sum("t")).first()[0]:  # no target: both are the background
        counts = counts.withColumn("t", F.col("n"))
    over = lambda c: F.greatest(F.col(c) - F.lit(DISCOUNT), F.lit(0.0))
    both = {"n": "0", "t": "1"}
    each, last = counts.where(F.col("b") == _ALONE), counts.where(F.col("b") == _LAST)
    pairs = counts.where(~F.col("b").isin(_ALONE, _LAST))
    all_of = each.agg(F.count("*"), *[F.coalesce(f, F.lit(0)).cast("double") for c in both for f in (F.sum(c), F.sum(over(c)))]).first()
    size = all_of[0] + 1
    total = {"n": max(all_of[1], 1.0), "t": max(all_of[3], 1.0)}
    left = {"n": 1 - all_of[2] / total["n"], "t": 1 - all_of[4] / total["t"]}
    floor = (F.col("n") + 1) / F.lit(all_of[1] + size)
    # A word is a context as often as it occurs and is not the last; the place before the first is one in each text.
    none = F.lit(0.0)
    parts = [
        each.select(F.col("w").alias("b"), F.col("n").alias("cn"), F.col("t").alias("ct"), none.alias("sn"), none.alias("st")),
        last.select("w", -F.col("n"), -F.col("t"), none, none),
        last.select(F.lit(_START).cast("long"), "n", "t", none, none),
        pairs.select("b", F.lit(0), F.lit(0), over("n"), over("t")),
    ]
    contexts = reduce(DataFrame.unionAll, parts).groupBy("b").agg(*[F.sum(c).cast("double").alias(c) for c in ("cn", "ct", "sn", "st")])
    share_left = lambda c: F.greatest(1 - F.col(f"s{c}") / F.greatest(F.col(f"c{c}"), F.lit(1.0)), F.lit(1e-9))
    contexts = contexts.select("b", *[f"c{c}" for c in both], *[(-F.log(share_left(c))).alias(f"r{k}") for c, k in both.items()])
    contexts = stage(contexts, "contexts")
    values = each.select("w", "n", *[(-F.log(over(c) / F.lit(total[c]) + F.lit(left[c]) * floor)).alias(f"p{k}") for c, k in both.items()])
    rests = contexts.select(F.col("b").alias("w"), "r0", "r1")
    single = stage(values.join(rests, "w"), "word-values")
    known = pairs.join(contexts, "b").join(values.drop("n"), "w")
    share = lambda c: over(c) / F.greatest(F.col(f"c{c}"), F.lit(1.0))
    gain = [(-F.log1p(share(c) * F.exp(F.col(f"r{k}") + F.col(f"p{k}")))).alias(f"v{k}") for c, k in both.items()]
    paired = settle(known.select("b", "w", "n", *gain), "pair-values")

    def split(table: DataFrame, most: int):
        lowest = _lowest_class(table, most)
        if lowest is None:
            return table.where(F.lit(False)), table
        return table.where(_class("n") >= lowest), table.where(_class("n") < lowest)

    (top, other), (top_pairs, other_pairs) = split(single, head_words), split(paired, head_pairs)
    top, top_pairs = top.toArrow().sort_by("w"), top_pairs.toArrow()
    keys = _pair_key(top_pairs["b"].to_numpy(), top_pairs["w"].to_numpy())
    order = np.argsort(keys)
    start = contexts.where(F.col("b") == _START).select("r0", "r1").first() or (0.0, 0.0)
    unseen = -np.log(np.maximum([left["n"], left["t"]], 1e-300) / (all_of[1] + size))
    cells = lambda t, *names: np.stack([t[c].to_numpy() for c in names])
    head = Head(np.array(start, float), unseen, top["w"].to_numpy(), cells(top, "p0", "p1"), cells(top, "r0", "r1"), keys[order], cells(top_pairs, "v0", "v1")[:, order], usual)

    def word_rows(batches):
        for batch in batches:
            w, *v = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            gained = [v[c] + v[c + 2] - unseen[c] for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ((_word_key(w), _last_key(w)), *[(gained[c], -v[c + 2]) for c in (0, 1)])], names=["key", "v0", "v1"])

    def pair_rows(batches):
        for batch in batches:
            b, w = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_pair_key(b, w)), batch.column(2), batch.column(3)], names=["key", "v0", "v1"])

    schema = "key long, v0 double, v1 double"
    staged = [counts_staged, contexts, single, paired]
    if not other.take(1) and not other_pairs.take(1):
        for t in staged:
            discard(t)
        return Whole(head, None)
    rare = other.select("w", "p0", "p1", "r0", "r1").mapInArrow(word_rows, schema)
    table = settle(rare.unionAll(other_pairs.select("b", "w", "v0", "v1").mapInArrow(pair_rows, schema)), "rare-values")
    for t in staged:
        discard(t)
    bits = max(4, int(np.ceil(np.log2(table.count() / _PART_KEYS + 1))))
    return Whole(replace(head, bitmap=key_bitmap(table)), table, bits)


def fit(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    most_words: int | None = None,
    most_pairs: int | None = None,
    head_words: int = HEAD_WORDS,
    head_pairs: int = HEAD_PAIRS,
) -> Whole | Matched:
    """Matched models of all ``documents`` and of those whose key is in ``target``."""
    rows = documents.select(F.col(f"`{key}`").alias("row"), text_of(text).alias("text"))
    marked = target.select(F.col(f"`{key}`").alias("row")).where("row IS NOT NULL").distinct().withColumn("in_target", F.lit(True))
    # The list grows with the corpus: it is broadcast as long as its measured size allows, else both sides are shuffled.
    flagged = join_small(rows, marked, ["row"], "left").select("text", F.coalesce("in_target", F.lit(False)).alias("in_target"))
    if most_words is None and most_pairs is None:
        return _fit_whole(rows, flagged, head_words, head_pairs)
    most_words, most_pairs = (sys.maxsize if m is None else m for m in (most_words, most_pairs))

    def count_words(batches):
        for batch in by_bytes(batches, 0, 16 << 20):
            n = Counter(w for t in batch.column(0).to_pylist() for w in words(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    counts = rows.select("text").mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = settle(counts, "word-counts")
    top = _most_frequent(counts, most_words).select("word", "n").collect()
    ids = {w: k for k, (w, _) in enumerate(sorted(top, key=lambda r: (-r[1], r[0])), 1)}
    size = len(ids) + 1
    shipped = documents.sparkSession.sparkContext.broadcast(ids)

    def combined(keys: list[np.ndarray], flags: list[np.ndarray]):
        pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
        n, t = np.bincount(at, minlength=len(pairs)), np.bincount(at[np.concatenate(flags)], minlength=len(pairs))
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64)), pa.array(t.astype(np.int64))], names=["pair", "n", "t"])

    def count_pairs(batches):
        keys, flags, held = [], [], 0
        for batch in by_bytes(batches, 0):
            ids, ends = flat_ids(shipped.value, batch.column(0).to_pylist())
            if len(ids):
                before = np.concatenate([[_START], ids[:-1]])
                starts = np.concatenate([[0], ends[:-1]])
                before[starts[starts < len(ids)]] = _START
                keys.append(before * size + ids)
                flags.append(np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(bool), np.diff(ends, prepend=0)))
                held += len(ids)
            if held >= _TOKENS:
                yield combined(keys, flags)
                keys, flags, held = [], [], 0
        if held:
            yield combined(keys, flags)

    pairs = flagged.mapInArrow(count_pairs, "pair long, n long, t long").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    pairs = settle(pairs, "pair-counts")
    each = pairs.groupBy((F.col("pair") % size).alias("word")).agg(F.sum("n"), F.sum("t")).collect()
    befores = pairs.groupBy(F.floor(F.col("pair") / size).alias("before")).agg(F.sum("n"), F.sum("t")).collect()
    kept = _most_frequent(pairs, most_pairs).select("pair", "n", "t").toPandas().sort_values("pair")
    return _matched(ids, size, np.array(each, np.int64).reshape(-1, 3), np.array(befores, np.int64).reshape(-1, 3), kept.to_numpy(np.int64).reshape(-1, 3))


def _class(n):
    """Frequency classes, sixteen to an octave, so that there are few of them however large the corpus."""
    return F.floor(F.log2(n) * 16)


def _lowest_class(counts: DataFrame, most: int) -> int | None:
    """The lowest of the highest frequency classes that have at most ``most`` rows together."""
    classes = sorted(counts.groupBy(_class("n").alias("c")).agg(F.count("*").alias("rows")).collect(), reverse=True)
    lowest, total = None, 0
    for c, rows in classes:
        total += rows
        if total > most:
            break
        lowest = c
    return lowest


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows of the highest frequency classes, as many classes as have at most ``most`` rows together."""
    lowest = _lowest_class(counts, most)
    return counts.where(F.lit(False)) if lowest is None else counts.where(_class("n") >= lowest)


def _matched(ids: dict[str, int], size: int, each: np.ndarray, befores: np.ndarray, kept: np.ndarray) -> Matched:
    n = np.zeros((2, size))
    n[:, each[:, 0]] = each[:, 1:].T
    if n[1].sum() == 0:  # no target: both are the background
        n[1], befores, kept = n[0], befores[:, [0, 1, 1]], kept[:, [0, 1, 1]]
    total = np.maximum(n.sum(axis=1, keepdims=True), 1)
    floor = (n[0] + 1) / (n[0] + 1).sum()  # what both models fall back to
    found = np.maximum(n - DISCOUNT, 0) / total
    p = found + (1 - found.sum(axis=1, keepdims=True)) * floor
    context = np.zeros((2, size))
    context[:, befores[:, 0]] = befores[:, 1:].T
    left, right = kept[:, 0] // size, kept[:, 0] % size
    share = np.maximum(kept[:, 1:].T - DISCOUNT, 0) / np.maximum(context[:, left], 1)
    rest = np.ones((2, size))
    for c in (0, 1):
        rest[c] -= np.bincount(left, share[c], size)
    rest = np.maximum(rest, 1e-9)
    return Matched(ids, -np.log(p), -np.log(rest), kept[:, 0], -np.log(share + rest[:, left] * p[:, right]))


_ADDED = ["n_words", "target_loss", "background_loss", "difference"]


def score_texts(df: DataFrame, models: Whole | Matched, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``n_words``, both mean losses per word and their ``difference`` (target less background).

    Without ``keep_text`` the text is left out, and is not carried through the join either.
    """
    if set(_ADDED) & {c.lower() for c in df.columns}:
        raise ValueError(f"a column of {_ADDED} exists already")
    if isinstance(models, Whole):
        return _score_whole(df, models, text, keep_text)
    out = _score_matched(df, models, text)
    return out if keep_text else out.drop(text)


def _score_whole(df: DataFrame, models: Whole, text: str, keep_text: bool) -> DataFrame:
    """The head is looked up where the text is; the rest by parts of the keys.

    A task asks for ``_TOKENS`` keys at a time, in one row a part.  A part's rows of the table come first, so that what is asked
    passes them once, and what comes back is one row a text that asked.  The texts' own rows travel the same way.
    """
    shipped, bits = df.sparkSession.sparkContext.broadcast(models.head), models.bits
    at = df.columns.index(text)
    kept = [c for c in df.columns if keep_text or c != text]
    row, sum0, sum1, part, kind, blob = (temp_name(df, c) for c in ("row", "sum0", "sum1", "part", "kind", "asked"))
    summed_schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name in kept], *as_schema(("n_words", "long"), (sum0, "double"), (sum1, "double"), (row, "long")).fields])
    sent = as_schema((part, "int"), (kind, "int"), (blob, "binary"))

    def run(batches):
        head = shipped.value
        hashes = _Hashes(head.usual)
        first = done = TaskContext.get().partitionId() << 40
        asked, held, types = [], 0, None

        def dealt():
            of, key, times = (np.concatenate([a[k] for a in asked]) for k in range(3))
            parts, blobs = _dealt(key, bits, [(of - first).astype("<u4"), times.astype("<u4")])
            n = len(parts)
            numbers = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array(np.full(n, first))]
            return [*[pa.nulls(n, t) for t in types], *numbers, pa.array(parts), pa.array(np.full(n, _ASKED, np.int32)), pa.array(blobs, pa.binary())]

        for batch in by_bytes(batches, at, 1 << 20):
            sums, n, (of, key, times) = head.sums(hashes, [t or "" for t in batch.column(at).to_pylist()])
            same = [batch.column(k) for k in range(batch.num_columns) if keep_text or k != at]
            types = [c.type for c in same]
            rows = np.arange(done, done + batch.num_rows)
            numbers = [pa.array(n.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), pa.array(rows)]
            to = [pa.array((rows % (1 << bits)).astype(np.int32)), pa.array(np.full(len(rows), _TEXT, np.int32)), pa.nulls(len(rows), pa.binary())]
            yield pa.RecordBatch.from_arrays([*same, *numbers, *to], names=names)
            if len(key):
                asked.append((of + done, key, times))
                held += len(key)
            done += batch.num_rows
            if held >= _TOKENS:
                yield pa.RecordBatch.from_arrays(dealt(), names=names)
                asked, held = [], 0
            if not held:
                first = done
        if held:
            yield pa.RecordBatch.from_arrays(dealt(), names=names)

    def table_rows(batches):
        for held in _together(batches, _TOKENS):
            key, v0, v1 = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(3))
            parts, blobs = _dealt(key, bits, [v0, v1])
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(np.full(len(parts), _TABLE, np.int32)), pa.array(blobs, pa.binary())], names=sent.names)

    def summed(batches):
        of_part, held, table = None, [], None
        for batch in batches:
            kinds = batch.column(names.index(kind)).to_numpy()
            mine = batch.filter(pa.array(kinds == _TEXT))
            if mine.num_rows:
                yield mine.select(names[: -len(sent)])
            for k in np.flatnonzero(kinds != _TEXT).tolist():
                p, b, first = (batch.column(names.index(c))[k].as_py() for c in (part, blob, row))
                if p != of_part:
                    of_part, held, table = p, [], None
                if kinds[k] == _TABLE:
                    held.append(_undealt(b, ["<f8", "<f8"]))
                    continue
                if table is None:
                    key, *value = (np.concatenate([h[c] for h in held] or [np.zeros(0)]) for c in range(3))
                    order = np.argsort(key)
                    table, held = (key[order], *[v[order] for v in value]), []
                key, of, times = _undealt(b, ["<u4", "<u4"])
                place, hit = _found(table[0], key)
                place, of, times = place[hit], of[hit], times[hit]
                texts = np.flatnonzero(np.bincount(of))
                sums = [np.bincount(of, times * v[place])[texts] for v in table[1:]] if len(of) else [np.zeros(0)] * 2
                nulls = [pa.nulls(len(texts), t) for t in batch.schema.types[: len(kept) + 1]]
                yield pa.RecordBatch.from_arrays([*nulls, *[pa.array(x) for x in sums], pa.array(texts + first)], names=names[: -len(sent)])

    schema = T.StructType([*summed_schema.fields, *sent.fields])
    names = schema.names
    scored = df.mapInArrow(run, schema)
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    if models.table is not None:
        rows = scored.unionByName(models.table.mapInArrow(table_rows, sent), allowMissingColumns=True)
        rows = rows.repartition(1 << bits, part).sortWithinPartitions(part, kind).mapInArrow(summed, summed_schema)
        rows = settle(rows, "scored")
        more = rows.where("n_words IS NULL").groupBy(F.col(row).alias("of")).agg(F.sum(sum0).alias("v0"), F.sum(sum1).alias("v1"))
        scored = rows.where("n_words IS NOT NULL")
        more = more.select(*[F.col(c).alias(temp_name(scored, f"{c}_more")) for c in ("of", "v0", "v1")])
        of, v0, v1 = more.columns
        scored = scored.join(more, F.col(row) == F.col(of), "left")
        scored = scored.withColumns({sum0: F.col(sum0) + F.coalesce(v0, F.lit(0.0)), sum1: F.col(sum1) + F.coalesce(v1, F.lit(0.0))})
    losses = {"target_loss": per_word(sum1), "background_loss": per_word(sum0), "difference": per_word(sum1) - per_word(sum0)}
    return scored.withColumns(losses).select(*[f"`{c}`" for c in kept], *_ADDED)


def _together(batches, most: int):
    """Lists of batches that hold about ``most`` rows."""
    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= most:
            yield held
            held, n = [], 0
    if n:
        yield held


def _score_matched(df: DataFrame, models: Matched, text: str) -> DataFrame:
    shipped = df.sparkSession.sparkContext.broadcast(models)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, *as_schema(("n_words", "long"), *[(c, "double") for c in _ADDED[1:]]).fields])

    def run(batches):
        for batch in by_bytes(batches, at):
            loss, n = shipped.value.losses([t or "" for t in batch.column(at).to_pylist()])
            new = [pa.array(n.astype(np.int64)), pa.array(loss[1]), pa.array(loss[0]), pa.array(loss[1] - loss[0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *_ADDED])

    return df.mapInArrow(run, schema)
