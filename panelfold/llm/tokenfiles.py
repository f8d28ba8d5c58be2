"""Token-id files: Parquet list columns in document order, with metadata that is read by itself.

``write_tokens`` orders the documents by key, encodes each whole text with a tokenizer file, appends the end id
and writes one row a document: key, other columns, place in the file's part, number of ids, ids.  The ids
are a list column, encoded by a dictionary of each row group's ids and, where that does not pay, as deltas;
row groups and pages are kept small enough that a reader finds single documents by the page index.  A
manifest holds what each part starts at, so that the place of a document among all ids is a sum of two
numbers and no pass over the ids is needed for it.

``TokenFiles.metadata`` reads no ids, ``TokenFiles.read`` reads them for a range of keys only (both filters
reach row groups and pages), and ``checksums`` reads every document's ids back.

Encoding remembers the ids of what stands between two spaces or line feeds: where the tokenizer splits bytes by
the usual pattern, a space or line feed between two other characters always begins a new match.  Other
tokenizers, and texts with several of them in a row, are encoded whole by the library.

Defined results: NULL texts are empty and have the end id alone; documents without a key come first, and
documents of one key stand in the order of their text's hash; repeated rows are as many documents; an
empty table makes files without rows; other columns are kept, a name that the files need is refused.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelfold.llm.common import as_schema, by_bytes, temp_name, text_of

ROW_GROUP = 16 << 20  # bytes
PAGE = 64 << 10  # bytes
PAGE_ROWS = 512  # rows of a page, for the narrow columns
_REMEMBERED = 3 << 18  # stretches whose ids a worker remembers
_BATCH = 4 << 20  # bytes of text encoded at once
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af]+")
# Letters and then signs that make one match; an apostrophe may begin another one.
_ENDED = re.compile(r"(\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af]+)([!-&(-/:-@\[-`{-~]+)")
# Byte-level vocabularies show each byte as a character: printable ones as themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_SPACE, _FEED = chr(_SHOWN[32]), chr(_SHOWN[10])
_ADDED = ("part", "at", "n_tokens", "tokens")


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """Ids of texts, as the library gives them for each whole text; made of a tokenizer file's content."""

    def __init__(self, made: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(made)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.model._resize_cache(0)  # what it would remember is remembered here
        self.known: dict[str, bytes | None] = {}
        self.ends: dict[str, bytes] = {}
        self.by_stretch = self._by_stretch(json.loads(made))
        if self.by_stretch:
            self.split = Tokenizer(self.tokenizer.model)
            self.split.pre_tokenizer = CharDelimiterSplit("\n")
            vocabulary = self.tokenizer.get_vocab()
            # Of ids that begin with a space, or hold a line feed.
            self.spaced, self.fed = np.zeros((2, max(vocabulary.values()) + 1), bool)
            for token, i in vocabulary.items():
                self.spaced[i], self.fed[i] = token[0] == _SPACE, _FEED in token

    def _by_stretch(self, made: dict) -> bool:
        """Whether stretches between spaces can be encoded by themselves."""
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        pre, model = made.get("pre_tokenizer") or {}, made["model"]
        if made.get("normalizer") or made.get("truncation") or any(pre.get(k) != v for k, v in plain.items()):
            return False
        if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return False
        return all(t.get("special") and not t.get("normalized") for t in made.get("added_tokens") or [])

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], before: str, begins: np.ndarray) -> list[bytes]:
        """Ids of words of letters behind a space or line feed; none begins inside a match, so one call gives them for all."""
        if not words:
            return []
        shown = [w if w.isascii() else w.encode().decode("latin-1").translate(_SHOWN) for w in words]
        ids = np.array(self.split.encode_batch_fast([before + f"\n{before}".join(shown)], add_special_tokens=False)[0].ids, "<u4")
        ends = [*(4 * np.nonzero(begins[ids])[0][1:]).tolist(), 4 * len(ids)]
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, stretches: list[str]) -> None:
        """Remember the ids of new stretches; None if white space at an end ties one to its neighbour.

        A stretch has a space before it, or begins with a line feed instead.
        """
        known, ends = self.known, self.ends
        words, lines, ended, others = set(), set(), [], []
        for s in stretches:
            if (s.isascii() and s.isalpha()) or _LETTERS.fullmatch(s):
                words.add(s)
            elif found := _ENDED.fullmatch(s):
                word, end = found.groups()
                ended.append((s, word, end))
                if word not in known:
                    (lines if s[0] == "\n" else words).add(word)
            elif s[:1] == "\n" and _LETTERS.fullmatch(s, 1):
                lines.add(s)
            elif s in ("", "\n") or (s[1].isspace() if s[0] == "\n" else s[0].isspace()) or s[-1].isspace():
                known[s] = None
            else:
                others.append(s)
        each = list(words)
        known.update(zip(each, self._words(each, _SPACE, self.spaced), strict=True))
        each = list(lines)
        known.update(zip(each, self._words([s[1:] for s in each], f"{_FEED}\n", self.fed), strict=True))
        new = list({end for _, _, end in ended} - ends.keys())
        ends.update(zip(new, map(_packed, self._whole(new))))
        for s, word, end in ended:
            known[s] = known[word] + ends[end]
        for s, ids in zip(others, self._whole([s if s[0] == "\n" else f" {s}" for s in others])):
            known[s] = _packed(ids)

    def __call__(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end`` (packed ids), and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not self.by_stretch or not len(texts):
            return _joined([_packed(ids) + end for ids in self._whole(texts.to_pylist())])
        if len(self.known) + len(self.ends) > _REMEMBERED:
            self.known.clear()
            self.ends.clear()
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        n = pc.list_value_length(cut).to_numpy().astype(np.int64)
        start = np.cumsum(n) - n
        flat = cut.flatten()
        coded = flat.dictionary_encode()
        stretches = coded.dictionary.to_pylist()
        ids = list(map(self.known.get, stretches))
        new = [k for k, i in enumerate(ids) if i is None]
        self._learn([s for s in map(stretches.__getitem__, new) if s not in self.known])
        for k in new:
            ids[k] = self.known[stretches[k]]
        # A text's first stretch has no space before it; where white space ends it, or is all there is of another, the text is encoded whole.
        firsts = flat.take(pa.array(start)).to_pylist()
        place = coded.indices.to_numpy().astype(np.int64)
        tied = np.zeros(len(ids), bool)
        tied[[k for k in new if ids[k] is None]] = True
        tied = tied[place]
        tied[start] = [not s or s[-1].isspace() for s in firsts]
        whole = (np.add.reduceat(tied, start, dtype=np.int64) > 0) & (n > 1)
        place[start] = len(ids) + np.arange(len(firsts))
        ids += map(_packed, self._whole(firsts))
        place = np.insert(place, start + n, len(ids))  # the end behind each text
        joined = pa.array([*ids, end], pa.large_binary()).take(pa.array(place))
        edges = np.frombuffer(joined.buffers()[1], np.int64)[: len(place) + 1][np.append(start + np.arange(len(n)), len(place))]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: edges[-1]]
        if not whole.any():
            return data.view("<i4"), np.diff(edges) // 4
        out = [data[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist())]
        again = np.nonzero(whole)[0].tolist()
        for k, of in zip(again, self._whole([texts[k].as_py() for k in again])):
            out[k] = _packed(of) + end
        return _joined(out)


def _joined(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(packed), "<i4"), np.fromiter(map(len, packed), np.int64, len(packed)) // 4


@lru_cache(maxsize=1)
def _encoder(made: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(made)


@dataclass
class TokenFiles:
    """Written token files: ``ids`` holds the documents, ``manifest`` what each part starts at."""

    spark: SparkSession
    path: str
    key: str

    def _rows(self, first, last) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/ids")
        if first is not None:
            rows = rows.where(F.col(f"`{self.key}`") >= F.lit(first))
        if last is not None:
            rows = rows.where(F.col(f"`{self.key}`") <= F.lit(last))
        # One row a part, of which there are as many as tasks wrote.
        parts = self.spark.read.parquet(f"{self.path}/manifest")
        names = [temp_name(rows, c) for c in ("of", "base")]
        placed = rows.join(F.broadcast(parts.select(F.col("part").alias(names[0]), F.col("start").alias(names[1]))), F.col("part") == F.col(names[0]))
        return placed.withColumn("start", F.col(names[1]) + F.col("at")).drop("part", "at", *names)

    def metadata(self, first=None, last=None) -> DataFrame:
        """All but the ids, of documents with a key in [first, last]; no id is read."""
        return self._rows(first, last).drop("tokens")

    def read(self, first=None, last=None) -> DataFrame:
        """Documents with a key in [first, last], with their ids."""
        return self._rows(first, last)

    def checksums(self) -> DataFrame:
        """(key, start, n_tokens, ids_crc32) of every document from the ids read back."""
        rows = self._rows(None, None).select(f"`{self.key}`", "start", "n_tokens", "tokens")
        schema = T.StructType([*rows.schema.fields[:2], *as_schema(("n_tokens", "long"), ("ids_crc32", "long")).fields])

        def run(batches):
            for batch in batches:
                lists = batch.column(3)
                ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
                ends = lists.offsets.to_numpy().tolist()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                n = np.diff(np.array(ends, np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(crc, pa.int64())], names=schema.names)

        return rows.mapInArrow(run, schema)


def _encoded(ordered: DataFrame, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """``ordered`` with its part's number, each document's place in it, the number of ids and the ids."""
    at = ordered.columns.index(text)
    kept = [f for f in ordered.schema.fields if f.name not in (text, "part")]
    schema = T.StructType([*kept, *as_schema(("part", "int"), ("at", "long"), ("n_tokens", "int")).fields, T.StructField("tokens", T.ArrayType(T.IntegerType(), False))])
    end = np.array([end_id], "<u4").tobytes()
    with open(tokenizer, encoding="utf-8") as f:  # a few MB
        shipped = ordered.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encode, place = _encoder(shipped.value), 0
        for batch in by_bytes(batches, at, _BATCH):
            ids, n = encode(batch.column(at), end)
            ends = place + np.cumsum(n)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends - place).astype(np.int32)), pa.array(ids))
            same = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*same, batch.column("part"), pa.array(ends - n), pa.array(n.astype(np.int32)), lists], names=schema.names)
            place = int(ends[-1])

    return ordered.mapInArrow(run, schema)


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> TokenFiles:
    """Write the ids of every text of ``df`` below ``path``, in ascending order of ``key``."""
    if {*_ADDED, "start"} & {c.lower() for c in df.columns if c != text}:
        raise ValueError(f"a column of {_ADDED} or start exists already")
    spark = df.sparkSession
    tie, row = temp_name(df, "tie"), temp_name(df, "row")
    # The hash and the row number let the range be cut inside a key that holds many rows.
    rows = df.withColumn(text, text_of(text)).withColumn(tie, F.xxhash64(F.col(f"`{text}`"))).withColumn(row, F.monotonically_increasing_id())
    order = [F.col(f"`{key}`").asc_nulls_first(), F.col(tie), F.col(row)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(tie, row).withColumn("part", F.spark_partition_id())
    options = {
        "compression": "zstd",
        "parquet.block.size": str(ROW_GROUP),
        "parquet.page.size": str(PAGE),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
        "parquet.writer.version": "PARQUET_2_0",  # deltas where a dictionary grows too large
        "parquet.enable.dictionary": "true",
    }
    _encoded(ordered, text, tokenizer, end_id).write.options(**options).parquet(f"{path}/ids")
    parts = spark.read.parquet(f"{path}/ids").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_documents"), F.min(key).alias("first"), F.max(key).alias("last"))
    # A window over one row a part, after the aggregation.
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.withColumn("start", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{path}/manifest")
    return TokenFiles(spark, path, key)
