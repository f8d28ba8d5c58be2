"""Token counts of a unigram tokenizer by a count-only Viterbi pass.

An Aho-Corasick automaton enumerates the vocabulary's pieces that end at each character; dynamic
programming carries the best score and its number of pieces only, no segmentation.  Ties follow the
tokenizer: the candidates for a place are taken from the earliest start on, and a later one must be
strictly better.  A character that no single piece covers may be taken as unknown, ``UNKNOWN_PENALTY``
below the smallest score, and counts as its UTF-8 bytes.  Words are parted at spaces, with the space as
the mark in front, as the tokenizer's pre-tokenizer does, and a distinct word is segmented once per batch.

Defined results: NULL and empty texts have no tokens; repeated rows count alike; all columns are kept and
an added column whose name is taken is an error; a very long word takes time in proportion to its length.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelfold.llm.common import as_schema, by_bytes

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_KEPT = 1 << 18


def read_vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """(piece, score) of the ordinary pieces of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return tuple(
        (model.id_to_piece(k), model.get_score(k)) for k in ids if not (model.is_unknown(k) or model.is_control(k) or model.is_byte(k) or model.is_unused(k))
    )


class Counter:
    def __init__(self, vocabulary: tuple[tuple[str, float], ...]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, int]] = {}

    def word(self, word: str) -> tuple[int, int]:
        """(tokens, of them bytes of unknown characters)."""
        n = len(word)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        done = 0  # ends up to here are final

        def close(end: int, found: bool, single: bool) -> None:
            if not single:
                candidate = score[end - 1] + self.unknown
                if not found or candidate > score[end]:
                    size = len(word[end - 1].encode("utf-8", "surrogatepass"))
                    score[end], count[end], unknown[end] = candidate, count[end - 1] + size, unknown[end - 1] + size

        found = single = False
        for last, (length, gain) in self.automaton.iter(word):
            end = last + 1
            while done < end - 1:
                done += 1
                close(done, found, single)
                found = single = False
            start = end - length
            candidate = score[start] + gain
            if not found or candidate > score[end]:
                score[end], count[end], unknown[end] = candidate, count[start] + 1, unknown[start]
            found, single = True, single or length == 1
        while done < n:
            done += 1
            close(done, found, single)
            found = single = False
        return count[n], unknown[n]

    def texts(self, texts: list[str]) -> np.ndarray:
        """(tokens, unknown bytes) of each text."""
        if len(self.known) > _KEPT:
            self.known = {}
        out = np.zeros((len(texts), 2), np.int64)
        known = self.known
        for k, text in enumerate(texts):
            if text:
                words = _words(text)
                for w in set(words).difference(known):
                    known[w] = self.word(w)
                out[k] = np.array([known[w] for w in words]).sum(axis=0)
        return out


def _words(text: str) -> list[str]:
    """The text with marks for spaces and one in front, parted before each mark."""
    first, *rest = text.replace(" ", MARK).split(MARK)
    words = [MARK + w for w in rest]
    return [MARK + first, *words] if first or not rest else words


@lru_cache(maxsize=2)
def _counter(vocabulary: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(vocabulary)


def count_tokens(df: DataFrame, vocabulary: tuple[tuple[str, float], ...], text: str = "text", out: str = "n_tokens", unknown: str = "n_unknown_bytes") -> DataFrame:
    """``df`` with the number of tokens of each text, and how many of them are bytes of unknown characters."""
    if {out.lower(), unknown.lower()} & {c.lower() for c in df.columns}:
        raise ValueError("a column of these names exists already")
    shipped = df.sparkSession.sparkContext.broadcast(vocabulary)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, *as_schema((out, "long"), (unknown, "long")).fields])

    def run(batches):
        counter = _counter(shipped.value)
        for batch in by_bytes(batches, at):
            n = counter.texts([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n[:, 0]), pa.array(n[:, 1])], names=[*batch.schema.names, out, unknown])

    return df.mapInArrow(run, schema)
