"""Toxicity from class-conditional Kneser-Ney word models.

One interpolated bigram model is counted over toxic and one over ordinary training texts.  Both back off
to the same continuation distribution, so an expression too rare to have been counted reliably is about
as likely under either and says nothing.  A text's evidence is the difference of its two log-likelihoods
per word, over the whole text and over its most telling passage of ``PASSAGE`` words; a logistic
calibration, fitted on training texts that the counts have not seen, turns it into a probability.

The models are fitted on every labelled text of the training part.  What is collected and broadcast is the models:
words and pairs with a count of their own, whose number follows the vocabulary and not the texts.  Counts, the
removal of copies and the calibration are Spark's sums and joins.  Scoring is one pass without a shuffle.

Defined results: NULL and empty texts have log-likelihoods of zero and the score of that evidence; labels
that are NULL are left out, a repeated id counts as toxic if any of its rows is, and copies of a text under
other ids count once for each label they have; with no labelled text of either class every score is the smoothed share of toxic ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.llm.common import as_schema, by_bytes, key_bitmap, may_hold, stage, text_of
from panelfold.operators import sizing
from panelfold.operators.sizing import join_small, row_bytes

LEAST_TEXTS = 6  # texts, and different words before it, that a word needs for a count of its own
LEAST_PAIR_TEXTS = 20  # texts that two words in a row need
DISCOUNT = 2.0
ALIKE = 0.8
_SLICE = 1 << 20  # bytes of text looked at once
LONG = 400  # words
PASSAGE = 1  # words of the passage whose evidence is looked at by itself
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Models:
    """Both models in logarithms; index 0 of the first axis is ordinary, 1 toxic."""

    ids: dict[str, int] = field(default_factory=dict)  # word 0 stands for all rare words
    word: np.ndarray = field(default_factory=lambda: np.zeros((2, 1)))
    rest: np.ndarray = field(default_factory=lambda: np.zeros((2, 1)))  # back-off weight by context
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    passage: int = PASSAGE
    long: int = LONG

    def losses(self, text_words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of every word under both models, and the ends of the texts."""
        ends = np.cumsum([len(w) for w in text_words])
        ids = np.fromiter((self.ids.get(w, 0) for ws in text_words for w in ws), np.int64, int(ends[-1]) if len(ends) else 0)
        out = self.word[:, ids].copy()
        if len(ids) > 1:
            follows = np.ones(len(ids), bool)
            follows[0] = False
            follows[ends[ends < len(ids)]] = False
            at = np.nonzero(follows)[0]
            out[:, at] += self.rest[:, ids[at - 1]]
            if len(self.pairs):
                key = ids[at - 1] * self.word.shape[1] + ids[at]
                slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
                hit = self.pairs[slot] == key
                out[:, at[hit]] = self.pair[:, slot[hit]]
        return out, ends

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Per text: log-likelihood per word (ordinary, toxic), the largest difference per word of a passage, length."""
        each = [words(t) for t in texts]
        losses, ends = self.losses(each)
        sums = np.concatenate([np.zeros((2, 1)), np.cumsum(losses, axis=1)], axis=1)
        gain = sums[1] - sums[0]
        out = np.zeros((len(texts), 4))
        for k, end in enumerate(ends.tolist()):
            n = len(each[k])
            if n:
                start, span = end - n, min(n, self.passage)
                out[k, :2] = (sums[:, end] - sums[:, start]) / n
                out[k, 2] = (gain[start + span : end + 1] - gain[start : end + 1 - span]).max() / self.passage
                out[k, 3] = np.log1p(n)
        return out

    def features(self, evidence: np.ndarray) -> np.ndarray:
        # Lengths beyond the usual say no more: the calibration has hardly seen any.
        length = np.minimum(evidence[:, 3], np.log1p(self.long))
        return np.column_stack([np.ones(len(evidence)), 10 * (evidence[:, 1] - evidence[:, 0]), 10 * evidence[:, 2], length])

    def score(self, evidence: np.ndarray) -> np.ndarray:
        z = self.features(evidence) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logistic(rows: DataFrame, x: list[str], y: str, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton's method on the few columns ``x``; each step's sums are one aggregation."""
    w = np.zeros(len(x))
    upper = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    for _ in range(50):
        z = reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(v)) for c, v in zip(x, w)])
        p = 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))
        at = rows.select(*x, y, p.alias("__p"))
        slope = [F.sum(F.col(c) * (F.col("__p") - F.col(y))) for c in x]
        bend = [F.sum(F.col(x[i]) * F.col(x[j]) * F.col("__p") * (1 - F.col("__p"))) for i, j in upper]
        sums = [float(v) for v in at.agg(*slope, *bend).first()]
        hessian = ridge * np.eye(len(x))
        for (i, j), v in zip(upper, sums[len(x) :]):
            hessian[i, j] += v
            hessian[j, i] += v if i != j else 0.0
        step = np.linalg.solve(hessian, np.array(sums[: len(x)]) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(rows: DataFrame, labels: DataFrame, label: str, keep, key: str = "doc_id", most: int | None = None, of=F.max) -> DataFrame:
    """The labelled ones of ``rows``, whose id is ``row``, with their label.

    ``of`` reduces the labels of a repeated id.  The list grows with the corpus, the rows may be whole texts: a list of up to
    ``BROADCAST_BYTES`` goes to where the rows are, a longer one first rules out there all rows it cannot hold,
    so that beside the list little more than the labelled rows is shuffled.
    """
    chosen = labels.where(keep & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(of(label).cast("int").alias(label))
    if most is not None:
        chosen = chosen.orderBy(F.xxhash64(F.lit(7), key), key).limit(most)
    chosen = stage(chosen.withColumnRenamed(key, "row"), "labelled")
    n = chosen.count()
    if n * row_bytes(chosen) > sizing.BROADCAST_BYTES:
        rows = _possible(rows, chosen)
    return join_small(rows, chosen, ["row"], known_rows=n)


def _possible(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` without those that a bitmap of the chosen ids' hashes rules out; only hashes go to Python."""
    hashed = F.xxhash64(F.col("row").cast("string"))
    shipped = rows.sparkSession.sparkContext.broadcast(key_bitmap(chosen.select(hashed.alias("key"))))

    def possible(keys: pa.Array) -> pa.Array:
        return pa.array(may_hold(shipped.value, keys.to_numpy(zero_copy_only=False)))

    return rows.where(F.arrow_udf(possible, "boolean")(hashed))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, keep, key: str = "doc_id", text: str = "text", most: int | None = None, of=F.max) -> DataFrame:
    """(row, text, label) of every labelled document, or of at most ``most`` of them with the smallest hash of their id.

    ``of`` reduces the labels of a repeated id.
    """
    rows = documents.select(F.col(f"`{key}`").alias("row"), text_of(text).alias("text"))
    return labelled(rows, labels, label, keep, key, most, of)


def fit(training: DataFrame, label: str) -> Models:
    """Models from rows of ``row``, ``text`` and a 0/1 ``label``."""
    rows = stage(training.select("row", "text", F.col(label).cast("int").alias("toxic"), F.xxhash64("text").alias("of")), "training")
    rows = _without_copies(rows).select("text", "toxic", (F.pmod("of", F.lit(4)) == 0).alias("held"))
    counted = rows.where("NOT held").select("text", "toxic")

    def texts_with(batches):
        for batch in by_bytes(batches, 0):
            n = Counter(w for t in batch.column(0).to_pylist() for w in set(words(t)))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "texts"])

    frequent = counted.mapInArrow(texts_with, "word string, texts long").groupBy("word").agg(F.sum("texts").alias("texts"))
    frequent = sorted(r[0] for r in frequent.where(F.col("texts") >= LEAST_TEXTS).select("word").collect())
    shipped = rows.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(frequent, 1)})

    def pairs(batches):
        ids = shipped.value
        for batch in by_bytes(batches, 0):
            for toxic in (0, 1):
                keys = [
                    _pair_keys([ids.get(w) or -3 - zlib.crc32(w.encode()) for w in words(t)])
                    for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    if c == toxic
                ]
                if keys:
                    # one number a pair: sorting numbers costs a fraction of sorting rows
                    keys = [(k[:, 0] + _LOWEST << _WORD_BITS) | k[:, 1] for k in keys]
                    every, n = np.unique(np.concatenate(keys), return_counts=True)
                    _, texts = np.unique(np.concatenate([np.unique(k) for k in keys]), return_counts=True)
                    before, word = (every >> _WORD_BITS) - _LOWEST, every & (1 << _WORD_BITS) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(before), pa.array(word.astype(np.int32)), pa.array(n * (1 - toxic)), pa.array(n * toxic), pa.array(texts)],
                        names=["before", "word", "n0", "n1", "texts"],
                    )

    counts = counted.mapInArrow(pairs, "before long, word int, n0 long, n1 long, texts long").groupBy("before", "word")
    counts = stage(counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("texts").alias("texts")), "pair-counts")
    models = _assemble(counts, shipped.value)
    _calibrate(models, rows.where("held").drop("held"), rows)
    return models


_ALONE = -1  # stands before a word for the word by itself
_LOWEST, _WORD_BITS = 1 << 33, 29  # what makes every word before another positive, and the bits of a word's number


def _pair_keys(ids: list[int]) -> np.ndarray:
    """(word before, word) of a text, and each word alone; a rare word is 0, but keeps its identity before another."""
    ids = np.array(ids, np.int64)
    word = np.maximum(ids, 0)
    follows = word[1:] > 0
    before = np.concatenate([np.full(len(ids), _ALONE), ids[:-1][follows]])
    return np.column_stack([before, np.concatenate([word, word[1:][follows]])])


def _without_copies(rows: DataFrame) -> DataFrame:
    """The rows of one text of each group of copies with one label.

    Copies in the training rows would make every word of a copied text look like a sign of its class.  Two texts
    are copies if their sets of five-word shingles are alike to ``ALIKE`` or more; each is compared with the
    first text that has one of three smallest shingle hashes in common with it, so at that likeness 99 of 100 are found.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - 4)), lambda i: F.xxhash64(F.array_join(F.slice("w", i, 5), " "))
    )
    seeds = (1, 2, 3)
    every = rows
    texts = rows.select(F.struct("of", "row").alias("me"), "toxic", F.split(F.lower(F.trim("text")), r"\s+").alias("w"))
    shingles = texts.withColumn("h", F.array_distinct(hashes))
    least = [F.array_min(F.transform("h", lambda x, s=s: F.xxhash64(x, F.lit(s)))).alias(f"m{s}") for s in seeds]
    # Only the three smallest hashes are kept; the shingles of the few texts that are compared are made once more.
    rows = stage(shingles.select("me", "toxic", *least).dropDuplicates(["me"]), "shingles")
    pairs = []
    for s in seeds:
        first = rows.groupBy(f"m{s}", "toxic").agg(F.min("me").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        pairs.append(rows.select("me", "toxic", f"m{s}").join(first, [f"m{s}", "toxic"]).where("me <> first").select("me", "first"))
    pairs = stage(reduce(DataFrame.unionAll, pairs).distinct(), "alike")
    one = join_small(texts, pairs, ["me"], known_rows=pairs.count()).select("me", "first", F.array_distinct(hashes).alias("h"))
    other = join_small(texts, pairs.select(F.col("first").alias("me")).distinct(), ["me"]).select(F.col("me").alias("first"), F.array_distinct(hashes).alias("g"))
    met = one.join(other, "first").where(F.size(F.array_intersect("h", "g")) >= ALIKE * F.size(F.array_union("h", "g")))
    return join_small(every, met.select("me.row", "me.of").distinct(), ["row", "of"], "left_anti")


def _assemble(counts: DataFrame, ids: dict[str, int]) -> Models:
    size = len(ids) + 1
    alone = counts.where(F.col("before") == _ALONE).select("word", "n0", "n1").toPandas()
    context = np.zeros((2, size))
    context[:, alone["word"]] = alone[["n0", "n1"]].to_numpy(float).T
    # Kneser-Ney's lower order: a word counts once for each different word before it, per class and over both.
    # Rare words stand for many, so their occurrences count.
    lefts = counts.where(F.col("before") != _ALONE).groupBy("word")
    lefts = lefts.agg(*[F.count(F.when(F.col(f"n{c}") > 0, 1)).alias(f"n{c}") for c in (0, 1)], F.count("*").alias("lefts")).toPandas()
    n = np.zeros((2, size))
    n[:, lefts["word"]] = lefts[["n0", "n1"]].to_numpy(float).T
    n[:, 0] = context[:, 0]
    shared = np.zeros(size)
    shared[lefts["word"]] = lefts["lefts"].to_numpy(float)
    few = np.append(False, shared[1:] < LEAST_TEXTS)  # always after the same words: no evidence of its own
    shared[0] = context[:, 0].sum()
    n[:, few] = 0
    shared = (shared + 1) / (shared + 1).sum()
    kept = n.sum(axis=1, keepdims=True)
    if not (kept > 0).all():
        return Models()
    found = np.maximum(n - DISCOUNT, 0) / kept
    p = found + (1 - found.sum(axis=1, keepdims=True)) * shared
    pairs = counts.where((F.col("before") > 0) & (F.col("texts") >= LEAST_PAIR_TEXTS)).select("before", "word", "n0", "n1").toPandas()
    left, right = pairs["before"].to_numpy(np.int64), pairs["word"].to_numpy(np.int64)
    seen = pairs[["n0", "n1"]].to_numpy(float).T
    share = np.where(context[:, left] > 0, np.maximum(seen - DISCOUNT, 0) / np.maximum(context[:, left], 1), 0)
    rest = np.ones((2, size))
    for c in (0, 1):
        rest[c] -= np.bincount(left, share[c], size)
    rest = np.maximum(rest, 1e-6)
    key = left * size + right
    order = np.argsort(key)
    return Models(ids, np.log(p), np.log(rest), key[order], np.log(share + rest[:, left] * p[:, right])[:, order], passage=PASSAGE, long=LONG)


def _calibrate(models: Models, held: DataFrame, rows: DataFrame) -> None:
    shipped = held.sparkSession.sparkContext.broadcast(models)
    x = ["x0", "x1", "x2", "x3"]

    def run(batches):
        for batch in by_bytes(batches, 0, _SLICE):
            f = shipped.value.features(shipped.value.evidence(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(f[:, k]) for k in range(4)] + [batch.column(1)], names=[*x, "toxic"])

    found = stage(held.mapInArrow(run, "x0 double, x1 double, x2 double, x3 double, toxic int"), "evidence")
    toxic, n = found.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    if len(models.ids) == 0 or not 0 < toxic < n:
        share = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
        models.weights = np.array([np.log((share[0] + 1) / (share[1] - share[0] + 1)), 0, 0, 0])
        if len(models.ids):
            models.weights[2] = 1.0
    else:
        models.weights = _logistic(found, x, "toxic")


def score_texts(df: DataFrame, models: Models, text: str = "text", score: str = "score", details: bool = False) -> DataFrame:
    """``df`` with each text's probability of being toxic, and on request both log-likelihoods per word."""
    added = [score, *(["toxic_loglik", "ordinary_loglik"] if details else [])]
    if {c.lower() for c in added} & {c.lower() for c in df.columns}:
        raise ValueError(f"a column of {added} exists already")
    shipped = df.sparkSession.sparkContext.broadcast(models)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, *as_schema(*[(c, "double") for c in added]).fields])

    def run(batches):
        for batch in by_bytes(batches, at, _SLICE):
            e = shipped.value.evidence([t or "" for t in batch.column(at).to_pylist()])
            new = [pa.array(shipped.value.score(e))] + ([pa.array(e[:, 1]), pa.array(e[:, 0])] if details else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *added])

    return df.mapInArrow(run, schema)
