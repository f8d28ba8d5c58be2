"""The toxicity models' counts, and the quality ensemble's statistics and weights, read a second time."""

import math
import random
import re
import unicodedata
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.llm import quality, toxicity
from panelfold.llm.common import text_of


def by_hand(texts, ids):
    """Log-probabilities of words and of pairs, from the definition: {(class, word)}, {(class, before, word)} with their back-off."""
    lefts, pairs, texts_with, alone = defaultdict(set), defaultdict(int), defaultdict(set), defaultdict(int)
    every = defaultdict(set)
    for k, (text, c) in enumerate(texts):
        words = text.split()
        for w in words:
            alone[c, ids.get(w, 0)] += 1
        for v, w in zip(words, words[1:]):
            if w in ids:
                lefts[c, ids[w]].add(v)
                every[ids[w]].add(v)
                if v in ids:
                    pairs[c, ids[v], ids[w]] += 1
                    texts_with[ids[v], ids[w]].add(k)
    size = len(ids) + 1
    shared = [alone[0, 0] + alone[1, 0]] + [len(every[w]) for w in range(1, size)]
    total = sum(s + 1 for s in shared)
    word, pair, rest = {}, {}, {}
    d = toxicity.DISCOUNT
    for c in (0, 1):
        n = [alone[c, 0]] + [len(lefts[c, w]) if len(every[w]) >= toxicity.LEAST_TEXTS else 0 for w in range(1, size)]
        found = [max(x - d, 0) / sum(n) for x in n]
        for w in range(size):
            word[c, w] = found[w] + (1 - sum(found)) * (shared[w] + 1) / total
        kept = [vw for vw, k in texts_with.items() if len(k) >= toxicity.LEAST_PAIR_TEXTS]
        share = {vw: max(pairs[(c, *vw)] - d, 0) / alone[c, vw[0]] if alone[c, vw[0]] else 0 for vw in kept}
        for v in range(size):
            rest[c, v] = max(1e-6, 1 - sum(s for (b, _), s in share.items() if b == v))
        for v, w in kept:
            pair[c, v, w] = share[v, w] + rest[c, v] * word[c, w]
    return word, pair, rest


def test_kneser_ney_by_hand(spark):
    r = random.Random(6)
    usual, rare = [f"w{chr(97 + k)}" for k in range(12)], [f"r{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    texts = []
    for _ in range(260):
        c = int(r.random() < 0.4)
        words = [r.choice(usual[:8] if c else usual[4:]) if r.random() < 0.9 else r.choice(rare) for _ in range(r.randint(3, 30))]
        texts.append((" ".join(words), c))
    rows = spark.createDataFrame([(k, t, c) for k, (t, c) in enumerate(texts)], "row long, text string, toxic int")
    held = {x.row for x in rows.select("row", F.xxhash64("text").alias("of")).where("pmod(of, 4) = 0").collect()}
    models = toxicity.fit(rows, "toxic")
    counted = [t for k, t in enumerate(texts) if k not in held]
    assert len(set(t for t, _ in texts)) == len(texts)
    word, pair, rest = by_hand(counted, models.ids)
    assert set(models.ids) == {w for w in usual + rare if sum(w in t.split() for t, _ in counted) >= toxicity.LEAST_TEXTS}
    size = len(models.ids) + 1
    for c in (0, 1):
        assert np.allclose(np.exp(models.word[c]), [word[c, w] for w in range(size)])
        assert np.allclose(np.exp(models.rest[c]), [rest[c, v] for v in range(size)])
        assert {(c, *divmod(int(k), size)) for k in models.pairs} == {k for k in pair if k[0] == c} and len(models.pairs)
        assert np.allclose(np.exp(models.pair[c]), [pair[(c, *divmod(int(k), size))] for k in models.pairs])


def test_only_verified_copies_are_merged(spark):
    r = random.Random(7)
    text = lambda: [f"x{r.randint(0, 10**6)}" for _ in range(100)]
    base, licence = text(), text()[:60]
    near = [*base[:99], "other"]
    rows = [(1, base, 0), (2, near, 0), (3, near, 1), (4, [*text(), *licence], 1), (5, [*text(), *licence], 0), (6, base, 0)]
    df = spark.createDataFrame([(k, " ".join(w), y, 10 * k) for k, w, y in rows], "row long, text string, toxic int, of long")
    got = {(x.row, x.toxic) for x in toxicity._without_copies(df).collect()}
    assert got == {(1, 0), (3, 1), (4, 1), (5, 0)}


def plain(text):
    kind = lambda c, *ks: unicodedata.category(c).startswith(ks)
    share = lambda a, b: a / b if b else 0.0
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text.strip(" ")) if w]
    lines = text.split("\n")
    spaces = sum(c in " \t\n\x0b\f\r" for c in text)
    letters, upper, digits = (sum(kind(c, k) for c in text) for k in ("L", "Lu", "Nd"))
    black = len(text) - spaces
    return {
        "log_words": math.log1p(len(words)), "word_length": share(black, len(words)), "letters": share(letters, black), "upper": share(upper, letters),
        "digits": share(digits, black), "symbols": share(black - letters - digits, black), "bars": share(text.count("|"), len(words)),
        "calls": share(text.count("!"), len(words)), "stops": share(text.count("."), len(words)), "distinct_words": share(len(set(words)), len(words)),
        "distinct_lines": share(len(set(lines)), len(lines)), "line_words": share(len(words), len(lines)),
    }


TEXTS = ["", " ", "One two.  Two!", "Ünï çode 12 | x|y\nline\nline\n", "A" * 5000, "日本 語 3!!", "\t\n", None]


def test_statistics_by_hand(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, text string")
    got = df.select("k", *[c.alias(n) for n, c in quality.statistics(text_of("text")).items()]).collect()
    for r in got:
        want = plain(TEXTS[r.k] or "")
        assert all(math.isclose(r[n], v, abs_tol=1e-12) for n, v in want.items()), (r, want)


@pytest.fixture(scope="module")
def fitted(spark):
    r = random.Random(8)
    rows = []
    for _ in range(400):
        good = r.random() < 0.5
        words = ["".join(r.choice("abcdefg") for _ in range(r.randint(2, 9))) for _ in range(r.randint(3, 60))]
        if (not good) ^ (r.random() < 0.1):
            words += ["!!"] * r.randint(2, 9) + [words[0]] * r.randint(3, 20)
        rows.append((" ".join(words), int(good)))
    return rows, quality.fit(spark.createDataFrame(rows, "text string, good int"), "good")


def test_the_weights_are_those_of_the_lasso(fitted):
    rows, ensemble = fitted
    y = np.array([g for _, g in rows], float)
    stats = [plain(t) for t, _ in rows]
    holds = lambda rule, s: all(s[n] <= t if below else s[n] > t for n, below, t in rule)
    marks = np.array([[holds(rule, s) for rule, _ in ensemble.rules] for s in stats], float)
    weights = np.array([w for _, w in ensemble.rules])
    p = 1 / (1 + np.exp(-(ensemble.constant + marks @ weights)))
    slope = marks.T @ (p - y) / len(y)
    # At the optimum the loss's slope balances the penalty's, and the constant has none.
    assert abs((p - y).mean()) < 2e-3 and np.abs(slope + quality.PENALTY * np.sign(weights)).max() < 2e-3
    assert 3 < len(weights) and ((p > 0.5) == y).mean() > 0.8


def test_scores_of_odd_tables(spark, fitted):
    rows, ensemble = fitted
    df = spark.createDataFrame([(1, t, "x") for t in TEXTS] + [(1, rows[0][0], "x")], "doc_id long, text string, statistics string")
    out = quality.score_texts(df, ensemble)
    assert out.columns == [*df.columns, "score"] and all(0 <= r.score <= 1 for r in out.collect()) and out.count() == len(TEXTS) + 1
    assert quality.score_texts(df.where("false"), ensemble).count() == 0
    with pytest.raises(ValueError):
        quality.score_texts(df.withColumnRenamed("statistics", "Score"), ensemble)
