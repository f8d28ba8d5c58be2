"""Cross-entropy differences against a plain computation of both models."""

import math
from collections import Counter

import numpy as np
import pytest

from panelfold.llm import lmscore
from panelfold.llm.common import key_bitmap, may_hold
from panelfold.llm.queries import QUERIES
from panelfold.llm.toxicity import words


def frequent(count, most):
    """Keys of the highest frequency classes that fit whole."""
    level = lambda k: math.floor(math.log2(count[k]) * 16)
    kept = set()
    for c in sorted({level(k) for k in count}, reverse=True):
        more = {k for k in count if level(k) == c}
        if len(kept) + len(more) > most:
            break
        kept |= more
    return kept


def slow_losses(docs, target, most_words, most_pairs, texts):
    """(n, target loss, background loss) of texts, by dictionaries."""
    count = Counter(w for _, t in docs for w in words(t or ""))
    kept = sorted(frequent(count, most_words), key=lambda w: (-count[w], w))
    number = {w: k for k, w in enumerate(kept, 1)}
    ids = lambda t: [number.get(w, 0) for w in words(t or "")]
    both = []
    for chosen in (docs, [d for d in docs if d[0] in target]):
        both.append(Counter((v, w) for _, t in chosen for v, w in zip([0, *ids(t)], ids(t))))
    size = len(kept) + 1
    pairs = frequent(both[0], most_pairs)
    if not both[1]:
        both[1] = both[0]
    d = lmscore.DISCOUNT
    one = [Counter(), Counter()]
    before = [Counter(), Counter()]
    for c in (0, 1):
        for (v, w), n in both[c].items():
            one[c][w] += n
            before[c][v] += n
    floor = [(one[0][w] + 1) / (sum(one[0].values()) + size) for w in range(size)]
    out = []
    for text in texts:
        loss = [0.0, 0.0]
        these = ids(text)
        for v, w in zip([0, *these], these):
            for c in (0, 1):
                total = max(sum(one[c].values()), 1)
                left = 1 - sum(max(n - d, 0) for n in one[c].values()) / total
                p = max(one[c][w] - d, 0) / total + left * floor[w]
                rest = max(1e-9, 1 - sum(max(both[c][q] - d, 0) / max(before[c][v], 1) for q in pairs if q[0] == v))
                share = max(both[c][v, w] - d, 0) / max(before[c][v], 1) if (v, w) in pairs else 0
                loss[c] -= math.log(share + rest * p)
        n = max(len(these), 1)
        out.append((len(these), loss[1] / n, loss[0] / n))
    return out


DOCS = [(1, "the cat sat on the mat the cat sat"), (2, "a dog ran to the cat"), (3, None), (4, ""), (5, "the cat sat on a dog on the mat"), (6, "unseen words only here"), (2, "a dog ran to the cat"), (None, "no id at all")]


@pytest.mark.parametrize("most_words,most_pairs,target", [(100, 100, {1, 2, 77}), (6, 9, {1, 5}), (1, 0, {5}), (50, 50, set())])
def test_against_dictionaries(spark, docs, most_words, most_pairs, target):
    chosen = spark.createDataFrame([(i,) for i in target] + [(None,)], "doc_id long")
    models = lmscore.fit(docs(DOCS), chosen, most_words=most_words, most_pairs=most_pairs)
    texts = [t for _, t in DOCS] + ["something else", "the " * 30_000]
    out = lmscore.score_texts(docs([(k, t) for k, t in enumerate(texts)]), models)
    got = {r.doc_id: (r.n_words, r.target_loss, r.background_loss, r.difference) for r in out.collect()}
    for k, (n, t, b) in enumerate(slow_losses(DOCS, target, most_words, most_pairs, texts)):
        assert got[k][0] == n and np.allclose(got[k][1:], (t, b, t - b))


@pytest.mark.parametrize("head_words,head_pairs", [(1 << 18, 1 << 20), (4, 3), (0, 0), (1 << 18, 0), (0, 1 << 20)])
@pytest.mark.parametrize("target", [{1, 2, 77}, set()])
def test_no_word_or_pair_is_left_out_whatever_is_broadcast(spark, docs, target, head_words, head_pairs):
    chosen = spark.createDataFrame([(i,) for i in target] + [(None,)], "doc_id long")
    models = lmscore.fit(docs(DOCS), chosen, head_words=head_words, head_pairs=head_pairs)
    out = lmscore.score_texts(docs([(k, t) for k, (_, t) in enumerate(DOCS)]), models)
    assert out.columns[:2] == ["doc_id", "text"]
    got = {r.doc_id: (r.n_words, r.target_loss, r.background_loss, r.difference) for r in out.collect()}
    for k, (n, t, b) in enumerate(slow_losses(DOCS, target, 10**9, 10**9, [t for _, t in DOCS])):
        assert got[k][0] == n and np.allclose(got[k][1:], (t, b, t - b))


def test_the_models_grow_with_the_corpus(spark, docs):
    """More words and pairs than the former 32,768 and 262,144: rare ones keep losses of their own."""
    name = lambda k: "".join(chr(97 + (k // 26**i) % 26) for i in range(4))
    rare = [" ".join(name(k) for k in range(a, a + 400)) for a in range(0, 40_000, 400)]
    rows = [(k, t) for k, t in enumerate(rare * 2)] + [(k, " ".join([name(k)] * 3)) for k in range(300, 40_300, 1000)]
    chosen = spark.createDataFrame([(0,), (100,)], "doc_id long")
    out = lmscore.score_texts(docs(rows), lmscore.fit(docs(rows), chosen, head_words=1000, head_pairs=1000)).collect()
    by_text = {r.text: r.difference for r in out}
    assert by_text[rare[0]] < min(by_text[t] for t in rare[1:]) - 1


def test_pairs_travel_unchanged():
    r = np.random.default_rng(4)
    for size in (1, 7, 300):
        for most in (200, 10**9):
            b, w = (np.where(r.random(size) < 0.5, r.integers(-2, 70_000, size), r.integers(-(2**63), 2**63 - 1, size)) for _ in range(2))
            n, t = r.integers(1, most, size), r.integers(0, 2, size)
            rows = lmscore._unpacked(lmscore._packed(b, w, n, t))
            assert sorted(zip(*(c.tolist() for c in rows))) == sorted(zip(*(c.tolist() for c in (b, w, n, t))))


def test_words_are_hashed_as_they_are_split():
    texts = ["", "\u03a3\u0391\u03a3 \u03a3", "\u0130stanbul x_y 1\u00b22 a\u0663b \u2167", "\ud800 a", "a" * 300 + " b a", "ab ba a b", "b"]
    hashes, ends = lmscore._word_hashes(texts)
    assert ends.tolist() == np.cumsum([len(words(t)) for t in texts]).tolist()
    by_word = {}
    for w, h in zip((w for t in texts for w in words(t)), hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    known = lmscore._Hashes(hashes[:3])
    assert known.of(hashes).tolist() == [hashes.tolist().index(h) + 1 if h in hashes[:3] else h for h in hashes.tolist()]


def test_what_is_asked_travels_unchanged():
    r = np.random.default_rng(5)
    for size in (1, 9, 400):
        keys = r.integers(-(2**63), 2**63 - 1, size)
        keys[size // 2 :] = keys[: size - size // 2]
        of, value = r.integers(0, 2**32, size).astype("<u4"), r.normal(size=size)
        parts, blobs = lmscore._dealt(keys, 4, [of, value])
        got = [(int(p), *x) for p, b in zip(parts, blobs) for x in zip(*(c.tolist() for c in lmscore._undealt(b, ["<u4", "<f8"])))]
        assert sorted(got) == sorted((k >> 60, k, o, v) for k, o, v in zip(keys.view(np.uint64).tolist(), of.tolist(), value.tolist()))


def test_no_text_carries_its_keys_through_the_join(spark, docs, monkeypatch):
    """What is kept of the scores is a row a text and one for each part it asked, without any list of keys; other columns stay."""
    texts = [t for _, t in DOCS if t] * 3
    rows = docs(list(enumerate(texts)) + [(None, None), (0, texts[0])])
    models = lmscore.fit(rows, spark.createDataFrame([(1,)], "doc_id long"), head_words=0, head_pairs=0)
    kept = []
    settle = lmscore.settle
    monkeypatch.setattr(lmscore, "settle", lambda df, label: kept.append(settle(df, label)) or kept[-1])
    with_list = rows.selectExpr("*", "array(doc_id) AS list", "named_struct('a', doc_id) AS row")
    out = lmscore.score_texts(with_list, models)
    assert sorted(map(str, out.select(with_list.columns).collect())) == sorted(map(str, with_list.collect()))
    (scored,) = kept
    assert [t for c, t in scored.dtypes if c not in with_list.columns and "<" in t or t == "binary"] == []
    assert scored.count() <= rows.count() * (1 + (1 << models.bits))


def test_bitmap_holds_every_key(spark):
    keys = np.random.default_rng(6).integers(-(2**63), 2**63 - 1, 5000)
    table = spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(3)
    bitmap = key_bitmap(table)
    assert may_hold(bitmap, keys).all()
    assert sum(int(w).bit_count() for w in bitmap) == len(np.unique(keys.view(np.uint64) >> np.uint64(58 - (len(bitmap) - 1).bit_length())))
    assert not key_bitmap(table.limit(0)).any()


def test_empty_tables(spark, docs):
    chosen = spark.createDataFrame([], "doc_id long")
    models = lmscore.fit(docs([]), chosen)
    assert [r.difference for r in lmscore.score_texts(docs([(1, "a b"), (2, None)]), models).collect()] == [0, 0]
    assert lmscore.score_texts(docs([]), models).count() == 0
    with pytest.raises(ValueError):
        lmscore.score_texts(docs([]).withColumnRenamed("h", "Difference"), models)


def test_query(spark, sf):
    rows = QUERIES["op8_lm_score"](spark, sf).toPandas()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").toPandas()["doc_id"]
    assert rows[rows["doc_id"].isin(good)]["difference"].mean() < rows[~rows["doc_id"].isin(good)]["difference"].mean()
