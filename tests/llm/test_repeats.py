"""Removal of repeated strings against a count of every window."""

import collections
import hashlib
import random

import numpy as np
import pytest

from panelfold.llm import repeats
from panelfold.llm.queries import QUERIES


def slow(texts, width):
    """Per text, what stays and the spans that go."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[k : k + width] for d in data for k in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - width + 1):
            if count[d[k : k + width]] > 1:
                gone[k : k + width] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        out.append((bytes(np.frombuffer(d, np.uint8)[~gone]), list(zip(edge[::2].tolist(), edge[1::2].tolist()))))
    return out


def check(df, rows, width):
    got = {r.doc_id: (bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in repeats.remove_repeats(df, width=width).collect()}
    assert got == {i: w for (i, _), w in zip(rows, slow([t for _, t in rows], width))}


def test_index_against_counts():
    r = random.Random(3)
    for alphabet in (b"ab", b"abcdefgh \x00\xff"):
        for _ in range(60):
            base = [bytes(r.choice(alphabet) for _ in range(r.randint(5, 60))) for _ in range(3)]
            made = set()
            for _ in range(r.randint(1, 15)):
                one = bytearray(r.choice(base) + r.choice(base))
                for _ in range(r.randint(0, 3)):
                    one[r.randrange(len(one))] = r.choice(alphabet)
                made.add(bytes(one))
            made = sorted(c for c in made if len(c) >= 8)
            if not made:
                continue
            copies = [r.choice([1, 1, 2]) for _ in made]
            count = collections.Counter()
            for c, n in zip(made, copies):
                for k in range(len(c) - 7):
                    count[c[k : k + 8]] += n
            for c, marks in zip(made, repeats.repeated_windows(made, copies, 8)):
                assert marks.tolist() == [count[c[k : k + 8]] > 1 for k in range(len(c) - 7)]


def texts():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(2, 9)))
    passage = [" ".join(word() for _ in range(n)) for n in (45, 60, 120, 300)]
    rows = []
    for i in range(60):
        body = [" ".join(word() for _ in range(r.randint(0, 120)))]
        for _ in range(r.randint(0, 2)):
            body.insert(r.randint(0, len(body)), r.choice(passage))
        rows.append((i, "".join(body)))
    rows += [(60, "For " * 900), (61, "x" * 2500), (62, None), (63, ""), (64, passage[3]), (65, passage[3]), (66, "é" * 150), (67, "y" * 199), (68, "ab" * 100 + "a")]
    return rows


def test_against_counts(docs):
    check(docs(texts()), texts(), 200)


def test_hot_strings_are_split_further(docs, monkeypatch):
    monkeypatch.setattr(repeats, "MOST", 2)  # read on the driver
    r = random.Random(9)
    shared = "".join(r.choice("abcdefgh ") for _ in range(260))
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(230)) + shared + "".join(r.choice("abcdefgh ") for _ in range(230))) for i in range(30)]
    # pairs that also share some of what surrounds the passage
    rows += [(100 + i, rows[i][1][150:] + "tail") for i in range(6)]
    check(docs(rows), rows, 200)


def test_long_texts_are_looked_at_in_segments(docs, monkeypatch):
    r = random.Random(11)
    text = "".join(r.choice("abcdefghij") for _ in range(4000))
    data = [(text[:3000] + text[500:900]).encode(), text[2500:].encode()]
    whole = sorted(zip(*[np.concatenate(c).tolist() for c in zip(*repeats._text_runs(data, 200))]))
    monkeypatch.setattr(repeats, "_SEGMENT", 700)
    windows = collections.Counter()
    for row, start, n, h, d in sorted(zip(*[np.concatenate(c).tolist() for c in zip(*repeats._text_runs(data, 200))])):
        windows.update((row, start + k, h, d - k) for k in range(n))
    want = collections.Counter((row, start + k, h, d - k) for row, start, n, h, d in whole for k in range(n))
    assert windows == want and len(want) == sum(len(x) - 199 for x in data)


def test_repeated_rows_null_keys_and_nothing(spark, docs):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(250))
    other = "".join(random.Random(2).choice("abcdefgh") for _ in range(250))
    out = repeats.remove_repeats(docs([(1, text), (1, text), (None, other), (2, other), (None, None), (3, other[:199])]))
    assert out.columns == ["doc_id", "text", "h", "row_key", "first", "score_", "kept", "spans"]
    assert sorted((r.doc_id or -1, len(r.kept), len(r.spans)) for r in out.collect()) == [(-1, 0, 0), (-1, 0, 1), (1, 0, 1), (1, 0, 1), (2, 0, 1), (3, 199, 0)]
    assert repeats.remove_repeats(docs([])).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs([]), kept="H")


def test_cut_characters_go_whole(docs):
    shared = "z" * 3 + "".join(random.Random(1).choice("abcdefgh") for _ in range(250))
    rows = [(1, "é" + shared), (2, "è" + shared)]  # the second byte of both letters differs, the first does not
    rows += [(3, "ü" + "q" * 5), (4, "x")]
    out = {r.doc_id: r.kept for r in repeats.remove_repeats(docs(rows), as_text=True).collect()}
    assert out == {1: "é", 2: "è", 3: "üqqqqq", 4: "x"}


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (len((t or "").encode()), len((t or "").encode()) - len(k), len(s), hashlib.sha256(k).hexdigest()) for (i, t), (k, s) in zip(rows, slow([t for _, t in rows], 200))}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_suffix_dedup"](spark, sf).collect()} == want


def test_equal_rows_have_the_marks_of_one(spark, monkeypatch):
    r = random.Random(11)
    text = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(600))
    other = text[:2000] + "x" + text[2001:]
    sizes = []
    cut = repeats._cut

    def counted(df, marks, *rest):
        sizes.append(marks.selectExpr("max(size(marks))").first()[0])
        return cut(df, marks, *rest)

    monkeypatch.setattr(repeats, "_cut", counted)
    for ids in ([1] * 200, [None] * 200, range(200)):
        rows = [(i, text) for i in ids] + [(1000, other)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = repeats.remove_repeats(df).collect()
        want = dict(zip([t for _, t in rows[-2:]], slow([text, *[t for _, t in rows[-2:]]], 200)[1:]))
        assert len(got) == 201 and all(bytes(g.kept) == want[g.text][0] for g in got)
    assert max(sizes) < 2 * len(text) / 100  # about one run in 137 bytes, however many rows
