"""Benchmark items in documents against a plain reading of the rules."""

import random
import re
from collections import Counter

import pytest

from panelfold.llm import decontaminate as D
from panelfold.llm.queries import QUERIES


def slow_words(text):
    """(template words, words with slot values) by Python's regular expressions."""
    text = text or ""
    for pattern, replacement in D.RULES:
        for group, chars in (("L", r"[^\W\d_]"), ("Nd", r"\d")):
            pattern = pattern.replace(rf"[^\p{{{group}}}]", f"(?!{chars})[\\s\\S]")
        text = regex_sub(pattern, replacement, text)
    words = text.lower().strip(" ").split(" ") if text.strip(" ") else []
    return [w[0] if w[0] in D.NUMBER + D.UNIT + D.NAME else w for w in words], words


def regex_sub(pattern, replacement, text):
    import regex

    return regex.sub(pattern.replace("(?!", "(?!"), re.sub(r"\$(\d)", r"\\\1", replacement), text)


def slow_find(docs, items):
    out = {}
    slots = set(D.NUMBER + D.UNIT + D.NAME)
    for item, text in items:
        template, values = slow_words(text)
        n = max(1, len(template) - D.WINDOW + 1) if template else 0
        windows = {k: tuple(template[k : k + D.WINDOW]) for k in range(n) if any(w not in slots for w in template[k : k + D.WINDOW])}
        for doc, body in docs:
            words, filled = slow_words(body)
            at = {}
            for k in range(max(1, len(words) - D.WINDOW + 1) if words else 0):
                at.setdefault(tuple(words[k : k + D.WINDOW]), []).append(k)
            hits = [(k, p) for k, w in windows.items() for p in at.get(w, ())]
            if not hits:
                continue
            shifts = Counter(p - k for k, p in hits)
            shift = min(shifts, key=lambda s: (-shifts[s], s))
            matched = {k for k, p in hits if abs(p - k - shift) <= D.NEAR}
            if not (len(matched) >= D.LEAST_COVERAGE * len(windows) or len(matched) >= D.LEAST_RUN):
                continue
            places = {k for k, p in hits if p - k == shift}
            filling = {}
            for s, v in enumerate(values):
                if v[0] in slots and any(k <= s < k + D.WINDOW for k in places):
                    filling.setdefault(v, []).append(filled[s + shift])
            total = sum(map(len, filling.values()))
            agreed = sum(max(Counter(f).values()) for f in filling.values())
            if agreed >= D.LEAST_CONSISTENT * total:
                out[doc, item] = (len(windows), len(matched), total, agreed)
    return out


ITEMS = [
    (1, "If Anna buys 12 apples for 3 dollars and then Bernd sells 5 of the apples to Anna, how many apples does Anna have after 3 days?"),
    (2, "The quick brown fox jumps over the lazy dog while the other animals of the farm sleep"),
    (3, "short one"),
    (4, None),
    (5, "1 2 3 4 5 6 7"),
    (6, "A train travels 120.5 km in 2 hours and 30 minutes; what is the mean speed of the train in km per hour, asked Clara of David?"),
]
DOCS = [
    (1, "Some text before. If Otto buys 40 apples for 7 dollars and then Emil sells 9 of the apples to Otto, how many apples does Otto have after 7 days? And after."),
    (2, "Some text before. If Otto buys 40 apples for 7 dollars and then Emil sells 9 of the apples to Paul, how many apples does Ida have after 8 days? And after."),
    (3, "we saw THE QUICK, brown fox jumps over the lazy dog while the other animals of the farm sleep!"),
    (4, "the quick brown fox jumps over a fence and goes home to sleep"),
    (5, "short one"),
    (6, "this is a short one indeed, my friend"),
    (7, None),
    (8, ""),
    (9, "9 8 7 6 5 4 3 2 1"),
    (10, "x " * 20000 + "A train travels 99,5 miles in 3 hours and 20 minutes; what is the mean speed of the train in miles per hour, asked Emma of Fritz?"),
    (3, "we saw the quick brown fox jumps over the lazy dog while the other animals of the farm sleep"),
]


def test_against_a_plain_reading(spark, docs):
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, at int")
    unique = [d for k, d in enumerate(DOCS) if k != 10]
    rows = D.find_items(docs(unique), benchmark).collect()
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched, r.n_slots, r.n_consistent) for r in rows}
    assert got == slow_find(unique, [i for i in ITEMS if i[1]]) and len(rows) == len(got)
    assert (1, 1) in got and (2, 1) not in got and (3, 2) in got and (4, 2) not in got and (5, 3) in got and (10, 6) in got
    assert {d for d, _ in got} == {1, 3, 5, 10}


def test_without_broadcast(spark, docs, monkeypatch):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(D.find_items(docs(DOCS), benchmark).collect())
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert sorted(D.find_items(docs(DOCS), benchmark).collect()) == want


def test_windows_count_in_one_alignment(spark, docs):
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(160)]
    item = " ".join(words)
    parted = " ".join(" ".join([*words[k : k + 7], *["between"] * 20]) for k in range(0, 160, 7))  # 66 of 156 windows, none near another
    slipped = " ".join([*words[:80], "extra", *words[80:]])
    rows = D.find_items(docs([(1, parted), (2, slipped)]), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.n_matched) for r in rows] == [(2, 152)]


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.find_items(docs(DOCS), empty).count() == 0
    assert D.find_items(docs([]), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op9_decontaminate"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = QUERIES["op9_decontaminate"](spark, sf).collect()
    assert {(r.doc_id, r.item_id): (r.n_windows, r.n_matched, r.n_slots, r.n_consistent) for r in rows} == slow_find(docs, items)


@pytest.mark.parametrize(
    "text,want",
    [
        ("He paid 1,234.50 dollars", ["he", "paid", "123450", "dollars"]),
        ("then John Smith went, and Mary", ["then", "john", "smith", "went", "and", "mary"]),
        ("7% of x2 and 3.", ["7", "%", "of", "x2", "and", "3"]),
        ("ab", ["a", "b"]),
    ],
)
def test_canonical(spark, text, want):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(text,)], "text string").select(D.canonical(F.col("text")).alias("c"))
    assert df.first()[0].split(" ") == want


def test_random_reparametrised_items(spark, docs):
    r = random.Random(3)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    items, rows = [], []
    for i in range(20):
        template = [r.choice(["N", "P", *r.sample(words, 6)]) for _ in range(30)]
        fill = lambda n, p: " ".join(str(n) if w == "N" else p if w == "P" else w for w in template)  # noqa: E731,B023
        items.append((i, "start " + fill(17, "Anna")))
        rows.append((i, " ".join(r.choices(words, k=40)) + " start " + fill(r.randint(100, 999), "Berta") + " " + " ".join(r.choices(words, k=40))))
        rows.append((100 + i, " ".join(r.choices(words, k=120))))
    found = D.find_items(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((f.doc_id, f.item_id) for f in found) == [(i, i) for i in range(20)]
