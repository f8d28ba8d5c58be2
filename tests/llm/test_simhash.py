"""SimHash groups against all pairs."""

import random
import re

import pytest
import xxhash

from panelfold.llm import simhash
from panelfold.llm.queries import QUERIES


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def slow_groups(prints, bits):
    """(first id) per row of [(id, fingerprint)], repeated ids joined."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= bits or prints[a][0] == prints[b][0]:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        least[find(k)] = min(least.get(find(k), i), i)
    return [least[find(k)] for k in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "ÄÖ a B c", "a b c d", "a b c d e\x0bF \x1f g", "x " * 5000, "\x85 \xa0 b"])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == slow_fingerprint(text)


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = [(d.doc_id, slow_fingerprint(d.text)) for d in docs]
    want = {i: (f"{f:016x}", g) for (i, f), g in zip(prints, slow_groups(prints, 4))}
    rows = QUERIES["op5_simhash"](spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(docs)


@pytest.mark.parametrize("bits,segments", [(4, 3), (4, 2), (3, 4), (2, 5), (0, 2)])
def test_every_close_pair_is_found(spark, bits, segments):
    r = random.Random(bits)
    prints = [r.getrandbits(64) for _ in range(30)]
    for p in list(prints):
        for n in range(1, 7):
            prints.append(p ^ sum(1 << b for b in r.sample(range(64), n)))
    prints += [0, 2**64 - 1, 1 << 63, prints[0]]
    signed = [p - (p >> 63 << 64) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed] + [(None,)], "fingerprint long")
    found = {(a, b) for a, b in simhash.near_pairs(df, bits=bits, segments=segments).collect()}
    distinct = sorted(set(signed))
    mask = 2**64 - 1
    assert found == {(a, b) for a in distinct for b in distinct if a < b and bin((a ^ b) & mask).count("1") <= bits}


def test_edge_rows(docs):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (5, "a b c d e f g"), (9, None), (8, ""), (7, "  "), (6, "quite another text than that one"), (4, "w " * 30000)]
    out = simhash.near_duplicates(docs(rows)).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.component_id for r in out} == {5: 3, 3: 3, 9: 7, 8: 7, 7: 7, 6: 6, 4: 4}
    assert all(r.fingerprint == 0 for r in out if r.doc_id in (7, 8, 9))
    assert simhash.near_duplicates(docs([])).count() == 0


def test_a_repeated_id_joins_its_rows(docs):
    rows = [(1, "one text of some words"), (2, "two other words in a text"), (2, "one text of some words"), (0, "two other words in a text")]
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(rows)).collect()} == {0: 0, 1: 0, 2: 0}


def test_a_large_group_of_copies(docs):
    rows = [(i, "the same words in each and every one") for i in range(2000)] + [(5000, "but these are other words than those")]
    out = simhash.near_duplicates(docs(rows)).groupBy("component_id").count().collect()
    assert {r.component_id: r["count"] for r in out} == {0: 2000, 5000: 1}
