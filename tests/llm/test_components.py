import random

from panelfold.llm.components import components


def test_against_union(spark):
    r = random.Random(4)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = {n: find(n) for n in root}
    df = spark.createDataFrame(pairs + [(None, 1), (2, None)], "a long, b long")
    got = components(df).collect()
    assert {g.node: g.component for g in got} == want and len(got) == len(want)


def test_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
