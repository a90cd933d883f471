import math

import numpy as np
from pyspark.sql import functions as F

from hackney.llm import topk


def _brute(vectors, k):
    fixed = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * x) for x in v]
        fixed[i] = min(fixed.get(i, ints), ints)
    out = []
    for q, a in fixed.items():
        if q % 5:
            continue
        best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in fixed.items()
                      if i != q and len(a) == len(b))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def _run(spark, vectors, k, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<float>, score string, dim int")
    rows = df.select("vec_id", topk.fixed_point(F.col("embedding")).alias("v"))
    found = topk.top_k(rows.where(F.col("vec_id") % 5 == 0), rows, k, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def test_equal_to_brute_force_with_ties_and_odd_rows(spark):
    r = np.random.default_rng(0)
    vectors = [(i, [float(np.float32(x)) for x in r.integers(-3, 4, 6) / 4]) for i in range(400)]  # many ties
    vectors += [(400, None), (401, []), (402, [math.nan] * 6), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (405, [math.inf] * 6),
                (410, [0.5, 0.5]), (411, [1.0, 1.0]), (None, [1.0] * 6), vectors[3], (5, [0.0] * 6)]
    assert _run(spark, vectors, 5, block_rows=90, group_queries=30) == _brute(vectors, 5)
    assert _run(spark, vectors[:3], 5) == _brute(vectors[:3], 5)
    assert _run(spark, [], 5) == []


def test_a_block_stops_early_and_finds_all():
    r = np.random.default_rng(1)
    rows = np.floor(256 * r.standard_normal((3000, 16))).astype(np.int64)
    block = topk.Block(np.arange(3000), rows)
    own = np.arange(0, 3000, 300)
    scores = rows[own] @ rows.T
    want = [[j for j in np.lexsort((np.arange(3000), -s)) if j != i][:5] for i, s in zip(own, scores, strict=True)]
    cold = np.full(len(own), -np.inf)
    floors = np.array([s[w[-1]] for s, w in zip(scores, want, strict=True)], float)
    for start in (cold, floors):  # a tie with the floor still counts
        got = list(block.best(rows[own], own, start, 5))
        assert [ids.tolist() for ids, _ in got] == want
        assert [s.tolist() for _, s in got] == [s[w].tolist() for s, w in zip(scores, want, strict=True)]
    left = block.shortlists(rows[own], own, floors, 5)
    assert np.median([len(x) for x in left]) <= topk.SHORTLIST  # outsiders were ruled out by bounds
