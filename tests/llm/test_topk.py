import math
import random

import pytest

from entityframe.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<double>, block int, v string"


def brute(rows, k=20, every=20, scale=64):
    clean = []
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for at, (q, a) in enumerate(clean):
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for other, (i, b) in enumerate(clean) if other != at)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def vectors(n, width=10, seed=0, values=None):
    chance = random.Random(seed)
    draw = (lambda: chance.choice(values)) if values else (lambda: chance.gauss(0, 1))
    return [(i, [draw() for _ in range(width)], 1, "x") for i in range(n)]


@pytest.mark.parametrize("blocks", [{}, {"candidate_block": 30, "query_block": 3, "step": 4}])
@pytest.mark.parametrize("values", [None, [-0.5, 0.0, 0.5]])
def test_matches_brute_force(spark, blocks, values):
    rows = vectors(230, values=values)
    got = exact_top_k(spark.createDataFrame(rows, SCHEMA), **blocks)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(25) + [
        (100, None, 1, "x"), (120, [1.0, None], 1, "x"), (140, [float("nan")], 1, "x"), (160, [float("-inf")], 1, "x"), (None, [1.0], 1, "x"),
        (180, [], 1, "x"), (200, [0.3], 1, "x"), (200, [0.3], 1, "x"), (200, [0.1], 1, "x"), (220, [5.0] * 14, 1, "x"),
    ]
    assert sorted(map(tuple, exact_top_k(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_components_beyond_double_precision(spark):
    rows = [(i, [1e7 + i, -1e6 * i], 1, "x") for i in range(30)]
    assert sorted(map(tuple, exact_top_k(spark.createDataFrame(rows, SCHEMA), k=3).collect())) == brute(rows, 3)


def test_fewer_candidates_than_k_and_empty(spark):
    assert exact_top_k(spark.createDataFrame([(0, [1.0], 1, "x")], SCHEMA)).collect() == []
    assert exact_top_k(spark.createDataFrame([], SCHEMA)).collect() == []
