import math
import random

import numpy as np
import pytest

from entityframe.llm.hard_negatives import Anchor, Block, ScoreWindow, _pack_block, hard_negatives, narrowing, scan_windows

SCHEMA = "vec_id long, label int, embedding array<double>, rid int, block string, chunk int, score long"


def clip(x):
    return min(max(x, -(1 << 63)), (1 << 63) - 1)


def brute(rows, every=100, scale=256, k=5):
    clean = []
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.append((i, label, [clip(math.floor(scale * x)) for x in v]))
    out = []
    for n, (a, label, v) in enumerate(clean):
        if a % every:
            continue
        scored = [(-clip(sum(x * y for x, y in zip(v, w))), i, m, other) for m, (i, other, w) in enumerate(clean) if m != n]
        best = sorted(s for s in scored if s[3] == label)[:k]
        for p, positive, *_ in best:
            inside = sorted(s for s in scored if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:k]
            out += [(a, positive, r + 1, i, -p, -s) for r, (s, i, *_) in enumerate(inside)]
    return sorted(out)


def vectors(n, width=12, labels=4, seed=0, values=None):
    chance = random.Random(seed)
    draw = (lambda: chance.choice(values)) if values else (lambda: chance.gauss(0.2, 1))
    return [(i, chance.randrange(labels), [draw() for _ in range(width)], 1, "b", 2, 3) for i in range(n)]


def got(spark, rows, **options):
    return sorted(map(tuple, hard_negatives(spark.createDataFrame(rows, SCHEMA), **options).collect()))


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "chunk_rows": 2, "step": 5}])
@pytest.mark.parametrize("values", [None, [0.0, 0.5, 1.0]])
def test_matches_brute_force(spark, options, values):
    rows = vectors(420, values=values)
    want = brute(rows, every=20)
    assert len(want) > 100
    assert got(spark, rows, every=20, **options) == want


def test_odd_rows(spark):
    more = [
        (500, 1, None), (600, 1, [1.0, None]), (700, 1, [float("nan")]), (800, 1, [float("inf")]), (None, 1, [1.0]), (900, None, [1.0]),
        (1000, 1, []), (1100, 1, [0.5]), (1200, 2, [3.0] * 20), (100, 1, [0.4] * 12), (100, 2, [0.4] * 12), (101, 1, [0.4] * 12), (101, 1, [0.4] * 12), (1300, 77, [1.0]),
    ]
    rows = vectors(200, seed=3) + [(*r, 1, "b", 2, 3) for r in more]
    assert got(spark, rows) == brute(rows)


def test_components_beyond_64_bits_in_their_sum(spark):
    rows = [(i, i % 3, [1e7 + i, -1e13 * (i % 5), 4e15], 1, "b", 2, 3) for i in range(60)]
    rows += [(100 + i, i % 2, [1e30, -1.0 * i], 1, "b", 2, 3) for i in range(5)]
    assert got(spark, rows, every=20) == brute(rows, every=20)


def test_labels_alone_and_no_rows(spark):
    assert got(spark, [(0, 1, [1.0], 1, "b", 2, 3)]) == []
    assert got(spark, [(0, 1, [1.0], 1, "b", 2, 3), (1, 2, [1.0], 1, "b", 2, 3)]) == []
    assert got(spark, [(1, 1, [1.0], 1, "b", 2, 3)]) == []
    assert got(spark, []) == []


def block_of(matrix, labels):
    import pandas as pd

    n = len(matrix)
    return Block(_pack_block(pd.DataFrame({"rid": range(n), "vec_id": range(n), "label": labels, "v": list(matrix)})))


def test_bounds_hold_after_every_step_and_close():
    chance = np.random.default_rng(1)
    matrix = chance.integers(-300, 300, (50, 20))
    block, anchor = block_of(matrix, [0] * 50), Anchor(-1, 0, chance.integers(-300, 300, 20))
    scores, width = matrix @ anchor.vector, None
    for alive, least, most, exact in narrowing(anchor, block, np.arange(50), 3):
        assert (least <= scores).all() and (scores <= most).all()
        assert width is None or (most - least).max() <= width
        width = (most - least).max()
    assert exact and width == 0


def test_the_bitmap_shrinks_before_all_columns_are_read():
    chance = np.random.default_rng(2)
    matrix = np.zeros((400, 64), dtype=np.int64)
    matrix[:, 0] = chance.integers(-1000, 1000, 400)
    matrix[:, 1:] = chance.integers(-3, 3, (400, 63))
    vector = np.full(64, 2)
    vector[0] = 500
    block, anchor = block_of(matrix, [1] * 400), Anchor(-1, 0, vector)
    seen = []
    scan = narrowing(anchor, block, np.arange(400), 8)
    alive, least, most, exact = next(scan)
    while not exact:
        seen.append(len(alive))
        alive, least, most, exact = scan.send((most >= 100_000) & (least <= 120_000))
    assert seen[0] == 400 and seen[1] < 40
    at, scores = scan_windows(anchor, block, [ScoreWindow(100_000, 120_000)], 5, 8)
    inside = np.sort((matrix @ vector)[((matrix @ vector) >= 100_000) & ((matrix @ vector) <= 120_000)])[-5:]
    assert set(inside) <= set(scores)
