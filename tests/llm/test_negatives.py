"""Packed products and hard negatives against plain integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import hard_negatives as hn
from pagemill.llm.hard_negatives import Packed, Vector, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def vector(values, row=0, key=0, label=0):
    return Vector(row, key, label, hn._scaled(np.array(values, dtype=np.float64)))


def whole(values):
    return [int(x * 256 // 1) if abs(x) < 1e15 else int(x) * 256 for x in values]


def product(a, b):
    return sum(x * y for x, y in zip(whole(a), whole(b)))


@pytest.mark.parametrize("size", [0.5, 40.0, 1e7, 1e30])
def test_packed_products_are_exact(size):
    rng = random.Random(3)
    draw = [[rng.uniform(-size, size) for _ in range(n)] for n in (8, 8, 3, 0, 8)]
    draw += [[size] * 8, [-size] * 8, [0.0] * 8]
    vectors = [vector(v, i) for i, v in enumerate(draw)]
    for anchor, values in zip(vectors, draw):
        block = Packed(vectors, sum(map(abs, hn._parts(anchor.packed))))
        assert [int(s) for s in block.scores(anchor)] == [product(values, other) for other in draw]


def plain(rows, every=100):
    """As the query's contract says, over all pairs."""
    usable = [
        (k, v, (lb + 1) % 10 if k is not None and k % 7 == 0 else lb) for k, v, lb in rows
        if lb is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for i, (key, values, label) in enumerate(usable):
        if key is None or key % every:
            continue

        def ordered(same):
            scored = [(product(values, v), k) for j, (k, v, lb) in enumerate(usable) if j != i and (lb == label) == same]
            return sorted(scored, key=lambda t: (-t[0], t[1] is None, t[1] or 0))

        negatives = ordered(False)
        for score, positive in ordered(True)[:5]:
            fit = [(s, k) for s, k in negatives if 30 * score <= 100 * s <= 90 * score][:10]

            def fits(s):
                return s if -(2**63) <= s < 2**63 else None

            found += [(key, positive, r, k, fits(score), fits(s)) for r, (s, k) in enumerate(fit, 1)]
    return sorted(found, key=repr)


def run(spark, rows, every=100, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = hard_negatives(table, F.col("_id") % every == 0, label=hn.shifted_label(), **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def odd(count, seed=1, dims=6):
    rng = random.Random(seed)
    grid = [i / 8 for i in range(-4, 9)]
    rows = [(i, [rng.choice(grid) for _ in range(dims)], rng.randrange(3)) for i in range(count)]
    rows += rows[:8]
    rows += [(None, [0.5] * dims, 1), (None, [0.25] * dims, 2), (5, None, 1), (6, [None] + [0.5] * (dims - 1), 1)]
    rows += [(200, [float("nan")] * dims, 0), (300, [float("inf")] * dims, 0), (400, [0.5] * dims, None), (500, [], 1)]
    rows += [(600, [0.5, 1.0], 1), (700, [0.0] * dims, 0), (-800, [0.75] * dims, 2)]
    return rows


def test_odd_rows_match_all_pairs(spark):
    rows = odd(150)
    expected = plain(rows, 10)
    assert len(expected) > 300
    assert run(spark, rows, 10) == expected


def test_many_passes_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(hn, "PACKED", 7)
    rows = odd(120, seed=5)
    assert run(spark, rows, 20, pass_bytes=200, task_rows=20) == plain(rows, 20)


def test_components_of_any_size_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * 10.0 ** rng.randrange(0, 30))) for _ in range(4)], i % 3) for i in range(60)]
    assert run(spark, rows, 10) == plain(rows, 10)


def test_tables_without_rows_or_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.5], 1), (2, [0.5], 1)]) == []
    assert run(spark, [(100, [0.5], 1)]) == []


def test_other_columns_are_not_looked_at(spark):
    rows = odd(60, seed=2)
    table = spark.createDataFrame(rows, SCHEMA)
    names = ["_row", "_id", "_label", "_values", "_parts", "_anchor", "_positive", "_rank", "_score"]
    table = table.select("*", *[F.lit("z").alias(n) for n in names])
    found = hard_negatives(table, F.col("_id") % 10 == 0, label=hn.shifted_label())
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows, 10)
