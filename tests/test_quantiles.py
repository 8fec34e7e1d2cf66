"""Quantiles and samples by counting, against sorting."""

import hashlib
import math
import random

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from tallyloom.operators import quantiles, sampling

FRACTIONS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.99, 1.0]


def plain_quantiles(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    found = []
    for g, values in groups.items():
        values.sort(key=lambda v: (isinstance(v, float) and math.isnan(v), 0 if isinstance(v, float) and math.isnan(v) else v))
        found += [(g, f, values[max(math.ceil(len(values) * f) - 1, 0)], len(values)) for f in FRACTIONS]
    return sorted(map(repr, found))


def random_rows(kind):
    rng = random.Random(kind)
    draw = {
        "long": lambda: rng.choice([rng.randint(-(2**62), 2**62), 7, -(2**63), 2**63 - 1]),
        "double": lambda: rng.choice([rng.gauss(0, 1e9), 0.1, float("inf"), float("-inf"), float("nan"), -1e-300]),
        "int": lambda: rng.randint(0, 3),
    }[kind]
    rows = [(rng.choice(["a", "a", "a", "b", None]), None if rng.random() < 0.05 else draw()) for _ in range(3000)]
    return [*rows, ("one", draw()), ("none", None)]


@pytest.mark.parametrize("kind", ["long", "double", "int"])
@pytest.mark.parametrize("accuracy", [3, 2000])
def test_quantiles_are_exact(spark, kind, accuracy):
    rows = random_rows(kind)
    df = spark.createDataFrame(rows, f"g string, v {kind}").repartition(5)
    found = quantiles.exact_quantiles(df, "g", "v", FRACTIONS, accuracy=accuracy)
    assert dict(found.dtypes)["quantile"] == dict(df.dtypes)["v"]
    assert sorted(map(repr, tuples(found))) == plain_quantiles(rows)


def test_a_bad_sketch_costs_time_only(spark, monkeypatch):
    rows = random_rows("long")
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda v, edges, accuracy: F.array(*[F.min(v)] * len(edges)))
    assert sorted(map(repr, tuples(quantiles.exact_quantiles(df, "g", "v", FRACTIONS)))) == plain_quantiles(rows)


def test_no_rows_and_bad_fractions(spark):
    none = spark.createDataFrame([("a", None)], "g string, v double")
    assert quantiles.exact_quantiles(none, "g", "v", [0.5]).isEmpty()
    for fractions in ([], [0.5, 0.5], [1.5]):
        with pytest.raises(ValueError):
            quantiles.exact_quantiles(none, "g", "v", fractions)


@pytest.mark.parametrize("digits, slack", [(1, 0), (3, 1_000)])
@pytest.mark.parametrize("size", [1, 20, 700])
def test_sample_is_what_sorting_gives(spark, monkeypatch, digits, slack, size):
    """An x with a third of all points, a small one, a null one, and an id that occurs often."""
    monkeypatch.setattr(sampling, "DIGITS", digits)
    monkeypatch.setattr(sampling, "SLACK", slack)
    rng = random.Random(8)
    points = [(i, rng.choice([0, 0, 50, 100, None]), rng.randint(0, 9)) for i in range(1500)] + [(3000, 150, 1), (3001, 150, 2)]
    points += [(77, 100, 5)] * 40
    found = sampling.stratified_sample(spark.createDataFrame(points, "qid long, x int, y int").repartition(6), size)
    want = []
    for x in {p[1] for p in points}:
        of_x = sorted((hashlib.md5(f"{sampling.SEED}:{q}".encode()).hexdigest(), y, q) for q, px, y in points if px == x)
        want += [(q, x, y, n) for n, (_, y, q) in enumerate(of_x[:size], 1)]
    assert sorted(map(repr, tuples(found))) == sorted(map(repr, want))


def test_few_points_beyond_the_sample_are_sorted(spark):
    points = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("qid"), (F.col("id") % 2).cast("int").alias("x"), F.lit(1).alias("y"))
    placed = points.withColumn("__at", sampling.sample_order())
    reach = sampling._reach(placed, 100)
    within = placed.join(reach, placed["x"] == reach["__x"]).where(F.substring("__at", 1, F.length("__last")) <= F.col("__last"))
    assert 200 <= within.count() <= 2 * (100 + sampling.SLACK)
    with pytest.raises(ValueError):
        sampling.stratified_sample(points, 0)
