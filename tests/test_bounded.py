import os
import random

import pytest
from helpers import plan, tuples

from tallyloom.operators import bounded, clusters
from tallyloom.plans import storage
from test_clusters import points, random_vectors, vectors


def same(spark, df, start, **options):
    plain, found = clusters.kmeans(df, start, **options), bounded.kmeans(df, start, **options)
    assert (found.means, found.iterations, found.distance, found.converged, found.history) == (
        plain.means, plain.iterations, plain.distance, plain.converged, plain.history)
    assert [w.iteration for w in found.work] == list(range(1, found.iterations + 1)) and found.work[0].written
    return found


@pytest.mark.parametrize("renew_after", [0.0, 0.3, 1.0, 1e9])
def test_means_and_history_are_those_without_bounds(spark, renew_after):
    df = storage.materialize(clusters.weigh_points(vectors(spark, random_vectors(400, seed=3))), "points")
    start = [(0, 0), (0, 3), (0, 40), (50_000, 1), (50_000, 2), (100_000, 7)]
    plain = clusters.kmeans(df, start, eta=1.0)
    found = bounded.kmeans(df, start, eta=1.0, renew_after=renew_after)
    assert (found.means, found.history, found.converged) == (plain.means, plain.history, True)


def test_ties_equal_means_and_wide_coordinates(spark):
    grid = points(spark, [(x, y, 1 + (x + y) % 3) for x in range(9) for y in range(9)])
    same(spark, grid, [(0, 0), (8, 8), (0, 8), (8, 0), (4, 4)], eta=0.5)
    same(spark, grid, [(3, 3), (3, 3), (5, 5)], eta=0.5)  # the second of two equal means stays empty
    top = 2**31 - 1
    same(spark, points(spark, [(-top, -top, 1), (top, top, 2), (0, 0, 1), (1, 0, 1), (top, -top, 1)]), [(-top, 0), (top, 0)], eta=0.5)


def test_one_mean_and_no_points(spark):
    found = same(spark, points(spark, [(1, 2, 1), (3, 4, 5)]), [(0, 0)], eta=0.5)
    assert all(w.compared == 0 for w in found.work[1:])
    none = same(spark, points(spark, []), [(0, 0), (1, 1)], eta=0.5)
    assert (none.iterations, none.distances_computed()) == (1, 0)


def test_a_point_without_coordinates_fails(spark):
    with pytest.raises(ValueError):
        bounded.kmeans(points(spark, [(1, 2, 1), (None, 4, 5)]), [(0, 0), (9, 9)])


def test_the_bound_of_iterations(spark):
    df = points(spark, [(0, 0, 1), (0, 1, 1), (0, 9, 1), (0, 30, 1)])
    with pytest.warns(UserWarning):
        assert not bounded.kmeans(df, [(0, 0), (0, 1)], eta=0.1, max_iterations=1).converged


def test_each_row_keeps_or_changes_its_cluster_as_a_full_comparison_says(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(200), rng.randrange(200), 1) for _ in range(600)]
    anchors = [(rng.randrange(200), rng.randrange(200)) for _ in range(12)]
    means = [(x + rng.randrange(-6, 7), y + rng.randrange(-6, 7)) for x, y in anchors]
    written = storage.materialize(bounded.anchored(points(spark, rows), anchors), "anchored")
    found = bounded.reassign(written, anchors, means)
    expected = clusters.assign(written.select("x", "y", "w"), means)
    assert sorted(tuples(found.select("x", "y", "cluster"))) == sorted(tuples(expected.select("x", "y", "cluster")))
    assert 0 < found.where("compared").count() < len(rows) / 2
    assert "Exchange" not in plan(found)
    # What is not exact about ``second`` is below the truth, also after another step.
    again = bounded.reassign(found, means, anchors)
    truth = {(r.x, r.y): r.second for r in bounded.anchored(written.select("x", "y", "w"), anchors).collect()}
    assert all(r.second <= truth[r.x, r.y] * (1 + 1e-9) for r in again.collect())


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_less_than_half_of_the_distances_on_the_test_tables(spark, folder):
    import __spark_entry__ as entry
    from tallyloom.plans import flows

    with storage.scope(spark):
        vectors = entry.postings_vectors(spark, f"/root/testdata/{folder}")
        result = flows.cluster_questions(vectors, entry.SETTINGS, bounded.kmeans).clustering
        n, k = result.work[0].points, len(result.means)
        assert result.iterations > 3
        assert result.distances_computed() < n * k * result.iterations / 2


def test_the_bounds_are_deleted(spark):
    folder = storage.shared_folder(spark).removeprefix("file:")
    bounded.kmeans(points(spark, [(0, 0, 1), (5, 5, 1)]), [(0, 0), (1, 1)], eta=0.5, renew_after=0.0)
    assert not [name for name in os.listdir(folder) if name.startswith("bounds-")]
