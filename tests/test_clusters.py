import random
import statistics

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from tallyloom.functions.geometry import distances, total_movement
from tallyloom.operators import clusters, sampling
from tallyloom.plans import flows

LANGS = ("A", "B", "C")
SETTINGS = clusters.ClusterSettings(languages=LANGS, kernels=6, eta=1.0)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "qid bigint, x int, y int")


def points(spark, rows):
    return spark.createDataFrame(rows, "x int, y int, w bigint")


def nearest(spark, x, y, centers):
    df = spark.createDataFrame([(x, y)], "x int, y int")
    return clusters.assign(df, centers).first().cluster


def random_vectors(n, seed=1):
    """Half of all points share the first x."""
    rng = random.Random(seed)
    return [(i, rng.choice([0, 0, 50_000, 100_000]), int(rng.expovariate(0.05))) for i in range(n)]


def python_nearest(x, y, centers):
    return min(range(len(centers)), key=lambda i: ((x - centers[i][0]) ** 2 + (y - centers[i][1]) ** 2, i))


def python_step(rows, means):
    moved = list(means)
    for i in range(len(means)):
        own = [(x, y) for _, x, y in rows if python_nearest(x, y, means) == i]
        if own:
            moved[i] = (sum(x for x, _ in own) // len(own), sum(y for _, y in own) // len(own))
    return moved


def test_ties_go_to_the_lowest_index(spark):
    assert nearest(spark, 0, 5, [(0, 10), (0, 0), (0, 20)]) == 0
    assert nearest(spark, 0, 5, [(0, 20), (0, 0), (0, 10)]) == 1
    assert nearest(spark, -(2**31), 0, [(2**31 - 1, 0), (0, 0)]) == 1
    assert nearest(spark, None, None, [(0, 0)]) == -1
    with pytest.raises(ValueError):
        distances("x", "y", [])


def test_nearest_center_agrees_with_brute_force(spark):
    rng = random.Random(5)
    centers = [(rng.randrange(-50, 150_000), rng.randrange(-50, 100)) for _ in range(45)]
    rows = random_vectors(500)
    found = clusters.assign(vectors(spark, rows), centers)
    assert sorted((r.qid, r.cluster) for r in found.collect()) == [(q, python_nearest(x, y, centers)) for q, x, y in rows]
    assert "Exchange" not in plan(found)


def test_means_are_truncated_and_empty_clusters_stay(spark):
    df = points(spark, [(0, 1, 1), (0, 2, 1), (0, -1001, 1), (0, -1002, 1)])
    assert clusters.move_means(df, [(0, 0), (0, -1000), (900_000, 5)]) == [(0, 1), (0, -1001), (900_000, 5)]


def test_weights_count_equal_points(spark):
    weighed = clusters.weigh_points(vectors(spark, [(1, 0, 5), (2, 0, 5), (3, 0, 6)]))
    assert sorted(tuples(weighed)) == [(0, 5, 2), (0, 6, 1)]


def test_one_iteration_shuffles_partial_sums_only(spark):
    text = plan(clusters.average(points(spark, [(0, 1, 1)]), [(0, 0)] * 3))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert text.rindex("HashAggregate") > text.index("Exchange")


def test_kmeans_agrees_with_brute_force(spark):
    rows = random_vectors(400)
    df = clusters.weigh_points(vectors(spark, rows))
    start = [(0, 0), (0, 3), (0, 40), (50_000, 1), (50_000, 2), (100_000, 7)]
    means, steps = start, 0
    while True:
        moved, steps = python_step(rows, means), steps + 1
        if moved == means:
            break
        means = moved
    result = clusters.kmeans(df, start, eta=1.0)
    assert (result.means, result.iterations, result.converged, result.distance) == (means, steps, True, 0.0)
    assert len(result.history) == steps * len(start)
    assert [tuple(h[2:4]) for h in result.history[: len(start)]] == start
    assert [tuple(h[4:6]) for h in result.history[-len(start):]] == means
    assert result.history_frame(spark).count() == len(result.history)
    assert tuples(result.means_frame(spark)) == [(i, *m) for i, m in enumerate(means)]
    assert not df.is_cached


def test_kmeans_stops_at_the_iteration_bound_and_below_eta(spark):
    rows = random_vectors(400)
    df = clusters.weigh_points(vectors(spark, rows))
    start = [(0, 0), (0, 1), (0, 2)]
    one = clusters.kmeans(df, start, eta=1.0, max_iterations=1)
    assert (one.iterations, one.converged, one.means) == (1, False, python_step(rows, start))
    assert one.distance == total_movement(start, one.means)
    loose = clusters.kmeans(df, start, eta=one.distance + 1)
    assert (loose.iterations, loose.converged, loose.means) == (1, True, one.means)
    exact = clusters.kmeans(df, start, eta=one.distance, max_iterations=2)
    assert exact.iterations == 2


def test_kmeans_leaves_a_callers_cache_alone(spark):
    df = points(spark, [(0, 1, 1)]).cache()
    clusters.kmeans(df, [(0, 0)])
    assert df.is_cached
    df.unpersist()


def test_movement_needs_equal_lengths():
    assert total_movement([(0, 0), (1, 1)], [(3, 4), (1, 1)]) == 25.0
    with pytest.raises(ValueError):
        total_movement([(0, 0)], [])


@pytest.mark.parametrize("values, median", [
    ([1, 4], 2), ([1, 4, 8], 4), ([5], 5), ([-1, -4], -2), ([0, -1], 0), ([7, 7, 7, 8], 7),
    ([2**31 - 1, 2**31 - 2, -(2**31)], 2**31 - 2), ([65535, 65536], 65535), ([-1, 0, 1, 65536, 131072], 1),
])
def test_median_cases(spark, values, median):
    df = spark.createDataFrame([(0, v, 1) for v in values], "c int, v int, w bigint")
    assert tuples(clusters.exact_median(df, "c", "v", "w")) == [(0, median)]


def test_weighted_medians_agree_with_brute_force(spark):
    rng = random.Random(11)
    rows = [(rng.choice([0, 0, 0, 1, 2]), rng.randrange(-200_000, 200_000), rng.randrange(1, 5)) for _ in range(999)]
    df = spark.createDataFrame(rows, "c int, v int, w bigint")
    for c, median in tuples(clusters.exact_median(df, "c", "v", "w")):
        values = [v for group, v, w in rows if group == c for _ in range(w)]
        assert median == int(statistics.median(values))


def test_settings_are_checked():
    assert clusters.ClusterSettings().per_language == 3
    for bad in ({"spread": 0}, {"kernels": 44}, {"kernels": 0}, {"languages": ()}, {"max_iterations": 0}):
        with pytest.raises(ValueError):
            clusters.ClusterSettings(**bad)


def test_stratified_sample(spark):
    rows = random_vectors(300)
    df = vectors(spark, rows)
    sample = sampling.stratified_sample(df, 2)
    taken = tuples(sample)
    assert len(taken) == 6 and {t[:3] for t in taken} <= set(rows)
    assert sorted(taken) == sorted(tuples(sampling.stratified_sample(df.repartition(5), 2)))
    assert {t[:3] for t in taken} != {t[:3] for t in tuples(sampling.stratified_sample(df, 2, seed=1))}
    assert plan(sampling.stratified_sample(df, 2)).count("WindowGroupLimit") == 2  # before and after the shuffle of the few points left


def test_exact_sample(spark):
    rows = random_vectors(300)
    df = vectors(spark, rows)
    sample = tuples(sampling.exact_sample(df, 9))
    assert len(set(sample)) == 9 and set(sample) <= set(rows)
    assert sample == tuples(sampling.exact_sample(df.repartition(5), 9))
    assert "TakeOrderedAndProject" in plan(sampling.exact_sample(df, 9))
    assert sampling.exact_sample(df, 999).count() == 300


def test_samples_are_spread_evenly(spark):
    """Over many seeds, every point is drawn about equally often."""
    df = vectors(spark, [(i, 0, i) for i in range(10)])
    drawn = [r.qid for seed in range(60) for r in sampling.exact_sample(df, 3, seed).collect()]
    assert all(6 <= drawn.count(i) <= 32 for i in range(10))


def test_initial_means(spark):
    df = vectors(spark, random_vectors(300))
    means = clusters.initial_means(df, SETTINGS)
    assert [x for x, _ in means] == [0, 0, 50_000, 50_000, 100_000, 100_000]
    narrow = clusters.ClusterSettings(languages=LANGS, kernels=6, spread=499)
    assert len(clusters.initial_means(df, narrow)) == 6


def test_a_stratum_that_is_too_small_is_an_error(spark):
    df = vectors(spark, [(i, 0, i) for i in range(20)] + [(21, 50_000, 0), (22, 50_000, 1), (23, 100_000, 0)])
    with pytest.raises(ValueError):
        clusters.initial_means(df, SETTINGS)
    with pytest.raises(ValueError):
        clusters.initial_means(df.limit(2), clusters.ClusterSettings(languages=LANGS, kernels=3, spread=10))


def test_summary_of_clusters(spark):
    df = points(spark, [(0, 1, 3), (50_000, 4, 1), (100_000, 9, 2), (100_000, 8, 1), (0, 3, 0)])
    df = df.where("w > 0")
    rows = tuples(clusters.summarize_clusters(df, [(10_000, 2), (100_000, 9), (9_000_000, 0)], SETTINGS))
    assert rows == [("A", 0.0, 75.0, 4, 1), ("C", 100.0, 100.0, 3, 9)]
    report = [r.line for r in clusters.format_report(spark.createDataFrame(rows, "lang string, pct_int double, pct double, size bigint, median int")).collect()]
    assert report[0] == "      1  A                 (0.0  %)            4"
    assert report[1] == "      9  C                 (100.0%)            3"
    backwards = spark.createDataFrame(rows[::-1], "lang string, pct_int double, pct double, size bigint, median int")
    assert {r.position: r.line for r in clusters.format_report(backwards).collect()} == {1: report[0], 2: report[1]}


def test_bound_of_iterations_is_told(spark):
    df = points(spark, [(0, 0, 1), (0, 100, 1), (0, 1000, 1)])
    with pytest.warns(UserWarning, match="after 1 iterations"):
        assert not clusters.kmeans(df, [(0, 0), (0, 1)], eta=1.0, max_iterations=1).converged


def test_most_frequent_language_takes_the_lowest_on_ties(spark):
    df = points(spark, [(100_000, 5, 2), (50_000, 5, 2), (0, 5, 1)])
    assert tuples(clusters.summarize_clusters(df, [(50_000, 5)], SETTINGS)) == [("B", 0.0, 40.0, 5, 5)]


def test_whole_clustering_of_a_file(spark, tmp_path):
    rng = random.Random(2)
    values = []
    for i in range(300):
        values += [f"1,{i},,,0,{LANGS[i % 3]}", f"2,{1000 + i},,{i},{rng.randrange(40)}"]
    path = tmp_path / "postings.csv"
    path.write_text("\n".join(values) + "\n")
    result = flows.cluster_postings(spark, str(path), SETTINGS)
    assert result.clustering.converged and len(result.clustering.means) == 6
    assert result.summary.agg(F.sum("size")).first()[0] == 300
    assert {r.lang for r in result.summary.collect()} == set(LANGS)
