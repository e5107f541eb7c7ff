"""Chunked windows equal plain windows and plain loops, hot keys included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from mercantil.operators import ordered
from mercantil.operators.topn import first_per_key, last_per_key, top_n_per_group


@pytest.fixture(scope="module")
def moves(spark):
    rng = random.Random(7)
    # Key 0 holds a good third of all rows.
    data = [(0 if i % 3 == 0 else rng.randrange(1, 40), rng.randrange(0, 5000), i,
             rng.randrange(-9, 9)) for i in range(3000)]
    return data, spark.createDataFrame(data, "k int, t bigint, id bigint, d bigint")


# Rows of a chunk: every group is cut, only the largest, none.
ROWS = [1, 500, 10_000]


@pytest.fixture(params=[(32, 16, 20), (9, 4, 6)], ids=["wide", "tiny"])
def digits(request, monkeypatch):
    """Also with few positions in a piece, so that all levels are reached."""
    for name, value in zip(("HIGH", "LOW", "BLOCK"), request.param):
        monkeypatch.setattr(ordered, name, value)


@pytest.mark.parametrize("size", ROWS)
@pytest.mark.parametrize("following", [False, True])
def test_neighbor_equals_window(moves, digits, size, following):
    _, df = moves
    got = ordered.with_neighbor(df, ["k"], ["t", "id"], ["d", "id"], "n", following, size)
    step = F.lead if following else F.lag
    plain = df.withColumn(
        "n", step(F.struct("d", "id")).over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("size", ROWS)
def test_clamped_levels_equal_a_loop(moves, digits, size):
    data, df = moves
    df = df.withColumn("x0", F.col("k") % 4)
    got = ordered.with_running_levels(
        df, ["k"], ["t", "id"], {"level": ("d", "x0"), "free": ("d", None)}, chunk_rows=size)
    wanted, level, free = {}, {}, {}
    for k, t, id_, d in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        level[k] = max(level.get(k, k % 4) + d, 0)
        free[k] = max(free.get(k, 0) + d, 0)
        wanted[id_] = (level[k], free[k])
    assert {r.id: (r.level, r.free) for r in got.collect()} == wanted


@pytest.mark.parametrize("size", ROWS)
def test_running_sum_without_floor(moves, digits, size):
    data, df = moves
    got = ordered.with_running_levels(
        df, ["k"], ["t", "id"], {"s": ("d", None)}, floor_at_zero=False, chunk_rows=size)
    total, wanted = {}, {}
    for k, t, id_, d in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        total[k] = total.get(k, 0) + d
        wanted[id_] = total[k]
    assert {r.id: r.s for r in got.collect()} == wanted


def test_one_instant_is_cut(spark, monkeypatch):
    """A third of all rows in one instant of one key: no chunk keeps them together."""
    monkeypatch.setattr(ordered, "BLOCK", 4)
    df = spark.range(900).select(F.lit(1).alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("t"), "id")
    chunks = ordered.with_chunk(df, ["k"], ["t", "id"], ordered.cuts(df, ["k"], ["t", "id"], 50)).groupBy("_chunk").count().collect()
    assert max(r["count"] for r in chunks) <= 50
    times = df.withColumn("t", F.timestamp_micros("t"))
    got = ordered.with_neighbor(times, ["k"], ["t", "id"], ["id"], "n", chunk_rows=50)
    plain = times.withColumn("n", F.lag(F.struct("id")).over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(got) == rows(plain)


def test_no_job_runs_while_a_plan_is_built(spark, moves):
    _, df = moves
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    ordered.with_running_levels(df, ["k"], ["t", "id"], {"s": ("d", None)})
    ordered.with_neighbor(df, ["k"], ["t", "id"], ["d"], "n")
    assert tracker.getJobIdsForGroup(None) == before


def test_top_n_equals_ranking(moves):
    _, df = moves
    for n in (1, 5, 2000):
        got = top_n_per_group(df, ["k"], [F.col("t"), F.col("id")], ["id"], n, salts=8)
        rank = F.row_number().over(Window.partitionBy("k").orderBy("t", "id"))
        assert rows(got) == rows(df.withColumn("r", rank).filter(F.col("r") <= n).drop("r"))


def test_edges_do_not_depend_on_input_order(moves):
    _, df = moves
    shuffled = df.orderBy(F.xxhash64("id"))
    for edge in (first_per_key, last_per_key):
        assert rows(edge(df, ["k"], ["t", "id"])) == rows(edge(shuffled, ["k"], ["t", "id"]))


def test_small_groups_are_sorted_once(spark):
    """Where no group is cut, the plan for cut groups does not run."""
    df = spark.createDataFrame([(k % 5, k, k, 1) for k in range(200)], "k int, t bigint, id bigint, d bigint")
    got = ordered.with_running_levels(df, ["k"], ["t", "id"], {"n": ("d", None)})
    assert max(r.n for r in got.collect()) == 40
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Window [") <= 2
