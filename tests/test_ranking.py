import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.operators.ranking import first_absent, global_rank, top_per_key


def test_global_rank_equals_sorted_position(spark):
    values = [(random.Random(i).randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(values, "v bigint, id bigint").repartition(4)
    got = {(r.v, r.id): r.rank for r in global_rank(df, ["v", "id"]).collect()}
    assert got == {pair: i for i, pair in enumerate(sorted(values))}


def test_top_per_key_limits_before_the_shuffle(spark, rows):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    top = top_per_key(df, "k", [F.desc("v")], 2)
    assert rows(top) == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def absent(spark, present, keys, size, k, width):
    frame = spark.createDataFrame([(key, r) for key, ranks in present.items() for r in ranks], "key int, rank bigint")
    found = first_absent(frame, spark.createDataFrame([(x,) for x in keys], "key int"), "key", size, k, width)
    out = {key: [] for key in keys}
    for row in found.collect():
        out[row.key].append(row["rank"])
    return {key: sorted(ranks) for key, ranks in out.items()}


@settings(max_examples=12, deadline=None)
@given(
    st.dictionaries(st.integers(0, 2), st.sets(st.integers(0, 39)), min_size=1),
    st.integers(1, 6), st.integers(1, 9),
)
def test_first_absent_matches_brute_force(spark, present, k, width):
    keys, size = [0, 1, 2], 40
    want = {key: [r for r in range(size) if r not in present.get(key, set())][:k] for key in keys}
    assert absent(spark, present, keys, size, k, width) == want


@pytest.mark.parametrize("width", [4, 64, 4096])
def test_first_absent_after_a_long_dense_stretch(spark, width):
    present = {1: set(range(3000)) | {3002}}
    assert absent(spark, present, [1], 3005, 5, width) == {1: [3000, 3001, 3003, 3004]}
