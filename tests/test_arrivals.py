"""Batches that arrive by folder, state of all keys, late rows and recovery."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weftline.session import scratch_path
from weftline.streaming import counts as C
from weftline.streaming import runner as S
from weftline.streaming.arrivals import by_arrival
from weftline.streaming.state import update_all_keys

SCHEMA = "batch int, key string, n bigint"
BATCHES = [(0, "a", 1), (0, "a", 2), (0, "b", 5), (0, None, 1), (1, "b", 1), (2, "c", 7), (3, "a", 4), (3, None, 2), (3, "b", None)]


def state_after(spark, rows, update=None, seed=None, history=True):
    """Rows of the state after each batch, and the folder they are in."""
    out, at = scratch_path(spark, "out"), scratch_path(spark, "state")
    options = {} if update is None else {"update": update}
    found = by_arrival(spark.createDataFrame(rows, SCHEMA), F.col("batch"), lambda stream: update_all_keys(
        stream, "key", "n", out, seed=seed, checkpoint=at, history=history, **options))
    return {(r["batch_id"], r["key"]): (r["total"], r["idle"]) for r in found.collect()}, out


def test_silent_keys_are_in_every_state(spark):
    got, _ = state_after(spark, BATCHES)
    assert got == {
        (0, "a"): (3, 0), (0, "b"): (5, 0), (0, None): (1, 0),
        (1, "a"): (3, 1), (1, "b"): (6, 0), (1, None): (1, 1),
        (2, "a"): (3, 2), (2, "b"): (6, 1), (2, None): (1, 2), (2, "c"): (7, 0),
        (3, "a"): (7, 0), (3, "b"): (6, 0), (3, None): (3, 0), (3, "c"): (7, 1),
    }


def test_keys_are_removed_and_begin_anew(spark):
    got, _ = state_after(spark, BATCHES, lambda added, total, idle: F.when(idle < 2, F.coalesce(added, F.lit(0)) + F.coalesce(total, F.lit(0))))
    assert got[(1, "a")] == (3, 1) and (2, "a") not in got and got[(3, "a")] == (4, 0)


def test_totals_of_silent_keys_can_change(spark):
    """A decaying total: halved in every batch, whether the key comes or not."""
    got, _ = state_after(spark, BATCHES, lambda added, total, idle: F.floor(F.coalesce(total, F.lit(0)) / 2) + F.coalesce(added, F.lit(0)))
    assert [got[(b, "b")][0] for b in range(4)] == [5, 3, 1, 0]


def test_seeded_keys_show_in_the_first_batch(spark):
    seed = spark.createDataFrame([("z", 9), ("a", 100), (None, 3)], "key string, total bigint")
    got, _ = state_after(spark, BATCHES[:4], seed=seed)
    assert got == {(0, "z"): (9, 1), (0, "a"): (103, 0), (0, "b"): (5, 0), (0, None): (4, 0)}


def test_without_history_two_states_are_kept(spark):
    got, out = state_after(spark, BATCHES, history=False)
    assert {b for b, _ in got} == {2, 3} and got[(3, "a")] == (7, 0)
    assert sorted(n for n in os.listdir(out.removeprefix("file:")) if n.startswith("batch_id=")) == ["batch_id=2", "batch_id=3"]


def test_no_rows_no_batches(spark):
    assert state_after(spark, [])[0] == {}


def test_each_folder_is_a_batch_and_its_size_does_not_matter(spark):
    out, at = scratch_path(spark, "out"), scratch_path(spark, "state")
    data = spark.range(3000).select("id", (F.col("id") % 3 * 10).alias("b")).repartition(7)
    found = by_arrival(data, F.col("b"), lambda stream: C.counts_per_batch(stream.select((F.col("id") % 3).alias("k")), out, "k", checkpoint=at))
    assert sorted((r["batch_id"], r["k"], r["n"]) for r in found.collect()) == [(0, 0, 1000), (1, 1, 1000), (2, 2, 1000)]


def test_late_rows_are_those_below_the_mark_before_their_batch(spark):
    rows = [(0, "10:00"), (0, "10:30"), (1, "10:19"), (1, "10:21"), (1, "10:40"), (2, "10:24"), (2, "10:34"), (3, "12:00")]
    data = spark.createDataFrame(rows, "b int, t string").select("b", F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t")).alias("ts"), F.lit("k").alias("k"))
    out, at = scratch_path(spark, "out"), scratch_path(spark, "state")
    found = by_arrival(data, F.col("b"), lambda stream: S.run_append(
        C.windowed_counts(stream, "ts", "5 minutes", None, "k", watermark="10 minutes"), out, at))
    got = {(r["t"], r["n"]) for r in found.select(F.date_format(F.timestamp_seconds("start_s"), "HH:mm").alias("t"), "n").collect()}
    # The marks before the batches are none, 10:20, 10:30 and 10:30.
    assert got == {("10:00", 1), ("10:20", 1), ("10:30", 2), ("10:40", 1)}


def test_a_failed_batch_is_written_once(spark):
    data = spark.range(40).select("id", (F.col("id") % 4).alias("b"))
    out, at, calls = scratch_path(spark, "out"), scratch_path(spark, "state"), []

    def sink(frame, batch_id):
        calls.append(batch_id)
        S.write_batch(frame, out, batch_id)
        if calls.count(batch_id) <= batch_id % 3:  # batch 1 fails once, batch 2 twice
            raise OSError("failed after the write")

    restarts = []
    by_arrival(data, F.col("b"), lambda stream: restarts.append(S.run_recovering(stream, sink, checkpoint=at)))
    assert restarts == [0, 1, 2, 0] and calls == [0, 1, 1, 2, 2, 2, 3]
    got = spark.read.parquet(out)
    assert sorted((r["batch_id"], r["id"]) for r in got.select("batch_id", "id").collect()) == sorted((i % 4, i) for i in range(40))


def test_a_lasting_failure_is_raised(spark):
    def sink(frame, batch_id):
        raise OSError("never")

    data = spark.range(4).select("id", F.lit(0).alias("b"))
    with pytest.raises(StreamingQueryException):
        by_arrival(data, F.col("b"), lambda stream: S.run_recovering(stream, sink, restarts=1))


def test_ordered_files_are_one_job_and_spread_equal_times(spark):
    data = spark.range(4000).select(F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).cast("timestamp").alias("ts"), "id").repartition(5)
    folder = S.staged_in_order(data, "ts", rows_per_file=500)
    path = folder.removeprefix("file:")
    files = sorted((os.stat(f"{path}/{n}").st_mtime, n) for n in os.listdir(path) if n.startswith("part-"))
    assert len({t for t, _ in files}) == len(files) >= 6
    seen = [spark.read.parquet(f"{path}/{n}").select(F.unix_seconds("ts")).collect() for _, n in files]
    assert sum(map(len, seen)) == 4000 and max(map(len, seen)) < 1200
    flat = [[-1 if r[0] is None else r[0] for r in part] for part in seen]
    assert all(max(a) <= min(b) for a, b in zip(flat, flat[1:]))
