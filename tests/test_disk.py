"""What jobs leave on disk while a program goes on, and steps that do not grow with the input."""

from __future__ import annotations

import glob
import time

import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from weftline.operators import pagerank as PR
from weftline.operators import recommend
from weftline.plans import streams
from weftline.plans.registry import QUERIES
from weftline.session import release, staged, tune
from weftline.streaming import runner


def shuffles(spark) -> set[str]:
    """Numbers of the shuffles that have files on this machine."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark):
    tune(spark)
    before = shuffles(spark)
    kept = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert kept.count() == 7
    assert shuffles(spark) <= before


def test_released_files_are_gone(spark):
    kept = staged(spark.range(10).toDF("id"), "some")
    path = kept.staged_at.removeprefix("file:")
    assert glob.glob(f"{path}/*.parquet")
    release(kept)
    assert not glob.glob(f"{path}*")


def test_many_sources_in_groups_and_slices(spark, monkeypatch):
    """More sources than a row has columns, messages in several jobs; the ranks of old rounds go."""
    edges = spark.createDataFrame([(i, (i * k + 1) % 23) for i in range(23) for k in (2, 5)], "src long, dst long")
    wanted = spark.range(11).toDF("id")
    frames = []

    def noted(df, label):
        frames.append(staged(df, label))
        return frames[-1]

    monkeypatch.setattr(PR, "staged", noted)
    got = {(r["source"], r["id"]): r["rank"] for r in PR.pagerank_many(edges, wanted, 4, rows_per_job=40).collect()}
    want = {(s, r["id"]): r["rank"] for s in range(11) for r in PR.pagerank(edges, 4, source=s).collect() if r["rank"] > 0}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    left = [f for f in frames if glob.glob(f.staged_at.removeprefix("file:"))]
    # 46 edges for each of two groups: three slices a round.
    assert len(frames) == 12 and left == frames[-3:]


def test_a_fit_drops_the_files_of_its_steps(spark):
    """Factors were sent in ten half steps; the files of few of them are left."""
    rows = [(u, i, float((u * i) % 5)) for u in range(40) for i in range(30) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before = shuffles(spark)
    model = recommend.fit_implicit(ratings, rank=2)
    for _ in range(20):
        left = shuffles(spark) - before
        if len(left) <= 6:
            break
        time.sleep(0.5)
    assert len(left) <= 6 and model.userFactors.count() == 40


def test_blocks_follow_the_ratings(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(recommend, "ALS", lambda **settings: seen.update(settings) or ALS(**settings))
    monkeypatch.setattr(recommend, "LEAST_BLOCKS", 1)
    ratings = spark.createDataFrame([(u, u % 7, 1.0) for u in range(50)], "user int, item int, rating double")
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        recommend.fit_implicit(ratings, rank=2, iterations=1)
        assert seen["numUserBlocks"] == seen["numItemBlocks"] == spark.sparkContext.defaultParallelism
        monkeypatch.setattr(recommend, "RATINGS_PER_BLOCK", 5)
        recommend.fit_implicit(ratings, rank=2, iterations=1)
        assert seen["numUserBlocks"] == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)


def test_batches_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    """Twenty files in a few batches, and every closed window once with its count."""
    minutes = 25_000 * 20 // 500
    rows = spark.range(25_000 * 20).select(
        (F.lit("2024-01-01").cast("timestamp").cast("long") + F.col("id") % minutes * 60).cast("timestamp").alias("ts"), F.lit("view").alias("event_type"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "stream_out", lambda spark: f"{tmp_path}/out")
    got = QUERIES["stream_watermark_append"](spark, str(tmp_path)).collect()
    # The last three windows are within the watermark of the last minute.
    assert len(got) == minutes // 5 - 3 and {r["n"] for r in got} == {2500} and len({r["start_s"] for r in got}) == len(got)
    offsets = [f for f in glob.glob(f"{tmp_path}/out/_spark_metadata/*") if f.rsplit("/", 1)[1].split(".")[0].isdigit()]
    assert 3 < len(offsets) <= 10


def test_files_of_a_batch_are_bounded(spark, monkeypatch):
    rows = spark.range(200).select(F.col("id").cast("timestamp").alias("ts"))
    folder = runner.staged_in_order(rows, "ts", rows_per_file=10)
    assert [runner.files_per_batch(spark, folder, n) for n in (1, 8, 20, 50)] == [20, 3, 1, 1]
    monkeypatch.setattr(runner, "FILES_PER_BATCH", 5)
    assert runner.files_per_batch(spark, folder, 1) == 5
