import time

import pytest
from pyspark.sql import functions as F

from weftline.functions.text import explode_words
from weftline.session import scratch_path
from weftline.streaming import counts as C
from weftline.streaming import runner as S


def write_lines(spark, folder, *batches):
    """One file per batch, in order of arrival."""
    for lines in batches:
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)
        time.sleep(0.05)


def word_stream(spark, folder, trim=False):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    return explode_words(lines, "value", trim=trim)


@pytest.fixture
def folder(spark):
    path = scratch_path(spark, "in")
    write_lines(spark, path, ["a b a"], ["b c", "val def"])
    return path


def test_running_counts_cover_all_batches(spark, folder, rows):
    got = S.run_complete(C.running_counts(word_stream(spark, folder), "word"), scratch_path(spark, "out"))
    assert rows(got) == [("a", 2), ("b", 2), ("c", 1), ("def", 1), ("val", 1)]


def test_batches_are_counted_on_their_own(spark, folder, rows):
    got = C.counts_per_batch(word_stream(spark, folder), scratch_path(spark, "out"), "word")
    assert rows(got, "batch_id", "word", "n") == [
        (0, "a", 2), (0, "b", 1), (1, "b", 1), (1, "c", 1), (1, "def", 1), (1, "val", 1)]


def test_batch_sql(spark, folder, rows):
    sql = "SELECT word, count(*) AS n FROM batch GROUP BY word"
    got = C.counts_per_batch(word_stream(spark, folder), scratch_path(spark, "out"), sql=sql)
    assert rows(got.filter("batch_id = 0"), "word", "n") == [("a", 2), ("b", 1)]


def test_seeded_totals_show_seeds_without_input(spark, folder, rows):
    seed = spark.createDataFrame([("hello", 1), ("a", 1)], "word string, n bigint")
    totals = S.run_complete(C.running_counts(word_stream(spark, folder), "word"), scratch_path(spark, "out"))
    assert rows(C.with_seed(totals, seed))[:2] == [("a", 3), ("b", 2)]
    assert ("hello", 1) in rows(C.with_seed(totals, seed))


def test_block_list_counts_what_it_drops(spark, folder, rows):
    listed = spark.createDataFrame([("val",), ("var",), ("def",)], "word string")
    got = C.unlisted_counts_per_batch(word_stream(spark, folder), listed, scratch_path(spark, "out"))
    assert got.filter("dropped").agg(F.sum("n")).first()[0] == 2
    assert rows(got.filter("NOT dropped AND batch_id = 1"), "word", "n") == [("b", 1), ("c", 1)]


def test_batch_log(spark, folder, rows):
    got = C.log_batches(word_stream(spark, folder), scratch_path(spark, "out"))
    assert rows(got, "batch_id", "n_words", "n_distinct") == [(0, 3, 2), (1, 4, 4)]


def test_restart_continues_without_counting_twice(spark, folder, rows):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "state")
    S.run_complete(C.running_counts(word_stream(spark, folder), "word"), out, checkpoint)
    write_lines(spark, folder, ["a new"])
    got = S.run_complete(C.running_counts(word_stream(spark, folder), "word"), out, checkpoint)
    assert rows(got) == [("a", 3), ("b", 2), ("c", 1), ("def", 1), ("new", 1), ("val", 1)]


def test_a_restart_without_input_returns_the_result_from_before(spark, folder, rows):
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    counts = lambda: S.run_complete(C.running_counts(word_stream(spark, folder), "word"), out, state)
    before = rows(counts())
    assert rows(counts()) == before and before
    write_lines(spark, folder, ["a"])
    assert ("a", 3) in rows(counts()) and ("a", 3) in rows(counts())


def test_streams_without_any_input(spark):
    path = scratch_path(spark, "nothing")
    spark.createDataFrame([], "value string").coalesce(1).write.text(path)
    words = lambda: word_stream(spark, path).filter("false")
    out = lambda: scratch_path(spark, "out")
    empty = word_stream(spark, scratch_path_with_no_file(spark))
    assert C.counts_per_batch(empty, out(), "word").columns == ["word", "n", "batch_id"]
    assert C.counts_per_batch(words(), out(), "word").count() == 0
    assert C.log_batches(word_stream(spark, scratch_path_with_no_file(spark)), out()).count() == 0
    listed = spark.createDataFrame([("x",)], "word string")
    assert C.unlisted_counts_per_batch(word_stream(spark, scratch_path_with_no_file(spark)), listed, out()).count() == 0
    totals = C.running_counts(word_stream(spark, scratch_path_with_no_file(spark)), "word")
    assert S.run_complete(totals, out()).count() == 0
    assert C.first_rows_per_batch(totals, out(), "word").count() == 0


def scratch_path_with_no_file(spark):
    import os

    path = scratch_path(spark, "no-file").removeprefix("file:")
    os.makedirs(path)
    return path


def test_null_is_a_key_of_the_state(spark, rows):
    path = scratch_path(spark, "keys")
    schema = "key bigint, n bigint"
    for batch in ([(1, 2), (None, 3), (None, 4)], [(None, 5), (1, None)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    updates = C.update_by_key(stream, "key", "n", lambda added, old: added + (old or 0))
    out = scratch_path(spark, "out")
    S.run_batches(updates, lambda frame, batch_id: S.write_batch(frame, out, batch_id), "update")
    last = spark.read.parquet(out).groupBy("key").agg(F.max_by("total", "batch_id").alias("n"))
    assert {r.key: r.n for r in last.collect()} == {1: 2, None: 12}


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_ordered_input_gives_the_same_windows_in_any_batching(spark, rows, files_per_batch):
    data = spark.range(0, 6000, 7).selectExpr("timestamp_seconds(id * 11 % 5999 * 3) AS ts", "id % 2 AS k")
    folder = S.staged_in_order(data, "ts", rows_per_file=100)
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    got = S.run_append(C.windowed_counts(stream, "ts", "5 minutes", None, "k", watermark="10 minutes"), scratch_path(spark, "out"))
    last = data.agg(F.max(F.unix_seconds("ts"))).first()[0] - 600
    want = data.selectExpr("floor(unix_seconds(ts) / 300) * 300 AS s", "k").groupBy("s", "k").count().filter(f"s + 300 <= {last}")
    assert rows(got, "start_s", "k", "n") == rows(want, "s", "k", "count")


def test_append_sink_restarts_cleanly(spark, folder):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "state")
    assert S.run_append(word_stream(spark, folder), out, checkpoint).count() == 7
    write_lines(spark, folder, ["x y"])
    assert S.run_append(word_stream(spark, folder), out, checkpoint).count() == 9


def test_custom_state_function(spark, folder, rows):
    """Largest batch sum so far, which built-in sums cannot express."""
    ones = word_stream(spark, folder).withColumn("n", F.lit(1).cast("bigint"))
    updates = C.update_by_key(ones, "word", "n", lambda added, old: max(added, old or 0))
    out = scratch_path(spark, "out")
    S.run_batches(updates, lambda frame, batch_id: S.write_batch(frame, out, batch_id), "update")
    assert rows(spark.read.parquet(out), "batch_id", "word", "total") == [
        (0, "a", 2), (0, "b", 1), (1, "b", 1), (1, "c", 1), (1, "def", 1), (1, "val", 1)]


def test_custom_state_adds_up_like_running_counts(spark, folder):
    ones = word_stream(spark, folder).withColumn("n", F.lit(1).cast("bigint"))
    updates = C.update_by_key(ones, "word", "n", lambda added, old: added + (old or 0))
    out = scratch_path(spark, "out")
    S.run_batches(updates, lambda frame, batch_id: S.write_batch(frame, out, batch_id), "update")
    last = spark.read.parquet(out).groupBy("word").agg(F.max_by("total", "batch_id").alias("n"))
    assert {r.word: r.n for r in last.collect()} == {"a": 2, "b": 2, "c": 1, "def": 1, "val": 1}


def timed_folder(spark, *batches):
    path = scratch_path(spark, "timed")
    for rows in batches:
        frame = spark.createDataFrame(rows, "ts string, kind string").withColumn("ts", F.to_timestamp("ts"))
        frame.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


BATCHES = [
    [("2024-01-01 00:01:00", "x"), ("2024-01-01 00:02:00", "x")],
    [("2024-01-01 00:30:00", "x")],
    [("2024-01-01 00:31:00", "x")],
    [("2024-01-01 00:03:00", "x"), ("2024-01-01 00:25:00", "y")],
    [("2024-01-01 01:00:00", "z")],
]


def timed_stream(spark, path):
    return spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows_are_dropped_only_in_append(spark, rows):
    path = timed_folder(spark, *BATCHES)
    minute = F.date_format(F.timestamp_seconds("start_s"), "HH:mm").alias("at")
    late = C.windowed_counts(timed_stream(spark, path), "ts", "5 minutes", None, "kind", watermark="10 minutes")
    got = S.run_append(late, scratch_path(spark, "out"))
    # The late rows came after a batch with watermark 00:20: 00:03 is dropped, 00:25 was still in time.
    assert rows(got.select(minute, "kind", "n")) == [("00:00", "x", 2), ("00:25", "y", 1), ("00:30", "x", 2)]
    full = C.windowed_counts(timed_stream(spark, path), "ts", "5 minutes", None, "kind", watermark="10 minutes")
    got = S.run_complete(full, scratch_path(spark, "out"))
    assert rows(got.select(minute, "kind", "n")) == [
        ("00:00", "x", 3), ("00:25", "y", 1), ("00:30", "x", 2), ("01:00", "z", 1)]


def test_sliding_windows_equal_the_batch_result(spark, rows):
    path = timed_folder(spark, *BATCHES)
    streamed = S.run_complete(
        C.windowed_counts(timed_stream(spark, path), "ts", "10 minutes", "5 minutes", "kind"), scratch_path(spark, "out"))
    batch = C.windowed_counts(spark.read.parquet(path), "ts", "10 minutes", "5 minutes", "kind")
    assert rows(streamed) == rows(batch) and streamed.agg(F.sum("n")).first()[0] == 14


def test_window_arguments():
    assert C.check_window(60) == ("60 seconds", "60 seconds")
    assert C.check_window(60, 30) == ("60 seconds", "30 seconds")
    with pytest.raises(ValueError):
        C.check_window(30, 60)


def test_modulo_batches(spark, rows):
    path = scratch_path(spark, "numbers")
    for _ in range(3):
        spark.range(1, 101).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    numbers = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(path)
    got = C.counts_per_batch(numbers.select((F.col("id") % 10).alias("key")), scratch_path(spark, "out"), "key")
    assert rows(got, "batch_id", "key", "n") == [(b, k, 10) for b in range(3) for k in range(10)]


def test_interval_trigger_runs_until_stopped(spark, folder):
    seen = []
    query = S.run_batches(word_stream(spark, folder), lambda frame, batch_id: seen.append(frame.count()), trigger="1 second")
    query.processAllAvailable()
    query.stop()
    assert seen[:2] == [3, 4] and not query.isActive
