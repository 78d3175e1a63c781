"""Streaming queries: the tables run as file streams until all input is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.text import explode_words, words_of_text
from weftline.plans.registry import LINES_SQL, TRIMMED_WORDS_SQL, WORDS_SQL, query
from weftline.plans.relational import BLOCKED_WORDS
from weftline.session import scratch_path
from weftline.sources.tables import listed, table
from weftline.sources.topics import decode_topic
from weftline.streaming import counts as C
from weftline.streaming.arrivals import by_arrival
from weftline.streaming.runner import (
    files_per_batch, run_append, run_batches, run_complete, run_recovering, staged_in_order, stream_lines, stream_table, write_batch, written,
)
from weftline.streaming.state import update_all_keys

# Totals that exist before the first batch.
SEED = [("hello", 1), ("world", 1)]

TALK_WORDS_SQL = WORDS_SQL.replace("doc_id", "role").replace("documents", "conversations")


def stream_out(spark):
    return scratch_path(spark, "stream-out")


def document_words(spark, d, trim=True):
    return words_of_text(stream_table(spark, d, "documents"), "text", trim=trim)


def summed(per_batch, *keys):
    return per_batch.groupBy(*keys).agg(F.sum("n").alias("n"))


@query("stream_word_count", f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word")
def stream_word_count(spark, d):
    return run_complete(C.running_counts(document_words(spark, d, trim=False), "word"), stream_out(spark))


@query("stream_batch_counts", f"SELECT word, count(*)::BIGINT AS n FROM ({TRIMMED_WORDS_SQL}) GROUP BY word")
def stream_batch_counts(spark, d):
    return summed(C.counts_per_batch(document_words(spark, d), stream_out(spark), "word"), "word")


@query("stream_running_total", f"SELECT word, count(*) AS n FROM ({TALK_WORDS_SQL}) GROUP BY word")
def stream_running_total(spark, d):
    words = words_of_text(stream_table(spark, d, "conversations"), "text")
    return run_complete(C.running_counts(words, "word"), stream_out(spark))


@query(
    "stream_seeded_total",
    f"""SELECT word, sum(n)::BIGINT AS n FROM (
          SELECT word, count(*) AS n FROM ({TRIMMED_WORDS_SQL}) GROUP BY word
          UNION ALL SELECT 'hello', 1 UNION ALL SELECT 'world', 1) GROUP BY word""",
)
def stream_seeded_total(spark, d):
    totals = run_complete(C.running_counts(document_words(spark, d), "word"), stream_out(spark))
    return C.with_seed(totals, spark.createDataFrame(SEED, "word string, n bigint"))


def window_sql(size, slide, keys="event_type", source="events", extra=""):
    """Each row belongs to size/slide windows that start at multiples of the slide."""
    return f"""SELECT start_s, start_s + {size} AS end_s, {keys}, count(*) AS n FROM (
          SELECT *, (floor(epoch(ts) / {slide}) * {slide} - {slide} * unnest(range(0, {size // slide})))::BIGINT AS start_s
          FROM {source}) {extra} GROUP BY ALL"""


@query("stream_window_tumbling", window_sql(3600, 3600))
def stream_window_tumbling(spark, d):
    size, _ = C.check_window(3600)
    events = stream_table(spark, d, "events")
    return run_complete(C.windowed_counts(events, "ts", size, None, "event_type"), stream_out(spark))


@query("stream_window_sliding", window_sql(600, 300))
def stream_window_sliding(spark, d):
    """Sliding windows, the complete result ordered by window."""
    size, slide = C.check_window(600, 300)
    counted = C.windowed_counts(stream_table(spark, d, "events"), "ts", size, slide, "event_type")
    return run_complete(counted.orderBy("start_s"), stream_out(spark))


@query(
    "stream_window_words",
    window_sql(
        86400, 86400, "word",
        "(SELECT ts, unnest(string_split(event_type || ' ' || props, ' ')) AS word FROM events)",
    ),
)
def stream_window_words(spark, d):
    """Words of each event line, every word carrying the time of its line."""
    lines = stream_table(spark, d, "events").select("ts", F.concat_ws(" ", "event_type", "props").alias("line"))
    words = explode_words(lines, "line", "ts")
    return run_complete(C.windowed_counts(words, "ts", "1 day", None, "word"), stream_out(spark))


@query(
    "stream_watermark_append",
    window_sql(
        300, 300,
        extra="WHERE start_s + 300 <= (SELECT floor(max(epoch_ms(ts))) / 1000.0 - 600 FROM events)",
    ),
)
def stream_watermark_append(spark, d):
    """Only windows that the watermark has closed are written, each once; events arrive in order of time, some files at a time."""
    rows = table(spark, d, "events").select("ts", "event_type").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = staged_in_order(rows, "ts", rows_per_file=25_000)
    events = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch(spark, folder)).parquet(folder)
    counted = C.windowed_counts(events, "ts", "5 minutes", None, "event_type", watermark="10 minutes")
    return run_append(counted, stream_out(spark))


@query("stream_batch_sql", f"SELECT word, count(*)::BIGINT AS n FROM ({TRIMMED_WORDS_SQL}) GROUP BY word")
def stream_batch_sql(spark, d):
    sql = "SELECT word, count(*) AS n FROM batch GROUP BY word"
    return summed(C.counts_per_batch(document_words(spark, d), stream_out(spark), sql=sql), "word")


@query(
    "stream_blocklist",
    f"""SELECT word, count(*)::BIGINT AS n, word IN ('val', 'var', 'def') AS dropped
        FROM ({TRIMMED_WORDS_SQL}) GROUP BY word""",
)
def stream_blocklist(spark, d):
    blocked = listed(spark, "word", BLOCKED_WORDS)
    found = C.unlisted_counts_per_batch(document_words(spark, d), blocked, stream_out(spark))
    return summed(found, "word", "dropped")


@query("stream_mod_count", "SELECT event_id % 10 AS key, count(*)::BIGINT AS n FROM events GROUP BY 1")
def stream_mod_count(spark, d):
    keys = stream_table(spark, d, "events").select((F.col("event_id") % 10).alias("key"))
    return summed(C.counts_per_batch(keys, stream_out(spark), "key"), "key")


@query("stream_device_filter", "SELECT user_id AS device FROM events WHERE value > 10")
def stream_device_filter(spark, d):
    devices = stream_table(spark, d, "events").filter("value > 10").select(F.col("user_id").alias("device"))
    return run_append(devices, stream_out(spark))


@query("stream_device_count", "SELECT event_type AS device_type, count(*) AS n FROM events GROUP BY 1")
def stream_device_count(spark, d):
    types = stream_table(spark, d, "events").select(F.col("event_type").alias("device_type"))
    return run_complete(C.running_counts(types, "device_type"), stream_out(spark))


@query(
    "stream_device_avg",
    "SELECT event_type AS device_type, avg(round(value * 100)::BIGINT) AS mean_cents FROM events GROUP BY 1",
)
def stream_device_avg(spark, d):
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = stream_table(spark, d, "events").select(F.col("event_type").alias("device_type"), cents.alias("cents"))
    return run_complete(events.groupBy("device_type").agg(F.avg("cents").alias("mean_cents")), stream_out(spark))


@query("stream_csv_dir", "SELECT c_name AS name, c_nationkey AS age FROM customer")
def stream_csv_dir(spark, d):
    """A folder of ``;``-separated files as a stream with a declared schema."""
    folder = scratch_path(spark, "csv")
    table(spark, d, "customer").select("c_name", "c_nationkey").write.csv(folder, sep=";")
    people = spark.readStream.schema("name string, age int").option("sep", ";").csv(folder)
    return run_append(people, stream_out(spark))


@query("stream_lines", f"SELECT line AS value, true AS timed FROM ({LINES_SQL})")
def stream_text_lines(spark, d):
    """Text lines with the arrival time of their file."""
    folder = scratch_path(spark, "lines")
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    lines.write.text(folder)
    timed = stream_lines(spark, folder).select("value", F.col("timestamp").isNotNull().alias("timed"))
    return run_append(timed, stream_out(spark))


@query(
    "topic_word_count",
    f"""SELECT word, count(*) AS n FROM ({TALK_WORDS_SQL}) WHERE role IN ('user', 'assistant') GROUP BY word""",
)
def topic_word_count(spark, d):
    """Two subscribed topics of a record stream, values decoded from bytes."""
    records = stream_table(spark, d, "conversations").select(
        F.col("role").alias("topic"), F.col("text").cast("binary").alias("value")
    )
    words = words_of_text(decode_topic(records, ["user", "assistant"]), "value")
    return run_complete(C.running_counts(words, "word"), stream_out(spark))


@query("stream_batch_log", f"SELECT count(*)::BIGINT AS n_words FROM ({TRIMMED_WORDS_SQL})")
def stream_batch_log(spark, d):
    return C.log_batches(document_words(spark, d), stream_out(spark)).agg(F.sum("n_words").alias("n_words"))


@query(
    "stream_first_rows",
    f"SELECT word, count(*) AS n FROM ({TRIMMED_WORDS_SQL}) GROUP BY word ORDER BY n DESC, word LIMIT 10",
)
def stream_first_rows(spark, d):
    """The ten most frequent words after the last batch."""
    counted = C.running_counts(document_words(spark, d), "word")
    previews = C.first_rows_per_batch(counted, stream_out(spark), F.desc("n"), "word")
    last = previews.agg(F.max("batch_id")).first()[0]
    return previews.filter(F.col("batch_id") == last).select("word", "n")


N_BATCHES = 4
BATCH_SQL = f"SELECT (event_id % {N_BATCHES})::INTEGER AS batch_id, event_type FROM events"
BATCH_COUNTS_SQL = f"SELECT batch_id, event_type, count(*) AS n FROM ({BATCH_SQL}) GROUP BY ALL"


def in_batches(spark, d, run, *columns, batch=None):
    """Events as a stream of several batches, each a folder that arrives by itself.

    ``run`` gets the stream, and an output folder and a checkpoint that stay the same.
    """
    out, checkpoint = stream_out(spark), scratch_path(spark, "stream-state")
    rows = table(spark, d, "events").select("event_id", "event_type", *columns)
    number = F.coalesce(F.col("event_id") % N_BATCHES, F.lit(0)) if batch is None else batch
    return by_arrival(rows, number, lambda stream: run(stream, out, checkpoint))


@query("stream_batches", BATCH_COUNTS_SQL)
def stream_batches(spark, d):
    """Every batch counted on its own."""
    return in_batches(spark, d, lambda stream, out, at: C.counts_per_batch(stream, out, "event_type", checkpoint=at))


@query(
    "stream_batches_sql",
    f"SELECT batch_id, event_type, count(*) AS n, max(event_id) AS last_id FROM (SELECT *, (event_id % {N_BATCHES})::INTEGER AS batch_id FROM events) GROUP BY ALL",
)
def stream_batches_sql(spark, d):
    """Every batch summed up by SQL text over its view."""
    sql = "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM batch GROUP BY event_type"
    return in_batches(spark, d, lambda stream, out, at: C.counts_per_batch(stream, out, sql=sql, checkpoint=at))


@query(
    "stream_batches_listed",
    f"""SELECT batch_id, event_type, n, event_type IN (SELECT min(event_type) FROM events) AS dropped FROM ({BATCH_COUNTS_SQL})""",
)
def stream_batches_listed(spark, d):
    """Counts of every batch, with a flag on the kinds that a list names."""
    first = table(spark, d, "events").agg(F.min("event_type").alias("event_type"))
    return in_batches(spark, d, lambda stream, out, at: C.unlisted_counts_per_batch(stream, first, out, "event_type", checkpoint=at))


@query(
    "stream_batches_log",
    f"SELECT batch_id, sum(n)::BIGINT AS n_words, count(*) AS n_distinct FROM ({BATCH_COUNTS_SQL}) GROUP BY batch_id",
)
def stream_batches_log(spark, d):
    """One line of totals for every batch."""
    return in_batches(spark, d, lambda stream, out, at: C.log_batches(
        stream.select(F.col("event_type").alias("word")), out, checkpoint=at))


RUNNING_SQL = f"""SELECT b AS batch_id, event_type, sum(n)::BIGINT AS n FROM ({BATCH_COUNTS_SQL}) JOIN range({N_BATCHES}) r(b) ON batch_id <= b GROUP BY ALL"""


@query(
    "stream_running_first",
    f"""SELECT batch_id::INTEGER AS batch_id, event_type, n FROM (
          SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, event_type) AS r FROM ({RUNNING_SQL})) WHERE r <= 3""",
)
def stream_running_first(spark, d):
    """The three kinds with most events since the start, as they stand after every batch."""
    return in_batches(spark, d, lambda stream, out, at: C.first_rows_per_batch(
        C.running_counts(stream, "event_type"), out, F.desc("n"), "event_type", n=3, checkpoint=at))


@query(
    "stream_update_state",
    f"SELECT batch_id, event_type, max(n) OVER (PARTITION BY event_type ORDER BY batch_id) AS total FROM ({BATCH_COUNTS_SQL})",
)
def stream_update_state(spark, d):
    """State that a function changes: the largest number of events that a kind had in one batch so far."""

    def run(stream, out, checkpoint):
        ones = stream.select("event_type", F.lit(1).cast("bigint").alias("n"))
        return C.updates_per_batch(C.update_by_key(ones, "event_type", "n", lambda added, old: max(added, old or 0)), out, checkpoint)

    return in_batches(spark, d, run)


def ones_of(column):
    return lambda stream: stream.select(column, F.lit(1).cast("bigint").alias("n"))


# Large events are few, so most users are silent in some batches.
LARGE = "value > 150"
BATCH_USERS_SQL = f"""large AS MATERIALIZED (SELECT (event_id % {N_BATCHES})::INTEGER AS batch_id, user_id, count(*) AS n FROM events WHERE {LARGE} GROUP BY ALL),
  arrived AS MATERIALIZED (SELECT DISTINCT (event_id % {N_BATCHES})::INTEGER AS batch_id FROM events WHERE {LARGE}),
  grid AS MATERIALIZED (SELECT u.user_id, b.batch_id, l.n FROM (SELECT DISTINCT user_id FROM large) u CROSS JOIN arrived b
    LEFT JOIN large l ON l.user_id = u.user_id AND l.batch_id = b.batch_id)"""


@query(
    "stream_all_keys",
    f"""WITH RECURSIVE {BATCH_USERS_SQL}, state AS (
          SELECT user_id, batch_id, n AS total, CASE WHEN n IS NULL THEN NULL ELSE 0 END::BIGINT AS idle FROM grid WHERE batch_id = 0
          UNION ALL
          SELECT user_id, g.batch_id,
                 CASE WHEN g.n IS NOT NULL THEN coalesce(s.total, 0) + g.n WHEN s.idle + 1 < 2 THEN s.total END,
                 CASE WHEN g.n IS NOT NULL THEN 0 WHEN s.idle + 1 < 2 THEN s.idle + 1 END
          FROM state s JOIN grid g USING (user_id) WHERE g.batch_id = s.batch_id + 1)
        SELECT batch_id, user_id, total, idle FROM state WHERE total IS NOT NULL""",
)
def stream_all_keys(spark, d):
    """Large events of every user after each batch, users without any in it too; after two silent batches a user is forgotten."""

    def update(added, total, idle):
        return F.when(added.isNotNull(), F.coalesce(total, F.lit(0)) + added).when(idle < 2, total)

    return in_batches(spark, d, lambda stream, out, at: update_all_keys(
        ones_of("user_id")(stream.where(LARGE)), "user_id", "n", out, update, checkpoint=at), "user_id", "value")


@query(
    "stream_seeded_batches",
    f"""SELECT b::INTEGER AS batch_id, event_type, sum(n)::BIGINT AS total FROM (
          SELECT batch_id, event_type, n FROM ({BATCH_COUNTS_SQL})
          UNION ALL SELECT 0, 'hello', 1 UNION ALL SELECT 0, 'world', 1
          UNION ALL SELECT 0, min(event_type), 1000 FROM events) JOIN range({N_BATCHES}) r(b) ON batch_id <= b GROUP BY ALL""",
)
def stream_seeded_batches(spark, d):
    """Counts since before the first batch: the state starts with three keys, two of which never come."""
    first = table(spark, d, "events").agg(F.min("event_type").alias("event_type")).withColumn("total", F.lit(1000).cast("bigint"))
    seed = spark.createDataFrame(SEED, "event_type string, total bigint").unionByName(first)
    found = in_batches(spark, d, lambda stream, out, at: update_all_keys(
        ones_of("event_type")(stream), "event_type", "n", out, seed=seed, checkpoint=at))
    return found.select("batch_id", "event_type", "total")


# Most events come in order of time, in quarters; a fifth of the second quarter comes last.
ARRIVAL_SQL = """SELECT ts, event_type, CASE WHEN q = 1 AND event_id % 5 = 0 THEN 3 ELSE q END AS batch_id FROM (
    SELECT *, (4 * event_id) // (SELECT max(event_id) + 1 FROM events) AS q FROM events)"""


@query(
    "stream_late_dropped",
    f"""WITH arrived AS MATERIALIZED ({ARRIVAL_SQL}),
          ends AS (SELECT batch_id, max(epoch_ms(ts)) - 600000 AS reach FROM arrived GROUP BY batch_id),
          marks AS (SELECT batch_id, max(reach) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM ends),
          placed AS (SELECT event_type, (floor(epoch(ts) / 300) * 300)::BIGINT AS start_s, batch_id FROM arrived),
          judged AS (SELECT event_type, start_s, (start_s + 300) * 1000 > coalesce(mark, -1) AS kept FROM placed JOIN marks USING (batch_id))
        SELECT start_s, start_s + 300 AS end_s, event_type, count(*) FILTER (WHERE kept) AS n, count(*) FILTER (WHERE NOT kept) AS n_late
        FROM judged WHERE (start_s + 300) * 1000 <= (SELECT max(reach) FROM ends)
        GROUP BY ALL HAVING count(*) FILTER (WHERE kept) > 0""",
)
def stream_late_dropped(spark, d):
    """Closed windows with the events that came in time, and how many were dropped as the watermark had passed their window."""
    top = table(spark, d, "events").agg(F.max("event_id")).first()[0] or 0
    quarter = F.floor(4 * F.col("event_id") / F.lit(top + 1)).cast("int")
    arrival = F.when((quarter == 1) & (F.col("event_id") % 5 == 0), F.lit(3)).otherwise(quarter)
    found = in_batches(spark, d, lambda stream, out, at: run_append(
        C.windowed_counts(stream, "ts", "5 minutes", None, "event_type", watermark="10 minutes"), out, at), "ts", batch=arrival)
    every = C.windowed_counts(table(spark, d, "events"), "ts", "5 minutes", None, "event_type")
    return found.join(every.withColumnRenamed("n", "n_all"), ["start_s", "end_s", "event_type"]).select(
        "start_s", "end_s", "event_type", "n", (F.col("n_all") - F.col("n")).alias("n_late"))


@query("stream_recovered", f"SELECT batch_id, event_type, n, CASE WHEN batch_id = 1 THEN 2 ELSE 1 END::BIGINT AS n_tries FROM ({BATCH_COUNTS_SQL})")
def stream_recovered(spark, d):
    """The sink fails once, after it has written the second batch and before that is committed; the query goes on from its checkpoint."""
    tries = {}

    def run(stream, out, checkpoint):
        def sink(frame, batch_id):
            tries[batch_id] = tries.get(batch_id, 0) + 1
            write_batch(frame.groupBy("event_type").agg(F.count("*").alias("n"), F.lit(tries[batch_id]).cast("bigint").alias("n_tries")), out, batch_id)
            if batch_id == 1 and tries[batch_id] == 1:
                raise OSError("the sink has failed")

        run_recovering(stream, sink, checkpoint=checkpoint)
        return written(spark, out, spark.createDataFrame([], "event_type string, n bigint, n_tries bigint, batch_id int").schema)

    return in_batches(spark, d, run)


@query("stream_interval_updates", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_interval_updates(spark, d):
    """Update output on a processing-time trigger: the changed counts of each batch; the last word on every kind counts."""
    out = stream_out(spark)
    counted = C.running_counts(stream_table(spark, d, "events").select("event_type"), "event_type")
    query_ = run_batches(counted, lambda frame, batch_id: write_batch(frame, out, batch_id), "update", trigger="200 milliseconds")
    try:
        query_.processAllAvailable()
    finally:
        query_.stop()
    updates = written(spark, out, spark.createDataFrame([], "event_type string, n bigint, batch_id int").schema)
    return updates.groupBy("event_type").agg(F.max_by("n", "batch_id").alias("n"))
