"""Secret scanning with ownership frequency over the whole corpus, with DataFrame functions only.

Patterns give candidates with their places.  A candidate value is counted over
distinct documents (repositories) and sources (owners): one that many owners
have is a widely copied example, one that few have looks live.  Long mixed
tokens become findings only when they look live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import text_or_empty, with_text
from weftline.session import staged


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int  # the value
    least: int  # characters of the value
    always: bool  # whether a match is a finding whatever its frequency


# Patterns and lengths are stated with the operator.
KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Kind("hex", r"[0-9a-f]+", 0, 24, True),
    # Long tokens of lower and upper case and digits.
    Kind("mixed", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{32,}", 0, 32, False),
)
# A value with so many owners is an example that was copied about.
EXAMPLE_OWNERS = 3
# Matches summed up at a time when places are worked out.
STEP = 128

# Whether a text can have a match; short runs of hexadecimal letters are in every text.
PROBES = {"hex": r"[0-9a-f]{24}"}
# The same runs as the pattern has, without those too short to count.
LONG = {"hex": r"[0-9a-f]{24,}"}


def running(lengths: Column) -> Column:
    """Sum of the elements before each, taken ``STEP`` at a time, so that arrays are not copied for each element."""
    def prefix(part: Column, base: Column) -> Column:
        return F.aggregate(part, F.struct(base.alias("sum"), F.array().cast("array<int>").alias("all")), lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all")))["all"]

    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / STEP).cast("int") - 1, F.lit(0))),
                        lambda i: F.slice(lengths, i * STEP + 1, F.lit(STEP)))
    bases = prefix(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x)), F.lit(0))
    return F.flatten(F.zip_with(parts, bases, prefix))


def matches(text: Column, kind: Kind) -> Column:
    """Array of (kind, start, end, value) of a text; leftmost and not overlapping, then by value length."""
    pattern = LONG.get(kind.name, kind.pattern)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(kind.group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    # The i-th match starts after i + 1 gaps and i matches.
    ends = running(F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), F.transform(whole, F.length), lambda g, m: g + m))
    found = F.transform(F.arrays_zip(whole.alias("m"), value.alias("v"), gaps.alias("g"), ends.alias("b")), lambda x: F.struct(
        F.lit(kind.name).alias("kind"), (x["b"] + x["g"]).alias("start"), (x["b"] + x["g"] + F.length(x["m"])).alias("end"),
        x["v"].alias("value")))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    kept = F.filter(F.slice(found, F.lit(1), F.size(whole)), lambda x: F.length(x["value"]) >= kind.least)
    return F.when(text.rlike(PROBES.get(kind.name, pattern)), kept).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``found``, the candidates of a text, each with a digest in place of its value."""
    text = text_or_empty()
    every = docs.withColumn("found", F.concat(*[matches(text, kind) for kind in KINDS]))
    return every.withColumn("found", F.transform("found", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.sha2(x["value"], 256).alias("digest"))))


def ownership(found: DataFrame, least_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(digest, repositories, owners, live) of every candidate value; a null owner counts as an owner.

    Counts are summed before each shuffle, so a value in every document is a
    few rows for a task.
    """
    each = found.where(F.size("found") > 0).select("doc_id", "owner", F.explode(F.array_distinct("found.digest")).alias("digest"))
    by_owner = each.distinct().groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("digest").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners")).withColumn(
        "live", F.col("owners") < least_owners)


def scan(docs: DataFrame, least_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(doc_id, row, spans): findings of every row of ``docs`` (doc_id, source, text).

    ``row`` is a digest of id, source and text; equal rows share it and their
    findings.  ``spans`` is an array of (kind, start, end, live), places in
    code points with the end exclusive, ordered by start and then by kind as
    listed.  A null text is empty and has none; a null source is an owner of
    its own; an empty table gives an empty one; other columns are not read.
    """
    found = staged(candidates(docs.select("doc_id", F.col("source").alias("owner"), row_digest().alias("row"), "text")).drop("text"), "secrets")
    some = found.where(F.size("found") > 0).dropDuplicates(["row"]).select("row", F.explode("found").alias("x")).select("row", "x.*")
    order = F.array_position(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind"))
    always = F.col("kind").isin([k.name for k in KINDS if k.always])
    judged = some.join(ownership(found, least_owners), "digest").where(always | F.col("live")).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "kind", "end", "live"))).alias("spans"))
    spans = F.transform("spans", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["live"].alias("live")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,live:boolean>>")
    return found.select("doc_id", "row").join(judged.select("row", spans.alias("spans")), "row", "left").withColumn(
        "spans", F.coalesce("spans", none))


def row_digest() -> Column:
    return F.sha2(F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("\x02")),
                              F.coalesce(F.col("source").cast("string"), F.lit("\x02")), text_or_empty()), 256)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def span_digests(scanned: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda x: x["kind"].isin([k.name for k in KINDS if k.always]))
    count = lambda name: F.size(F.filter("spans", lambda x: x["kind"] == name)).cast("long").alias(f"n_{name}")
    return scanned.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"))


def redacted(docs: DataFrame, scanned: DataFrame, live: str = "[SECRET]", example: str = "[EXAMPLE]") -> DataFrame:
    """``docs`` with the findings cut out of their texts, live ones and examples marked apart.

    Columns are those of ``docs``; ``n_chars``, where there is one, is set anew.
    Overlapping findings are cut out as one, which is live if any of them is.
    """
    text = F.col("doc")["text"]
    found = scanned.where(F.size("spans") > 0).dropDuplicates(["row"]).select("row", "spans")
    merged = F.aggregate("spans", F.array().cast("array<struct<start:int,end:int,live:boolean>>"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > x["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end"),
            (F.try_element_at(acc, F.lit(-1))["live"] | x["live"]).alias("live")))),
    ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"), x["live"].alias("live"))))))
    cut = F.transform("cuts", lambda x, i: F.concat(
        F.substring(text, F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0)) + 1,
                    x["start"] - F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0))),
        F.when(x["live"], live).otherwise(example)))
    rest = F.substring(text, F.try_element_at("cuts", F.lit(-1))["end"] + 1, F.length(text))
    # The row travels as one column, so none of its names can clash.
    joined = docs.select(F.struct("*").alias("doc"), row_digest().alias("row")).join(found, "row", "left").withColumn("cuts", merged)
    changed = with_text(F.concat(F.array_join(cut, ""), rest), docs.schema)
    return joined.select(F.when(F.col("spans").isNotNull(), changed).otherwise(F.col("doc")).alias("doc")).select("doc.*")
