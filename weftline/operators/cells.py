"""Wide-column cells: ``row_key -> family:qualifier -> versioned bytes``.

A cell table is a frame ``(row_key BINARY, family STRING, qualifier STRING,
version BIGINT, value BINARY)``.  Writes only ever append; the value of a cell
is the one with the highest version.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.codec import decode_cell, encode_cell, encode_key, hint_type, spark_type
from weftline.operators.relational import broadcast_if_small
from weftline.session import cut_lineage

CELL_SCHEMA = "row_key binary, family string, qualifier string, version bigint, value binary"


@dataclass(frozen=True)
class CellColumn:
    """A table column and the cell it comes from; an empty family is the row key."""

    field: str
    kind: str
    family: str
    qualifier: str

    @property
    def is_row_key(self) -> bool:
        return self.family == ""


def declare_columns(fields: list[tuple[str, str]], cells: list[str]) -> list[CellColumn]:
    """Pair ``(name, type)`` fields with ``family:qualifier`` cells by position."""
    if not cells:
        raise ValueError("declared fields need their cell names")
    if len(fields) != len(cells):
        raise ValueError("there must be as many cell names as declared fields")
    columns = []
    for (name, kind), cell in zip(fields, cells):
        family, _, qualifier = cell.partition(":")
        columns.append(CellColumn(name, spark_type(kind), family, qualifier))
    return columns


def to_cells(
    df: DataFrame,
    row_key: str | None = None,
    family: str = "info",
    version: Column | int | None = None,
    int_encoding: str = "binary",
) -> DataFrame:
    """Unpivot rows into cells: the key column (default: the first) and one cell per other column.

    A null string becomes an empty value; other nulls write no cell.  A null
    key is an error.
    """
    key = row_key or df.columns[0]
    if key not in df.columns:
        raise ValueError(f"no column named {key}")
    kinds = dict(df.dtypes)
    if version is None:
        version = F.unix_millis(F.current_timestamp())
    elif isinstance(version, int):
        version = F.lit(version)
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("qualifier"),
                encode_cell(F.col(name), kinds[name], int_encoding).alias("value"),
            )
            for name in df.columns
            if name != key
        ]
    )
    return (
        df.select(
            encode_key(F.col(key), kinds[key], int_encoding).alias("row_key"),
            F.lit(family).alias("family"),
            version.cast("bigint").alias("version"),
            F.inline(cells),
        )
        .filter("value IS NOT NULL")
        .select("row_key", "family", "qualifier", "version", "value")
    )


def only_cells(cells: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """Cells of the named (family, qualifier) pairs, as a filter the scan can use."""
    by_family: dict[str, list[str]] = {}
    for family, qualifier in names:
        by_family.setdefault(family, []).append(qualifier)
    if not by_family:
        return cells
    wanted = [
        (F.col("family") == family) & F.col("qualifier").isin(qualifiers)
        for family, qualifiers in by_family.items()
    ]
    return cells.filter(reduce(lambda a, b: a | b, wanted))


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of every cell; versions combine before the shuffle.

    Of several values with one version the greatest counts, so that a repeated
    task gives the same result.
    """
    newest = cells.groupBy("row_key", "family", "qualifier").agg(F.max(F.struct("version", "value")).alias("top"))
    return newest.select("row_key", "family", "qualifier", "top.value", "top.version")


def typed_scan(
    cells: DataFrame | None,
    columns: list[CellColumn],
    keys: DataFrame | None = None,
    int_encoding: str = "binary",
    missing_long_as_zero: bool = True,
    of_keys: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per row key with the declared columns decoded.

    Only the declared cells are scanned, so rows without any of them do not
    appear.  Picking the newest version and pivoting is one aggregation.  With
    ``keys`` only those rows are returned, once per key row; a table that finds
    the cells of key bytes by itself gives them with ``of_keys``.
    """
    cell_columns = [c for c in columns if not c.is_row_key]
    encoded = None
    if keys is not None:
        declared = next((c.kind for c in columns if c.is_row_key), None)
        encoded = cut_lineage(encoded_keys(keys, declared, int_encoding))
        cells = only_keys(cells, encoded) if of_keys is None else of_keys(encoded)
    scanned = only_cells(cells, [(c.family, c.qualifier) for c in cell_columns])
    picks = []
    for i, column in enumerate(cell_columns):
        here = (F.col("family") == column.family) & (F.col("qualifier") == column.qualifier)
        picks.append(F.max(F.when(here, F.struct("version", "value")))["value"].alias(f"_c{i}"))
    grouped = scanned.groupBy("row_key")
    rows = grouped.agg(*picks) if picks else scanned.select("row_key").distinct()
    if encoded is not None:
        rows = encoded.join(rows, "row_key")
    source = {c: f"_c{i}" for i, c in enumerate(cell_columns)}
    return rows.select(
        *[
            decode_cell(
                F.col("row_key" if c.is_row_key else source[c]),
                c.kind,
                int_encoding,
                missing_long_as_zero and not c.is_row_key,
            ).alias(c.field)
            for c in columns
        ]
    )


def encoded_keys(keys: DataFrame, kind: str | None = None, int_encoding: str = "binary") -> DataFrame:
    """Row-key bytes of the first column of a key frame, read as the type that the table's keys have."""
    name, own = keys.dtypes[0]
    kind = kind or own
    return keys.select(encode_key(F.col(name).cast(kind), kind, int_encoding).alias("row_key"))


def only_keys(cells: DataFrame, encoded: DataFrame) -> DataFrame:
    """Cells of the given keys; the range of the keys is a filter that the scan can use."""
    low, high = encoded.agg(F.min("row_key"), F.max("row_key")).first()
    if low is None:
        return cells.filter(F.lit(False))
    ranged = cells.filter(F.col("row_key").between(F.lit(bytes(low)), F.lit(bytes(high))))
    return ranged.join(broadcast_if_small(encoded.distinct()), "row_key", "left_semi")


def _json_fragment(value: Column) -> Column:
    """JSON text of one value: that of a one-element array without its brackets."""
    text = F.to_json(F.array(value))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _hinted_json(value: Column, kind: str) -> Column:
    decoded = decode_cell(value, kind, missing_long_as_zero=False)
    if kind == "binary":
        decoded = F.base64(decoded)
    elif kind == "timestamp":
        decoded = F.date_format(decoded, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    elif kind == "date":
        decoded = decoded.cast("string")
    return _json_fragment(decoded)


def json_scan(
    cells: DataFrame, hints: dict[str, str] | None = None, keys: DataFrame | None = None,
    key_kind: str | None = None, int_encoding: str = "binary",
) -> DataFrame:
    """``(rowkey, content)`` with all cells of a row as one JSON object.

    Members are named ``family:qualifier`` and sorted by name.  Values are
    text unless ``hints`` gives a type for the name.  Keys are encoded as
    ``key_kind``, by default the type they come in.
    """
    if keys is not None:
        wanted = cut_lineage(encoded_keys(keys, key_kind, int_encoding))
        cells = only_keys(cells, wanted)
    name = F.concat_ws(":", "family", "qualifier")
    fragment = _json_fragment(decode_cell(F.col("value"), "string"))
    by_kind: dict[str, list[str]] = {}
    for cell, hint in (hints or {}).items():
        by_kind.setdefault(hint_type(hint), []).append(cell)
    for kind, names in by_kind.items():
        member = name.isin(names)
        # Decode only the cells of this type: other values are hidden from the decoder.
        typed = _hinted_json(F.when(member, F.col("value")), kind)
        fragment = F.when(member, typed).otherwise(fragment)
    members = latest(cells).select(
        "row_key",
        F.struct(name.alias("name"), F.concat(_json_fragment(name), F.lit(":"), fragment).alias("text")).alias("m"),
    )
    rows = members.groupBy("row_key").agg(F.array_sort(F.collect_list("m")).alias("m"))
    if keys is not None:
        rows = wanted.join(rows, "row_key")
    content = F.concat(F.lit("{"), F.array_join(F.col("m.text"), ","), F.lit("}"))
    return rows.select(F.col("row_key").cast("string").alias("rowkey"), content.alias("content"))


def row_count(cells: DataFrame) -> DataFrame:
    """Number of rows and of distinct cells: two levels of counting, no distinct sets."""
    per_row = latest(cells).groupBy("row_key").agg(F.count("*").alias("n"))
    return per_row.agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_cells"))
