"""Cell bytes: big-endian two's complement and IEEE-754, UTF-8 text, 0xFF for true.

Everything but float and double stays inside the JVM; those two use Arrow
batches because Spark has no expression for the IEEE bit pattern.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Type names accepted in a column declaration; any other name is string.
TYPE_NAMES = {
    "long": "bigint",
    "float": "float",
    "double": "double",
    "integer": "int",
    "int": "int",
    "boolean": "boolean",
    "binary": "binary",
    "timestamp": "timestamp",
    "datetype": "date",
}

# Type names accepted as hints in a schemaless scan.
HINT_NAMES = {
    "LongType": "bigint",
    "FloatType": "float",
    "DoubleType": "double",
    "IntegerType": "int",
    "BooleanType": "boolean",
    "BinaryType": "binary",
    "TimestampType": "timestamp",
    "DateType": "date",
}


def spark_type(name: str) -> str:
    """Spark type of a declared type name; unknown names mean string."""
    return TYPE_NAMES.get(name.lower(), "string")


def hint_type(name: str) -> str:
    return HINT_NAMES.get(name, "string")


def _ieee_writer(code: str):
    width = int(code[2])

    @F.arrow_udf("binary")
    def write(values: pa.Array) -> pa.Array:
        raw = values.fill_null(0.0).to_numpy(zero_copy_only=False).astype(code).tobytes()
        cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(raw)])
        return pc.if_else(values.is_valid(), cells.cast(pa.binary()), pa.scalar(None, pa.binary()))

    return write


def _ieee_reader(code: str, result: str):
    width = int(code[2])

    @F.arrow_udf(result)
    def read(cells: pa.Array) -> pa.Array:
        good = pc.fill_null(pc.equal(pc.binary_length(cells), width), False)
        fixed = cells.filter(good).cast(pa.binary(width))
        values = np.frombuffer(fixed.buffers()[1] or b"", code, len(fixed), fixed.offset * width)
        mask = good.to_numpy(zero_copy_only=False)
        out = np.zeros(len(cells), f"f{width}")
        out[mask] = values
        # A mask keeps NaN apart from null.
        return pa.array(out, mask=~mask)

    return read


def _hex_bytes(value: Column, digits: int) -> Column:
    """Big-endian bytes of an integer; ``hex`` of a negative long has 16 digits."""
    full = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.unhex(F.substring(full, 17 - digits, digits))


def _signed(cell: Column, width: int) -> Column:
    """Integer of a big-endian cell, NULL when the width is wrong."""
    digits = F.when(F.length(cell) == width, F.hex(cell))
    if width == 8:
        return F.conv(digits, 16, -10).cast("bigint")
    unsigned = F.conv(digits, 16, 10).cast("bigint")
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")


def encode_cell(value: Column, kind: str, int_encoding: str = "binary") -> Column:
    """Bytes of a value of Spark type ``kind``; NULL in, NULL out except strings."""
    if kind == "bigint":
        return _hex_bytes(value, 16)
    if kind == "int":
        if int_encoding == "text":
            return value.cast("string").cast("binary")
        return _hex_bytes(value, 8)
    if kind == "double":
        return _ieee_writer(">f8")(value)
    if kind == "float":
        return _ieee_writer(">f4")(value)
    if kind == "boolean":
        return F.when(value, F.unhex(F.lit("FF"))).when(~value, F.unhex(F.lit("00")))
    if kind in ("timestamp", "timestamp_ntz"):
        return _hex_bytes(F.unix_millis(value.cast("timestamp")), 16)
    if kind == "date":
        return _hex_bytes(F.unix_millis(value.cast("timestamp")), 16)
    if kind == "binary":
        return value
    return F.coalesce(value.cast("string"), F.lit("")).cast("binary")


def encode_key(value: Column, kind: str, int_encoding: str = "binary") -> Column:
    """Row-key bytes; a null key is an error, because it would stand for no row or for all of them."""
    return F.when(value.isNull(), F.raise_error(F.lit("a row key must not be null")).cast("binary")).otherwise(
        encode_cell(value, kind, int_encoding))


def decode_cell(
    cell: Column, kind: str, int_encoding: str = "binary", missing_long_as_zero: bool = True
) -> Column:
    """Value of a cell; an unreadable cell is NULL, or 0 for a long."""
    if kind == "bigint":
        value = _signed(cell, 8)
        return F.coalesce(value, F.lit(0).cast("bigint")) if missing_long_as_zero else value
    if kind == "int":
        if int_encoding == "text":
            return cell.cast("string").try_cast("int")
        return _signed(cell, 4)
    if kind == "double":
        return _ieee_reader(">f8", "double")(cell)
    if kind == "float":
        return _ieee_reader(">f4", "float")(cell)
    if kind == "boolean":
        return F.when(F.length(cell) == 1, F.hex(cell) != "00")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.timestamp_millis(_signed(cell, 8)).cast(kind)
    if kind == "date":
        return F.timestamp_millis(_signed(cell, 8)).cast("date")
    if kind == "binary":
        return cell
    return cell.cast("string")
