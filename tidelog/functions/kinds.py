"""Row kinds, sequence numbers, and the scalar codecs of a changelog as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kinds of a change row.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = 0, 1, 2, 3
NAMES = {INSERT: "+I", UPDATE_BEFORE: "-U", UPDATE_AFTER: "+U", DELETE: "-D"}
KIND, SEQ = "_row_kind", "_seq"


def kind(value: int) -> Column:
    return F.lit(value).cast("tinyint")


def value_kind(column: Column) -> Column:
    """1 for rows that take something away, 0 for rows that add."""
    return F.when(column.isin(UPDATE_BEFORE, DELETE), 1).otherwise(0).cast("tinyint")


def compose_seq(xid: Column, op: Column) -> Column:
    """Transaction in the high half, operation in the low one. Transactions must stay below 2**31, so that order is kept."""
    return F.shiftleft(xid.cast("long"), 32).bitwiseOR(op.cast("long"))


def seq_xid(seq: Column) -> Column:
    return F.shiftrightunsigned(seq, 32)


def seq_op(seq: Column) -> Column:
    return seq.bitwiseAND(F.lit(0xFFFFFFFF))


def compose_tid(block: Column, offset: Column) -> Column:
    return F.shiftleft(block.cast("long"), 16).bitwiseOR(offset.cast("long"))


def days_since_2000(date: Column) -> Column:
    return F.datediff(date, F.lit("2000-01-01").cast("date"))


def date_of_days(days: Column) -> Column:
    return F.date_add(F.lit("2000-01-01").cast("date"), days)


def micros_since_2000(ts: Column) -> Column:
    """Of a timestamp with or without zone, read as UTC."""
    return F.unix_micros(ts.cast("timestamp")) - F.lit(946_684_800_000_000)


def timestamp_of_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros + F.lit(946_684_800_000_000)).cast("timestamp_ntz")


def to_decimal(text: Column, precision: int = 38, scale: int = 18) -> Column:
    """Null where the text is no number or doesn't fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def four_decimals(value: Column) -> Column:
    return F.printf(F.lit("%.4f"), value.cast("double"))


def close_to(a: Column, b: Column, eps: float = 0.005) -> Column:
    return F.abs(a - b) < F.lit(eps)


def net(kind_column: Column) -> Column:
    """+1 for rows that add, -1 for rows that take away; summed it is the number of live rows."""
    return F.when(kind_column.isin(UPDATE_BEFORE, DELETE), -1).otherwise(1)


def fnv1a32(data: bytes) -> int:
    """The 32-bit FNV-1a hash."""
    found = 0x811C9DC5
    for byte in data:
        found = (found ^ byte) * 0x01000193 & 0xFFFFFFFF
    return found


def fnv1a32_column(text: Column) -> Column:
    """The same of a text's UTF-8 bytes, as a long."""
    digits = F.hex(F.encode(text, "UTF-8"))
    byte = lambda i: F.conv(F.substring(digits, 2 * i - 1, F.lit(2)), 16, 10).cast("long")
    places = F.when(F.length(digits) > 0, F.sequence(F.lit(1), (F.length(digits) / 2).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.lit(0x811C9DC5).cast("long"), lambda h, i: (h.bitwiseXOR(byte(i)) * F.lit(0x01000193).cast("long")).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))


def to_text(value: Column, nested: bool = False) -> Column:
    """Any value as text: nested ones as JSON, binary as hexadecimal digits after ``\\x``, the others as a cast writes them."""
    return F.to_json(value) if nested else value.cast("string")


def binary_text(value: Column) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(value)))


def to_number(value: Column) -> Column:
    """A number of whatever numeric or text type as double; null where it is none."""
    return value.cast("string").try_cast("double")
