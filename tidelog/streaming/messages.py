"""Change rows as messages and back: one message for up to ``ROWS`` rows of a table's transaction, then its end marker.

A message has its kind (``batch``, ``sync``), the table, the schema's number, the transaction and a payload: a frame of a
little-endian four-byte length and the rows as JSON. All of it is DataFrame operations, so a stream of messages is
dispatched, decoded and committed like any other. Rows keep their types by the schema that reads them; decimals travel as
text, binary columns in base 64 as JSON has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.kinds import SEQ, seq_op, seq_xid

ROWS = 1_000
MESSAGE = "kind string, table string, schema_id int, xid long, part long, payload binary"
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


def framed(data: Column) -> Column:
    """A binary value after its length in four bytes, the lowest first."""
    n = F.octet_length(data)
    byte = lambda shift: F.lpad(F.hex(F.shiftright(n, shift).bitwiseAND(F.lit(255))), 2, "0")
    return F.concat(F.unhex(F.concat(byte(0), byte(8), byte(16), byte(24))), data)


def unframed(frame: Column) -> Column:
    """The value of a frame; null if the length doesn't fit what follows: such a message is damaged."""
    digits = F.hex(F.substring(frame, 1, 4))
    n = F.conv(F.concat(*(F.substring(digits, i, 2) for i in (7, 5, 3, 1))), 16, 10).cast("long")
    data = F.substring(frame, F.lit(5), F.octet_length(frame))
    return F.when(F.octet_length(data) == n, data)


def to_messages(changes: DataFrame, table: str, schema_id: int = 0, seq: str = SEQ, rows: int = ROWS) -> DataFrame:
    """Messages of a table's changes. A transaction's rows are cut into parts by their operation number, so that none grows with the transaction."""
    part = F.floor(seq_op(F.col(seq)) / F.lit(rows)).cast("long")
    row = F.struct(*changes.columns)
    packed = changes.groupBy(seq_xid(F.col(seq)).alias("xid"), part.alias("part")).agg(F.array_sort(F.collect_list(row), lambda a, b: F.signum(a[seq] - b[seq]).cast("int")).alias("rows"))
    payload = framed(F.encode(F.to_json("rows", _TIMES), "UTF-8"))
    batches = packed.select(F.lit("batch").alias("kind"), F.lit(table).alias("table"), F.lit(schema_id).alias("schema_id"), "xid", "part", payload.alias("payload"))
    ends = packed.groupBy("xid").agg(F.max("part").alias("part")).select(F.lit("sync").alias("kind"), F.lit(table).alias("table"), F.lit(schema_id).alias("schema_id"), "xid", "part", F.lit(None).cast("binary").alias("payload"))
    return batches.unionByName(ends)


def from_messages(messages: DataFrame, table: str, struct: T.StructType) -> DataFrame:
    """The change rows of one table's batches, typed by ``struct``; messages of other kinds and tables are passed over."""
    mine = messages.where((F.col("kind") == "batch") & (F.col("table") == table))
    rows = F.from_json(F.decode(unframed(F.col("payload")), "UTF-8"), T.ArrayType(struct), _TIMES)
    return mine.select(F.explode(rows).alias("row")).select("row.*")


def ended(messages: DataFrame) -> DataFrame:
    """(table, xid) of the transactions whose end marker and all parts are there."""
    whole = messages.groupBy("table", "xid").agg(F.max(F.when(F.col("kind") == "sync", F.col("part"))).alias("last"), F.count_distinct(F.when(F.col("kind") == "batch", F.col("part"))).alias("parts"))
    return whole.where("parts = last + 1").select("table", "xid")
