"""Changes as rows: inserts, updates with both images, deletes, upserts, snapshot differences, sequence numbers, commits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.kinds import DELETE, INSERT, KIND, SEQ, UPDATE_AFTER, UPDATE_BEFORE, compose_seq, compose_tid, kind


def inserts(rows: DataFrame) -> DataFrame:
    return rows.withColumn(KIND, kind(INSERT))


def updates(target: DataFrame, changed: Column, assignments: dict[str, Column]) -> DataFrame:
    """Of each matching row the old image, then the new one, next to each other."""
    columns = target.columns
    old = F.struct(kind(UPDATE_BEFORE).alias(KIND), *(F.col(c).alias(c) for c in columns))
    new = F.struct(kind(UPDATE_AFTER).alias(KIND), *(assignments[c].cast(target.schema[c].dataType).alias(c) if c in assignments else F.col(c).alias(c) for c in columns))
    return target.where(changed).select(F.posexplode(F.array(old, new)).alias("_image", "_row")).select("_image", "_row.*").select(*columns, KIND, "_image")


def deletes(target: DataFrame, gone: Column) -> DataFrame:
    return target.where(gone).withColumn(KIND, kind(DELETE))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """+I for rows whose key the target doesn't have."""
    return inserts(rows.join(target.select(*keys), keys, "left_anti").select(*rows.columns))


def upserts(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """+I for new keys; -U and +U for keys that exist, whether or not the values differ. One row a key must come in."""
    return _compared(target.join(rows.select(*keys), keys, "left_semi").select(*target.columns), rows, keys, F.lit(True))


def diff(before: DataFrame, after: DataFrame, keys: list[str], changed: Column | None = None) -> DataFrame:
    """The changes that turn one table into the other, by key. ``changed`` tells when a row that both have is an update, by
    its columns as ``o.`` (before) and ``n.`` (after); without it any column that differs makes one, null being a value.
    Of a key with several rows each old one meets each new one."""
    return _compared(before, after, keys, changed)


def _compared(before: DataFrame, after: DataFrame, keys: list[str], changed: Column | None) -> DataFrame:
    columns, rest = after.columns, [c for c in after.columns if c not in keys]
    old = before.select(*columns, F.lit(True).alias("_in")).alias("o")
    new = after.select(*columns, F.lit(True).alias("_in")).alias("n")
    joined = old.join(new, reduce(lambda a, b: a & b, (F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys)), "full_outer")
    image = lambda side, k: F.struct(kind(k).alias(KIND), *(F.col(f"{side}.{c}").alias(c) for c in columns))
    if changed is None:
        changed = ~reduce(lambda a, b: a & b, (F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in rest), F.lit(True))
    events = (
        F.when(F.col("o._in").isNull(), F.array(image("n", INSERT)))
        .when(F.col("n._in").isNull(), F.array(image("o", DELETE)))
        .when(changed, F.array(image("o", UPDATE_BEFORE), image("n", UPDATE_AFTER)))
    )
    return joined.select(F.posexplode(events).alias("_image", "_row")).select("_row.*", "_image").select(*columns, KIND, "_image")


def sequenced(changes: DataFrame, xid: Column, order: list[Column]) -> DataFrame:
    """``_seq`` from the transaction and the place within it; the order must be total, as Spark's rows have none of their own."""
    numbered = changes.withColumn("_xid", xid.cast("long"))
    op = F.row_number().over(Window.partitionBy("_xid").orderBy(*order)) - 1
    return numbered.withColumn(SEQ, compose_seq(F.col("_xid"), op)).drop("_xid")


def with_metadata(changes: DataFrame, xid: str | None = None, op: str | None = None, tid: str | None = None, seq: str = SEQ) -> DataFrame:
    """The optional transaction, operation and row-id columns, under the names given. The row id is taken from ``_tid``, 0 without one."""
    row = F.coalesce(F.col("_tid").cast("long"), F.lit(0)) if "_tid" in changes.columns else F.lit(0).cast("long")
    for name, value in ((xid, F.shiftrightunsigned(seq, 32)), (op, F.col(seq).bitwiseAND(F.lit(0xFFFFFFFF))), (tid, row)):
        if name:
            changes = changes.withColumn(name, value)
    return changes


def with_row_ids(rows: DataFrame) -> DataFrame:
    """``_tid``: block and offset (65,536 rows a block) of each row within its Parquet file. ``rows`` must be a plain scan."""
    place = F.col("_metadata.row_index")
    return rows.select("*", compose_tid(F.shiftright(place, 16), place.bitwiseAND(F.lit(0xFFFF))).alias("_tid"))


def committed(changes: DataFrame, transactions: DataFrame, txn: str) -> DataFrame:
    """Rows of transactions that committed; ``transactions`` has (txn, committed)."""
    return changes.join(transactions.where("committed").select(txn), txn, "left_semi")


def padded(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``: missing ones are null, unknown ones go."""
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields))
