"""Reading a changelog: the merged table, kind counts, net rows, reconciliation, last values, sorted runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.kinds import DELETE, INSERT, KIND, SEQ, UPDATE_AFTER, UPDATE_BEFORE, net, value_kind


def live(changes: DataFrame, keys: list[str], seq: str = SEQ, kind: str = KIND) -> DataFrame:
    """The row with the largest sequence number of each key, unless it takes the key away. A filter on keys reaches the scan; each task keeps one row a key before the shuffle. Without keys all rows are live."""
    if not keys:
        return changes.drop(seq, kind)
    rank = Window.partitionBy(*keys).orderBy(F.desc(seq), F.asc(kind))
    last = changes.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") == 1)
    return last.where(~F.col(kind).isin(UPDATE_BEFORE, DELETE)).drop("_rank", seq, kind)


def live_by_struct(changes: DataFrame, keys: list[str], seq: str = SEQ, kind: str = KIND) -> DataFrame:
    """The same as an aggregate, which also runs in complete-mode streams."""
    rest = [c for c in changes.columns if c not in keys and c != seq]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_last")).select(*keys, "_last.*")
    return last.where(~F.col(kind).isin(UPDATE_BEFORE, DELETE)).drop(kind)


def kind_counts(changes: DataFrame, kind: str = KIND, by: list[str] | None = None) -> DataFrame:
    return changes.groupBy(*(by or []), kind).agg(F.count("*").alias("n"))


def kind_summary(changes: DataFrame, kind: str = KIND, by: list[str] | None = None) -> DataFrame:
    """One row (a group): total, inserts, both halves of updates, deletes, net."""
    one = lambda k, name: F.count_if(F.col(kind) == k).alias(name)
    return changes.groupBy(*(by or [])).agg(
        F.count("*").alias("total"), one(INSERT, "ins"), one(UPDATE_BEFORE, "upd_before"), one(UPDATE_AFTER, "upd_after"), one(DELETE, "del"),
        F.coalesce(F.sum(net(F.col(kind))), F.lit(0)).cast("long").alias("net"),
    )


def reconcile(source_counts: DataFrame, summary: DataFrame, insert_only: tuple[str, ...] = ()) -> DataFrame:
    """A status by table: (name, n) of the source against a summary by name. A net mismatch has its own status."""
    both = source_counts.join(summary, "name", "left")
    status = (
        F.when(F.col("total").isNull() | (F.col("total") == 0), "missing")
        .when(F.col("name").isin(*insert_only) & (F.col("total") == F.col("n")), "exact")
        .when(F.col("net") == F.col("n"), "net match")
        .when(F.col("total") >= F.col("n"), "captured, net differs")
        .otherwise("incomplete")
    )
    return both.select("name", F.col("n").alias("source_rows"), F.coalesce("total", F.lit(0)).alias("events"), F.coalesce("net", F.lit(0)).alias("net"), status.alias("status"))


def last_values(changes: DataFrame, keys: list[str], value: str, seq: str = SEQ, kind: str = KIND) -> DataFrame:
    """The newest value that was set for each key, old images aside."""
    set_ = changes.where(~F.col(kind).isin(UPDATE_BEFORE, DELETE))
    return set_.groupBy(*keys).agg(F.max_by(value, seq).alias(value))


def history(changes: DataFrame, keys: list[str], value: str, seq: str = SEQ) -> DataFrame:
    """Every change of a key with the value before it."""
    return changes.withColumn(f"previous_{value}", F.lag(value).over(Window.partitionBy(*keys).orderBy(seq)))


def physical(changes: DataFrame, keys: list[str], seq: str = SEQ, kind: str = KIND) -> DataFrame:
    """The columns of a data file in order: kind, key copies, sequence and value kind (with keys only), the row, sequence."""
    user = [c for c in changes.columns if c not in (seq, kind)]
    system = [*(F.col(k).alias(f"_KEY_{k}") for k in keys), F.col(seq).alias("_SEQUENCE_NUMBER"), value_kind(F.col(kind)).alias("_VALUE_KIND")] if keys else []
    return changes.select(kind, *system, *user, seq)


def sorted_runs(changes: DataFrame, keys: list[str], seq: str = SEQ) -> DataFrame:
    """Each task's rows by key, nulls first, then by sequence; without keys as they come."""
    return changes.sortWithinPartitions(*(F.asc_nulls_first(k) for k in keys), seq) if keys else changes
