"""When buffered transactions are flushed: by count, by rows, by age; replayed over a log of transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_A_FILE = 65_536


@dataclass(frozen=True)
class FlushPolicy:
    txns: int = 100
    seconds: int = 30
    min_rows: int = 0

    def due(self, txns: int, rows: int, age: float) -> bool:
        """After a commit: the age alone is enough; the count only with enough rows. 0 transactions: at each commit; 0 seconds: age is off."""
        by_count = txns >= max(1, self.txns) and rows >= self.min_rows
        return bool(rows) and (by_count or (self.seconds > 0 and age >= self.seconds))


def batch_by_count(txn: Column, txns: int = 100) -> Column:
    return F.floor(txn / F.lit(txns)).cast("long")


def batch_by_rows(rows: DataFrame, order: list[Column], by: list[str], size: int = ROWS_A_FILE, name: str = "file_no") -> DataFrame:
    """A file number within each of ``by`` (a task or a table's flush), ``size`` rows each."""
    return rows.withColumn(name, F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / F.lit(size)).cast("long"))


def flushes_by_age(events: DataFrame, by: list[str], ts: str, seconds: int) -> DataFrame:
    """``by``, flushes: how often a buffer is flushed if each flush restarts the clock. The rule goes from event to event, so a group's times are folded in order: few and short groups, such as one table's commits in one day."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    start = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, t: F.when(acc["last"].isNull(), F.struct(t.alias("last"), acc["n"].alias("n"))).when(t - acc["last"] >= seconds * 1_000_000, F.struct(t.alias("last"), (acc["n"] + 1).alias("n"))).otherwise(acc)
    return events.groupBy(*by).agg(F.sort_array(F.collect_list(micros)).alias("_t")).select(*by, F.aggregate("_t", start, step, lambda acc: acc["n"]).alias("flushes"))


def overload(messages: DataFrame, order: list[Column], by: list[str], size: Column, capacity: int) -> DataFrame:
    """Messages of a burst that nobody reads: those that end beyond the capacity would have been dropped by a bounded buffer."""
    used = F.sum(size).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return messages.withColumn("used", used).withColumn("over", F.col("used") > capacity)


def drop_report(marked: DataFrame, size: Column, by: list[str] | None = None) -> DataFrame:
    """Of ``overload``'s rows by ``by``: messages, those a bounded buffer would have dropped, and their bytes."""
    return marked.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.count_if("over").alias("dropped"), F.coalesce(F.sum(F.when(F.col("over"), size)), F.lit(0)).cast("long").alias("dropped_bytes"))
