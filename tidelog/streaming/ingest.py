"""Change streams into tables: commits known by their number, so never applied twice, at once or when a flush policy says so.

``committer`` commits each micro-batch. ``Flusher`` holds micro-batches back as files below its folder until the policy is
due (by age, or by transactions with enough rows; the age also between batches, by ``tick``), and then commits all tables
together. What is held lies on the shared disk, so a restart goes on with it; ``stop`` flushes the rest.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidelog.functions.kinds import seq_xid
from tidelog.operators.policy import FlushPolicy
from tidelog.sources.files import Files
from tidelog.sources.table import Table


def change_files(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int = 100) -> DataFrame:
    """A stream of Parquet change files; what isn't read yet waits, nothing is dropped."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


@dataclass
class Report:
    """What became of the rows: ``unrouted`` ones named a table that isn't there. ``taken`` reads the counters and sets them back."""

    rows: int = 0
    unrouted: int = 0

    def taken(self) -> tuple[int, int]:
        found = self.rows, self.unrouted
        self.rows = self.unrouted = 0
        return found


def committer(tables: dict[str, Table], route: str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, stream: str = "stream", report: Report | None = None) -> Callable[[DataFrame, int], None]:
    """What foreachBatch calls. With ``route`` rows go to the table that this column names; without, to the only one."""

    def commit(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        again = len(tables) > 1 or report is not None
        if again:
            rows = rows.persist()  # one read of the batch for all its tables
        try:
            if report is not None:
                lost = F.col(route).isNull() | ~F.col(route).isin(*tables) if route else F.lit(False)
                told = rows.agg(F.count("*").alias("rows"), F.count_if(lost).alias("unrouted")).first()
                report.rows += told["rows"]
                report.unrouted += told["unrouted"]
            for name, table in tables.items():
                table.append(rows.where(F.col(route) == name).drop(route) if route else rows, batch=f"{stream}:{number}")
        finally:
            if again:
                rows.unpersist()

    return commit


@dataclass
class Flusher:
    """Holds micro-batches in ``folder`` and commits them by ``policy``. Pass it to ``ingest`` as ``sink``."""

    spark: SparkSession
    tables: dict[str, Table]
    folder: str
    policy: FlushPolicy = field(default_factory=FlushPolicy)
    route: str | None = None
    stream: str = "stream"
    seq: str = "_seq"
    clock: Callable[[], float] = time.time
    flushes: list[str] = field(default_factory=list)
    lock: RLock = field(default_factory=RLock)  # batches arrive in the stream's thread, ticks in another

    def _held(self) -> list[dict]:
        """What is held, the oldest first: a note is written after its rows, so all of it is whole."""
        files = Files(self.spark)
        names = [n for n, _ in files.names(f"{self.folder}/notes") if n.endswith(".json")]
        done = max((int(n) for n, _ in files.names(f"{self.folder}/flushed") if n.isdigit()), default=-1)
        notes = sorted((json.loads(files.read(f"{self.folder}/notes/{n}")) for n in names), key=lambda n: n["number"])
        return [n for n in notes if n["number"] > done]

    def __call__(self, batch: DataFrame, number: int) -> None:
        files, rows = Files(self.spark), f"{self.folder}/rows/{number}"
        if not files.exists(f"{self.folder}/notes/{number}.json"):
            batch.write.mode("overwrite").parquet(rows)
            facts = self.spark.read.schema(batch.schema).parquet(rows).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(seq_xid(F.col(self.seq))).alias("txns")).first()
            files.create(f"{self.folder}/notes/{number}.json", json.dumps({"number": number, "rows": facts["rows"], "txns": facts["txns"], "at": self.clock()}))
        self.tick()

    def tick(self) -> bool:
        """Flush if the policy is due; call it now and then while no rows arrive."""
        with self.lock:
            return self._tick()

    def _tick(self) -> bool:
        held = self._held()
        rows, txns = (sum(n[k] for n in held) for k in ("rows", "txns"))
        age = self.clock() - min((n["at"] for n in held if n["rows"]), default=self.clock())
        if not self.policy.due(txns, rows, age):
            return False
        return self.flush("age" if self.policy.seconds and age >= self.policy.seconds else "count")

    def flush(self, why: str = "asked") -> bool:
        """Commit all that is held, every table under the last batch's number; False without rows."""
        with self.lock:
            return self._flush(why)

    def _flush(self, why: str) -> bool:
        files, held = Files(self.spark), self._held()
        if not any(n["rows"] for n in held):
            return False
        last = held[-1]["number"]
        schema = self.spark.read.parquet(f"{self.folder}/rows/{held[0]['number']}").schema
        rows = self.spark.read.schema(schema).parquet(*(f"{self.folder}/rows/{n['number']}" for n in held))
        committer(self.tables, self.route, stream=self.stream)(rows, last)
        files.create(f"{self.folder}/flushed/{last}", "")
        self.flushes.append(why)
        for note in held:
            files.remove(f"{self.folder}/rows/{note['number']}")
            files.remove(f"{self.folder}/notes/{note['number']}.json")
        return True

    def stop(self, query: StreamingQuery) -> None:
        """Take in what has arrived, end the stream, flush the rest."""
        query.processAllAvailable()
        query.stop()
        self.flush("stop")


def ingest(changes: DataFrame, tables: dict[str, Table], checkpoint: str, route: str | None = None, seconds: int | None = None, stream: str = "stream", prepare: Callable[[DataFrame], DataFrame] | None = None, sink: Flusher | None = None, report: Report | None = None) -> StreamingQuery:
    """Start the stream: every ``seconds``, or once over all there is. A restart goes on from the checkpoint."""
    writer = changes.writeStream.foreachBatch(sink or committer(tables, route, prepare, stream, report)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def work(query: StreamingQuery, sink: Flusher, seconds: float = 1.0) -> None:
    """Wait for a stream to end and let the policy's clock run meanwhile; an error of the stream is raised here, what is held stays held."""
    while not query.awaitTermination(seconds):
        sink.tick()
    sink.flush("stop")


def windowed_counts(events: DataFrame, ts: str, length: str, slide: str | None = None, late: str = "10 minutes", by: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling or sliding counts with a watermark; the same call works on a batch table."""
    marked = events.withWatermark(ts, late)
    return marked.groupBy(F.window(ts, length, slide).alias("w") if slide else F.window(ts, length).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def sessions(events: DataFrame, ts: str, gap: str, by: tuple[str, ...], late: str = "10 minutes") -> DataFrame:
    marked = events.withWatermark(ts, late)
    return marked.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")
