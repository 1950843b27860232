"""``spark.read.format("tidelog")``: a table's change rows as a Python data source, one partition a file.

For sessions that know a path only. ``Table.raw`` reads the same through Spark's own Parquet scan, which is faster and
pushes filters down; this reader needs a path that pyarrow's file systems can open.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from . import avro
from .schema import Schema


class _File(InputPartition):
    def __init__(self, path: str, names: dict[str, str]):
        self.path, self.names = path, names


class ChangeSource(DataSource):
    """Options: ``path``; ``snapshot`` (the latest without it)."""

    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def _opened(self) -> tuple[fs.FileSystem, str]:
        path = self.options["path"]
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))

    def schemas(self) -> dict[int, Schema]:
        disk, root = self._opened()
        files = (f.path for f in disk.get_file_info(fs.FileSelector(f"{root}/schema")) if f.base_name.startswith("schema-"))
        return {s.id: s for s in (Schema.of_json(disk.open_input_file(p).read().decode()) for p in files)}

    def schema(self) -> T.StructType:
        found = self.schemas()
        last = found[max(found)]
        return T.StructType([*last.struct().fields, T.StructField(last.kind, T.ByteType()), T.StructField(last.seq, T.LongType())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self, schema)


class _Reader(DataSourceReader):
    def __init__(self, source: ChangeSource, schema: T.StructType):
        self.source, self.schema = source, schema

    def partitions(self) -> list[InputPartition]:
        disk, root = self.source._opened()
        read = lambda p: disk.open_input_file(f"{root}/{p}").read()
        number = self.source.options.get("snapshot") or read("snapshot/LATEST").decode()
        told, all_ = json.loads(read(f"snapshot/snapshot-{number}")), self.source.schemas()
        last, found = all_[max(all_)], []
        for part in ("base", "delta"):
            for manifest in avro.read(read(f"manifest/{told[part]}")) if told[part] else ():
                for entry in avro.read(read(f"manifest/{manifest['manifest']}")):
                    was = {f.id: f.name for f in all_[entry["schema"]].fields}
                    names = {f.name: was[f.id] for f in last.fields if f.id in was} | {last.kind: last.kind, last.seq: last.seq}
                    found.append(_File(f"{root}/data/{entry['file']}", names))
        return found

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        disk, _ = self.source._opened()
        wanted = to_arrow_schema(self.schema)
        with disk.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=sorted(set(partition.names.values()))):
                columns = [batch.column(partition.names[f.name]).cast(f.type) if f.name in partition.names else pa.nulls(batch.num_rows, f.type) for f in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ChangeSource)
