"""Row counts without reading rows: Parquet footers, and a count that a JDBC source carries out itself."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import SparkSession

_WHOLE = ("INT32", "INT64")


def footers(spark: SparkSession, paths: list[str], columns: tuple[str, ...] = ()) -> list[dict]:
    """By file ``rows``, and by column [least, most] as whole number or text (None where the footer doesn't say). Footers only are opened, several at a time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def value(kind: str, logical: str, raw) -> int | str | None:
        if kind in _WHOLE and logical in ("", "INTEGER"):
            return int(str(raw))
        return raw.toStringUsingUTF8() if kind == "BINARY" and logical == "STRING" else None

    def one(path: str) -> dict:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            rows, bounds = 0, {c: [None, None] for c in columns}
            unsure = set()
            for block in reader.getFooter().getBlocks():
                rows += block.getRowCount()
                for column in block.getColumns() if columns else ():
                    name = column.getPath().toDotString()
                    if name not in bounds:
                        continue
                    stats, kind = column.getStatistics(), column.getPrimitiveType()
                    logical = kind.getLogicalTypeAnnotation()
                    logical = "" if logical is None else str(logical).split("(")[0]
                    if stats is None or not stats.hasNonNullValue():
                        if stats is None or stats.getNumNulls() != block.getRowCount():
                            unsure.add(name)
                        continue
                    low, high = (value(str(kind.getPrimitiveTypeName()), logical, x) for x in (stats.genericGetMin(), stats.genericGetMax()))
                    if low is None:
                        unsure.add(name)
                        continue
                    order = (lambda x: x.encode()) if isinstance(low, str) else (lambda x: x)
                    least, most = bounds[name]
                    bounds[name] = [low if least is None or order(low) < order(least) else least, high if most is None or order(high) > order(most) else most]
            return {"path": path, "rows": rows, "bounds": {c: [None, None] if c in unsure else b for c, b in bounds.items()}}
        finally:
            reader.close()

    with ThreadPool(min(16, max(1, len(paths)))) as pool:
        return pool.map(one, paths)


def footer_rows(spark: SparkSession, paths: list[str]) -> int:
    return sum(f["rows"] for f in footers(spark, paths))


def jdbc_rows(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> int:
    """The source counts; one row comes back."""
    return int(spark.read.jdbc(url, f"(SELECT count(*) AS n FROM {table}) counted", properties=properties or {}).first()[0])
