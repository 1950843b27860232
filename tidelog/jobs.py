"""Command line: ``python -m tidelog.jobs compact|inspect WAREHOUSE [TABLE...] [--dry-run]``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tidelog.sources.table import Catalog, Table


def compact(catalog: Catalog, names: list[str] | None = None, dry_run: bool = False, say=print) -> int:
    """Compact the tables named, or all; one that fails doesn't stop the others. The number of failures."""
    failed = 0
    for name in names or catalog.tables():
        try:
            if not catalog.exists(name):
                raise ValueError("no such table")
            if dry_run:
                say(f"{name}: would compact {len(catalog.table(name).file_entries())} files")
            else:
                say(f"{name}: snapshot {catalog.table(name).compact()}")
        except Exception as error:  # noqa: BLE001  the next table is another job
            failed += 1
            say(f"{name}: failed: {error}")
    return failed


def visible(frame: DataFrame) -> DataFrame:
    """Without system columns."""
    return frame.select(*(c for c in frame.columns if not c.startswith("_")))


def inspect(table: Table, rows: int = 5, say=print) -> None:
    say(table.schema().struct().treeString())
    say(f"rows: {table.raw().count()}")
    visible(table.raw()).limit(rows).show(truncate=False)


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=("compact", "inspect"))
    parser.add_argument("warehouse")
    parser.add_argument("tables", nargs="*")
    parser.add_argument("--dry-run", action="store_true")
    given = parser.parse_args(args)
    catalog = Catalog(SparkSession.builder.getOrCreate(), given.warehouse)
    if given.job == "compact":
        return int(compact(catalog, given.tables, given.dry_run) > 0)
    for name in given.tables or catalog.tables():
        inspect(catalog.table(name))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
