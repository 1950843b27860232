"""Transactions over several tables: changes are held back, staged as one, and become visible table by table on commit.

``prepare`` writes each table's rows to its staging folder, then a marker that names them all: from then on the commit can
be finished by anyone (``recover``). Publishing is known by the transaction's name, so finishing twice applies it once. What has
no marker was never promised and is discarded.

A name is ``writer:number``, the numbers of a writer ascending: a table remembers each writer's highest number only.
"""

from __future__ import annotations

import json
from functools import reduce
from types import TracebackType

from pyspark.sql import DataFrame

from tidelog.sources.files import Files
from tidelog.sources.table import Catalog, Table, batch_id


class Transaction:
    """``with Transaction(catalog, "loader:1") as t: t.write("orders", changes)``: commits at the end, discards on an error."""

    def __init__(self, catalog: Catalog, name: str):
        self.catalog, self.name, self.held = catalog, name, {}
        self.marker = _marker(catalog, name)

    def write(self, table: str, changes: DataFrame) -> None:
        self.held.setdefault(table, []).append(changes)

    def prepare(self) -> dict[str, str]:
        """Stage everything; the folders by table. Nothing is visible yet."""
        staged = {}
        for table, changes in self.held.items():
            folder = self.catalog.table(table).stage(reduce(DataFrame.unionByName, changes))
            if folder:
                schema = self.catalog.table(table).schema()
                staged[table] = {"folder": folder, "schema": schema.id, "fingerprint": schema.fingerprint()}
        Files(self.catalog.spark).create(self.marker, json.dumps({"name": self.name, "staged": staged}), replace=True)
        return {t: s["folder"] for t, s in staged.items()}

    def commit(self) -> dict[str, int]:
        self.prepare()
        return finish(self.catalog, self.name)

    def discard(self) -> None:
        _discard(self.catalog, self.name)
        self.held = {}

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if kind is None:
            self.commit()
        else:
            self.discard()


def _folder(catalog: Catalog) -> str:
    return f"{catalog.warehouse}/transactions"


def _marker(catalog: Catalog, name: str) -> str:
    return f"{_folder(catalog)}/{name.replace(':', '-')}.json"


def finish(catalog: Catalog, name: str) -> dict[str, int]:
    """Publish a prepared transaction's tables; the snapshots by table. Tables that have it already are passed over."""
    files, marker, found = Files(catalog.spark), _marker(catalog, name), {}
    for table, told in json.loads(files.read(marker) or '{"staged": {}}')["staged"].items():
        target: Table = catalog.table(table)
        done = target.has_batch(name)
        found[table] = done if done is not None else target.promote(told["folder"], name)
    files.remove(marker)
    return found


def _discard(catalog: Catalog, name: str) -> None:
    files, marker = Files(catalog.spark), _marker(catalog, name)
    for told in json.loads(files.read(marker) or '{"staged": {}}')["staged"].values():
        files.remove(told["folder"])
    files.remove(marker)


def recover(catalog: Catalog) -> list[str]:
    """After a crash: prepared transactions are published; staged folders that none of them names are removed. No writer may be at work."""
    files = Files(catalog.spark)
    told = (json.loads(files.read(f"{_folder(catalog)}/{n}") or "{}") for n, _ in files.names(_folder(catalog)))
    names = sorted((t["name"] for t in told if "name" in t), key=batch_id)
    for name in names:
        finish(catalog, name)
    for table in catalog.tables():
        files.remove(catalog.table(table).staging)
    return names
