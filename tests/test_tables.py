"""Tables against a model: random operations, replays, time travel, schema changes, compaction jobs, streams."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import jobs
from tidelog.functions import types
from tidelog.operators import capture, merge
from tidelog.operators.policy import FlushPolicy
from tidelog.sources.schema import SchemaError
from tidelog.sources.sync import pending, sync
from tidelog.sources.files import Files
from tidelog.sources.table import Catalog, Table
from tidelog.streaming import ingest

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType())])
CHANGES = "id long, v int, _row_kind byte, _seq long"


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "w"))


def rows(spark, *changes):
    return spark.createDataFrame(list(changes), CHANGES)


OPS = st.lists(st.tuples(st.sampled_from(["put", "del"]), st.integers(0, 6), st.integers(0, 99)), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(OPS, st.randoms())
def test_live_is_the_model(spark, ops, rnd):
    model, changes, seq = {}, [], 0
    for op, key, value in ops:
        if op == "put":
            if key in model:
                changes.append((key, model[key], 1, seq))
                seq += 1
            changes.append((key, value, 2 if key in model else 0, seq))
            model[key] = value
        elif key in model:
            changes.append((key, model.pop(key), 3, seq))
        seq += 1
    delivered = changes + changes[: len(changes) // 2]  # again, and in any order
    rnd.shuffle(delivered)
    frame = rows(spark, *delivered)
    assert dict(merge.live(frame, ["id"]).collect()) == model
    assert dict(merge.live_by_struct(frame, ["id"]).collect()) == model
    assert merge.kind_summary(rows(spark, *changes)).first()["net"] == len(model)


def test_commits_time_travel_compaction(spark, catalog):
    t = catalog.create("t", ROW, ("id",))
    assert t.latest_id() == -1 and t.live().count() == 0
    assert t.append(rows(spark), batch="none") is None  # an empty batch makes no snapshot
    assert t.append(rows(spark, (1, 10, 0, 1), (2, 20, 0, 2)), batch="a") == 0
    assert t.append(rows(spark, (1, 10, 1, 3), (1, 11, 2, 4), (2, 20, 3, 5)), batch="b") == 1
    assert t.append(rows(spark, (9, 9, 0, 9)), batch="b") == 1  # delivered twice, applied once
    assert dict(t.live().collect()) == {1: 11} and dict(t.as_of(0).collect()) == {1: 10, 2: 20}
    assert t.changes(0).count() == 3 and t.raw().count() == 5
    before = t.live().collect()
    assert t.compact() == 2 and t.raw().count() == 1 and t.live().collect() == before
    assert [s["kind"] for s in t.snapshots()] == ["APPEND", "APPEND", "COMPACT"]
    t.truncate()
    t.append(rows(spark, (3, 30, 0, 20)))
    assert dict(t.live().collect()) == {3: 30} and t.snapshot()["total_rows"] == 1
    assert [r[1] for r in t.lookup(id=3).collect()] == [30] and t.lookup(id=4).count() == 0
    t.register("t_view")
    assert spark.sql("select count(*) from t_view").first()[0] == 1


def test_physical_columns(spark):
    assert merge.physical(rows(spark, (1, 2, 3, 4)), ["id"]).columns == ["_row_kind", "_KEY_id", "_SEQUENCE_NUMBER", "_VALUE_KIND", "id", "v", "_seq"]
    assert merge.physical(rows(spark, (1, 2, 3, 4)), []).columns == ["_row_kind", "id", "v", "_seq"]


def test_schema_changes(spark, catalog):
    t = catalog.create("t", ROW, ("id",))
    t.append(rows(spark, (1, 10, 0, 1)))
    t.add_column("extra", T.StringType())
    t.rename_column("v", "w")
    t.change_type("w", T.StringType())
    t.append(spark.createDataFrame([(2, "x", "e", 0, 2)], "id long, w string, extra string, _row_kind byte, _seq long"))
    assert sorted(t.live().collect()) == [(1, "10", None), (2, "x", "e")]
    t.drop_column("w")
    t.add_column("w", T.IntegerType())  # the same name is another field
    assert sorted(t.live().select("id", "w").collect()) == [(1, None), (2, None)]
    for bad in (lambda: t.drop_column("id"), lambda: t.add_column("extra", T.StringType()), lambda: t.alter(lambda s: s.with_keys(("extra",))), lambda: t.add_column("n", T.StringType()) and t.alter(lambda s: s.add("m", T.StringType(), nullable=False))):
        with pytest.raises(SchemaError):
            bad()


def test_catalog_jobs_sync(spark, catalog, tmp_path):
    catalog.create("a.t", ROW, ("id",)).append(rows(spark, (1, 1, 0, 1)))
    catalog.create("b.t", ROW).append(rows(spark, (1, 1, 0, 1), (1, 1, 0, 2)))
    assert catalog.tables() == ["a.t", "b.t"] and catalog.table("b.t").live().count() == 2
    said = []
    assert jobs.compact(catalog, ["a.t", "nope"], say=said.append) == 1 and len(said) == 2
    target = str(tmp_path / "mirror.db" / "t")
    assert sync(spark, catalog.table("a.t").path, target) and [p for p in pending(spark, catalog.table("a.t").path, target)] == ["snapshot/LATEST"]
    assert catalog.rename("b.t", "b.u").live().count() == 2
    catalog.drop("b.u")
    assert catalog.tables() == ["a.t"]
    assert jobs.visible(rows(spark, (1, 2, 0, 1))).columns == ["id", "v"]


def test_stream_restarts_without_loss_or_repeats(spark, catalog, tmp_path):
    inbox, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    t = catalog.create("t", ROW, ("id",))
    for n in range(2):
        rows(spark, (n, n, 0, n), (7, n, 2, 10 + n)).coalesce(1).write.mode("append").parquet(inbox)
        stream = ingest.change_files(spark, inbox, rows(spark).schema)
        ingest.ingest(stream, {"t": t}, mark).awaitTermination()
    assert dict(t.live().collect()) == {0: 0, 1: 1, 7: 1} and t.raw().count() == 4
    ingest.committer({"t": t})(rows(spark, (5, 5, 0, 99)), 0)  # a batch number that was committed
    assert t.raw().count() == 4


def test_policy_and_types():
    p = FlushPolicy(100, 30, 10)
    assert p.due(100, 10, 0) and not p.due(100, 9, 0) and p.due(1, 1, 30) and not p.due(99, 99, 29) and not p.due(100, 0, 99)
    assert types.unpack_typmod(types.pack_typmod(12, 4)) == (12, 4) and types.unpack_typmod(-1) == (38, 18)
    assert types.lake_type(types.spark_type(types.DECIMAL, types.pack_typmod(10, 2)), False) == "DECIMAL(10, 2) NOT NULL"
    assert [types.lake_type(types.spark_type(c)) for c in (types.SMALLINT, types.TIMESTAMPTZ, types.TEXT)] == ["SMALLINT", "TIMESTAMP WITH LOCAL TIME ZONE", "STRING"]


def test_truncated_files_stop_nobody(spark, catalog):
    t = catalog.create("t", ROW, ("id",))
    t.append(rows(spark, (1, 1, 0, 1)))
    t.files.create(f"{t.path}/snapshot/snapshot-1", "")
    t.files.create(f"{t.path}/snapshot/snapshot-2", '{"id": 2')
    t.files.create(f"{t.path}/schema/schema-1", '{"id"')
    assert t.latest_id() == 0 and t.append(rows(spark, (2, 2, 0, 2))) == 3 and t.append(rows(spark, (3, 3, 0, 3))) == 4
    assert dict(t.live().collect()) == {1: 1, 2: 2, 3: 3} and [s["id"] for s in t.snapshots()] == [0, 3, 4]
    t.files.remove(f"{t.path}/snapshot/LATEST")
    assert t.latest_id() == 4
    t.add_column("w", T.StringType())
    assert t.schema().id == 2 and t.live().columns == ["id", "v", "w"]


def test_files_are_created_once(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    files = Files(spark)
    with ThreadPool(8) as pool:
        won = pool.map(lambda n: files.create(str(tmp_path / "one"), f"writer {n}" * 1000), range(8))
    assert sum(won) == 1 and files.read(str(tmp_path / "one")) == f"writer {won.index(True)}" * 1000
    assert files.create(str(tmp_path / "one"), "new", replace=True) and files.read(str(tmp_path / "one")) == "new"
    assert [n for n, _ in files.names(str(tmp_path))] == ["one"]


def test_two_writers_lose_nothing(spark, catalog):
    from multiprocessing.pool import ThreadPool

    t = catalog.create("t", ROW, ("id",))
    with ThreadPool(2) as pool:
        pool.map(lambda w: [t.append(rows(spark, (10 * w + n, n, 0, n)), batch=f"w{w}:{n}") for n in range(3)], range(2))
    assert sorted(r.id for r in t.live().collect()) == [0, 1, 2, 10, 11, 12] and len(t.snapshots()) == 6


def test_appends_during_compaction_stay(spark, catalog, monkeypatch):
    t = catalog.create("t", ROW, ("id",))
    t.append(rows(spark, (1, 1, 0, 1)))
    stage = Table.stage

    def slow(self, changes, files=None):
        found = stage(self, changes, files)
        if not during:
            during.append(1)
            getattr(t, step)(*args)
        return found

    for step, args, left in (("append", (rows(spark, (2, 2, 0, 2)),), {1: 1, 2: 2}), ("truncate", (), {})):
        during = []
        monkeypatch.setattr(Table, "stage", slow)
        t.compact()  # an append within stages too, but `during` is full by then
        monkeypatch.setattr(Table, "stage", stage)
        assert dict(t.live().collect()) == left, step


def test_old_batches_stay_known(spark, catalog):
    t = catalog.create("t", ROW, ("id",))
    t.append(rows(spark, (1, 1, 0, 1)), batch="s:0")
    entry = t.file_entries()[0]
    for n in range(1, 2001, 100):  # 2,000 batches later
        t._publish("APPEND", [entry], f"s:{n + 99}")
    before = t.latest_id()
    assert t.append(rows(spark, (9, 9, 0, 9)), batch="s:0") == before == t.latest_id() and t.append(rows(spark, (9, 9, 0, 9)), batch="s:2001") == before + 1


def test_manifests_merge_and_are_skipped(spark, catalog, monkeypatch):
    from tidelog.sources import table as module

    monkeypatch.setattr(module, "MERGE_MANIFESTS", 3)
    t = catalog.create("t", ROW, ("id",))
    for n in range(6):
        t.append(rows(spark, *((10 * n + i, i, 0, i) for i in range(10))))
    assert len(t.manifests()) <= 5 and t.raw().count() == 60
    opened = []
    monkeypatch.setattr(Table, "_avro", lambda self, name, read=Table._avro: opened.append(name) or read(self, name))
    assert [r.v for r in t.lookup(id=57).collect()] == [7]
    assert sum(n.startswith("manifest-") and not n.startswith("manifest-list") for n in opened) == 1


def test_avro_is_what_the_library_reads(spark, tmp_path):
    import json

    from tidelog.sources import avro

    schema = {"type": "record", "name": "r", "fields": [{"name": n, "type": t} for n, t in (("a", "long"), ("b", ["null", "string"]), ("c", {"type": "array", "items": "int"}), ("d", {"type": "map", "values": "boolean"}), ("e", "double"), ("f", "bytes"))]}
    rows_ = [{"a": a, "b": b, "c": [1, -2] * (i % 3), "d": {"k": True} if i % 2 else {}, "e": i / 7, "f": bytes([i % 256])} for i, (a, b) in enumerate(zip([0, -1, 1, 63, 64, -64, -65, 2**63 - 1, -(2**63)] * 300, ["é", None, ""] * 900, strict=True))]
    data = avro.write(schema, rows_)
    assert avro.read(data) == rows_ and avro.read(avro.write(schema, [])) == []
    for bad in (b"", data[:-1], data[: len(data) // 2], data[:-20] + b"x" * 20):
        with pytest.raises(ValueError):
            avro.read(bad)
    (tmp_path / "x.avro").write_bytes(data)
    jvm = spark.sparkContext._jvm
    reader = jvm.org.apache.avro.file.DataFileReader(jvm.java.io.File(str(tmp_path / "x.avro")), jvm.org.apache.avro.generic.GenericDatumReader())
    for row in rows_[:12]:
        told = reader.next()
        assert told.get("a") == row["a"] and (told.get("b") is None) == (row["b"] is None) and json.loads(told.toString())["c"] == row["c"]
    reader.close()


def test_footers_and_jdbc_counts(spark, tmp_path):
    from tidelog.sources.counts import footer_rows, footers, jdbc_rows

    frame = spark.range(1000).selectExpr("id", "cast(id as string) s", "date_add(date'2024-01-01', cast(id as int)) d", "cast(null as int) z")
    frame.repartition(3).write.parquet(str(tmp_path / "p"))
    paths = [str(p) for p in (tmp_path / "p").glob("*.parquet")]
    assert footer_rows(spark, paths) == 1000
    told = footers(spark, paths, ("id", "s", "d", "z"))
    assert min(t["bounds"]["id"][0] for t in told) == 0 and max(t["bounds"]["s"][1] for t in told) == "999" and all(t["bounds"]["d"] == [None, None] == t["bounds"]["z"] for t in told)
    url = "jdbc:derby:memory:tide;create=true"
    spark.range(7).withColumnRenamed("id", "N").write.jdbc(url, "COUNTED", mode="overwrite")
    assert jdbc_rows(spark, url, "COUNTED") == 7


def test_columns_are_checked_and_may_be_named_otherwise(spark, catalog):
    t = catalog.create("t", ROW, ("id",))
    before = t.schema().fingerprint()
    with pytest.raises(SchemaError):
        t.append(rows(spark, (1, 1, 0, 1)).withColumn("more", F.lit(1)))
    with pytest.raises(SchemaError):
        t.append(rows(spark, (1, 1, 0, 1)).withColumn("v", F.array(F.lit(1))))
    t.append(rows(spark, (1, 1, 0, 1)).drop("v"))
    assert [tuple(r) for r in t.live().collect()] == [(1, None)] and t.schema().logical().names == ["id", "v", "_seq"]
    t.add_column("w", T.StringType())
    assert t.schema().fingerprint() != before
    u = catalog.create("u", ROW, ("id",), {"sequence.field": "lsn", "rowkind.field": "k", "metadata.xid": "x"})
    u.append(rows(spark, (1, 1, 0, 5 << 32), (1, 2, 2, 6 << 32)).withColumnsRenamed({"_row_kind": "k", "_seq": "lsn"}))
    assert u.raw().columns == ["id", "v", "x", "k", "lsn"] and [tuple(r) for r in u.live().select("id", "v", "x").collect()] == [(1, 2, 6)] and [r.v for r in u.lookup(id=1).collect()] == [2]
    with pytest.raises(SchemaError):
        u.add_column("lsn", T.StringType())


def test_transactions(spark, catalog):
    from tidelog.operators.transactions import Transaction, finish, recover

    for name in ("a", "b"):
        catalog.create(name, ROW, ("id",))
    with Transaction(catalog, "w:1") as t:
        t.write("a", rows(spark, (1, 1, 0, 1)))
        t.write("a", rows(spark, (2, 2, 0, 2)))
        t.write("b", rows(spark))
    assert catalog.table("a").live().count() == 2 and catalog.table("b").latest_id() == -1
    t = Transaction(catalog, "w:2")
    t.write("b", rows(spark, (3, 3, 0, 3)))
    t.prepare()
    assert catalog.table("b").live().count() == 0
    marker = catalog.table("b").files.read(t.marker)
    assert finish(catalog, "w:2") == {"b": 0}
    catalog.table("b").files.create(t.marker, marker)  # the crash came before the marker was removed
    assert recover(catalog) == ["w:2"] and catalog.table("b").raw().count() == 1
    with pytest.raises(RuntimeError), Transaction(catalog, "w:3") as t:
        t.write("a", rows(spark, (4, 4, 0, 4)))
        t.prepare()
        raise RuntimeError
    assert catalog.table("a").live().count() == 2 and recover(catalog) == []


def test_flusher_holds_and_goes_on(spark, catalog, tmp_path):
    t, now = catalog.create("t", ROW, ("id",)), [0.0]
    made = lambda: ingest.Flusher(spark, {"t": t}, str(tmp_path / "held"), FlushPolicy(txns=3, seconds=30, min_rows=4), clock=lambda: now[0])
    batch = lambda n, many=1: rows(spark, *((10 * n + i, n, 0, (n + 1) << 32 | i) for i in range(many)))
    sink = made()
    for n in range(3):
        sink(batch(n), n)  # three transactions, but too few rows
    assert t.latest_id() == -1
    sink = made()  # a restart
    sink(batch(2), 2)  # the last batch again
    sink(batch(3), 3)
    assert sink.flushes == ["count"] and t.raw().count() == 4
    sink(batch(4), 4)
    now[0] = 29
    assert not sink.tick()
    now[0] = 30
    assert sink.tick() and sink.flushes == ["count", "age"] and t.raw().count() == 5 and not sink.tick() and not sink.flush()
    sink(batch(3), 3)
    sink.flush()
    assert t.raw().count() == 5  # batches that were flushed stay out


def test_messages_that_are_damaged(spark):
    from tidelog.streaming import messages

    changes = rows(spark, *((i, i, 0, (i // 7) << 32 | i % 7) for i in range(20)))
    made = messages.to_messages(changes, "t", rows=3)
    assert sorted(messages.from_messages(made, "t", changes.schema).collect()) == sorted(changes.collect()) and messages.from_messages(made, "u", changes.schema).count() == 0
    assert sorted(r.xid for r in messages.ended(made).collect()) == [0, 1, 2]
    assert sorted(r.xid for r in messages.ended(made.where("not (xid = 1 and part = 1 and kind = 'batch')")).collect()) == [0, 2]
    cut = made.withColumn("payload", F.expr("substring(payload, 1, length(payload) - 1)"))
    assert messages.from_messages(cut, "t", changes.schema).count() == 0


def test_inspect_and_paths_with_a_scheme(spark, tmp_path):
    catalog = Catalog(spark, f"file://{tmp_path}/w", staging=f"file://{tmp_path}/staging")
    t = catalog.create("t", ROW, ("id",))
    t.append(rows(spark, (1, 2, 0, 3)))
    said = []
    jobs.inspect(t, say=said.append)
    assert "id" in said[0] and said[1] == "rows: 1" and dict(t.live().collect()) == {1: 2}
    assert catalog.tables() == ["default.t"] and list((tmp_path / "staging").rglob("*.parquet")) == []


def test_row_ids(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "p"))
    found = capture.with_row_ids(spark.read.parquet(str(tmp_path / "p")))
    assert sorted((r.id, r._tid) for r in found.collect()) == [(i, i) for i in range(10)]
