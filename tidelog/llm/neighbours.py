"""Approximate nearest neighbours by inner product: an adaptive dimension scan of rotated vectors within probed lists.

Vectors get one more component that makes all of them equally long, so that the largest inner product is the smallest
distance; queries get a zero there. Both are turned by one random rotation, after which the first k components are a fair
sample of a distance: a list is scanned a block of columns at a time, and a candidate is abandoned as soon as its partial
distance, by a test of significance ``EPSILON``, can't belong to one below the twentieth best so far. What is left is scored
exactly: the inner product of the original vectors in double precision, ties to the smaller id.

Lists come from k-means on a bounded sample (``SAMPLE`` vectors); every vector is indexed. Equal vectors are one entry with
its TOP + 1 smallest ids (no query can be answered with more of them). Lists are searched in groups of up to ``LIST_ROWS``
entries; a list of more is dealt over several tasks, all of which are searched.

How many lists a query probes is found on the indexed table: the true neighbours of ``CALIBRATING`` of the queries are made by
brute force over all entries, and each query then probes so many of its nearest lists that those hold the share ``RECALL`` of
them (``PROBES`` lists at least, and further ones until they hold ``LEAST_FOUND`` entries). Where vectors have little
structure that is most of the lists, and the work a query grows with the table.

Rows that repeat an id and a vector count once. Where an id has several vectors, a query is as near to another id as their
nearest two, and with very many vectors to an id fewer than TOP ids may be found. An empty table gives no rows.

Vectors that are null, zero, hold null or non-finite components, or have another length than most, and rows without an id,
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOP, SAMPLE, ROUNDS, SEED = 20, 20_000, 6, 7
ROWS_A_LIST, MAX_LISTS, LIST_ROWS = 256, 4_096, 4_096
PROBES, LEAST_FOUND, BLOCK, EPSILON = 48, 2_000, 16, 2.1
RECALL, CALIBRATING = 0.98, 256


def usable(vectors: DataFrame, vector: str, key: str) -> DataFrame:
    """id, v (array<float>): the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & fine)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes[0] if sizes else 0))


def entries(rows: DataFrame) -> DataFrame:
    """v, ids (ascending, TOP + 1 at most): one row for equal vectors."""
    rank = Window.partitionBy("v").orderBy("id")
    least = rows.groupBy("v", "id").agg(F.lit(0)).select("v", "id").withColumn("n", F.row_number().over(rank)).where(F.col("n") <= TOP + 1)
    return least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


class Space:
    """The longest length squared, the rotation and the lists' centres, as plain arrays."""

    def __init__(self, longest: float, size: int, sample: np.ndarray, lists: int):
        rng = np.random.default_rng(SEED)
        self.longest = longest
        self.turn = np.linalg.qr(rng.standard_normal((size + 1, size + 1)))[0].astype(np.float32)
        points = self.points(sample)
        centres = points[rng.permutation(len(points))[:lists]]
        for _ in range(ROUNDS):
            near = self.nearest(points, centres)
            sums = np.zeros_like(centres, dtype=np.float64)
            np.add.at(sums, near, points)
            counts = np.bincount(near, minlength=len(centres))
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres).astype(np.float32)
        self.centres = centres

    def points(self, v: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.longest - (v * v).sum(1), 0))
        return np.column_stack([v, more]).astype(np.float32) @ self.turn

    def queries(self, v: np.ndarray) -> np.ndarray:
        """Of unit length times the longest: the order of candidates doesn't depend on it."""
        unit = v * np.sqrt(self.longest / (v * v).sum(1))[:, None]
        return np.column_stack([unit, np.zeros(len(v))]).astype(np.float32) @ self.turn

    @staticmethod
    def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return (points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)

    def nearest(self, points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.concatenate([self.distances(points[a : a + 2048], centres).argmin(1) for a in range(0, len(points), 2048)] or [np.empty(0, np.int64)])


def adaptive_scan(points: np.ndarray, query: np.ndarray, keep: int) -> np.ndarray:
    """Rows of ``points`` that may be among the ``keep`` nearest to the query."""
    n, size = points.shape
    if n <= 2 * keep:
        return np.arange(n)
    first = points[: 2 * keep]
    bound = np.partition(((first - query) ** 2).sum(1), keep - 1)[keep - 1]
    alive, partial = np.arange(n), np.zeros(n, np.float32)
    for at in range(0, size, BLOCK):
        end = min(size, at + BLOCK)
        part = points[alive, at:end] - query[at:end]
        partial = partial + np.einsum("ij,ij->i", part, part)
        # With k of d components seen, a distance of at most `bound` shows more than this by chance only.
        slack = (1 + EPSILON / np.sqrt(end)) ** 2 if end < size else 1 + 1e-5
        fits = partial <= bound * slack * end / size
        alive, partial = alive[fits], partial[fits]
        if end < size and len(alive) > 2 * keep:  # the most promising so far tighten the bound
            best = alive[np.argpartition(partial, keep)[:keep]]
            bound = min(bound, float(((points[best] - query) ** 2).sum(1).max()))
    return alive


def grouped(sizes: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """(group of each list, parts of each group): lists of at most LIST_ROWS entries together, larger ones alone in parts."""
    group, parts, held = {}, {}, LIST_ROWS
    for at, n in sorted(sizes.items()):
        held += n
        if held > LIST_ROWS:
            parts[len(parts)], held = -(-n // LIST_ROWS), n
        group[at] = len(parts) - 1
    return group, parts


def probes_needed(index: DataFrame, sample: list, space: Space, sizes: dict[int, int], top: int) -> int:
    """How many of their nearest lists hold RECALL of the true neighbours of the queries ``sample`` (id, v), by brute force over ``index``."""
    if not sample:
        return 1
    asked, queries = np.asarray([r["id"] for r in sample], np.int64), np.asarray([r["v"] for r in sample])
    shared = index.sparkSession.sparkContext.broadcast((asked, queries))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, queries = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, lists, ids = matrix(batch.column(1)) @ queries.T, batch.column(0).to_numpy(), batch.column(2)
            most = min(top + 1, len(scores))
            best = np.argpartition(-scores, most - 1, axis=0)[:most]
            out = [(q, vec, scores[b, i], lists[b]) for i, q in enumerate(asked.tolist()) for b in best[:, i].tolist() for vec in ids[b].as_py() if vec != q]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int32()), strict=True)], ["query_id", "vec_id", "score", "list"])

    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = index.select("list", "v", "ids").mapInArrow(nearest, "query_id long, vec_id long, score double, list int")
    true = true.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top).groupBy("query_id", "list").count().collect()
    size = np.asarray([sizes.get(i, 0) for i in range(len(space.centres))])
    place, hits = {}, np.zeros(len(size))
    for q, far in zip(asked.tolist(), space.distances(space.queries(queries), space.centres), strict=True):
        order = np.argsort(far, kind="stable")
        place[q] = {at: n for n, at in enumerate(order[size[order] > 0].tolist())}
    for r in true:
        hits[place[r["query_id"]][r["list"]]] += r["count"]
    return int(np.searchsorted(np.cumsum(hits), RECALL * hits.sum())) + 1


def search(vectors: DataFrame, query_rows, vector: str = "embedding", key: str = "vec_id", top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows where ``query_rows`` (a condition on ``id``) holds their ``top`` nearest others found."""
    spark = vectors.sparkSession
    rows = usable(vectors, vector, key)
    table = written(entries(rows), "entries")
    facts = table.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("longest"), F.max(F.size("v")).alias("size")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = max(1, min(MAX_LISTS, facts["n"] // ROWS_A_LIST))
    sample = np.asarray([r[0] for r in table.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(SAMPLE).collect()])
    space = Space(float(facts["longest"]), facts["size"], sample, lists)
    shared = spark.sparkContext.broadcast((space.longest, space.turn, space.centres))

    def opened() -> Space:
        made = Space.__new__(Space)
        made.longest, made.turn, made.centres = shared.value
        return made

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = opened()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(space.nearest(space.points(matrix(batch.column(0))), space.centres).astype(np.int32)), *batch.columns], ["list", "v", "ids"])

    index = written(table.mapInArrow(file, "list int, v array<double>, ids array<long>"), "lists")
    sizes = {r["list"]: r["count"] for r in index.groupBy("list").count().collect()}
    group, parts = grouped(sizes)
    asking = rows.where(query_rows).select("id", "v").distinct()
    some = asking.withColumn("h", F.xxhash64("id", "v")).orderBy("h").limit(CALIBRATING).collect()
    probed = max(PROBES, probes_needed(index, some, space, sizes, top))
    counted = spark.sparkContext.broadcast((sizes, group, parts))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, (sizes, group, parts) = opened(), counted.value
        size = np.asarray([sizes.get(i, 0) for i in range(len(space.centres))])
        for batch in batches:
            if not batch.num_rows:
                continue
            far = space.distances(space.queries(matrix(batch.column(1))), space.centres)
            rows, groups, part, lists = [], [], [], []
            for i, near in enumerate(np.argsort(far, axis=1, kind="stable")):
                near = near[size[near] > 0]
                enough = int(np.searchsorted(np.cumsum(size[near]), LEAST_FOUND)) + 1
                by: dict[int, list[int]] = {}
                for at in near[: max(probed, enough)].tolist():
                    by.setdefault(group[at], []).append(at)
                for g, some in by.items():
                    for p in range(parts[g]):
                        rows.append(i)
                        groups.append(g)
                        part.append(p)
                        lists.append(some)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), pa.array(part, pa.int32()), batch.column(0).take(taken), batch.column(1).take(taken), pa.array(lists, pa.list_(pa.int32()))], ["group", "part", "id", "v", "lists"])

    probes = asking.mapInArrow(probe, "group int, part int, id long, v array<double>, lists array<int>")

    def scan(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if held.num_rows and asked.num_rows:
            space = opened()
            v, q = matrix(held.column("v").combine_chunks()), matrix(asked.column("v").combine_chunks())
            order = np.argsort(held.column("list").to_numpy(), kind="stable")
            v, ids = v[order], held.column("ids").combine_chunks().take(pa.array(order)).to_pylist()
            points, turned = space.points(v), space.queries(q)
            names, counts = np.unique(held.column("list").to_numpy(), return_counts=True)
            rows_of = {at: np.arange(end - n, end) for at, n, end in zip(names.tolist(), counts, np.cumsum(counts), strict=True)}
            lists = asked.column("lists").to_pylist()
            for i, query in enumerate(asked.column("id").to_pylist()):
                some = np.concatenate([rows_of[at] for at in lists[i] if at in rows_of])  # the nearest list first: its bound is the best
                near = some[adaptive_scan(points[some], turned[i], top + 1)]
                scores = (v[near] * q[i]).sum(1)
                reached: dict[int, float] = {}
                for b in np.argsort(-scores, kind="stable").tolist():
                    if len(reached) >= top and scores[b] < last:
                        break
                    for vec in ids[near[b]]:
                        if vec != query:
                            reached.setdefault(vec, scores[b])
                    last = scores[b]  # the least score that is needed: ties with it are all looked at
                found = sorted((-score, vec) for vec, score in reached.items())[:top]
                out.append((np.full(len(found), query, np.int64), np.asarray([f[1] for f in found], np.int64), np.asarray([-f[0] for f in found])))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})

    places = spark.createDataFrame([(at, g, parts[g]) for at, g in group.items()], "list int, group int, parts int")
    dealt = index.join(F.broadcast(places), "list").select("group", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), "list", "v", "ids")
    found = dealt.groupBy("group", "part").cogroup(probes.groupBy("group", "part")).applyInArrow(scan, "query_id long, vec_id long, score double")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
