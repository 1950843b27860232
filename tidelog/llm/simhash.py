"""SimHash near-duplicates: 64-bit fingerprints of 3-word shingles, links at 2 or fewer differing bits, pivot distance tables.

Two fingerprints that differ in 2 bits at most are equal in one of three blocks of bits. The reference fingerprints are 0
and nine masks, three in each block. For disjoint masks the distances to them fix how many bits are set under each:
d(x, mask) = d(x, 0) + |mask| - 2 * bits(x in mask). Within 2 bits these counts differ by 2 in total at most. So a fingerprint
is filed, for each block, under the block's bits with the counts of the other two, and with those one step away (39 keys at
most): two that link share a key, and two at random share one with a chance of about 10 in 1,000,000,000. Within a key a table of
distances to further, pseudo-random pivots discards pairs whose largest coordinate difference exceeds 2, and the Hamming
distance is computed for the survivors only. Exact copies are one fingerprint from the start. A key gives a spanning tree of
its links, never all its pairs; no key is capped. Components come from alternating large-star and small-star rounds, each
written to the shared folder.

Words are runs of anything but space and \\x09-\\x0D of the text with A-Z lower-cased; a text of fewer than three words is one
shingle, one without words (or null) has fingerprint zero, which links like any other. Rows that repeat an id keep a row each; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, join_by_size, lean, text_bytes, written, written_at

BITS, LINK, SHINGLE, SEED = 64, 2, 3, 42
SMALL_KEY = 8
BLOCKS = ((0, 21), (21, 21), (42, 22))  # first bit, bits
PIECES = tuple((at + 7 * n, 7 if n < 2 else size - 14) for at, size in BLOCKS for n in range(3))
PIVOTS = np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(24)], np.uint64)
_ONES = np.uint64(0x0101010101010101)
SMALL_GRAPH = 500_000


def shingles(data: bytes, width: int = SHINGLE) -> list[bytes]:
    words = data.lower().split()
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One unsigned fingerprint a text: a bit is 1 if more than half of the shingles' XXH64 have it."""
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    hashes = [np.fromiter(map(digest, s), np.uint64, len(s)) for s in map(shingles, texts)]
    sizes = np.array([len(h) for h in hashes], np.int64)
    return majority(np.concatenate([*hashes, np.empty(0, np.uint64)]), sizes)


def majority(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of ``sizes`` hashes: the bits that over half of them have; 0 for an empty run."""
    out = np.zeros(len(sizes), np.uint64)
    if not len(flat):
        return out
    full = np.flatnonzero(sizes)
    pieces = [np.arange(0, n, 255) + at for n, at in zip(sizes[full], (np.cumsum(sizes) - sizes)[full], strict=True)]
    cuts, first = np.concatenate(pieces), np.cumsum([0, *(len(p) for p in pieces[:-1])])
    for bit in range(8):  # eight counters a word of memory; 255 summands can't overflow a byte
        sums = np.add.reduceat((flat >> np.uint64(bit)) & _ONES, cuts)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        over = (2 * counts > sizes[full, None]).astype(np.uint64)
        out[full] |= (over << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(1, dtype=np.uint64)
    return out


def fingerprint_table(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the fingerprint as a signed long, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints(part.column(1).to_pylist()).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(key).alias("doc_id"), text_bytes(F.col(text)).alias("text")).mapInArrow(lean(run), f"doc_id {docs.schema[key].dataType.simpleString()}, fp long")


def pivot_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rows): for each block its bits and the other blocks' counts, as they are and one step away; each row at most once under a key."""
    counts = [np.bitwise_count(fps & (np.uint64((1 << size) - 1) << np.uint64(at))).astype(np.uint64) for at, size in PIECES]
    every, keys, rows = np.arange(len(fps)), [], []
    for block, (at, size) in enumerate(BLOCKS):
        own = ((fps >> np.uint64(at)) & np.uint64((1 << size) - 1)) << np.uint64(2) | np.uint64(block)
        others = [i for i in range(9) if i // 3 != block]
        shifts = [np.uint64(24 + 4 * n) for n in range(6)]
        for i, shift in zip(others, shifts, strict=True):
            own = own | counts[i] << shift
        keys.append(own)
        rows.append(every)
        for i, shift in zip(others, shifts, strict=True):
            up, down = np.flatnonzero(counts[i] < PIECES[i][1]), np.flatnonzero(counts[i] > 0)
            keys += [own[up] + (np.uint64(1) << shift), own[down] - (np.uint64(1) << shift)]
            rows += [up, down]
    return np.concatenate(keys), np.concatenate(rows)


def _near(one: np.ndarray, other: np.ndarray, table_one: np.ndarray, table_other: np.ndarray) -> np.ndarray:
    """Which rows are within LINK bits: coordinates first, then the distance for the survivors."""
    left = np.flatnonzero(np.abs(table_one - table_other).max(1) <= LINK)
    one, other = np.broadcast_to(one, len(other))[left], other[left]
    return left[np.bitwise_count(one ^ other) <= LINK]


def key_links(fps: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is connected within each key; ``starts`` are the keys' first rows."""
    sizes = np.diff(np.append(starts, len(fps)))
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    ends = np.repeat(starts + sizes, sizes)
    small = np.repeat(sizes <= SMALL_KEY, sizes)
    links = []
    for step in range(1, SMALL_KEY):
        at = np.flatnonzero(small & (np.arange(len(fps)) + step < ends))
        if len(at):
            near = at[_near(fps[at], fps[at + step], table[at], table[at + step])]
            links.append((fps[near], fps[near + step]))
    for start, size in zip(starts[sizes > SMALL_KEY], sizes[sizes > SMALL_KEY], strict=True):
        waiting = np.arange(start, start + size)
        while len(waiting):
            front, waiting = [waiting[0]], waiting[1:]
            while front and len(waiting):
                at = front.pop()
                found = _near(fps[at], fps[waiting], table[at], table[waiting])
                if len(found):
                    links.append((np.full(len(found), fps[at]), fps[waiting[found]]))
                    front += list(waiting[found])
                    waiting = np.delete(waiting, found)
    return links


def link_table(distinct: DataFrame) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints ``fp`` that connect all that is connected within some key."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            keys, rows = pivot_keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fps[rows].view(np.int64))], ["key", "fp"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            many = np.repeat(sizes > 1, sizes)  # most keys hold one fingerprint
            sizes = sizes[sizes > 1]
            links = key_links(fps[many].view(np.uint64), np.cumsum(sizes) - sizes) if len(sizes) else []
            a = np.concatenate([x[0] for x in links] or [np.empty(0, np.uint64)]).view(np.int64)
            b = np.concatenate([x[1] for x in links] or [np.empty(0, np.uint64)]).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            keys, fps = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last key may go on in the next batch
            if cut or (held and held[-1][0][-1] != keys[-1]):
                yield told(*(np.concatenate(x) for x in zip(*held, (keys[:cut], fps[:cut]), strict=True)))
                held = []
            held.append((keys[cut:], fps[cut:]))
        if held:
            yield told(*(np.concatenate(x) for x in zip(*held, strict=True)))

    filed = distinct.select("fp").mapInArrow(lean(file), "key long, fp long")
    return filed.repartition("key").sortWithinPartitions("key").mapInArrow(lean(search), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node it is connected to, itself included."""
    edges, path = written_at(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        count = edges.count()
        if count <= SMALL_GRAPH:  # one task does it without shuffles; beyond that the same rounds run by key
            edges = edges.coalesce(1)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        own = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        joined = large.join(own, F.col("u") == F.col("w"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        before = path
        edges, path = written_at(small, "links")
        drop_path(links.sparkSession, before)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row; component_id is the smallest id reachable, null only if none of them has an id."""
    table = written(fingerprint_table(docs, text, key), "fingerprints")
    distinct = written(table.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    roots = written(components(link_table(distinct)), "roots")
    # Unlinked fingerprints are their own component; linked ones get the least id over all of theirs.
    linked = written(distinct.join(roots, F.col("fp") == F.col("node")).select("fp", "least", "root"), "linked")
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m")), "least")
    found = join_by_size(linked.select("fp", "root"), least, "root", "m").select("fp", "component_id")
    every = written(distinct.join(found, "fp", "left").select("fp", "n", F.coalesce("component_id", "least").alias("component_id")), "every")
    return join_by_size(table, every, "fp", "n").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
