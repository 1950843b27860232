"""Near copies by whole-text similarity: five-word shingle sets with a Jaccard similarity of 0.8 or more, without a loss.

Such texts differ in about ten of a 64-bit SimHash's bits, which no key over fingerprints reaches. So there are two steps:

1. ``simhash.link_table``: fingerprints (of five-word shingles) within 2 bits, found by pivot tables. Each such pair of texts
   is verified; this joins copies with few changes.
2. Prefixes: all shingles have one order, rare ones first. In it the first common shingle of two similar sets is among the
   first n - 0.8 n + 1 of each, and at least 4/9 of both sizes' sum must follow in both. Each text is filed under the shingles
   of its prefix. A key's texts are first compared with one of them; then, where a key still holds several components, with
   ``LEADERS`` of its texts; what is still apart is compared with each other. So any two similar
   texts end in one component, whatever the first step missed, and a large group of copies isn't compared in pairs.

Between the texts of a key a sketch decides first: 1,024 bits (folded to 256 where rows are many), each the parity of how many of a text's shingles
fall into one of as many classes. Where two sketches differ a shingle is in one set only, so of similar sets they differ in a ninth of both sizes'
sum at most: this bound loses no pair either. A pair is verified by its whole sets (64-bit hashes of the shingles). In the later passes pairs are not made of texts that are
in one component already. What many unlike texts share, such as a long passage, comes late in the order and makes no pairs; rarity is counted
over all texts by ``2 ** RARITY_BITS`` ranges of the hash, a table of fixed size, and is a matter of speed only. Texts of one
key that are all unlike each other, though each shares most of its shingles with each, are the one case in which the pairs of
a key are all compared.

Words are as in ``simhash``. A text of fewer than five words is one shingle; texts without words (null too) are copies of each
other, and so are texts of equal words. Rows are told apart by id and text, so rows without an id or that repeat one are
judged like any other; of rows that are equal in both, one stays. Ids sort null last, then by text. Extra columns are kept,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, join_by_size, lean, passing, text_bytes, written
from .simhash import components, link_table, majority

WIDTH, SEED = 5, 7
RARITY_BITS, SLICES = 18, 64
GROUP_SHINGLES = 20_000
LEADERS = 16
PARITY, FOLDED = tuple(f"p{i}" for i in range(16)), tuple(f"q{i}" for i in range(4))
FEW_TEXTS = 200_000


def word_list(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """The distinct shingles' XXH64, ascending. Shingles are made one at a time: a very long text costs its words and eight bytes a shingle."""
    if len(words) <= WIDTH:
        made, n = iter([b" ".join(words)] if words else []), min(1, len(words))
    else:
        made, n = map(b" ".join, zip(*(islice(words, i, None) for i in range(WIDTH)), strict=False)), len(words) - WIDTH + 1
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), made), np.uint64, n))


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    """Of two texts' distinct hashes."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 5 * both >= 4 * (len(one) + len(other) - both)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """n - ceil(0.8 n) + 1; none of an empty set."""
    return np.where(n, n + 1 - (4 * n + 4) // 5, 0)


def parities(hashes: np.ndarray) -> np.ndarray:
    """The sketch as sixteen words: whether each of 1,024 classes of the hash has an odd number."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & 1023, minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _same(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


def _named(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id, mark (a digest of the text as it is), text."""
    return docs.select(F.col(key).alias("doc_id"), F.md5(text_bytes(F.col(text))).alias("mark"), text_bytes(F.col(text)).alias("text"))


def sketches(named: DataFrame) -> DataFrame:
    """doc_id, mark, same (a digest of the words), fp, n (shingles), the sketch for every row; and rows with a slice's number and its counts of shingles by range of the hash, each text of a task counted once."""
    shift, slice_size = np.uint64(64 - RARITY_BITS), (1 << RARITY_BITS) // SLICES
    kind = pa.schema([("doc_id", pa.null()), ("mark", pa.string()), ("same", pa.binary()), ("fp", pa.int64()), ("n", pa.int32()), *((p, pa.int64()) for p in PARITY), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, of_id = np.zeros(1 << RARITY_BITS, np.uint32), set(), pa.null()
        for batch in batches:
            of_id = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 256):
                part, hashes, same = batch.slice(at, 256), [], []
                for text in part.column(2):
                    words = word_list(text.as_py())
                    digest, found = _same(words), shingle_hashes(words)
                    if digest not in seen:
                        seen.add(digest)
                        np.add.at(total, (found >> shift).astype(np.int64), 1)
                    same.append(digest)
                    hashes.append(found)
                sizes = np.array([len(h) for h in hashes], np.int64)
                fps = majority(np.concatenate([*hashes, np.empty(0, np.uint64)]), sizes)
                none, words_of = pa.nulls(len(same)), np.asarray([parities(h) for h in hashes]).reshape(-1, 16)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(same, pa.binary()), pa.array(fps.view(np.int64)), pa.array(sizes, pa.int32()), *(pa.array(words_of[:, i]) for i in range(16)), none.cast(pa.int32()), none.cast(pa.binary())], kind.names)
        filled = [i for i in range(SLICES) if total[i * slice_size : (i + 1) * slice_size].any()]
        columns = [pa.nulls(len(filled), of_id), *(pa.nulls(len(filled), f.type) for f in list(kind)[1:-2])]
        blobs = [total[i * slice_size : (i + 1) * slice_size].astype("<u4").tobytes() for i in filled]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(filled, pa.int32()), pa.array(blobs, pa.binary())], kind.names)

    return named.mapInArrow(lean(run), f"doc_id {named.schema['doc_id'].dataType.simpleString()}, mark string, same binary, fp long, n int, {', '.join(f'{p} long' for p in PARITY)}, slice int, counts binary")


def rarity(made: DataFrame) -> np.ndarray:
    """How many shingles each range of the hash has, over all tasks; SLICES rows come to the driver."""

    def added(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b, "<u4") for b in table.column("counts").to_pylist()], axis=0, dtype=np.int64)
        return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "counts": pa.array([total.astype("<i8").tobytes()])})

    counts = np.zeros((SLICES, (1 << RARITY_BITS) // SLICES), np.int64)
    for row in made.where("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(added, "slice int, counts binary").collect():
        counts[row["slice"]] = np.frombuffer(row["counts"], "<i8")
    return counts.ravel()


def prefixes(named: DataFrame, counts: np.ndarray) -> DataFrame:
    """key, same, n, rest: the shingles of each text's prefix and how many of its own follow, itself included; each text once a task."""
    shared, shift = named.sparkSession.sparkContext.broadcast(counts), np.uint64(64 - RARITY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = shared.value, set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                same, keys, sizes = [], [], []
                for text in batch.column(0).slice(at, 256):
                    words = word_list(text.as_py())
                    digest = _same(words)
                    if digest in seen or not words:
                        continue
                    seen.add(digest)
                    found = shingle_hashes(words)
                    first = int(prefix_length(np.int64(len(found))))
                    order = common[(found >> shift).astype(np.int64)]
                    if first < len(found):  # the rarest ones, ties by hash, then those alone are sorted
                        bound = np.partition(order, first - 1)[first - 1]
                        some = np.flatnonzero(order <= bound)
                        some = some[np.argsort(order[some], kind="stable")][:first]
                    else:
                        some = np.argsort(order, kind="stable")
                    same.append(digest)
                    keys.append(found[some])
                    sizes.append(len(found))
                sizes, lengths = np.asarray(sizes, np.int64), np.asarray([len(k) for k in keys], np.int64)
                rows = np.repeat(np.arange(len(same)), lengths)
                rest = sizes[rows] - (np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths))
                flat = np.concatenate([*keys, np.empty(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(same, pa.binary()).take(pa.array(rows)), pa.array(sizes[rows], pa.int32()), pa.array(rest, pa.int32())], ["key", "same", "n", "rest"])

    return named.select("text").mapInArrow(lean(run), "key long, same binary, n int, rest int")


def _may_be_similar(sketch: tuple[str, ...]) -> Column:
    """Whether a_n, b_n and the sketches a_<word>, b_<word> leave room for a similarity of 0.8."""
    differ = sum((F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in sketch), F.lit(0))
    return (5 * F.least("a_n", "b_n") >= 4 * F.greatest("a_n", "b_n")) & (9 * differ <= F.col("a_n") + F.col("b_n"))


def verified(pairs: DataFrame, texts: DataFrame, named: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose texts are similar. ``texts``: same, n and the row (doc_id, mark) to read it from.

    A text's set goes to the groups that need it. A group is one ``a`` with some of its ``b``, GROUP_SHINGLES or one text: an
    ``a`` with many partners is dealt over several groups. A group's rows pass by one at a time, the ``a`` first."""
    side = lambda x: texts.select(F.col("same").alias(x), F.col("n").alias(f"{x}_n"), *(F.col(p).alias(f"{x}_{p}") for p in PARITY))
    pairs = written(pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b").where(_may_be_similar(PARITY)).select("a", "b"), "pairs")
    sized = pairs.join(texts.select(F.col("same").alias("b"), "n"), "b").groupBy("a").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).cast("int").alias("groups"), F.count("*").alias("m"))
    sized = written(sized.withColumn("groups", F.greatest(F.col("groups"), F.lit(1))), "groups")
    firsts = sized.select(F.col("a").alias("same"), F.col("a").alias("to"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(0).alias("turn"))
    others = join_by_size(pairs, sized, "a", "m").select(F.col("b").alias("same"), F.col("a").alias("to"), F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("group"), F.lit(1).alias("turn"))
    sent = firsts.unionByName(others).groupBy("same").agg(F.collect_list(F.struct("to", "group", "turn")).alias("sent"))
    wanted = written(sent.join(texts.select("same", F.col("doc_id").alias("row_id"), F.col("mark").alias("row_mark")), "same"), "wanted")
    marks = wanted.select(F.col("row_mark").alias("mark")).distinct()
    if wanted.count() <= FEW_TEXTS:  # their digests tell at the scan which texts need not be shuffled
        named = named.join(F.broadcast(marks), "mark", "left_semi")
    read = named.join(wanted, F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("mark") == F.col("row_mark"))).select("same", "text", "sent")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [shingle_hashes(word_list(t.as_py())).tobytes() for t in part.column(1)]
                lists = part.column(2).to_pylist()
                rows = np.repeat(np.arange(len(sets)), [len(x) for x in lists])
                flat = [s for x in lists for s in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s["to"] for s in flat], pa.binary()), pa.array([s["group"] for s in flat], pa.int32()), pa.array([s["turn"] for s in flat], pa.int32()), part.column(0).take(pa.array(rows)), pa.array([sets[r] for r in rows], pa.binary())],
                    ["to", "group", "turn", "same", "hashes"],
                )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in batches:
            a, b = [], []
            for to, turn, same, hashes in zip(*(batch.column(c) for c in ("to", "turn", "same", "hashes")), strict=True):
                data = np.frombuffer(hashes.as_buffer(), np.uint64)
                if not turn.as_py():
                    at, own = to.as_py(), data.copy()
                elif to.as_py() == at and similar(own, data):
                    a.append(at)
                    b.append(same.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    sets = read.mapInArrow(lean(hashed), "to binary, group int, turn int, same binary, hashes binary")
    ordered = sets.repartition("to", "group").sortWithinPartitions("to", "group", "turn", "same")
    return written(ordered.mapInArrow(lean(compared), "a binary, b binary"), "similar")


def _rooted(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """``rows`` with the component of the text in ``column``, as ``<column>_at``."""
    found = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return rows.join(found, column, "left").withColumn(f"{column}_at", F.coalesce("_root", column)).drop("_root")


def _mixed(left: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the keys that hold several components, with their component."""
    known = written(_rooted(left.drop("same_at"), roots, "same"), "known")
    several = known.groupBy("key").agg(F.min("same_at").alias("low"), F.max("same_at").alias("high"), F.count("*").alias("m")).where("low <> high").select("key", "m")
    return written(join_by_size(known, written(several, "several"), "key", "m").drop("m"), "mixed")


def _grouped(named: DataFrame) -> DataFrame:
    """doc_id, mark, id and text_mark of the row that its group keeps, for every row."""
    everything = written(sketches(named), "sketches")
    made = everything.where("slice is null").drop("slice", "counts")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("least")
    texts = written(made.groupBy("same").agg(least, F.first("fp").alias("fp"), F.first("n").alias("n"), *(F.first(p).alias(p) for p in PARITY), F.count("*").alias("copies")).select("same", "fp", "n", *PARITY, "copies", "least", "least.doc_id", "least.mark"), "texts")

    # Fingerprints within two bits; texts of one fingerprint meet its first.
    by_print = written(texts.where("n > 0").groupBy("fp").agg(F.min("same").alias("first"), F.count("*").alias("m")), "prints")
    near = written(link_table(by_print.select("fp")), "near")
    side = lambda c: by_print.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_first"))
    bits = near.join(side("a"), "a").join(side("b"), "b").select(F.col("a_first").alias("a"), F.col("b_first").alias("b"))
    equal = join_by_size(texts.where("n > 0").select("same", "fp"), by_print, "fp", "m").where("same <> first").select(F.col("first").alias("a"), F.col("same").alias("b"))
    links = verified(bits.unionByName(equal), texts, named)

    # Prefixes: each key's texts against its first one. One shuffle; a key's rows are held on disk where they are many.
    of_key = Window.partitionBy("key")
    filed = prefixes(named, rarity(everything)).withColumn("lead", F.min(F.struct("same", "n", "rest")).over(of_key)).withColumn("last", F.max("same").over(of_key))
    members = written(filed.where("lead.same <> last").select("key", "same", "n", "rest", F.col("lead.same").alias("lead"), F.col("lead.n").alias("lead_n"), F.col("lead.rest").alias("lead_rest")).distinct(), "members")
    enough = lambda n, rest, m, other: 9 * F.least(rest, other) >= 4 * (F.col(n) + F.col(m))
    apart = members.where("same <> lead").where(enough("n", "rest", "lead_n", "lead_rest")).select(F.col("lead").alias("a"), F.col("same").alias("b")).distinct()
    apart = apart.join(links, ["a", "b"], "left_anti")
    links = written(links.unionByName(verified(apart, texts, named)), "links")
    roots = written(components(links), "roots")

    # Keys that still hold several components: their texts against a few of them.
    side = lambda x, rows, *more: rows.select("key", F.col("same").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("n", "rest", *FOLDED)), F.col("same_at").alias(f"{x}_at"), *more)
    close = enough("a_n", "a_rest", "b_n", "b_rest") & _may_be_similar(FOLDED)
    folded = [reduce(lambda x, y: x.bitwiseXOR(y), (F.col(p) for p in PARITY[i::4])).alias(q) for i, q in enumerate(FOLDED)]
    left = _mixed(members.select("key", "same", "n", "rest"), roots).join(texts.select("same", *folded), "same")
    left = written(left, "left")
    order = Window.partitionBy("key").orderBy(F.xxhash64("same"), "same")
    leaders = side("a", left.withColumn("place", F.row_number().over(order)).where(F.col("place") <= LEADERS))
    listed = leaders.groupBy("key").agg(F.collect_list(F.struct("a", "a_n", "a_rest", "a_at", *(f"a_{p}" for p in FOLDED))).alias("leaders"))
    counted = written(listed.join(left.groupBy("key").agg(F.count("*").alias("m")), "key"), "leaders")
    met = join_by_size(side("b", left), counted, "key", "m").select("*", F.explode("leaders").alias("leader")).select("*", "leader.*")
    links = written(links.unionByName(verified(met.where((F.col("a_at") != F.col("b_at")) & close).select("a", "b"), texts, named)), "links")
    roots = written(components(links), "roots")
    # What is still apart: against each other.
    left = _mixed(left, roots)
    more = written(side("a", left).join(side("b", left), "key").where((F.col("a_at") < F.col("b_at")) & close).select("a", "b").distinct(), "more")
    if not more.isEmpty():
        links = written(links.unionByName(verified(more, texts, named)), "links")
        roots = written(components(links), "roots")

    every = written(_rooted(texts.select("same", "copies", "least"), roots, "same"), "every")
    best = written(every.groupBy("same_at").agg(F.min("least").alias("best"), F.count("*").alias("m")), "best")
    told = written(join_by_size(every.select("same", "copies", "same_at"), best, "same_at", "m").select("same", "copies", F.col("best.doc_id").alias("id"), F.col("best.mark").alias("text_mark")), "told")
    return join_by_size(made.select("doc_id", "mark", "same"), told, "same", "copies").select("doc_id", "mark", "id", "text_mark")


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, component_id (smallest id of the documents it is connected to, itself included; null if none has one), for every row."""
    with passing(docs.sparkSession) as kept:
        return kept(_grouped(_named(docs, text, key)).select("doc_id", F.col("id").alias("component_id")), "near")


def keep_representatives(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, of each group the one with the smallest id."""
    id_name, mark_name = fresh(docs, "near_id"), fresh(docs, "near_mark")
    with passing(docs.sparkSession) as stays:
        found = written(_grouped(_named(docs, text, key)), "groups")
        rows = found.groupBy("doc_id", "mark").agg(F.first("id").alias("id"), F.first("text_mark").alias("text_mark"), F.count("*").alias("n"))
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("text_mark"))
        rows = stays(rows.withColumn("kept", same).select(F.col("doc_id").alias(id_name), F.col("mark").alias(mark_name), "n", "kept"), "decisions")
    here = lambda frame, names: frame[key].eqNullSafe(names[id_name]) & (F.md5(text_bytes(frame[text])) == names[mark_name])
    gone = rows.where("not kept").select(id_name, mark_name)
    kept = docs.join(gone, here(docs, gone), "left_anti")
    again = rows.where("kept and n > 1").select(id_name, mark_name)
    if again.isEmpty():
        return kept
    one = kept.join(again, here(kept, again), "left_semi").dropDuplicates([key, text])
    return kept.join(again, here(kept, again), "left_anti").unionByName(one)
