"""Token ids in ORC: one row per document, run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are range partitioned and sorted by id (ties by a hash of the text), so every file covers its own range of ids: a
reader for some ids skips files and stripes by their statistics and Bloom filters, and many readers share a file by stripe.
``shard`` numbers the ranges in ascending order and ``local_start`` counts the ids before a document within its range; a
document's place among all ids is the sum of the earlier ranges plus that. Null texts are empty, null ids come first; rows
that repeat an id each keep their own entry. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, held, lean, scratch

END_ID = 2
CACHE_PIECES, KEPT_PIECES, SLICE_BYTES = 120_000, 30_000, 4 << 20
FILE_BYTES, MOST_FILES = 32 << 20, 20_000
# Within these characters the tokenizer's rules are plain: normalising only lower-cases, and the pieces are its own pattern's.
_OTHER = r"[^\t\n\r\x20-\x7e\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]|<\|"
_PIECE = r"'(?:s|t|re|ve|m|ll|d)|[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+|[0-9]|[^a-z0-9\x{df}-\x{f6}\x{f8}-\x{ff}]+"
_SPACE = re.compile("[\t\n\r ]+")


def strung(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``chosen`` of ``values`` (a run is a start and a size) end to end, and where each begins, with the end of all."""
    n = sizes[chosen]
    cuts = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat((starts[chosen] - cuts[:-1]).astype(np.int32), n)
    at += np.arange(cuts[-1], dtype=np.int32)
    return values[at], cuts


class WordEncoder:
    """The tokenizer's ids of texts, by piece: its pattern cuts a text into pieces and merges nothing across them, so a
    piece's ids depend on the piece alone. Texts are cut column by column (white-space chunks, the distinct ones' pieces);
    new pieces are encoded many at a time, where the last id of each ends a word, which tells them apart. A chunk with
    other characters than ``_OTHER`` allows, or a special token's string, is one piece and goes to the tokenizer as it is.
    Two generations of ``CACHE_PIECES`` pieces are held: what was met again survives when the older one goes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # The same model behind steps that pieces need no more: they are lower case and apart already.
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.kind = id_type(len(self.ends))
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def trim(self) -> None:
        """At a task's end: what was met first, and so mostly often, stays for the next one."""
        self.new, self.old = dict(islice(self.new.items(), KEPT_PIECES)), {}
        give_back()

    def _raw(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        lines = [pieces[i : i + 256] for i in range(0, len(pieces), 256)]
        for line, found in zip(lines, self.plain.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.asarray(found.ids, self.kind)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
            if len(cuts) == len(line):
                raw = ids.tobytes()
                self.new.update(zip(line, map(raw.__getitem__, map(slice, [0, *cuts[:-1].tolist()], cuts.tolist())), strict=True))
            else:
                self.new.update((p, self._raw(p)) for p in line)

    def _ids_of(self, pieces: list[str], odd: bool = False) -> list[bytes]:
        if len(self.new) >= CACHE_PIECES:
            self.new, self.old = {"": b""}, self.new
        wanted = [p for p in pieces if p not in self.new]
        self.new.update((p, self.old[p]) for p in wanted if p in self.old)
        wanted = [p for p in wanted if p not in self.new]
        if odd:
            self.new.update((p, self._raw(p)) for p in wanted)
        else:
            self._learn(wanted)
        return list(map(self.new.__getitem__, pieces))

    def _plain_texts(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        chunks = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        distinct = chunks.flatten().dictionary_encode()
        pieces = pc.ascii_split_whitespace(pc.replace_substring_regex(distinct.dictionary, _PIECE, r"\0 "))
        named = pieces.flatten().dictionary_encode()
        found = self._ids_of(named.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        ids, cuts = strung(np.frombuffer(b"".join(found), self.kind), np.cumsum(sizes) - sizes, sizes, np.asarray(named.indices))
        cuts = cuts[np.asarray(pieces.offsets)]
        ids, ends = strung(ids, cuts[:-1], np.diff(cuts), np.asarray(distinct.indices))
        return ids, ends[np.asarray(chunks.offsets)]

    def _odd_text(self, text: str) -> bytes:
        """A text with a chunk that the rules above don't cover."""
        chunks = _SPACE.split(text)
        odd = np.asarray(pc.match_substring_regex(pa.array(chunks, pa.string()), _OTHER))
        whole = dict(zip(rare := sorted({c for c, o in zip(chunks, odd, strict=True) if o}), self._ids_of(rare, True), strict=True))
        others = [c for c, o in zip(chunks, odd, strict=True) if not o]
        ids, cuts = self._plain_texts(pa.array(others, pa.string()))
        raw, cuts = ids.tobytes(), iter((cuts * ids.itemsize).tolist())
        out, at = [], next(cuts)
        for chunk, o in zip(chunks, odd, strict=True):
            if o:
                out.append(whole[chunk])
            else:
                before, at = at, next(cuts)
                out.append(raw[before:at])
        return b"".join(out)

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """Each text's little-endian ids of ``kind``; null is empty."""
        texts, out = pc.fill_null(texts, ""), []
        sizes = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
        at = 0
        while at < len(texts):  # so many texts that the arrays below stay small
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
            some = texts.slice(at, to - at)
            odd = pc.match_substring_regex(some, _OTHER)
            ids, cuts = self._plain_texts(pc.if_else(odd, "", some))
            raw, cuts = ids.tobytes(), (cuts * ids.itemsize).tolist()
            out += [self._odd_text(some[i].as_py()) if o else raw[cuts[i] : cuts[i + 1]] for i, o in enumerate(odd.to_pylist())]
            at = to
        give_back()
        return out


def id_type(ids: int) -> str:
    """The narrowest little-endian type for that many ids: what is shuffled is half as long for a small vocabulary."""
    return "<u2" if ids <= 1 << 16 else "<u4"


def measured(docs: DataFrame, text: str, key: str, files: int | None) -> tuple[int, np.ndarray]:
    """How many files (by the texts' bytes, MOST_FILES at most), and ascending ids that cut the table into ranges of about as many rows."""
    if not files:
        total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        files = max(1, min(MOST_FILES, -(-total // FILE_BYTES)))
    return files, id_bounds(docs, key, files)


def id_bounds(docs: DataFrame, key: str, files: int) -> np.ndarray:
    """Ascending ids that cut the table into ``files`` ranges of about as many rows; read from the id column alone."""
    cuts = [i / files for i in range(1, files)]
    found = docs.select(F.percentile_approx(F.col(key), cuts, 100 * files)).first()[0] if cuts else None
    return np.asarray(found or [], np.int64)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID, files: int | None = None, stripe_bytes: int = 64 << 20) -> None:
    """Encode every text and write the ORC files under ``path``. One shuffle, of ids rather than text; ids must be integers."""
    files, bounds = measured(docs, text, key, files)
    kind = WordEncoder(tokenizer_path).kind if end_id < 1 << 16 else "<u4"
    end = np.asarray([end_id], kind).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(f"encoder {tokenizer_path} {kind}", lambda: WordEncoder(tokenizer_path))
        encoder.kind = kind
        for batch in batches:
            ids = [b + end for b in encoder.encode(batch.column(1))]
            order = np.asarray([zlib.crc32(b) for b in ids], np.int64)
            keys = batch.column(0).cast(pa.int64())
            known = np.asarray(keys.fill_null(0))
            low, high = np.searchsorted(bounds, known, "left"), np.searchsorted(bounds, known, "right")
            shard = low + order * (high - low + 1) // (1 << 32)  # an id that fills several ranges is dealt over them
            shard[np.asarray(keys.is_null())] = 0
            for at in range(0, batch.num_rows, 2048):
                to = slice(at, at + 2048)
                yield pa.RecordBatch.from_arrays([keys[to], pa.array(shard[to], pa.int32()), pa.array(order[to]), pa.array(ids[to], pa.binary())], ["doc_id", "shard", "tie", "ids"])
        encoder.trim()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = 0, None
        for batch in batches:
            blobs, shards = batch.column(2).to_pylist(), np.asarray(batch.column(1))
            sizes = np.asarray([len(b) for b in blobs], np.int64) // np.dtype(kind).itemsize
            starts = np.cumsum(sizes) - sizes
            first = np.flatnonzero(np.concatenate([[len(shards) > 0 and shards[0] != last], shards[1:] != shards[:-1]]))
            base = np.full(len(sizes), before, np.int64)
            for at, nxt in zip(first, np.append(first, len(sizes))[1:], strict=True):  # a batch may open no range
                base[at:nxt] = -starts[at]
            starts_in = starts + base
            tokens = pa.ListArray.from_arrays(pa.array(np.append(starts, sizes.sum()).astype(np.int32)), pa.array(np.frombuffer(b"".join(blobs), kind).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts_in), pa.array(sizes), tokens], ["doc_id", "shard", "local_start", "n_tokens", "tokens"])
            if len(sizes):
                before, last = int(starts_in[-1] + sizes[-1]), shards[-1]

    encoded = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, "doc_id long, shard int, tie long, ids binary")
    placed = encoded.repartitionById(files, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "shard", "ids")
    (
        placed.mapInArrow(lean(place), "doc_id long, shard int, local_start long, n_tokens long, tokens array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id").option("orc.create.index", "true").option("orc.row.index.stride", "1000").option("orc.compress", "SNAPPY").option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, shard, local_start, n_tokens, tokens; filters on doc_id reach the files' statistics and Bloom filters."""
    return spark.read.schema("doc_id long, shard int, local_start long, n_tokens long, tokens array<int>").orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start among all ids, n_tokens, ids_crc32, from the files."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(4)
            flat, cuts = np.asarray(tokens.flatten()).astype("<u4").tobytes(), np.asarray(tokens.offsets)
            cuts = cuts - cuts[0] if len(cuts) else cuts
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums, pa.int64())], ["doc_id", "shard", "local_start", "n_tokens", "ids_crc32"])

    # One row for each range of ids, so the window below is over a few thousand rows at most.
    sizes = read_tokens(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    rows = read_tokens(spark, path).mapInArrow(lean(crc), "doc_id long, shard int, local_start long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write all documents' ids to a new folder in the shared one and index what was written."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, text, key)
    return token_index(docs.sparkSession, path)
