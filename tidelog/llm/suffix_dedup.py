"""Exact substring dedup by suffix arrays: bytes of a document that some smaller id also has in 50 bytes or more.

Every 50-byte window of every document is judged, but only those that can repeat are sorted. How a table is handled:

1. Documents are dealt into blocks by a hash of the id. A window's anchor is its 16-byte string with the smallest hash, so
   equal windows have equal anchors. A block sends the hashes of its anchors, packed, to the shard of each hash.
2. A shard answers which anchors occur in more than one document, and which in very many.
3. A block sends the stretch of text around each such anchor (all windows that have it as theirs), each distinct stretch
   once, to the shard of the anchor. Windows of very frequent anchors go one by one to the shard of their own hash, so that
   a line that a third of all documents have doesn't meet in one shard.
4. A shard sorts its stretches in runs of bounded size: suffix arrays by Larsson-Sadakane refinement, common prefixes after
   Kasai over the permuted array, and the runs' distinct windows merged by binary search. It answers the smallest id that
   has each window.
5. A block marks the windows whose smallest id is below the document's and cuts the marked bytes.

The hashes only choose candidates: windows are compared byte by byte in step 4, so a clash costs time and not a result. All
steps are one plan; blocks are shuffled once and that exchange is used three times. A null text is empty. Rows without an
id count as larger than any; rows that repeat an id don't remove each other's bytes. Extra columns are not read. An empty table
gives no rows. A message goes from a block to each shard that it has an anchor for, so there are at most as many messages as
anchors (a seventeenth of the bytes), and before that as many as blocks times shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

WIDTH, GRAM = 50, 16
BLOCK_BYTES, RUN_BYTES, TILE = 8 << 20, 1 << 20, 1 << 19
SHARDS_A_BLOCK = 3
FREQUENT = 20_000
LAST = np.iinfo(np.int64).max
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


# --- windows and anchors -----------------------------------------------------------------------------------------------


def words_at(data: np.ndarray, big: bool = False) -> np.ndarray:
    """The eight bytes from every place on as one number; ``big`` keeps their order."""
    view = np.ndarray((max(0, len(data) - 7),), ">u8" if big else "<u8", buffer=data, strides=(1,))
    return view.astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C3
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    eight = words_at(data)
    return mixed(eight[:-8] * _C1 + (eight[8:] ^ (eight[8:] >> np.uint64(31))) * _C2) if len(eight) > 8 else np.empty(0, np.uint64)


def window_anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, place, hash) of the runs of consecutive valid window starts that share an anchor."""
    found = []
    grams = WIDTH - GRAM + 1
    for at in range(0, len(valid), TILE):
        ok = valid[at : at + TILE]
        if not ok.any():
            continue
        hashes = gram_hashes(data[at : at + len(ok) + WIDTH - 1])
        if not len(hashes):
            continue
        key = (hashes & ~np.uint64((1 << 22) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while 2 * size <= grams:
            key = np.minimum(key[: len(key) - size], key[size:])
            size *= 2
        if size < grams:
            key = np.minimum(key[: len(key) - (grams - size)], key[grams - size :])
        starts = np.flatnonzero(ok[: len(key)])
        if not len(starts):
            continue
        place = (key[starts] & np.uint64((1 << 22) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        ends = np.append(cut[1:], len(starts)) - 1
        found.append((starts[cut] + at, starts[ends] + at, place[cut] + at, mixed(hashes[place[cut]])))  # smallest hashes are low; mixed again they spread
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Block:
    """Some documents' bytes end to end, and the runs of windows by anchor."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").combine_chunks()
        texts = table.column("text").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.binary())
        self.ids = np.asarray(ids.fill_null(LAST), np.int64) if len(ids) else np.empty(0, np.int64)
        self.null = np.asarray(ids.is_null()) if len(ids) else np.empty(0, bool)
        wide = np.dtype(np.int64) if pa.types.is_large_binary(texts.type) else np.dtype(np.int32)
        offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if len(texts) else None
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
        self.offsets = offsets - offsets[0]
        # A fixed order whatever order the rows came in.
        first = [self.data[a : a + 64].tobytes() for a in self.offsets[:-1]]
        order = np.array(sorted(range(len(self.ids)), key=lambda i: (self.ids[i], self.offsets[i + 1] - self.offsets[i], first[i], self.data[self.offsets[i] : self.offsets[i + 1]].tobytes() if i and self.ids[i] == LAST else b"")), np.int64)
        if len(order) and (order[1:] < order[:-1]).any():
            sizes = np.diff(self.offsets)[order]
            self.data = np.concatenate([self.data[self.offsets[i] : self.offsets[i + 1]] for i in order])
            self.ids, self.null, self.offsets = self.ids[order], self.null[order], np.concatenate([[0], np.cumsum(sizes)])
        valid = np.ones(len(self.data), bool)
        for end, size in zip(self.offsets[1:], np.diff(self.offsets), strict=True):
            valid[end - min(WIDTH - 1, size) : end] = False
        self.first, self.last, _, self.hash = window_anchors(self.data, valid)
        self.doc = np.searchsorted(self.offsets, self.first, "right") - 1
        self.values, self.which = np.unique(self.hash >> np.uint64(16), return_inverse=True)


def shard_of(values: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the 48-bit values: a sorted block is cut into one piece a shard."""
    return ((values >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    steps = np.diff(values, prepend=np.uint64(0))
    rest = steps[1:]
    if len(rest) and rest.max() >= 1 << 32:
        return b"\0" + values.astype("<u8").tobytes()
    return b"\1" + values[:1].astype("<u8").tobytes() + rest.astype("<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"\0":
        return np.frombuffer(data, "<u8", offset=1)
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1, 1), np.frombuffer(data, "<u4", offset=9).astype(np.uint64)]), dtype=np.uint64)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start, as many as its count, end to end."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def pieces(sorted_shards: np.ndarray) -> list[tuple[int, int, int]]:
    """(shard, first, past the last) of a sorted array of shards."""
    if not len(sorted_shards):
        return []
    cut = np.flatnonzero(np.concatenate([[True], sorted_shards[1:] != sorted_shards[:-1]]))
    return [(int(sorted_shards[a]), int(a), int(b)) for a, b in zip(cut, np.append(cut[1:], len(sorted_shards)), strict=True)]


# --- suffix arrays -----------------------------------------------------------------------------------------------------


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order. Larsson-Sadakane: groups that are equal in their first h bytes are refined by the group of the suffix h further on, only while they hold more than one."""
    n = len(data)
    key = words_at(np.concatenate([data, np.zeros(7, np.uint8)]), big=True)
    order = np.argsort(key, kind="stable")
    zeros = not data.min()
    if zeros:  # the zeros behind the end must not equal zero bytes within the text: shorter suffixes come first
        length = np.minimum(n - np.arange(n), 8)
        order = np.lexsort((length, key))
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    if zeros:
        new[1:] |= length[order][1:] != length[order][:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    open_ = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(open_):
        members = order[open_]
        group = rank[members]
        follow = rank[np.minimum(members + h, n)] + 1
        by = np.argsort(group * np.int64(n + 1) + follow, kind="stable")
        members, group, follow = members[by], group[by], follow[by]
        order[open_] = members
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        rank[members] = np.maximum.accumulate(np.where(new, open_, 0))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(open_)))
        open_ = open_[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the prefix each suffix shares with the one before it in the order (0 for the first).

    Kasai's walk in text order, where the length drops by one at most from place to place: it is compared only where the
    byte before the two suffixes differs, and everywhere else it is one less than at the place before."""
    n = len(data)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    prior = np.where(before > 0, data[np.maximum(before - 1, 0)], 0)
    own = np.concatenate([[0], data[:-1]])
    compare = (before <= 0) | (np.arange(n) == 0) | (prior != own)
    at = np.flatnonzero(compare & (before >= 0))
    eight = words_at(np.concatenate([data, np.zeros(8, np.uint8)]))
    length = np.zeros(n, np.int64)
    a, b, where = at.copy(), before[at], at
    while len(where):
        limit = n - np.maximum(a, b)
        differ = eight[a] ^ eight[b]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        same = np.minimum(same, limit)
        length[where] += same
        go = (same == 8) & (limit > 8)
        a, b, where = a[go] + 8, b[go] + 8, where[go]
    source = np.maximum.accumulate(np.where(compare, np.arange(n), 0))
    plcp = np.maximum(length[source] - (np.arange(n) - source), 0)
    return plcp[order]


def run_windows(data: np.ndarray, starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows at ``starts`` with an id each: the distinct ones in order, the smallest id of each, and each start's place among them."""
    order = suffix_array(data)
    same = common_prefixes(data, order) >= WIDTH
    ids = np.full(len(data), LAST, np.int64)
    ids[starts] = owners
    is_window = np.zeros(len(data), bool)
    is_window[starts] = True
    group_in_order = np.cumsum(~same) - 1
    sorted_window = is_window[order]
    groups, first = np.unique(group_in_order[sorted_window], return_index=True)
    members = order[sorted_window]
    least = np.minimum.reduceat(ids[members], first)
    place = np.empty(len(data), np.int64)
    place[members] = np.searchsorted(groups, group_in_order[sorted_window])
    bytes_ = np.ndarray((len(data) - WIDTH + 1,), f"S{WIDTH}", buffer=data, strides=(1,))
    return bytes_[members[first]], least, place[starts]


def smallest_owner(stretches: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each stretch the smallest id that has it in some stretch, end to end; and the stretches' counts of windows."""
    runs, at, size = [], 0, 0
    for i, s in enumerate(stretches):
        size += len(s)
        if size >= RUN_BYTES or i == len(stretches) - 1:
            runs.append((at, i + 1))
            at, size = i + 1, 0
    merged_keys, merged_ids, parts = None, None, []
    for a, b in runs:
        lengths = np.array([len(s) for s in stretches[a:b]], np.int64)
        counts = lengths - WIDTH + 1
        base = np.cumsum(lengths) - lengths
        starts = ragged(base, counts)
        keys, least, place = run_windows(np.frombuffer(b"".join(stretches[a:b]), np.uint8), starts, np.repeat(owners[a:b], counts))
        parts.append((keys, place, counts))
        if merged_keys is None:
            merged_keys, merged_ids = keys.copy(), least.copy()
        else:  # the shorter, sorted run is looked up in what is merged so far
            at = np.searchsorted(merged_keys, keys)
            known = np.zeros(len(keys), bool)
            inside = at < len(merged_keys)
            known[inside] = merged_keys[at[inside]] == keys[inside]
            merged_ids[at[known]] = np.minimum(merged_ids[at[known]], least[known])
            merged_keys = np.insert(merged_keys, at[~known], keys[~known])
            merged_ids = np.insert(merged_ids, at[~known], least[~known])
    ids = [merged_ids[np.searchsorted(merged_keys, keys)][place] if len(parts) > 1 else merged_ids[place] for keys, place, _ in parts]
    return np.concatenate(ids), np.concatenate([c for _, _, c in parts])


# --- the steps ---------------------------------------------------------------------------------------------------------

_ANCHORS = "block long, shard long, payload binary, many binary"
_REPLY = "block long, kind int, shard long, payload binary"
_STRETCHES = "block long, shard long, payload binary, sizes binary, owners binary"


def _rows(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(schema, columns, strict=True)})


def _send_anchors(shards: int):
    def run(table: pa.Table) -> pa.Table:
        block, name = Block(table), table.column("block")[0].as_py()
        count = np.bincount(block.which, minlength=len(block.values)) if len(block.values) else np.empty(0, np.int64)
        # In two documents of this block already?
        least = np.full(len(count), LAST, np.int64)
        most = np.full(len(count), -1, np.int64)
        np.minimum.at(least, block.which, block.doc)
        np.maximum.at(most, block.which, block.doc)
        repeated = least < most
        rows = []
        for shard, a, b in pieces(shard_of(block.values, shards)):
            frequent = np.flatnonzero(count[a:b] >= 8)
            many = np.packbits(repeated[a:b]).tobytes() + frequent.astype("<u4").tobytes() + count[a:b][frequent].astype("<u4").tobytes()
            rows.append((name, shard, packed(block.values[a:b]), many))
        return _rows([("block", pa.int64()), ("shard", pa.int64()), ("payload", pa.binary()), ("many", pa.binary())], rows)

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    values = [unpacked(p) for p in table.column("payload").to_pylist()]
    sizes = np.array([len(v) for v in values])
    here, often = np.zeros(sizes.sum(), bool), np.ones(sizes.sum(), np.int64)
    at = np.cumsum(sizes) - sizes
    for many, a, n in zip(table.column("many").to_pylist(), at, sizes, strict=True):
        bits = (n + 7) // 8
        here[a : a + n] = np.unpackbits(np.frombuffer(many, np.uint8, bits), count=n).astype(bool)
        pairs = np.frombuffer(many, "<u4", offset=bits).reshape(2, -1)
        often[a + pairs[0]] = pairs[1]
    flat = np.concatenate(values)
    order = np.argsort(flat, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
    group = np.diff(np.append(new, len(flat)))
    repeated = np.empty(len(flat), bool)
    repeated[order] = np.repeat((group > 1) | np.logical_or.reduceat(here[order], new), group)
    frequent = np.empty(len(flat), bool)
    frequent[order] = np.repeat(np.add.reduceat(often[order], new) > FREQUENT, group)
    rows = [
        (block, 0, shard, np.packbits(repeated[a : a + n]).tobytes() + np.packbits(frequent[a : a + n]).tobytes())
        for block, shard, a, n in zip(table.column("block").to_pylist(), table.column("shard").to_pylist(), at, sizes, strict=True)
    ]
    return _rows([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int64()), ("payload", pa.binary())], rows)


def _stretches(block: Block, replies: pa.Table, shards: int) -> tuple[list[tuple[int, list[bytes], np.ndarray]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By shard its distinct stretches and their smallest ids; and of each occurrence first window, last window, shard's place in that list, stretch's place in the shard."""
    flags = np.zeros((2, len(block.values)), bool)
    bits = {s: p for s, k, p in zip(*(replies.column(c).to_pylist() for c in ("shard", "kind", "payload")), strict=True) if k == 0}
    for shard, a, b in pieces(shard_of(block.values, shards)):
        if shard in bits:
            both, size = np.frombuffer(bits[shard], np.uint8), (b - a + 7) // 8
            flags[0, a:b], flags[1, a:b] = (np.unpackbits(x, count=b - a) for x in (both[:size], both[size:]))
    chosen = flags[:, block.which] if len(block.which) else np.zeros((2, 0), bool)
    plain, often = np.flatnonzero(chosen[0] & ~chosen[1]), np.flatnonzero(chosen[0] & chosen[1])
    first, last, shard = block.first[plain], block.last[plain], shard_of(block.hash[plain] >> np.uint64(16), shards)
    if len(often):
        counts = block.last[often] - block.first[often] + 1
        single = ragged(block.first[often], counts)
        eight = [words_at(block.data[single[:, None] + np.arange(at, at + 8)].ravel())[::8] for at in (0, 8, 16, 24, 32, 40, 42)]
        h = np.zeros(len(single), np.uint64)
        for word in eight:
            h = mixed(h * _C1 + word)
        first, last, shard = np.concatenate([first, single]), np.concatenate([last, single]), np.concatenate([shard, shard_of(h >> np.uint64(16), shards)])
    by = np.argsort(shard, kind="stable")
    first, last, shard = first[by], last[by], shard[by]
    owner = block.ids[np.searchsorted(block.offsets, first, "right") - 1]
    raw, out, place = block.data.tobytes(), [], np.empty(len(first), np.int64)
    where = np.empty(len(first), np.int64)
    for name, a, b in pieces(shard):
        known: dict[bytes, int] = {}
        where[a:b] = len(out)
        place[a:b] = [known.setdefault(raw[f : g + WIDTH], len(known)) for f, g in zip(first[a:b].tolist(), last[a:b].tolist(), strict=True)]
        least = np.full(len(known), LAST, np.int64)
        np.minimum.at(least, place[a:b], owner[a:b])
        out.append((name, list(known), least))
    return out, first, last, where, place


def _send_stretches(shards: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows and replies.num_rows:
            name = table.column("block")[0].as_py()
            for shard, texts, least in _stretches(Block(table), replies, shards)[0]:
                rows.append((name, shard, b"".join(texts), np.array([len(t) for t in texts], "u1").tobytes(), least.astype("<i8").tobytes()))
        return _rows([("block", pa.int64()), ("shard", pa.int64()), ("payload", pa.binary()), ("sizes", pa.binary()), ("owners", pa.binary())], rows)

    return run


def _answer_stretches(table: pa.Table) -> pa.Table:
    known: dict[bytes, int] = {}
    places, owners = [], []
    for payload, sizes, least in zip(*(table.column(c).to_pylist() for c in ("payload", "sizes", "owners")), strict=True):
        ends = np.cumsum(np.frombuffer(sizes, "u1").astype(np.int64))
        places.append(np.array([known.setdefault(payload[a:b], len(known)) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], np.int64))
        owners.append(np.frombuffer(least, "<i8"))
    least = np.full(len(known), LAST, np.int64)
    np.minimum.at(least, np.concatenate(places), np.concatenate(owners))
    ids, counts = smallest_owner(list(known), least)
    # Runs of equal ids within a stretch: how many, their lengths, their ids.
    ends = np.cumsum(counts)
    new = np.concatenate([[True], ids[1:] != ids[:-1]])
    new[ends - counts] = True
    cut = np.flatnonzero(new)
    length, owner = np.diff(np.append(cut, len(ids))).astype("u1"), ids[cut].astype("<i8")
    first = np.searchsorted(cut, ends - counts)
    many = np.diff(np.append(first, len(cut)))
    rows = []
    for block, shard, place in zip(table.column("block").to_pylist(), table.column("shard").to_pylist(), places, strict=True):
        at = ragged(first[place], many[place])
        rows.append((block, 1, shard, many[place].astype("u1").tobytes() + length[at].tobytes() + owner[at].tobytes()))
    return _rows([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int64()), ("payload", pa.binary())], rows)


def _read_answers(payload: bytes, count: int) -> np.ndarray:
    """The smallest ids of all windows of ``count`` stretches, end to end."""
    runs = int(np.frombuffer(payload, "u1", count).sum(dtype=np.int64))
    return np.repeat(np.frombuffer(payload, "<i8", runs, count + runs), np.frombuffer(payload, "u1", runs, count))


def _cut(shards: int, id_type: pa.DataType):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = [("doc_id", id_type), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", spans_type)]

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(schema, [])
        block = Block(table)
        edge = np.zeros(len(block.data) + 1, np.int32)
        if replies.num_rows:
            found, first, last, where, place = _stretches(block, replies, shards)
            answers = {s: p for s, k, p in zip(*(replies.column(c).to_pylist() for c in ("shard", "kind", "payload")), strict=True) if k == 1}
            doc = np.searchsorted(block.offsets, first, "right") - 1
            for i, (shard, texts, _) in enumerate(found):
                ids = _read_answers(answers[shard], len(texts))
                sizes = np.array([len(t) for t in texts], np.int64) - WIDTH + 1
                a, b = np.searchsorted(where, [i, i + 1])
                counts = last[a:b] - first[a:b] + 1
                least, starts = ids[ragged((np.cumsum(sizes) - sizes)[place[a:b]], counts)], ragged(first[a:b], counts)
                gone = starts[least < np.repeat(block.ids[doc[a:b]], counts)]
                np.add.at(edge, gone, 1)
                np.add.at(edge, gone + WIDTH, -1)
        covered = np.cumsum(edge[:-1], dtype=np.int32) > 0
        rows = []
        for i, (a, b) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist(), strict=True)):
            mine, data = covered[a:b], block.data[a:b]
            spans = []
            if mine.any():
                turn = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                spans = [{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()]
                data = data[~mine]
            rows.append((None if block.null[i] else int(block.ids[i]), b - a, data.tobytes(), spans))
        return _rows(schema, rows)

    return run


def dedup_substrings(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, kept (binary), spans (array of removed [start, end) bytes) for every row. Ids must be integers."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    shards = blocks * SHARDS_A_BLOCK
    rows = docs.select(F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).alias("block"), F.col(key).cast("long").alias("id"), text_bytes(F.col(text)).alias("text"))
    rows = rows.repartition(blocks, "block")
    anchors = rows.groupBy("block").applyInArrow(_send_anchors(shards), _ANCHORS)
    flags = anchors.groupBy("shard").applyInArrow(_answer_anchors, _REPLY)
    stretches = rows.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(_send_stretches(shards), _STRETCHES)
    owners = stretches.groupBy("shard").applyInArrow(_answer_stretches, _REPLY)
    return rows.groupBy("block").cogroup(flags.unionByName(owners).groupBy("block")).applyInArrow(
        _cut(shards, pa.int64()), "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"
    )
