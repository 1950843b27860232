"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

``build_index`` reads the training texts once and stores the postings (term, row, pos) of every token, whatever the benchmark,
partitioned by documents: each file is an inverted index of its own documents, its postings in the order of the terms'
hashes, so that a term's list is contiguous and a look-up skips row groups that don't have the term. Nothing is shuffled.

``lists_of`` reads the benchmark's terms' lists from it and counts them, ``find_phrases`` orders each window's terms by that, rarest first. The lists
of the rarest terms, each moved back by its term's place, give the alignments of windows with documents; these are intersected
with the list of the second rarest term, likewise moved, and what is left with those of all other terms. Frequent terms' lists
are therefore read only where an alignment needs them. ``find_near`` answers proximity queries for any two terms,
``near_items`` whether an item's two rarest terms come near each other.

A window is ``width`` consecutive words of an item; an item with fewer words, but not none, is one window. Words are taken
from the text with A-Z lower-cased; a null text has none. Items that repeat an id count once, with all their texts; a null id
is ''. Rows that repeat an id are told apart. Empty tables have no hits. Extra columns are not read, or kept by
``drop_contaminated`` whatever their names. A side of a join is broadcast if it was counted and has BROADCAST_ROWS at most;
beyond that, terms are salted by documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, passing, text_bytes, written

# All of ASCII but digits and small letters parts words, once capitals are lower-cased; NUL is replaced beforehand.
_PARTS = "".join(chr(i) for i in range(1, 128) if not chr(i).isalnum())
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WIDTH, NEAR = 10, 10
BROADCAST_ROWS, SALTS = 200_000, 64


def words(text: Column) -> Column:
    """In one walk over the characters and a split at spaces, which takes a fifth of a regular expression's time."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("\0"), F.lit(" "))
    spaced = F.translate(plain, _CAPITALS + _PARTS, _CAPITALS.lower() + " " * len(_PARTS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def item_words(items: DataFrame, text: str = "text", key: str = "item_id", width: int = WIDTH) -> DataFrame:
    """item (id as string), words, and how many make a window, for items that have words."""
    table = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("words"))
    return table.where(F.size("words") > 0).distinct().withColumn("need", F.least(F.size("words"), F.lit(width)))


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents: row, doc_id, mark, words; postings: term, row, pos), both stored in the shared folder."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.md5(text_bytes(F.col(text))).alias("mark"), words(F.col(text)).alias("words"))
    held = written(rows, "words")
    postings = held.select("row", F.posexplode("words").alias("pos", "term")).select("term", "row", "pos")
    return held, written(postings.sortWithinPartitions(F.xxhash64("term")), "postings")


def _few(frame: DataFrame) -> bool:
    return frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _by_term(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """Postings joined with ``asked`` on the term. A frequent term's list is dealt over SALTS tasks where ``asked`` is too large to be broadcast."""
    if _few(asked):
        return postings.join(F.broadcast(asked), "term")
    salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return postings.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"]).drop("salt")


def _intersected(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (row, pos, term and others) that have a posting."""
    terms, rows = written(wanted.select("term").distinct(), "terms"), written(wanted.select("row").distinct(), "rows")
    some = postings
    for column, found in (("term", terms), ("row", rows)):
        if _few(found):  # otherwise the join below sees all postings
            some = some.join(F.broadcast(found), column, "left_semi")
    return wanted.join(some, ["row", "pos", "term"], "left_semi")


def lists_of(postings: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the posting lists of the items' terms, read from the index once; term, n: how many postings each has, if any)."""
    terms = written(items.select(F.explode("words").alias("term")).distinct(), "terms")
    lists = written(postings.join(F.broadcast(terms) if _few(terms) else terms, "term", "left_semi"), "lists")
    return lists, written(lists.groupBy("term").agg(F.count("*").alias("n")), "counts")


def _windows(items: DataFrame, counts: DataFrame) -> DataFrame:
    """window, item, start, need, terms (n, term, place; rarest first): the windows of which every term has postings."""
    placed = items.select("item", "words", "need", F.posexplode("words").alias("place", "term")).join(counts, "term", "left")
    first, last = F.greatest(F.lit(0), F.col("place") - F.col("need") + 1), F.least(F.col("place"), F.size("words") - F.col("need"))
    starts = placed.select("item", "words", "need", F.explode(F.sequence(first, last)).alias("start"), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "place").alias("one"))
    listed = starts.groupBy("item", "words", "start", "need").agg(F.sort_array(F.collect_list("one")).alias("terms")).where("terms[0].n > 0")
    return written(listed.select(F.monotonically_increasing_id().alias("window"), "item", "start", "need", "terms"), "windows")


def find_phrases(postings: DataFrame, items: DataFrame, width: int = WIDTH, read: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """row, ranges (array of [first, last] word positions within occurrences), items (sorted ids): documents with an occurrence of a window."""
    postings, counts = read or lists_of(postings, items)
    windows = _windows(items, counts)
    known = F.broadcast(windows) if _few(windows) else windows
    rarest = windows.select("window", "need", F.get("terms", F.lit(0))["term"].alias("term"), F.get("terms", F.lit(0))["place"].alias("place"))
    # `base` is where the item would begin in the document.
    aligned = written(_by_term(postings, rarest).select("window", "need", "row", (F.col("pos") - F.col("place")).alias("base")), "aligned")
    at = lambda term: (term["term"].alias("term"), (F.col("base") + term["place"]).alias("pos"))
    second = aligned.where("need > 1").join(known.select("window", "terms"), "window").select("window", "need", "row", "base", *at(F.get("terms", F.lit(1))))
    two = written(_intersected(postings, second).select("window", "need", "row", "base"), "aligned")
    others = two.where("need > 2").join(known.select("window", "terms"), "window").select("window", "need", "row", "base", F.explode(F.slice("terms", 3, width)).alias("one"))
    rest = _intersected(postings, others.select("window", "need", "row", "base", *at(F.col("one"))))
    whole = rest.groupBy("window", "need", "row", "base").agg(F.count("*").alias("n")).where("n = need - 2").select("window", "need", "row", "base")
    every = whole.unionByName(two.where("need = 2")).unionByName(aligned.where("need = 1")).join(known.select("window", "item", "start"), "window")
    found = every.select("row", "item", F.struct((F.col("base") + F.col("start")).alias("first"), (F.col("base") + F.col("start") + F.col("need") - 1).alias("last")).alias("range"))
    return found.groupBy("row").agg(F.sort_array(F.collect_set("range")).alias("ranges"), F.sort_array(F.collect_set("item")).alias("items"))


def _close(left: DataFrame, right: DataFrame, on: list[str], within: int) -> DataFrame:
    """Rows of ``left`` (with pos) and ``right`` (with other) at most ``within`` words apart: in the same block of words or one beside it."""
    block = lambda c: F.floor(F.col(c) / (within + 1))
    dealt = left.withColumn("block", F.explode(F.array(block("pos") - 1, block("pos"), block("pos") + 1)))
    return dealt.join(right.withColumn("block", block("other")), [*on, "block"]).where((F.abs(F.col("pos") - F.col("other")) <= within) & (F.col("pos") != F.col("other"))).drop("block")


def find_near(held: DataFrame, postings: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """doc_id, pos, other: every pair of postings of two terms at most ``within`` words apart."""
    a = postings.where(F.col("term") == first).select("row", "pos")
    b = postings.where(F.col("term") == second).select("row", F.col("pos").alias("other"))
    return _close(a, b, ["row"], within).join(held.select("row", "doc_id"), "row").select("doc_id", "pos", "other")


def near_items(postings: DataFrame, counts: DataFrame, items: DataFrame, within: int = NEAR) -> DataFrame:
    """row, n_near: how many items have their two rarest terms (ties: the smaller) at most ``within`` words apart in a document. Items of one term have none."""
    terms = items.select("item", F.explode("words").alias("term")).distinct().join(counts, "term")
    two = terms.groupBy("item").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "term"))), 1, 2).alias("two")).where("size(two) = 2")
    both = written(_by_term(postings, two.select("item", F.posexplode("two").alias("side", "one")).select("item", "side", "one.term")), "rarest")
    side = lambda n, c: both.where(F.col("side") == n).select("row", "item", F.col("pos").alias(c))
    found = _close(side(0, "pos"), side(1, "other"), ["row", "item"], within)
    return found.groupBy("row").agg(F.count_distinct("item").alias("n_near"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", width: int = WIDTH) -> DataFrame:
    """doc_id, mark, n_words, n_hit, ranges, items, n_near for every row of ``docs``."""
    items = written(item_words(benchmark, item_text, item_key, width), "items")
    held, postings = build_index(docs, text, key)
    read = lists_of(postings, items)
    found = written(find_phrases(postings, items, width, read), "found")
    covered = F.aggregate(
        "ranges",
        F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n")),
        lambda acc, r: F.struct(F.greatest(acc["end"], r["last"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), r["last"] - F.greatest(acc["end"], r["first"] - 1))).alias("n")),
        lambda acc: acc["n"],
    )
    joined = held.select("row", "doc_id", "mark", F.size("words").alias("n_words")).join(found, "row", "left").join(near_items(*read, items), "row", "left")
    return joined.select(
        "doc_id", "mark", F.col("n_words").cast("long").alias("n_words"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"), "ranges",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs``, all columns, less the rows with a hit. A row is known by its id and text, so rows without an id are judged too, and a clean row that shares another's id stays."""
    id_name, mark_name = fresh(docs, "bad_id"), fresh(docs, "bad_mark")
    with passing(docs.sparkSession) as kept:
        items = written(item_words(benchmark), "items")
        held, postings = build_index(docs, text, key)
        found = find_phrases(postings, items)
        bad = kept(held.select("row", F.col("doc_id").alias(id_name), F.col("mark").alias(mark_name)).join(found.select("row"), "row", "left_semi").select(id_name, mark_name).distinct(), "contaminated")
    return docs.join(bad, docs[key].eqNullSafe(bad[id_name]) & (F.md5(text_bytes(docs[text])) == bad[mark_name]), "left_anti")
