"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Token weights are added up by cell (source, language, topic). The sample is to have ``rate`` of all tokens, with the target
shares of every source, language and topic. A target is given, or else the natural share to the power ``TEMPERATURE``,
normalised, so that small ones get more than their share; but no more than all of their documents give at that rate: what
is above that goes to the others in proportion, so that the targets can be met. Raking multiplies the cells' weights so that one
marginal after the other fits, ``ROUNDS`` times. No cell's weight may exceed its tokens / rate: a cell that reaches that is kept
whole, and the next rounds find what it lacks in other cells of the same marginal. A document is then kept with the
calibrated probability rate * weight / tokens of its cell, which is 1 at most, decided by a hash of its id: the same on every
run and every executor, and copies of an id stay or go together. ``marginals`` says what the sample is expected to get beside
what it should: given targets may ask for more than there is, and are then met as far as there is.

Topics are given: names with words, of which a text has the first whose words it contains (``TOPICS`` by default, a fixed list
for the test corpus), else ``prose``. Null sources and languages are the category ''. A null text has no tokens. Cells without
tokens carry no weight and are sampled at the plain rate. Rows that repeat an id are weighed each; extra columns are kept by
``sample_documents`` whatever their names; empty tables give no rows. Cells are few against documents; up to ``ONE_TASK`` of
them are raked without shuffles, more by the same plan over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, written

DIMENSIONS = ("source", "lang", "topic")
TEMPERATURE, ROUNDS, RATE, ONE_TASK = 0.5, 16, 0.5, 200_000
TOKEN = r"[^ \t\n\r]+"
# Words that name a topic, in order of precedence; first letters are left out so that case doesn't matter.
TOPICS = (("legal", ("icense", "opyright", "arranty")), ("access", ("assword", "ecret", "oken")), ("contact", ("@", "+1-")), ("listing", (" | ", "!!")))


Topics = tuple[tuple[str, tuple[str, ...]], ...]


def topic_of(text: Column, topics: Topics = TOPICS) -> Column:
    """The first topic of which the whole text has a word, else ``prose``."""
    found = F.lit("prose")
    for name, needles in reversed(topics):
        has = F.lit(False)
        for needle in needles:
            has = has | F.contains(text, F.lit(needle))
        found = F.when(has, F.lit(name)).otherwise(found)
    return found


def weighed(docs: DataFrame, text: str = "text", topics: Topics = TOPICS) -> tuple[Column, Column]:
    """(topic, tokens) of a row."""
    value = F.coalesce(F.col(text), F.lit(""))
    return topic_of(value, topics), F.regexp_count(value, F.lit(TOKEN)).cast("long")


def tempered(cells: DataFrame, name: str, rate: float) -> DataFrame:
    """value, share: the tempered natural shares of a dimension, none above natural share / rate, adding up to 1.

    The level at which the uncapped ones stand follows from how many of the smallest are capped; one pass over the values in
    ascending order tells. A dimension has few values, far fewer than there are cells."""
    mass = cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("mass")).where("mass > 0")
    total = Window.partitionBy(F.lit(1))
    some = mass.withColumn("high", F.col("mass") / (F.sum("mass").over(total) * F.lit(rate))).withColumn("part", F.pow(F.col("mass").cast("double"), F.lit(TEMPERATURE)))
    below = Window.partitionBy(F.lit(1)).orderBy("mass").rangeBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy(F.lit(1)).orderBy("mass").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(1.0) - F.coalesce(F.sum("high").over(below), F.lit(0.0))) / F.sum("part").over(rest)
    levels = some.withColumn("level", level).withColumn("fits", F.col("level") * F.col("part") <= F.col("high"))
    reached = F.min(F.when(F.col("fits"), F.struct("mass", "level"))).over(total)["level"]
    return levels.withColumn("reached", reached).select("value", F.when(F.col("reached").isNull(), F.col("high")).otherwise(F.least("high", F.col("reached") * F.col("part"))).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, rate: float = RATE) -> DataFrame:
    """``cells`` (the dimensions, tokens) with ``weight``: raked so that each marginal's sums are its targets' shares of all tokens, each at most tokens / rate.

    ``targets`` may give for a dimension a table (value, share); dimensions without one use their tempered natural shares."""
    few = cells.count() <= ONE_TASK
    narrow = lambda t: t.coalesce(1) if few else t
    table = narrow(cells).withColumn("weight", F.col("tokens").cast("double"))
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    for name in DIMENSIONS:
        found = (targets or {}).get(name)
        found = written(narrow(tempered(cells, name, rate)), "targets") if found is None else found
        wanted = found.select(F.col("value").alias(name), F.col("share").cast("double").alias(f"want_{name}"))
        table = table.join(F.broadcast(wanted) if few else wanted, name, "left").fillna(0.0, [f"want_{name}"])
    for n in range(rounds):
        if n % 4 == 0:  # a short plan each time
            table = narrow(written(table, "cells"))
        for name in DIMENSIONS:
            held = F.sum("weight").over(Window.partitionBy(name))
            fitted = F.least(F.col("tokens") / F.lit(rate), F.col("weight") * (F.col(f"want_{name}") * F.lit(total) / held))
            table = table.withColumn("weight", F.when(held > 0, fitted).otherwise(0.0))
    return table.select(*DIMENSIONS, "tokens", "weight", *(f"want_{d}" for d in DIMENSIONS))


def marginals(raked: DataFrame) -> DataFrame:
    """dimension, value, natural, wanted and expected share of tokens."""
    tables = []
    for d in DIMENSIONS:
        sums = raked.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("value")).agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w"), F.max(f"want_{d}").alias("wanted"))
        every = Window.partitionBy("dimension")
        tables.append(sums.select("dimension", "value", (F.col("t") / F.sum("t").over(every)).alias("natural"), "wanted", (F.col("w") / F.sum("w").over(every)).alias("expected")))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def uniform(key: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_rates(docs: DataFrame, text: str = "text", rate: float = RATE, targets: dict[str, DataFrame] | None = None, keep: tuple[str, ...] = ("doc_id",), topics: Topics = TOPICS) -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` of every row with its source, lang, topic, tokens and probability, and the names that these have there."""
    names = {c: fresh(docs, f"mix_{c}") for c in (*DIMENSIONS, "tokens", "probability")}
    topic, tokens = weighed(docs, text, topics)
    named = docs.select(*(docs[c] for c in keep), *(F.coalesce(F.col(c), F.lit("")).alias(names[c]) for c in DIMENSIONS[:2]), topic.alias(names["topic"]), tokens.alias(names["tokens"]))
    cells = written(named.groupBy(*(F.col(names[c]).alias(c) for c in DIMENSIONS)).agg(F.sum(names["tokens"]).alias("tokens")), "cells")
    raked = written(rake(cells, targets, rate=rate), "raked")
    factor = F.coalesce(F.col("weight") / F.when(F.col("tokens") > 0, F.col("tokens")), F.lit(1.0))
    rates = raked.select(*(F.col(c).alias(names[c]) for c in DIMENSIONS), F.least(F.lit(1.0), F.lit(rate) * factor).alias(names["probability"]))
    return named.join(F.broadcast(rates) if raked.count() <= ONE_TASK else rates, [names[c] for c in DIMENSIONS]), names


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", rate: float = RATE, targets: dict[str, DataFrame] | None = None, topics: Topics = TOPICS) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, sampled for every row."""
    found, names = with_rates(docs, text, rate, targets, (key,), topics)
    p = F.col(names["probability"])
    return found.select(F.col(key).alias("doc_id"), *(F.col(names[c]).alias(c) for c in DIMENSIONS), F.col(names["tokens"]).alias("n_tokens"), p.alias("probability"), (uniform(F.col(key)) < p).alias("sampled"))


def sample_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", rate: float = RATE, targets: dict[str, DataFrame] | None = None, topics: Topics = TOPICS) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns."""
    found, names = with_rates(docs, text, rate, targets, tuple(docs.columns), topics)
    return found.where(uniform(F.col(key)) < F.col(names["probability"])).select(*docs.columns)
