"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of ``documents``; the last writes the
kept documents' token ids as ORC and returns their index. Rows keep their columns whatever these are called beside doc_id,
text, lang and source; null texts are empty documents. Nothing is read in part: a stage works on all its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontaminate, mixing, near_copies, tokens_orc, toxicity
from tidelog.llm.common import table, written
from tidelog.llm.queries import tokenizer_path

# The pipeline keeps most of what is clean: only cells that are far over their target lose much.
RATE = 0.9


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more, by MinHash bands and prefixes) the smallest id stays."""
    return near_copies.keep_representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an occurrence of a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay with the probability that their source, language and topic are given."""
    return mixing.sample_documents(docs, rate=RATE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' ids in ORC; doc_id, start, n_tokens, ids_crc32 from the files."""
    return tokens_orc.encode_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mixed),
    ("tokens", tokens),
]

# The classifier, the fingerprints' hash and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), "pipeline-tokens")
