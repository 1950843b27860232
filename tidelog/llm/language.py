"""Language identification by word, backing off to ever shorter character n-grams for words never seen.

A word is a letter with the letters and combining marks after it, lower-cased; numbers of any script are no letters. A known
word adds its smoothed log frequency in each language. An unknown one is padded with ``_`` and scored by its n-grams of the
largest n, from 5 down to 1, of which any is known, each n-gram by its log frequency among the n-grams of that size; a word
without a known letter adds nothing. The language with the largest sum wins, ties going to the smaller name. ``score`` is its
share of the normalised likelihoods. Texts that are null or have no letter get ``und`` and score 0; so do all texts if there
was nothing to learn from. Rows that repeat an id are predicted each; extra columns aren't read; an empty table gives no rows.

The model is fitted on a bounded sample: of each language the labelled documents whose hash of id and text is below a bound
that lets about ``TRAIN_DOCS`` through, in whole; rows that are equal count once. All languages are learned. The model keeps
the ``MAX_WORDS`` and ``MAX_GRAMS`` most frequent entries a language, or fewer where there are so many languages that it
would have more than ``CELLS`` numbers: its broadcast is bounded whatever the corpus.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, held

TRAIN_DOCS = 1_500
MAX_WORDS, MAX_GRAMS, LONGEST, CELLS = 20_000, 20_000, 5, 32_000_000
UNDETERMINED = "und"
_MEMO = 300_000


def _class(wanted: Callable[[str], bool]) -> str:
    """The characters for which ``wanted`` holds, as ranges of a regular expression's class."""
    held = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and wanted(chr(i))]
    starts = [i for n, i in enumerate(held) if not n or held[n - 1] != i - 1]
    ends = [i for n, i in enumerate(held) if n + 1 == len(held) or held[n + 1] != i + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True))


_LETTERS = _class(str.isalpha)
WORD = re.compile(f"[{_LETTERS}][{_LETTERS}{_class(lambda c: unicodedata.category(c)[0] == 'M')}]*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    padded = f"_{word}_" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class LanguageModel:
    """Per-language log frequencies of words and of n-grams of each size."""

    def __init__(self, langs: list[str], words: dict[str, Counter], sizes: dict[int, dict[str, Counter]]):
        self.langs = sorted(langs)
        self._open({0: self._table(words)} | {n: self._table(by) for n, by in sizes.items()})

    @classmethod
    def of(cls, langs: list[str], tables: dict[int, tuple[list[str], np.ndarray]]) -> LanguageModel:
        """A model from what ``langs`` and ``tables`` of another hold; those travel as plain arrays."""
        made = cls.__new__(cls)
        made.langs = langs
        made._open(tables)
        return made

    def _open(self, tables: dict[int, tuple[list[str], np.ndarray]]) -> None:
        self.tables = tables
        self.grams = {n: dict(zip(entries, logs, strict=True)) for n, (entries, logs) in tables.items()}
        self.words = self.grams.pop(0)
        self.memo: dict[str, np.ndarray | None] = {}

    def _table(self, by: dict[str, Counter]) -> tuple[list[str], np.ndarray]:
        entries = sorted({e for lang in self.langs for e in by.get(lang, ())})
        counts = np.asarray([[by.get(lang, {}).get(e, 0) for e in entries] for lang in self.langs], float).reshape(len(self.langs), len(entries))
        logs = np.log(counts + 0.5) - np.log(counts.sum(1, keepdims=True) + 0.5 * max(1, len(entries)))
        return entries, logs.T.astype(np.float32).copy()

    def word(self, word: str) -> np.ndarray | None:
        if (found := self.words.get(word)) is not None:
            return found
        if word in self.memo:
            return self.memo[word]
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            if known := [v for g in grams(word, n) if (v := self.grams[n].get(g)) is not None]:
                found = np.sum(known, 0)
                break
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        self.memo[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text or ""))
        if not counts or not self.langs:
            return UNDETERMINED, 0.0
        rows = [(v, n) for w, n in counts.items() if (v := self.word(w)) is not None]
        total = np.asarray([n for _, n in rows], float) @ np.asarray([v for v, _ in rows]) if rows else np.zeros(len(self.langs))
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.langs[best], float(share[best] / share.sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Fit on the bounded sample; counting runs on the executors, the pruned counts come to the driver."""
    spark = docs.sparkSession
    named = docs.select(F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("t")).where("lang is not null and t is not null")
    found = {r["lang"]: r["n"] for r in docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    langs = sorted(found)
    most = min(MAX_WORDS, CELLS // (6 * max(1, len(langs)) ** 2))
    # A bound of the hash a language, so that nothing has to be ranked: no language's rows meet in one task.
    shares = spark.createDataFrame([(name, 2.0**64 * min(1.0, TRAIN_DOCS / n) - 2.0**63) for name, n in found.items()], "lang string, low double")
    sample = named.join(F.broadcast(shares), "lang").where(F.col("h").cast("double") <= F.col("low")).select("lang", "t").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.update((name, w) for w in words_of(value))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found]), pa.array([k[1] for k in found]), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    counts = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    words: dict[str, Counter] = {name: Counter() for name in langs}
    for row in counts.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= most).select("lang", "word", "n").collect():
        words[row.lang][row.word] = row.n
    sizes: dict[int, dict[str, Counter]] = {n: {} for n in range(1, LONGEST + 1)}
    for name, found in words.items():
        for n in sizes:
            by: Counter = Counter()
            for word, times in found.items():
                for g in grams(word, n):
                    by[g] += times
            sizes[n][name] = Counter(dict(sorted(by.items(), key=lambda e: (-e[1], e[0]))[: min(MAX_GRAMS, most)]))
    return LanguageModel(langs, words, sizes)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred and score for every row, from whole texts, in one narrow pass."""
    shared, name, hidden = docs.sparkSession.sparkContext.broadcast((model.langs, model.tables)), f"language {uuid.uuid4().hex}", fresh(docs, "language_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = held(name, lambda: LanguageModel.of(*shared.value))
        for batch in batches:
            found = [mine.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*keep, "lang_pred", "score"])

    fields = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keep)
    return docs.select(*keep, F.col(text).alias(hidden)).mapInArrow(run, fields + "lang_pred string, score double")
