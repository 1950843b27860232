"""Toxicity by a classifier chain: each category's linear model also reads the probabilities of the categories before it.

The categories are the columns of the label table in the order of ``CHAIN``. A model is a ridge-penalised logistic
regression (Newton steps) over the counts (their logarithms) of up to ``WORDS`` words and word beginnings of ``STEMS`` letters,
the most telling by a signed root of chi-square, and a few numbers about the text's form. Beginnings are marked by a hyphen:
inflected and compound words that are too rare to be features tell by their stem. While training, an earlier category's probability comes from models that didn't see the
document (``FOLDS`` folds), so that a later model doesn't trust it more than it deserves; at prediction from the full model.
The threshold is where the last category's probabilities from those folds have the best F1 (``THRESHOLD`` without both labels).

It is fitted on a bounded sample of labelled documents, ``SAMPLE`` of each combination of labels at most (those with the
smallest hash of the id), weighted back to the combinations' true sizes. Fitting is one executor task over that sample; the
model that comes back has a few thousand numbers. Null texts are empty. Labels that are null are left out of their category;
a category without both labels in the sample has its share as probability everywhere; without labels at all it is 0. Of rows
that repeat a label's id the smallest labels count; of documents that repeat an id the smallest text is trained on, and all are
judged. Ids may be of any type; documents and labels without an id are judged, not trained on. Extra columns aren't read, and
kept by ``drop_toxic``. Empty tables give no rows.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from math import log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))  # category, label column, the value that counts
SAMPLE, FOLDS, WORDS, LEAST_DOCS, RIDGE, STEPS = 1_500, 5, 1_000, 3, 1.0, 8
MARGIN = 1.25
THRESHOLD = 0.5
FORM = 5
STEMS, SEEN = (3, 4, 5, 6, 7), 200_000
WORD = re.compile(r"[^\W\d_]+")


def form(text: str, words: list[str], distinct: int) -> list[float]:
    """Numbers about a text's form, each about 0 to 1."""
    n, letters = max(1, len(text)), max(1, sum(map(len, words)))
    return [distinct / max(1, len(words)), sum(w.isupper() for w in words) / max(1, len(words)), 1 - letters / n, min(1.0, letters / max(1, len(words)) / 20), text.count("!") / n]


def stems(word: str) -> list[str]:
    """A word's features: itself and its beginnings."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) >= n)]


def read(text: str | None) -> tuple[Counter, list[float]]:
    """(how often each lower-case word occurs, the form)."""
    words = WORD.findall(text or "")
    return Counter(map(str.lower, words)), form(text or "", words, len(set(words)))


class Counts:
    """Labelled texts' features as flat arrays: text, feature and the logarithm of its count; features of LEAST_DOCS texts at least."""

    def __init__(self, texts: list[str | None]):
        place: dict[str, int] = {}
        rows, columns, values, numbers = [], [], [], []
        for i, text in enumerate(texts):
            words, shape = read(text)
            found: dict[int, int] = {}
            for w, n in words.items():
                for feature in stems(w):
                    at = place.setdefault(feature, len(place))
                    found[at] = found.get(at, 0) + n
            rows.append(np.full(len(found), i, np.int32))
            columns.append(np.fromiter(found.keys(), np.int32, len(found)))
            values.append(np.log2(1 + np.fromiter(found.values(), np.float64, len(found))))
            numbers.append(shape)
        none = np.empty(0, np.int32)
        row, column, value = np.concatenate([none, *rows]), np.concatenate([none, *columns]), np.concatenate([np.empty(0), *values])
        often = np.bincount(column, minlength=len(place)) >= LEAST_DOCS
        kept = often[column]
        self.words = np.asarray(list(place), object)[often]
        self.row, self.value = row[kept], value[kept]
        self.column = (np.cumsum(often) - 1)[column[kept]]
        self.numbers = np.asarray(numbers).reshape(len(texts), FORM)

    def matrix(self, chosen: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """A column for each feature of ``chosen``, the numbers, and ones, for every text."""
        x = np.zeros((len(numbers), len(chosen) + numbers.shape[1] + 1))
        to = np.full(len(self.words), -1)
        to[chosen] = np.arange(len(chosen))
        kept = to[self.column] >= 0
        x[self.row[kept], to[self.column[kept]]] = self.value[kept]
        x[:, len(chosen) : -1] = numbers
        x[:, -1] = 1
        return x

    def telling(self, use: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The most telling features of the texts ``use``."""
        mine = use[self.row]
        row, column, n_all = self.row[mine], self.column[mine], len(self.words)
        docs, n = np.bincount(column, minlength=n_all), np.bincount(column, weight[row], n_all)
        k = np.bincount(column, weight[row] * y[row], n_all)
        share = (weight * y)[use].sum() / weight[use].sum()
        fits = np.flatnonzero((docs >= LEAST_DOCS) & (n > 0))
        score = np.abs(k - n * share)[fits] / np.sqrt(n[fits] * share * (1 - share))
        names = self.words[fits]
        best = sorted(np.argsort(-score, kind="stable")[: 4 * WORDS].tolist(), key=lambda i: (-score[i], names[i]))[:WORDS]
        return fits[sorted(best, key=lambda i: names[i])]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Words, their weights, the weights of the numbers and of the earlier categories, the constant."""

    def __init__(self, words: list[str], weights: np.ndarray):
        self.words, self.weights = words, weights
        self.weight_of = dict(zip(words, weights.tolist(), strict=False))  # the numbers' weights follow

    @classmethod
    def fit(cls, table: Counts, numbers: np.ndarray, use: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[Linear, np.ndarray]:
        """The model of the texts ``use`` (flags), and its probabilities for all texts."""
        total, hits = weight[use].sum(), (weight * y)[use].sum()
        if not total or not hits or hits == total:
            share = min(max(hits / total if total else 0.0, 1e-9), 1 - 1e-9)
            return cls([], np.append(np.zeros(numbers.shape[1]), np.log(share / (1 - share)))), np.full(len(numbers), share)
        chosen = table.telling(use, y, weight)
        every = table.matrix(chosen, numbers)
        x, y, weight = every[use], y[use], weight[use]
        b = np.zeros(x.shape[1])
        b[-1] = np.log(hits / (total - hits))
        penalty = np.full(x.shape[1], RIDGE)
        penalty[len(chosen) : -1], penalty[-1] = 0.05, 1e-6
        for _ in range(STEPS):
            p = sigmoid(x @ b)
            curve = weight * p * (1 - p)
            b = b - np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (p - y)) + penalty * b)
        return cls(table.words[chosen].tolist(), b), sigmoid(every @ b)


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Where probabilities of texts that weren't trained on have the best F1: midway to the next lower probability."""
    hits = float((weight * y).sum())
    if not hits or hits == weight.sum():
        return THRESHOLD
    order = np.argsort(-p, kind="stable")
    ranked, caught = p[order], np.cumsum((weight * y)[order])
    f1 = np.where(np.append(ranked[:-1] > ranked[1:], True), 2 * caught / (np.cumsum(weight[order]) + hits), 0)
    at = int(np.argmax(f1))
    return float((ranked[at] + (ranked[at + 1] if at + 1 < len(ranked) else 0.0)) / 2)


class Chain:
    """The categories' models in order."""

    def __init__(self, names: list[str], models: list[Linear], threshold: float = THRESHOLD):
        self.names, self.models, self.threshold = names, models, threshold
        self.known = {w for m in models for w in m.words}
        self.seen: dict[str, list[str]] = {}

    def to_json(self) -> str:
        return json.dumps([self.threshold, [[n, m.words, m.weights.tolist()] for n, m in zip(self.names, self.models, strict=True)]])

    @classmethod
    def of_json(cls, text: str) -> Chain:
        threshold, rows = json.loads(text)
        return cls([r[0] for r in rows], [Linear(r[1], np.asarray(r[2])) for r in rows], threshold)

    def found(self, words: Counter) -> dict[str, int]:
        """The models' features of a text and how often they occur."""
        out: dict[str, int] = {}
        for w, n in words.items():
            some = self.seen.get(w)
            if some is None:
                if len(self.seen) >= SEEN:
                    self.seen.clear()
                some = self.seen[w] = [f for f in stems(w) if f in self.known]
            for f in some:
                out[f] = out.get(f, 0) + n
        return out

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """A column a category."""
        told = [read(t) for t in texts]
        found, numbers = [self.found(t[0]) for t in told], np.asarray([t[1] for t in told]).reshape(len(texts), FORM)
        for model in self.models:
            sums = numbers @ model.weights[len(model.words) : -1] + model.weights[-1]
            for i, features in enumerate(found):
                sums[i] += sum(model.weight_of[f] * log2(1 + n) for f, n in features.items() if f in model.weight_of)
            numbers = np.column_stack([numbers, sigmoid(sums)])
        return numbers[:, numbers.shape[1] - len(self.models) :]

    @classmethod
    def fit(cls, texts: list[str | None], labels: dict[str, np.ndarray], weight: np.ndarray) -> Chain:
        """``labels``: by category 0, 1 or nan."""
        table = Counts(texts)
        numbers, fold, models, threshold = table.numbers, np.arange(len(texts)) % FOLDS, [], THRESHOLD
        for y in labels.values():
            known, filled = ~np.isnan(y), np.nan_to_num(y)
            models.append(Linear.fit(table, numbers, known, filled, weight)[0])
            out = np.zeros(len(texts))
            for f in range(FOLDS):
                if (fold == f).any():
                    out[fold == f] = Linear.fit(table, numbers, known & (fold != f), filled, weight)[1][fold == f]
            threshold = best_threshold(out[known], y[known], weight[known])
            numbers = np.column_stack([numbers, out])
        return cls(list(labels), models, threshold)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Chain:
    columns = [c for _, c, _ in CHAIN]
    keys = [f"y{i}" for i in range(len(columns))]
    named = labels.select(F.col(key).alias("id"), F.struct(*(F.col(c).alias(k) for k, c in zip(keys, columns, strict=True))).alias("y")).where("id is not null")
    named = named.groupBy("id").agg(F.min("y").alias("y")).select("id", "y.*", F.xxhash64("id").alias("h"))
    sizes_by = {tuple(r[k] for k in keys): r["count"] for r in named.groupBy(*keys).count().collect()}
    # Ids below a bound of the hash: about MARGIN * SAMPLE of each combination, found without ranking; fit() keeps the SAMPLE smallest.
    low = F.lit(False)
    for combination, n in sizes_by.items():
        mine = F.lit(True)
        for k, value in zip(keys, combination, strict=True):
            mine &= F.col(k).eqNullSafe(F.lit(value))
        low |= mine & (F.col("h").cast("double") <= 2.0**64 * min(1.0, MARGIN * SAMPLE / n) - 2.0**63)
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(named.where(low)), "id")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["id"] not in rows or (row["text"] or "") < (rows[row["id"]][0] or ""):
                    rows[row["id"]] = (row["text"], *(row[k] for k in keys), row["h"])
        room: dict[tuple, int] = {}
        for i in sorted(rows, key=lambda i: (rows[i][-1], i)):
            labelled = rows[i][1:-1]
            room[labelled] = room.get(labelled, 0) + 1
            rows[i] = rows[i][:-1] if room[labelled] <= SAMPLE else None
        ordered = [rows[i] for i in sorted(rows, key=lambda i: ((i if isinstance(i, int) else crc32(str(i).encode())) * 2654435761 % (1 << 32), i)) if rows[i]]
        taken: dict[tuple, int] = {}
        for r in ordered:
            taken[r[1:]] = taken.get(r[1:], 0) + 1
        weight = np.asarray([sizes_by[r[1:]] / taken[r[1:]] for r in ordered])
        weight = weight / weight.mean() if len(weight) else weight
        y = {name: np.asarray([np.nan if r[1 + i] is None else float(r[1 + i] == value) for r in ordered]) for i, (name, _, value) in enumerate(CHAIN)}
        yield pa.RecordBatch.from_arrays([pa.array([Chain.fit([r[0] for r in ordered], y, weight).to_json()])], ["model"])

    # Repartitioned, not coalesced: only the sample goes to one task, the documents are read by many.
    found = sample.repartition(1).mapInArrow(lean(fit), "model string").first()
    return Chain.of_json(found[0]) if found else Chain.fit([], {name: np.empty(0) for name, _, _ in CHAIN}, np.empty(0))


def predict(docs: DataFrame, chain: Chain, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, p_<category> for each, and toxic (the last category's probability reaches the chain's threshold), for every row."""
    model, names = docs.sparkSession.sparkContext.broadcast(chain.to_json()), [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Chain.of_json(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                p = mine.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in p.T), pa.array(p[:, -1] >= mine.threshold)], ["doc_id", *names, "toxic"])

    fields = ", ".join(f"{n} double" for n in names)
    return docs.select(F.col(key).alias("doc_id"), text).mapInArrow(lean(run), f"doc_id {docs.schema[key].dataType.simpleString()}, {fields}, toxic boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that aren't judged toxic, all columns, in one narrow pass."""
    chain = train(docs, labels, text, key)
    model, place = docs.sparkSession.sparkContext.broadcast(chain.to_json()), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Chain.of_json(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield part.filter(pa.array(mine.predict(part.column(place).to_pylist())[:, -1] < mine.threshold))

    return docs.mapInArrow(lean(run), docs.schema)
