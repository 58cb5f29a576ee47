"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

A word is its lower-case letters and its form (case pattern and punctuation). Each of the hashed rows of words and forms has a
sparse random index vector; the word vector of a row is the sum of the index vectors of the two neighbours on each side, over the
sample, scaled to length one. A document is described by the mean of its word vectors, the largest and smallest means of
its stretches of 64 words in each dimension, and five numbers: length, share of distinct words, of words that repeat the one before,
over the text and in the worst stretch, and the length of the mean. The network has one hidden layer of tanh units; a fifth of
the sample is kept from the fit to choose the temperature that calibrates its probabilities.

The fit uses at most ``sample`` labelled documents, chosen by a hash of doc_id among all that may be learned from; scoring reads every
whole text in one pass without a shuffle. What travels to the tasks is the table of vectors and the network, of a size that no
table changes (WORDS + FORMS rows).

Defined results: null text is an empty text, which has a score too; a null label is no label; several labels of one doc_id
count as one by their mean, 1 from a half up; a null doc_id has no label and is not held out; of several
rows of one doc_id the smallest text is learned from; without any label every score is
0.5; repeated rows are scored each; other columns pass through in the struct ``row``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.runtime import hold, ship, stored

SAMPLE, FOLDS, HELD_OUT = 10_000, 4, 2
WORDS, FORMS, DIMENSIONS, ONES, REACH, STRETCH = 1 << 15, 1 << 12, 32, 4, 2, 64
HIDDEN, EPOCHS, RATE, DECAY, BATCH = 32, 40, 3e-3, 1e-4, 128
#: Distinct words that a Python worker keeps.
KEPT = 200_000
#: Rows of a table of vectors that travel together.
SLAB = 2048

def form(word: str) -> str:
    """Case pattern with punctuation: ``THE!!`` is ``A!!``, ``Theded.`` is ``Aa.``"""
    out, last = [], ""
    for c in word:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if kind != last or kind not in "Aa0":
            out.append(kind)
        last = kind
    return "".join(out)


class _Rows(dict):
    """A word's two rows, packed into one number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        core = "".join(filter(str.isalpha, word)).lower()
        out = self[word] = zlib.crc32(core.encode()) % WORDS * FORMS + zlib.crc32(form(word).encode()) % FORMS
        return out


_ROWS = _Rows()


def _begin() -> None:
    hold("quality", _ROWS.clear)


def rows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The word row and the form row of each word; form rows follow the word rows."""
    words = text.split()
    packed = np.fromiter(map(_ROWS.__getitem__, words), np.int64, len(words))
    return packed // FORMS, packed % FORMS + WORDS


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors, half of their ones negative, the same everywhere."""
    rng = np.random.default_rng(11)
    out = np.zeros((WORDS + FORMS, DIMENSIONS), np.int32)
    at = rng.random(out.shape).argpartition(ONES, axis=1)[:, :ONES]
    np.put_along_axis(out, at, np.array([1, -1] * (ONES // 2), np.int32)[None, :], 1)
    return out


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the neighbours' index vectors over the texts of a task."""
    _begin()
    index = index_vectors()
    sums = np.zeros_like(index)
    for batch in batches:
        for text in batch["text"]:
            words, forms = rows_of(text or "")
            own = index[words] + index[forms]
            around = np.zeros_like(own)
            for d in range(1, REACH + 1):
                around[d:] += own[:-d]
                around[:-d] += own[d:]
            np.add.at(sums, words, around)
            np.add.at(sums, forms, around)
    for at in range(0, len(sums), SLAB):
        yield pd.DataFrame({"slab": [at], "sums": [sums[at : at + SLAB].tobytes()]})


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in rows["sums"])
    return pd.DataFrame({"slab": [rows["slab"].iloc[0]], "sums": [total.astype(np.int32).tobytes()]})


def word_vectors(texts: DataFrame) -> np.ndarray:
    """One vector of length one per row; a row without a context has its index vector."""
    slabs = texts.mapInPandas(_contexts, "slab long, sums binary").groupBy("slab").applyInPandas(_add, "slab long, sums binary")
    index = index_vectors()
    table = index.astype(np.float32)
    for row in slabs.collect():  # (WORDS + FORMS) / SLAB rows
        part = np.frombuffer(row["sums"], np.int32).reshape(-1, DIMENSIONS)
        seen = part.any(1)
        table[row["slab"] : row["slab"] + len(part)][seen] = part[seen]
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def describe(text: str | None, vectors: np.ndarray) -> np.ndarray:
    out = np.zeros(3 * DIMENSIONS + 5, np.float32)
    words, forms = rows_of(text or "")
    n = len(words)
    if n:
        own = vectors[words] + vectors[forms]
        starts = np.arange(0, n, STRETCH)
        sums = np.add.reduceat(own, starts, axis=0)
        means = sums / np.minimum(STRETCH, n - starts)[:, None]
        again = np.r_[0, words[1:] == words[:-1]]
        mean = sums.sum(0) / n
        out[:DIMENSIONS], out[DIMENSIONS : 2 * DIMENSIONS] = mean, means.max(0)
        out[2 * DIMENSIONS : 3 * DIMENSIONS] = means.min(0)
        repeats = (np.add.reduceat(again, starts) / np.minimum(STRETCH, n - starts)).max()
        out[-5:] = np.log1p(n), len(np.unique(words)) / n, again.mean(), repeats, np.sqrt(mean @ mean)
    return out


@dataclass
class Network:
    """Two layers over standardised features, and the temperature of their logits."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return (hidden @ self.w2 + self.b2)[:, 0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Network:
    """Adam on the cross entropy of the rows outside ``calibrate``; the temperature on those inside."""
    rng = np.random.default_rng(5)
    fit = ~calibrate if (~calibrate).any() else calibrate
    x, fx, fy = x.astype(np.float64), x[fit].astype(np.float64), y[fit].astype(np.float64)
    share = (fy.sum() + 1) / (len(fy) + 2)
    net = Network(
        fx.mean(0), fx.std(0) + 1e-6, rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, 1)) / np.sqrt(HIDDEN), np.array([np.log(share / (1 - share))]),
    )
    names = ("w1", "b1", "w2", "b2")
    first, second = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2))
    step = 0
    scaled = (fx - net.mean) / net.scale
    for _ in range(EPOCHS):
        order = rng.permutation(len(fy))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            hidden = np.tanh(scaled[at] @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip((hidden @ net.w2 + net.b2)[:, 0], -60, 60)))
            out = (p - fy[at])[:, None] / len(at)
            back = out @ net.w2.T * (1 - hidden**2)
            slopes = {"w1": scaled[at].T @ back + DECAY * net.w1, "b1": back.sum(0), "w2": hidden.T @ out + DECAY * net.w2, "b2": out.sum(0)}
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * slopes[n]
                second[n] = 0.999 * second[n] + 0.001 * slopes[n] ** 2
                move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - RATE * move)
    if calibrate.any():
        z, cy = net.logits(x[calibrate]), y[calibrate]
        loss = lambda t: np.mean(np.logaddexp(0, z / t) - cy * z / t)
        net.temperature = float(min(np.exp(np.linspace(-2, 3, 101)), key=loss))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.network is None or not len(texts):
            return np.full(len(texts), 0.5)
        return self.network.probabilities(np.stack([describe(t, self.vectors) for t in texts]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, label of at most ``sample`` documents that may be learned from, chosen by a hash of doc_id."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    spark = ship(docs.sparkSession)
    # The limit bounds what is broadcast: two numbers for each of ``sample`` documents.
    chosen = F.broadcast(training_labels(labels, sample))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    # However many rows a doc_id has, it is one document of the sample.
    known = stored(rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text")), "quality-sample")
    vectors = word_vectors(known.select("text"))
    shared = spark.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _begin()
        for batch in batches:
            x = [describe(t, shared.value).tolist() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": x})

    rows = known.mapInPandas(features, "doc_id long, label int, x array<float>").toPandas()
    if rows.empty:
        return Model(vectors, None)
    rows = rows.sort_values("doc_id")  # makes the fit the same each time
    ids = rows["doc_id"].to_numpy(np.int64)
    calibrate = np.array([zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in ids])
    return Model(vectors, fit_network(np.array(rows["x"].tolist()), rows["label"].to_numpy(), calibrate))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns in a struct ``row``, and ``score``, the calibrated probability of quality 1."""
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _begin()
        for texts in batches:
            yield pd.Series(shared.value.scores(texts.tolist()), dtype=float)

    return docs.select(F.struct("*").alias("row"), scored(F.col("text")).alias("score"))
