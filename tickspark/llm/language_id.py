"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three lower-cased letters (everything else is a blank), weighted by
their share of the text times their inverse document frequency over all labelled rows. Weights are learned by
follow-the-regularised-leader with elastic-net penalties: each shard of the training sample runs through its
rows from the common state, and the states are averaged after every epoch. A temperature fitted on rows
the weights have not seen calibrates the probabilities.

The fit uses a sample of about ``max_rows`` labelled rows, chosen by a hash; document frequencies and
predictions cover every row and whole texts. The state brought to the driver has ``2 ** BITS`` rows and one
column per language, whatever the corpus.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text if there is no
labelled row. Rows without a label or text are not learned from. Ties between languages go to the first by name.
Repeated rows are predicted alike. Other columns stay; input columns named like those added are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tickspark.llm.common import fitting_name, map_batches, stored

BITS = 16
SCALE = 50.0
PART = 1 << 18


def _letters() -> np.ndarray:
    """Lower-case code of each letter of the basic plane, 32 for anything else."""
    return np.array([ord(chr(i).lower()[0]) if chr(i).isalpha() else 32 for i in range(0x10000)], np.uint32)


class Features:
    """Hashed n-grams of texts."""

    def __init__(self):
        self.low = _letters()

    def parts(self, text: str | None) -> Iterator[np.ndarray]:
        """The n-grams of a text, in parts of bounded size. Nothing if it has no letter."""
        if not text:
            return
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        known = self.low[np.minimum(codes, 0xFFFF)]
        if codes.max(initial=0) > 0xFFFF:
            far = np.flatnonzero(codes > 0xFFFF)
            known[far] = [int(codes[i]) if text[i].isalpha() else 32 for i in far]
        if not (known != 32).any():
            return
        shift = np.uint32(32 - BITS)
        for a in range(0, len(known), PART):
            c = known[max(0, a - 2): a + PART]
            new = c[min(a, 2):]
            one = new * np.uint32(0x9E3779B1)
            two = (c[:-1] * np.uint32(0x85EBCA6B) ^ c[1:]) * np.uint32(0xC2B2AE35)
            three = ((c[:-2] * np.uint32(0x27D4EB2F) ^ c[1:-1]) * np.uint32(0x165667B1) ^ c[2:]) * np.uint32(0x9E3779B1)
            yield np.concatenate([one, two[max(0, min(a, 2) - 1):], three]) >> shift

    def of(self, text: str | None) -> np.ndarray:
        found = list(self.parts(text))
        return np.concatenate(found) if found else np.zeros(0, np.uint32)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # with inverse document frequencies multiplied in
    bias: np.ndarray
    temperature: float

    def logits(self, features: Features, text: str | None) -> np.ndarray | None:
        total, sums = 0, np.zeros(len(self.languages))
        for index in features.parts(text):
            sums += self.weights[index].sum(axis=0, dtype=np.float64)
            total += len(index)
        return self.bias + SCALE * sums / total if total else None

    def predict(self, features: Features, text: str | None) -> tuple[str, float]:
        z = self.logits(features, text) if self.languages else None
        if z is None:
            return "und", 0.0
        p = np.exp((z - z.max()) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max() / p.sum())


class Ftrl:
    """Follow-the-regularised-leader for softmax regression with L1 and L2 penalties."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float = 1.0, beta: float = 0.1, l1: float = 1e-3, l2: float = 1e-3):
        self.z, self.n, self.alpha, self.beta, self.l1, self.l2 = z, n, alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def learn(self, index: np.ndarray, x: np.ndarray, label: int) -> None:
        """One example. The last row of the state is the bias."""
        rows, x = np.append(index, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(rows)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[label] -= 1.0
        g = x[:, None] * p
        n = self.n[rows]
        self.z[rows] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[rows] = n + g * g


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram is, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, df, rows = Features(), np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen = np.zeros(1 << BITS, bool)
                for index in features.parts(t):
                    seen[index] = True
                df += seen
                rows += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"feature": np.append(at, -1), "n": np.append(df[at], rows)})

    out, rows = np.zeros(1 << BITS, np.int64), 0
    # at most 2 ** BITS + 1 rows
    for r in map_batches(docs.select(text), run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n")).collect():
        if r[0] < 0:
            rows = r[1]
        else:
            out[r[0]] = r[1]
    return out, rows


def fit(docs: DataFrame, text: str = "text", label: str = "lang", max_rows: int = 16_384, epochs: int = 3, shards: int = 8,
        key: str | None = "doc_id") -> LanguageModel:
    """Learn from the rows of ``docs`` that have a text and a label. ``key`` only spreads the sample's choice."""
    rows = docs.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}  # one row per language
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)
    df, n = document_frequencies(rows, text)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    hashed = F.xxhash64(*([F.col(key)] if key else []), F.col(text))
    rate = min(1.0, max_rows / sum(counts.values()))
    chosen = rows.select(F.col(text).alias("text"), F.col(label).alias("label"), hashed.alias("h")).where(
        F.pmod("h", F.lit(1 << 30)) < int(rate * (1 << 30)))
    sample = stored(chosen.repartition(shards, "h").sortWithinPartitions("h", "text"), "language-sample")
    held = F.pmod(F.shiftright("h", 32), F.lit(5)) == 0
    place = {lang: i for i, lang in enumerate(languages)}
    shape = ((1 << BITS) + 1, len(languages))
    z, sq = np.zeros(shape), np.zeros(shape)

    def epoch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, state, seen = Features(), Ftrl(z.copy(), sq.copy()), 0
        for batch in batches:
            for t, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                index, count = np.unique(features.of(t), return_counts=True)
                if len(index):
                    state.learn(index, SCALE * count / count.sum() * idf[index], place[lang])
                    seen += 1
        yield pa.RecordBatch.from_pydict({"seen": [seen], "z": [state.z.astype("<f4").tobytes()], "n": [state.n.astype("<f4").tobytes()]})

    for _ in range(epochs):
        states = map_batches(sample.where(~held).select("text", "label").coalesce(shards), epoch, "seen bigint, z binary, n binary").collect()
        states = [s for s in states if s.seen]
        if not states:
            break
        total = sum(s.seen for s in states)
        z = sum(np.frombuffer(s.z, "<f4").reshape(shape) * (s.seen / total) for s in states).astype(np.float64)
        sq = sum(np.frombuffer(s.n, "<f4").reshape(shape) * (s.seen / total) for s in states).astype(np.float64)
    w = Ftrl(z, sq).weights()
    model = LanguageModel(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1], 1.0)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [(model.logits(features, t), place[lang]) for t, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            found = [(v, y) for v, y in found if v is not None]
            yield pa.RecordBatch.from_pydict({"z": pa.array([v.tolist() for v, _ in found], pa.list_(pa.float64())),
                                              "y": pa.array([y for _, y in found], pa.int32())})

    judged = map_batches(sample.where(held).select("text", "label"), judge, "z array<double>, y int").collect()  # a fifth of max_rows
    if judged:
        model.temperature = temperature(np.array([r.z for r in judged]), np.array([r.y for r in judged]))
    return model


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that gives the labels the highest likelihood, between 1/20 and 20."""

    def loss(t: float) -> float:
        s = logits / t
        top = s.max(axis=1)
        return float((top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - s[np.arange(len(s)), labels]).mean())

    grid = [math.exp(v) for v in np.linspace(-math.log(20), math.log(20), 121)]
    return min(grid, key=loss)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    docs = docs.drop(pred, score)
    source = fitting_name(docs, "text_to_judge")
    schema = StructType([*docs.schema.fields]).add(pred, StringType()).add(score, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [model.predict(features, t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*batch.schema.names[:-1], pred, score])

    if text in docs.columns:
        given = docs.withColumn(source, F.col(text))
    else:
        raise ValueError(f"no column {text}")
    return map_batches(given, run, schema)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``. A null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts
