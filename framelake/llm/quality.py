"""Quality classifier: random-indexing word vectors pooled per document, then a calibrated two-layer network.

The fit reads a bounded sample: at most `per_class` labelled documents of each class, those with the smallest hash of
their id. One task draws sparse random index vectors for the sample's most frequent tokens, adds up the index vectors
of each token's neighbours, pools token vectors to a mean per document, trains the network and sets its temperature on
a part of the sample that training does not see. The model (a few MB: vocab x dim numbers) is broadcast, and every
whole text is scored in its partition: scoring shuffles nothing.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import lean, ready

TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+|\d+|\n|_+")
#: Tokens outside the vocabulary fall into classes of their own, as do words that stand again beside or next but one to
#: themselves; capitals are added to a token's vector.
CLASSES = ("<letters>", "<marks>", "<digits>", "<line>", "<capitals>", "<again>")
#: How much capitals weigh beside the token itself.
CAPITALS = 3


@dataclass(frozen=True)
class Settings:
    per_class: int = 3000
    vocab: int = 20_000
    dim: int = 128
    nonzero: int = 8
    reach: int = 2
    hidden: int = 32
    epochs: int = 300
    seed: int = 7


@dataclass
class Model:
    index: dict[str, int]
    vectors: np.ndarray  # a row a token; rows beyond them stand for the same tokens in capitals
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def rows(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        rows = np.fromiter(map(self.row, tokens), np.int64, len(tokens))
        rows[_repeats(tokens)] = self.index["<again>"]
        return rows

    def row(self, token: str) -> int:
        found = self.cache.get(token)
        if found is None:
            if len(self.cache) > 100_000:
                self.cache.clear()
            found = self.cache[token] = _row(self.index, len(self.vectors), token)
        return found

    def pooled(self, text: str) -> np.ndarray:
        return pooled(self.vectors, self.rows(text), text)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.stack([self.pooled(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(_forward(self, (x - self.mean) / self.scale) / self.temperature, -30, 30)))

    @property
    def cache(self) -> dict[str, int]:
        return self.__dict__.setdefault("_cache", {})

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_cache"}


def _row(index: dict[str, int], half: int, token: str) -> int:
    low = token.lower()
    found = index.get(low)
    if found is None:
        found = index["<letters>" if low[0].isalpha() else "<digits>" if low[0].isdigit() else "<line>" if low == "\n" else "<marks>"]
    return found + half * (len(token) > 1 and token.isupper())


def _repeats(tokens: list[str]) -> list[int]:
    """Places of words that repeat the token before, or the one before that."""
    at = [k for k, (c, b, a) in enumerate(zip(tokens, tokens[1:], tokens[2:], strict=False), 2) if (a == b or a == c) and a.isalpha()]
    return [1, *at] if len(tokens) > 1 and tokens[0] == tokens[1] and tokens[0].isalpha() else at


def pooled(vectors: np.ndarray, rows: np.ndarray, text: str) -> np.ndarray:
    """Mean token vector, and the log of the token count and the share of repeated lines; zeros without tokens."""
    out = np.zeros(vectors.shape[1] + 2)
    if len(rows):
        capitals = rows >= len(vectors)
        rows = np.where(capitals, rows - len(vectors), rows)
        used, counts = np.unique(rows, return_counts=True)  # weigh each distinct token by its count
        out[:-2] = counts @ vectors[used] / len(rows)
        out[:-2] += CAPITALS * vectors[CLASSES.index("<capitals>")] * capitals.mean()
        lines = [x for x in text.split("\n") if x.strip()]
        out[-2] = np.log1p(len(rows))
        out[-1] = 1 - len(set(lines)) / len(lines) if lines else 0
    return out


def _forward(m, x: np.ndarray) -> np.ndarray:
    return np.tanh(x @ m.w1 + m.b1) @ m.w2 + m.b2


def _vectors(docs: list[np.ndarray], names: list[str], s: Settings) -> np.ndarray:
    """Random indexing: a token's own index vector and those of its neighbours, each of `nonzero` entries of +-1."""
    size = len(names)
    at, sign = np.zeros((size, s.nonzero), np.int64), np.zeros((size, s.nonzero))
    for k, name in enumerate(names):
        r = np.random.default_rng([s.seed, zlib.crc32(name.encode())])
        at[k], sign[k] = r.choice(s.dim, s.nonzero, replace=False), r.choice((-1.0, 1.0), s.nonzero)
    context = np.zeros(size * s.dim)
    for ids in docs:
        for gap in range(1, s.reach + 1):
            for a, b in ((ids[:-gap], ids[gap:]), (ids[gap:], ids[:-gap])):
                for k in range(0, len(a), 4096):
                    x, y = a[k : k + 4096].astype(np.int64), b[k : k + 4096]
                    np.add.at(context, (x[:, None] * s.dim + at[y]).ravel(), sign[y].ravel() / gap)
    context = context.reshape(size, s.dim)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    context[np.arange(size)[:, None], at] += sign / np.sqrt(s.nonzero)
    return context.astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray, s: Settings) -> Model:
    """weights: what a row stands for, so that probabilities follow the classes' shares in the corpus."""
    seen: dict[str, int] = {}  # each token once; texts become numbers
    numbers, repeats, total = [], [], Counter()
    for t in texts:
        tokens = TOKEN.findall(t)
        numbers.append(np.fromiter((seen.setdefault(x, len(seen)) for x in tokens), np.int32, len(tokens)))
        repeats.append(np.array(_repeats(tokens), np.int32))
    counts = np.zeros(len(seen), np.int64)
    for x in numbers:
        np.add.at(counts, x, 1)
    for token, k in seen.items():
        total[token.lower()] += int(counts[k])
    names = [*CLASSES, *(w for w, _ in sorted(total.items(), key=lambda z: (-z[1], z[0]))[: s.vocab] if w not in CLASSES)]
    index = {w: k for k, w in enumerate(names)}
    row = np.fromiter((_row(index, 0, t) for t in seen), np.int32, len(seen))
    docs = []
    for x, at in zip(numbers, repeats, strict=True):
        docs.append(row[x])
        docs[-1][at] = index["<again>"]
    del seen, numbers, repeats, total
    vectors = _vectors(docs, names, s)
    model = Model(index, vectors, np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), 0.0, 1.0)
    x = np.stack([model.pooled(t) for t in texts]) if texts else np.zeros((0, s.dim + 2))
    model.mean, model.scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(s.dim + 2), np.ones(s.dim + 2))
    r = np.random.default_rng(s.seed)
    model.w1, model.b1 = r.normal(0, (s.dim + 2) ** -0.5, (s.dim + 2, s.hidden)), np.zeros(s.hidden)
    model.w2 = r.normal(0, s.hidden**-0.5, s.hidden)
    if len(set(labels.tolist())) < 2:  # nothing to tell apart: the one class there is, or even odds
        model.w2[:], model.b2 = 0, 4.0 * (2 * labels[0] - 1) if len(labels) else 0.0
        return model
    x = (x - model.mean) / model.scale
    aside = np.arange(len(x)) % 5 == 4
    _train(model, x[~aside], labels[~aside], weights[~aside], s)
    _calibrate(model, x[aside], labels[aside], weights[aside])
    return model


def _train(m: Model, x: np.ndarray, y: np.ndarray, w: np.ndarray, s: Settings) -> None:
    """Full-batch Adam on the weighted log loss with a small weight decay."""
    w, decay = w / w.sum(), 1e-3
    p = [m.w1, m.b1, m.w2, np.array(m.b2)]
    first, second = [np.zeros_like(z) for z in p], [np.zeros_like(z) for z in p]
    for step in range(1, s.epochs + 1):
        h = np.tanh(x @ p[0] + p[1])
        err = w * (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y)
        back = np.outer(err, p[2]) * (1 - h**2)
        grads = [x.T @ back + decay * p[0], back.sum(axis=0), h.T @ err + decay * p[2], err.sum()]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            p[k] = p[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = *p[:3], float(p[3])


def _calibrate(m: Model, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
    """The temperature with the least weighted log loss on rows that training did not see."""
    if len(x):
        z = _forward(m, x)
        loss = lambda t: (w * np.logaddexp(0, np.where(y == 1, -z, z) / t)).sum()
        m.temperature = float(min(np.geomspace(0.25, 8, 60), key=loss))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on rows of docs(doc_id, text) that labels(doc_id, label) marks 0 or 1.

    Null ids, null labels and labels other than 0 and 1 are left out; an id labelled twice takes its lower label.
    """
    ready(docs.sparkSession)
    marked = labels.where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    there = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    picked = None
    for y, n in sorted(there.items()):
        some = marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.per_class)
        some = some.withColumn("w", F.lit(n / min(n, settings.per_class)))
        picked = some if picked is None else picked.union(some)
    if picked is None:
        return fit([], np.zeros(0, int), np.zeros(0), settings)
    # at most 2 x per_class rows
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ys, ws = [], [], []
        for b in batches:
            texts += b.column("text").to_pylist()
            ys.append(b.column("y").to_numpy())
            ws.append(b.column("w").to_numpy())
        none = [np.zeros(0)]
        model = fit(texts, np.concatenate(ys or none).astype(int), np.concatenate(ws or none), settings)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = sample.repartition(1).sortWithinPartitions("doc_id", "text").mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([], np.zeros(0, int), np.zeros(0), settings)


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """df with a double column out, the probability of label 1; a column of that name in df is replaced.

    Null and empty texts have no tokens and get the score of an all-zero pool.
    """
    kept = [c for c in df.columns if c != out]
    df = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = df.select("*", F.lit(0.0).alias(out)).schema
    at, sent = kept.index(text), df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.scores([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, out])
        sent.value.cache.clear()  # the worker lives on

    return df.mapInArrow(lean(run), schema)
