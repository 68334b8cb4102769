"""Language identification: word-first backoff.

A word that training knows scores by its log frequency in each language. An unknown word falls back to its character
n-grams, from the longest length down to single letters, at the first length of which training knows any. A document's
language has the highest sum over its words; the score is its share under equal priors.

The fit reads a bounded sample: about `per_language` documents of each language, chosen by a hash of their id, so no
task or driver holds a language's documents. Counts are made per partition and added up in a shuffle; the most frequent
`words` words and `grams` n-grams of each length and language form the model, whose size these bounds fix.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import ready, sliced, stored

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    per_language: int = 3000
    words: int = 30_000
    grams: int = 10_000
    longest: int = 5


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between blanks that mark its ends; single letters without them."""
    framed = f" {word} " if n > 1 else word
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


class Model:
    """counts: (length, language) -> {item: count}, length 0 for words; totals alike, over all items seen."""

    def __init__(self, languages: list[str], counts: dict, totals: dict, settings: Settings):
        self.languages, self.settings = languages, settings
        self.tables: list[dict[str, int]] = []  # item -> row of the matrix of its length
        self.logs: list[np.ndarray] = []
        for n in range(settings.longest + 1):
            rows: dict[str, int] = {}
            for lang in languages:
                for item in counts.get((n, lang), {}):
                    rows.setdefault(item, len(rows))
            c = np.zeros((len(rows), len(languages)))
            for k, lang in enumerate(languages):
                for item, m in counts.get((n, lang), {}).items():
                    c[rows[item], k] = m
            total = np.array([totals.get((n, lang), 0) for lang in languages], float)
            self.tables.append(rows)
            self.logs.append(np.log((c + 0.5) / (total + 0.5 * (len(rows) + 1))))
        self.reset()

    def reset(self) -> None:
        self.rows, self.matrix, self.used = {}, np.zeros((1024, len(self.languages))), 0

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("languages", "settings", "tables", "logs")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.reset()

    def word(self, word: str) -> np.ndarray:
        """Log frequencies of a word by language."""
        found = self.tables[0].get(word)
        if found is not None:
            return self.logs[0][found]
        for n in range(self.settings.longest, 0, -1):
            known = [t for g in grams(word, n) if (t := self.tables[n].get(g)) is not None]
            if known:
                return self.logs[n][known].mean(axis=0)
        return np.zeros(len(self.languages))

    def row(self, word: str) -> int:
        """Place of a word's scores in a matrix that keeps them."""
        at = self.rows.get(word)
        if at is None:
            if self.used == len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            self.matrix[self.used] = self.word(word)
            at = self.rows[word] = self.used
            self.used += 1
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall((text or "").lower())
        if not self.languages or not any(c.isalpha() for w in words for c in w):  # \w has other numbers than \d
            return UNKNOWN, 0.0
        if self.used > 200_000:
            self.reset()
        at = [self.rows.get(w, -1) for w in words]
        if -1 in at:
            at = [self.row(w) for w in words]
        sums = self.matrix[at].sum(axis=0)
        share = np.exp(sums - sums.max())
        best = int(np.argmax(sums))
        return self.languages[best], float(share[best] / share.sum())


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from rows of docs(doc_id, text, lang); rows with a null in any of these teach nothing."""
    docs = docs.select("doc_id", "text", "lang").dropna()
    seen = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}  # a row a language
    if not seen:
        return Model([], {}, {}, settings)
    share = F.lit(1.0)
    for lang, n in seen.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, settings.per_language / n))).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = docs.where(place < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(LETTERS.findall(text.as_py().lower()))
        for lang, words in found.items():
            tables = [words, *(Counter() for _ in range(settings.longest))]
            for word, c in words.items():
                for n in range(1, settings.longest + 1):
                    for g in grams(word, n):
                        tables[n][g] += c
            for n, t in enumerate(tables):
                size = len(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array(np.full(size, n, np.int32)), pa.array(list(t), pa.string()), pa.array(list(t.values()), pa.int64())],
                    ["lang", "n", "item", "c"],
                )

    counted = sample.mapInArrow(count, "lang string, n int, item string, c long").groupBy("lang", "n", "item").agg(F.sum("c").alias("c"))
    counted, _ = stored(counted, "counts")
    totals = {(r["n"], r["lang"]): r["c"] for r in counted.groupBy("n", "lang").agg(F.sum("c").alias("c")).collect()}
    order = Window.partitionBy("lang", "n").orderBy(F.col("c").desc(), "item")
    most = F.when(F.col("n") == 0, F.lit(settings.words)).otherwise(F.lit(settings.grams))
    top = counted.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most)
    counts: dict = {}
    for r in top.select("lang", "n", "item", "c").toLocalIterator():  # bounded by words and grams
        counts.setdefault((r["n"], r["lang"]), {})[r["item"]] = r["c"]
    return Model(sorted(seen), counts, totals, settings)


def with_language(df: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """df with the predicted language and its score; columns of these names in df are replaced.

    A null text, or one without letters, is `und` with score 0.
    """
    ready(df.sparkSession)
    kept = [c for c in df.columns if c not in (out, score)]
    df = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = df.select("*", F.lit("").alias(out), F.lit(0.0).alias(score)).schema
    at, sent = kept.index(text), df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [sent.value.predict(t.as_py()) for t in batch.column(at)]
            columns = [pa.array([lang for lang, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, out, score])

    return df.mapInArrow(run, schema)
