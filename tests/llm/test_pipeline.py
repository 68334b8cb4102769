"""The pipeline's stages against brute force on a small corpus."""

import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
import public_tokenizers
from test_decontaminate import plain as hits
from tokenizers import Tokenizer

from framelake.llm import mixing, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(9)
    good, bad = [f"w{k}a" for k in range(300)], [f"q{k}b" for k in range(300)]
    item = " ".join(r.choice(good) for _ in range(14))
    rows, labels = [], []
    for k in range(400):
        y = k % 7 != 3
        words = [r.choice(good if y else bad) for _ in range(r.randrange(20, 200))]
        text = "".join(w + r.choice([" ", "\n", "  "]) for w in words) + ("" if y else " ### %%%")
        if k % 29 == 5:
            text += item
        if k % 31 == 7 and k > 40:
            text = rows[k - 40][1] + (" w1a" if k % 2 else "")
            y = labels[k - 40][1]
        rows.append((k, text, "en", ["a", "b", None][k % 3 if k % 2 else 0], len(text)))
        labels.append((k, int(y), 0))
    rows += [(400, None, None, "a", None), (401, "", "en", "b", 0), (None, rows[0][1] + " more words w2a", "en", "b", 1), rows[11], (402, "w5a " * 12_000, "en", "a", 48_000)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame(labels[:300], "doc_id long, quality int, toxic int").write.parquet(f"file://{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"file://{path}/benchmark.parquet")
    return f"file://{path}"


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Rows before the first stage and after each."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    small = quality.Settings(per_class=200, vocab=1500, dim=48, epochs=120)
    keep, quality.train.__defaults__ = quality.train.__defaults__, ("quality", small)
    try:
        out.append([tuple(x) for x in docs.select(COLUMNS).collect()])
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert found.columns == docs.columns
            path = f"{folder}/out-{name}"
            found.write.parquet(path)
            docs = spark.read.parquet(path)
            out.append([tuple(x) for x in docs.collect()])
    finally:
        quality.train.__defaults__ = keep
    return out


def test_quality(stages):
    gone = {x[0] for x in stages[0]} - {x[0] for x in stages[1]} - {None, 400, 401}
    bad = {x[0] for x in stages[0] if x[1] and "###" in x[1]}
    assert gone == bad and set(stages[1]) <= set(stages[0])


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_duplicates(stages):
    rows = stages[1]
    sets, group = [shingles(x[1]) for x in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                group = [group[b] if g == group[a] else g for g in group]
    low = {}
    for g, x in zip(group, rows, strict=True):
        low[g] = x[0] if low.get(g) is None else min(low[g], low[g] if x[0] is None else x[0])
    assert sorted((x[0] for x in stages[2]), key=str) == sorted(low.values(), key=str) and len(stages[2]) < len(rows)


def test_decontamination(stages):
    items = [(1, next(x[1] for x in stages[0] if x[0] == 5)[-len(max(re.findall(r"(?:w\d+a ){13}w\d+a$", next(x[1] for x in stages[0] if x[0] == 5)), key=len)) :])]
    assert sorted((x[0] for x in stages[3]), key=str) == sorted((x[0] for x in stages[2] if not hits(x[1], items)[1]), key=str)
    assert len(stages[3]) < len(stages[2])


def test_mixing(stages):
    before = {x[0]: x for x in stages[3]}
    count = lambda t: len(re.findall(mixing.WORD, t or ""))
    names = sorted({x[3] for x in stages[3]}, key=lambda s: (s is None, s or ""))
    sizes = [sum(count(x[1]) for x in stages[3] if x[3] == s) for s in names]
    for s, target in zip(names, mixing.targets(sizes), strict=True):
        assert abs(sum(count(x[1]) for x in stages[4] if x[3] == s) - target) <= 2 * 64
    seen = {}
    for x in stages[4]:
        own = before[x[0]]
        assert x[2:4] == own[2:4] and x[4] == len(x[1]) and x[1]
        words = iter(re.findall(mixing.WORD, own[1]))
        assert all(w in words for w in re.findall(mixing.WORD, x[1]))
        seen[x[0]] = seen.get(x[0], 0) + count(x[1])
    assert all(n <= 2 * count(before[k][1]) for k, n in seen.items())
    assert any(x[1] == before[x[0]][1] for x in stages[4])


def test_tokens(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [(x[0], [*plain.encode(x[1], add_special_tokens=False).ids, 2]) for x in stages[4]]
    assert sorted(str((x[0], x[2], x[3])) for x in stages[5]) == sorted(str((k, len(v), zlib.crc32(np.array(v, "<u4").tobytes()))) for k, v in want)
    rows = sorted(stages[5], key=lambda x: x[1])
    assert [x[1] for x in rows] == np.cumsum([0, *(x[2] for x in rows)])[:-1].tolist() and [x[0] for x in rows] == sorted((x[0] for x in rows), key=lambda v: (v is not None, v or 0))


def test_run(spark, folder):
    """With production settings, twice the same."""
    first = sorted(map(str, corpus_pipeline.run(spark, folder).collect()))
    assert first and first == sorted(map(str, corpus_pipeline.run(spark, folder).collect()))
