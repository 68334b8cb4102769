import numpy as np
import pytest

from framelake.llm import quality

SMALL = quality.Settings(per_class=200, vocab=2000, dim=48, epochs=120)


def corpus(n=240, seed=3):
    r = np.random.default_rng(seed)
    good, bad = [f"w{k}a" for k in range(60)], [f"q{k}b" for k in range(60)]
    rows = []
    for k in range(n):
        y = int(r.random() < 0.7)
        words = r.choice(good if y else bad, r.integers(5, 60))
        rows.append((k, " ".join(words) + ("." if y else " ###"), y))
    return rows


def test_learns_and_scores(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "kept") for k, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k % 2], "doc_id long, quality int")
    model = quality.train(docs, labels, settings=SMALL)
    got = dict(quality.with_score(docs, model).select("doc_id", "score").collect())
    held = [(got[k] >= 0.5) == (y == 1) for k, _, y in rows if k % 2 == 0]
    assert np.mean(held) > 0.97
    again = dict(quality.with_score(docs, quality.train(docs, labels, settings=SMALL)).select("doc_id", "score").collect())
    assert got == again


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "w1a w2a"), (3, "w1a " * 20_000), (3, "w1a " * 20_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (1, 0), (None, 1), (2, None), (7, 5)], "doc_id long, quality int")
    for marks in (labels, labels.where("quality = 1"), labels.limit(0)):
        scores = [r["score"] for r in quality.with_score(docs, quality.train(docs, marks, settings=SMALL)).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert quality.with_score(docs.limit(0), quality.train(docs, labels, settings=SMALL)).count() == 0


@pytest.mark.parametrize("text", ["", "\n\n", "A", "x" * 100_000])
def test_pool_is_finite(text):
    model = quality.fit(["a b", "c d"] * 5, np.array([0, 1] * 5), np.ones(10), SMALL)
    assert np.isfinite(model.scores([text])).all()


def test_against_plain_forward_pass(spark):
    """Pool and network recomputed from the model's numbers, token by token."""
    rows = corpus(120)
    m = quality.fit([t for _, t, _ in rows], np.array([y for *_, y in rows]), np.ones(len(rows)), SMALL)
    texts = [t for _, t, _ in rows[:30]] + ["", "A B c c", "W1A w1a 12 ?? \n\n line\nline\n", "unseen words here 77 " * 300]
    for text, got in zip(texts, m.scores(texts), strict=True):
        tokens = quality.TOKEN.findall(text)
        pool = np.zeros(m.vectors.shape[1] + 2)
        for i, t in enumerate(tokens):
            again = t.isalpha() and ((i > 0 and tokens[i - 1] == t) or (i > 1 and tokens[i - 2] == t))
            low = t.lower()
            kind = "<letters>" if low[0].isalpha() else "<digits>" if low[0].isdigit() else "<line>" if low == "\n" else "<marks>"
            row = m.index["<again>"] if again else m.index.get(low, m.index[kind])
            pool[:-2] += m.vectors[row].astype(float) / len(tokens)
            if len(t) > 1 and t.isupper() and not again:
                pool[:-2] += quality.CAPITALS * m.vectors[m.index["<capitals>"]].astype(float) / len(tokens)
        if tokens:
            lines = [x for x in text.split("\n") if x.strip()]
            pool[-2], pool[-1] = np.log1p(len(tokens)), 1 - len(set(lines)) / len(lines) if lines else 0
        z = sum(np.tanh(sum((pool[i] - m.mean[i]) / m.scale[i] * m.w1[i, h] for i in range(len(pool))) + m.b1[h]) * m.w2[h] for h in range(len(m.w2))) + m.b2
        assert abs(got - 1 / (1 + np.exp(-z / m.temperature))) < 1e-5


def test_index_vectors():
    """Random indexing: sparse +-1 vectors, and neighbours' vectors added up."""
    names = [*quality.CLASSES, "a", "b", "c"]
    s = quality.Settings(dim=64, nonzero=6, reach=1)
    alone = quality._vectors([], names, s)
    assert all((np.count_nonzero(v) == 6) and np.allclose(np.abs(v[v != 0]), 6**-0.5) for v in alone)
    a, b, c = (names.index(x) for x in "abc")
    near = quality._vectors([np.array([a, b, c, b])], names, s)
    context = near[a] - alone[a]
    assert np.allclose(context, alone[b] / np.linalg.norm(alone[b]), atol=1e-6)
