import random
import re

from framelake.llm import decontaminate


def toks(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, items, width=10):
    w, hit, found = toks(text), set(), set()
    for item, body in items:
        b = toks(body)
        n = min(width, len(b))
        wins = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def case(seed, short):
    r = random.Random(seed)
    vocab = ["the", "Of", "É", "é", "a1", "zß", "x", "y", "z", "q"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n", "  "]) for _ in range(n))
    items = [(k, text(r.choice([3, 9, 10, 11, 30] if short else [10, 12, 40]))) for k in range(12)] + [(50, None), (51, " ,"), (None, text(12))]
    docs = []
    for k in range(40):
        body = text(r.randrange(0, 80))
        for _ in range(r.randrange(3)):
            own = toks(r.choice(items)[1])
            at = r.randrange(len(own) + 1)
            body += " " + " ".join(own[at : at + r.randrange(5, 25)]).upper() + " " + text(r.randrange(4))
        docs.append((k, body))
    return docs + [(None, docs[3][1]), (3, docs[3][1]), (77, None), (78, ""), (79, "the x " * 9000)], items


def test_against_brute_force(spark):
    for seed, short in ((1, False), (2, True), (3, False)):
        docs, items = case(seed, short)
        d = spark.createDataFrame([(k, t, "a", 1) for k, t in docs], "doc_id long, text string, items string, key int")
        b = spark.createDataFrame(items, "item_id long, text string")
        got = [tuple(x) for x in decontaminate.judged(d, b).select("doc_id", "n_words", "n_hit", "items").collect()]
        want = [(k, *plain(t, items)) for k, t in docs]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.judged(d.limit(0), b).count() == 0
    assert decontaminate.judged(d, b.limit(0)).select("n_words", "n_hit").collect() == [(3, 0)]
    assert decontaminate.judged(d, b).select("n_hit", "items").collect() == [(3, ["1"])]
