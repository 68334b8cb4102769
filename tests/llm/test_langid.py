import math
import re
from collections import Counter

import numpy as np

from framelake.llm import langid

SMALL = langid.Settings(per_language=400, words=400, grams=500, longest=4)


def corpus(n=500):
    r = np.random.default_rng(6)
    parts = {"en": ["th", "er", "ing", "on"], "de": ["sch", "ung", "ä", "ein"], "fr": ["eau", "é", "oi", "ent"]}
    rows = []
    for k in range(n):
        lang = ["en", "en", "en", "de", "fr"][k % 5]
        words = ["".join(r.choice(parts[lang], r.integers(1, 5))) for _ in range(int(r.integers(4, 40)))]
        rows.append((k, " ".join(words).capitalize() + ".", lang))
    return rows


def test_held_out(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.where("doc_id % 7 <> 0"), SMALL)
    got = {r["doc_id"]: r for r in langid.with_language(df, model).collect()}
    assert np.mean([got[k]["lang_pred"] == lang for k, _, lang in rows if k % 7 == 0]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_backoff():
    m = langid.Model(["a", "b"], {(0, "a"): {"tree": 9}, (0, "b"): {"baum": 9}, (2, "b"): {"au": 4}, (1, "a"): {"t": 5}}, {(0, "a"): 9, (0, "b"): 9, (2, "b"): 4, (1, "a"): 5}, langid.Settings(longest=3))
    assert m.predict("Tree")[0] == "a" and m.predict("xaux")[0] == "b" and m.predict("zt")[0] == "a"


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 ?! ²½", None), (None, "abc", "en"), (4, "abc", None), (5, "abc " * 30_000, "en"), (5, "abc", "en")]
    df = spark.createDataFrame([(*x, 0.5) for x in rows], "doc_id long, text string, lang string, score double")
    got = [r["lang_pred"] for r in langid.with_language(df, langid.train(df, SMALL)).collect()]
    assert got == ["und"] * 3 + ["en"] * 4
    assert {r["lang_pred"] for r in langid.with_language(df, langid.train(df.limit(0), SMALL)).collect()} == {"und"}
    assert langid.with_language(df.limit(0), langid.train(df, SMALL)).count() == 0


def plain(rows, settings):
    """The backoff score, counted and added up word by word."""
    langs = sorted({lang for _, _, lang in rows})
    words = {lang: Counter(w for _, t, x in rows if x == lang for w in re.findall(r"[^\W\d_]+", t.lower())) for lang in langs}
    tables = {0: words}
    for n in range(1, settings.longest + 1):
        tables[n] = {lang: Counter() for lang in langs}
        for lang in langs:
            for w, c in words[lang].items():
                framed = f" {w} " if n > 1 else w
                for i in range(len(framed) - n + 1):
                    tables[n][lang][framed[i : i + n]] += c
    kept = {n: {lang: dict(sorted(t[lang].items(), key=lambda z: (-z[1], z[0]))[: settings.words if n == 0 else settings.grams]) for lang in langs} for n, t in tables.items()}
    sizes = {n: len({x for lang in langs for x in kept[n][lang]}) for n in kept}
    log = lambda n, lang, x: math.log((kept[n][lang].get(x, 0) + 0.5) / (sum(tables[n][lang].values()) + 0.5 * (sizes[n] + 1)))

    def score(text):
        sums = dict.fromkeys(langs, 0.0)
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            parts = [(0, w)] if any(w in kept[0][lang] for lang in langs) else []
            for n in range(settings.longest, 0, -1):
                if not parts:
                    framed = f" {w} " if n > 1 else w
                    grams = [framed[i : i + n] for i in range(len(framed) - n + 1)]
                    parts = [(n, g) for g in grams if any(g in kept[n][lang] for lang in langs)]
            for lang in langs:
                sums[lang] += sum(log(n, lang, x) for n, x in parts) / max(1, len(parts))
        best = min(langs, key=lambda lang: (-sums[lang], lang))  # of a tie, the first language in order
        return best, 1 / sum(math.exp(v - sums[best]) for v in sums.values())

    return score


def test_against_plain_backoff(spark):
    rows = corpus(260)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = langid.Settings(per_language=10_000, words=120, grams=150, longest=4)
    score = plain([x for x in rows if x[0] % 3], small)
    model = langid.train(df.where("doc_id % 3 <> 0"), small)
    other = [(k, f"{t} zzqx ßtraße éclair", lang) for k, t, lang in rows if k % 3 == 0]
    got = langid.with_language(spark.createDataFrame(other, "doc_id long, text string, lang string"), model).collect()
    for r in got:
        lang, share = score(r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - share) < 1e-9
