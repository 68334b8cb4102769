import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from framelake.llm import passages


@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 400)), min_size=1, max_size=40, unique_by=lambda x: x[0]))
@settings(max_examples=80, deadline=None)
def test_chain_scores(points):
    points.sort()
    pb, pa = np.array([p for p, _ in points]), np.array([q for _, q in points])
    best = []
    for i, (b, a) in enumerate(points):
        gains = [best[j] - passages.GAP_COST * (b - points[j][0] + a - points[j][1]) for j in range(i) if points[j][1] < a]
        best.append(passages.K + max([0, *gains]))
    found = passages.chains(pb, pa)
    top = found[0]
    cost = sum(passages.GAP_COST * (points[y][0] - points[x][0] + points[y][1] - points[x][1]) for x, y in zip(top, top[1:], strict=False))
    assert abs(passages.K * len(top) - cost - max(best)) < 1e-6
    assert sorted(x for c in found for x in c) == list(range(len(points)))


def test_runs_of_like_words(spark):
    r = random.Random(5)
    run = ["the"] * 120
    rows = [(k, " ".join(words(r, 30 + k) + run[: 70 + 5 * k] + words(r, 20))) for k in range(6)] + [(9, " ".join(words(r, 100)))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x for g in got for x in (g["doc_id"], g["other"])} == set(range(6))
    assert all(g["end_word"] - g["start_word"] >= 60 for g in got)


def words(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def test_planted_passages(spark):
    r = random.Random(3)
    shared = words(r, 90)
    edited = shared[:30] + ["zz"] + shared[31:60] + shared[62:]
    rows, spans = [], {}
    for k in range(30):
        left, right = words(r, r.randrange(0, 80)), words(r, r.randrange(20, 80))
        body = {0: shared, 1: edited, 2: shared[:20]}.get(k % 5)
        spans[k] = (len(left), len(left) + len(body)) if body and k % 5 < 2 else None
        rows.append((k, " ".join(left + (body or []) + right)))
    long = words(r, 9000)
    rows += [(50, " ".join(long)), (51, " ".join(long[4000:4100])), (60, rows[3][1]), (61, rows[3][1].upper()), (62, None), (63, ""), (None, rows[3][1]), (64, "a b c"), (65, "a b c")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n int")
    got = passages.repeated_passages(df, min_words=50).collect()
    partners = {}
    for g in got:
        partners.setdefault(g["doc_id"], []).append(g)
        partners.setdefault(g["other"], [])
    planted = {k for k, s in spans.items() if s}
    assert set(partners) - {None} == planted | {50, 51, 3, 60, 61} | ({3} & set(spans))
    for k in (k for k in planted if partners[k]):  # the text that others are held against has no row of its own
        best = max(partners[k], key=lambda g: g["end_word"] - g["start_word"])
        assert abs(best["start_word"] - spans[k][0]) <= 6 and abs(best["end_word"] - spans[k][1]) <= 6 and best["identity"] >= 0.9
    assert [(g["start_word"], g["end_word"], g["other"], g["identity"]) for g in partners[60]][0][2:] == (3, 1.0)
    hit = partners[51][0] if partners[51] else partners[50][0]
    assert {hit["start_word"], hit["other_start"]} == {0, 4000}
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_shared_passage_of_common_lines(spark):
    """Two texts share a passage whose lines also stand, each alone, in other texts."""
    r = random.Random(11)
    rows, pairs = [], []
    for k in range(12):
        lines = [words(r, 10) for _ in range(6)]
        for line in lines:
            rows += [(1000 * k + 100 + len(rows), " ".join(words(r, 30) + line + words(r, 30))) for _ in range(15)]
        pair = (10_000_000 + 2 * k, 10_000_001 + 2 * k)
        rows += [(x, " ".join(words(r, 40) + sum(lines, []) + words(r, 40))) for x in pair]
        pairs.append(pair)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(sorted((g["doc_id"], g["other"]))) for g in got} == set(pairs)
    assert all((g["start_word"], g["end_word"], g["other_start"], g["other_end"], g["identity"]) == (40, 100, 40, 100, 1.0) for g in got)


def edited(r, body, share):
    """body with this share of its words replaced, dropped or followed by another."""
    out = []
    for w in body:
        out += [w] if r.random() >= share else r.choice([words(r, 1), [], [w, *words(r, 1)]])
    return out


def test_lone_seeds(spark):
    """Pairs of passages with edits, of which many keep one seed only."""
    r = random.Random(13)
    rows = []
    for n, share in enumerate((0.05, 0.1, 0.15)):
        for k in range(60):
            body = words(r, 70)
            for x, part in ((0, body), (1, edited(r, body, share))):
                rows.append((1000 * n + 2 * k + x, " ".join(words(r, 40) + part + words(r, 40))))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(g["doc_id"] ^ g["other"] == 1 and g["identity"] >= 0.8 for g in got)
    found = [len({g["doc_id"] // 2 for g in got if g["doc_id"] // 1000 == n}) / 60 for n in range(3)]
    assert found[0] >= 0.95 and found[1] >= 0.8 and found[2] >= 0.5


def runs_of(a, b, n):
    """Longest run of equal words in a row of two texts, if of n at least."""
    best, last = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            if x == y:
                now[j] = last[j - 1] + 1
        best, last = max(best, *now), now
    return best if best >= n else 0


def test_against_all_pairs(spark):
    """Passages between texts whose seeds stand in decoys too: every text with a repeat is found, and no other."""
    r = random.Random(21)
    vocab = words(r, 60)
    rows, texts = [], {}
    for k in range(12):
        body = words(r, 80)
        for x in range(r.choice([2, 3])):
            cut = r.randrange(0, 10)
            texts[100 * k + x] = words(r, r.randrange(60)) + body[cut : cut + 60 + r.randrange(5)] + words(r, r.randrange(60))
        for d in range(40):  # decoys quote parts of it
            at = r.randrange(0, 70)
            texts[100 * k + 10 + d] = words(r, 20) + body[at : at + r.choice([6, 10, 22])] + words(r, 15) + [r.choice(vocab) for _ in range(5)]
    rows = [(k, " ".join(t)) for k, t in texts.items()]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {x for g in got for x in (g["doc_id"], g["other"])}
    want, ids = set(), sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if a // 100 == b // 100 and runs_of(texts[a], texts[b], 50):
                want |= {a, b}
    assert want <= found and len(want) > 12
    for g in got:  # and what is found is so
        a, b = texts[g["doc_id"]][g["start_word"] : g["end_word"]], texts[g["other"]][g["other_start"] : g["other_end"]]
        assert len(a) >= 50 and len(b) >= 50 and g["identity"] >= 0.8
        assert g["identity"] < 1 or a == b


def test_long_repeat_with_decoys(spark):
    """A repeat of 3,000 words, whose later seeds also stand in short texts, is one passage."""
    r = random.Random(8)
    body = words(r, 3000)
    rows = [(1, " ".join(words(r, 40) + body)), (2, " ".join(words(r, 90) + body + words(r, 10)))]
    rows += [(100 + k, " ".join(words(r, 5) + body[600 + 15 * k : 630 + 15 * k])) for k in range(150)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    best = max((g for g in got if {g["doc_id"], g["other"]} == {1, 2}), key=lambda g: g["end_word"] - g["start_word"])
    assert best["end_word"] - best["start_word"] >= 2995


def test_edited_passage_of_common_lines(spark):
    """Two texts share lines of which each has a word of its own; the lines also stand, each alone, in other texts."""
    r = random.Random(17)
    rows, pairs = [], set()
    for k in range(12):
        lines = [words(r, 13) for _ in range(5)]
        for line in lines:
            rows += [(1000 * k + 100 + n, " ".join(words(r, 30) + line + words(r, 30))) for n in range(len(rows), len(rows) + 15)]
        pair = (10_000_000 + 2 * k, 10_000_001 + 2 * k)
        rows += [(x, " ".join(words(r, 40) + sum((line + words(r, 1) for line in lines), []) + words(r, 40))) for x in pair]
        pairs.add(pair)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(sorted((g["doc_id"], g["other"]))) for g in got} == pairs
    assert all((g["start_word"], g["end_word"], g["other_start"], g["other_end"]) == (40, 109, 40, 109) and g["identity"] == 65 / 69 for g in got)


def test_ties_of_a_seed_as_all_pairs():
    """Places of one seed, in small and large tiles: links are as connected as all pairs that make a passage."""
    import pyarrow as pa

    r = random.Random(4)
    k, side = passages.K, passages._side(passages.K, 50)
    for n in (9, 150):
        bodies = [words(r, 2 * side) for _ in range(4)]
        rows = []
        for t in range(n):
            body = [w if r.random() > 0.1 else r.choice(bodies[0]) for w in r.choice(bodies)]
            rows.append((t, body[:side], body[side:], t % 5 > 0))
        texts = {t: [*before, *(f"seed{x}" for x in range(k)), *after] for t, before, after, _ in rows}
        at = pa.RecordBatch.from_pylist([{"t": t, "text": " ".join(x), "at": [side]} for t, x in texts.items()])
        around = pa.Table.from_batches(passages._contexts(k, side)(iter([at])))
        tile = around.append_column("own", pa.array([own for *_, own in rows]))
        for name, kind, value in (("c", pa.int32(), 0), ("key", pa.int64(), 1), ("i", pa.int32(), 0), ("j", pa.int32(), 0), ("first", pa.bool_(), False)):
            tile = tile.append_column(name, pa.array([value] * n, kind))
        links = [x for b in passages._ties(k, 50, 0.8)(iter(tile.to_batches())) for x in b.to_pylist()]
        want = [
            (y, x) for x in range(n) for y in range(x + 1, n) if passages.pair_passages(texts[y], texts[x], [([side], [side])], k, 50, 0.8)[0]
        ]
        tied = [(t, 0) for t, *_, own in rows if not own]

        def groups(pairs, n=n):
            low = list(range(n))
            for a, b in pairs:
                low = [min(low[a], low[b]) if x in (low[a], low[b]) else x for x in low]
            return low

        assert {(x["tb"], x["ta"]) for x in links} <= set(want) and len(links) < n
        assert groups([*((x["tb"], x["ta"]) for x in links), *tied]) == groups([*want, *tied])


def test_ends_of_runs_are_not_extended_pair_by_pair(monkeypatch):
    """Places of one seed at the ends of runs of a word have many words in common, but no passage: few are extended."""
    import pyarrow as pa

    r = random.Random(9)
    k, side, n = passages.K, passages._side(passages.K, 50), 300
    contexts = []
    for _ in range(n):
        run = ["the"] * r.randrange(30, 40)
        contexts.append((run + [words(r, 1)[0]] * side, words(r, 1) * side))
    marks = [[np.array([hash(w) % 2**20 + 2**16 for w in x[:side]], "<u4").tobytes() for x in c] for c in contexts]
    tile = {"t": range(n), "p": [side] * n, "own": [True] * n, "first": [False] * n, "before": [x for x, _ in marks], "after": [x for _, x in marks]}
    tile |= {"c": np.zeros(n, np.int32), "key": np.ones(n, np.int64), "i": np.zeros(n, np.int32), "j": np.zeros(n, np.int32)}
    calls, outward = [], passages._outward
    monkeypatch.setattr(passages, "_outward", lambda b, a: calls.append(1) or outward(b, a))
    assert not [x for b in passages._ties(k, 50, 0.8)(iter(pa.table(tile).to_batches())) for x in b.to_pylist()]
    assert len(calls) < 4 * n


def test_places_in_runs_go_once(spark, monkeypatch):
    """Chains of one seed inside a passage of their texts are not looked at: rows that reach follow texts, not places."""
    r = random.Random(6)
    rows = [(x, " ".join(words(r, 20) + ["the"] * 400 + words(r, 20))) for x in range(20)]
    made, stored = {}, passages.stored

    def counted(df, kind):
        out = stored(df, kind)
        made[kind] = made.get(kind, 0) + out[0].count()
        return out

    monkeypatch.setattr(passages, "stored", counted)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x for g in got for x in (g["doc_id"], g["other"])} == set(range(20))
    assert made["reaching"] <= 5 * len(rows)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=48), st.lists(st.integers(0, 3), max_size=48)), min_size=1, max_size=20))
@settings(max_examples=200, deadline=None)
def test_straight_extensions(pairs):
    """Where no edit goes on, the equal words that two rows begin with are the whole extension."""
    width = passages._side(passages.K, 50) + passages.EDIT + 3
    left, right = ([bytes(p[n]) for p in pairs] for n in (0, 1))
    n, ends = passages._straight(*(passages._rows_of(x, width, np.uint8) for x in (left, right)))
    for b, a, m, end in zip(left, right, n.tolist(), ends.tolist(), strict=True):
        found = passages._outward(b, a)[:3]
        assert found == (m, m, m) if end else min(found) >= m


@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=60), max_size=6))
@settings(max_examples=200, deadline=None)
def test_seeds_of_many_texts(texts):
    owner, at, h = passages.seeds_of(texts)
    for x, words in enumerate(texts):
        want = passages.seeds(words)
        assert at[owner == x].tolist() == want[0].tolist() and h[owner == x].tolist() == want[1].tolist()
