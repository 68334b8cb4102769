import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from framelake.llm import simhash


def plain(text):
    words = [w.encode() for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@given(st.text(alphabet="aBÉß \t\n.", max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain(text)


def test_close_pairs_against_popcount():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**64, 150, dtype=np.uint64)
    b = np.concatenate([a[:70] ^ np.uint64(0b1011), a[70:90] ^ np.uint64(0b11111), r.integers(0, 2**64, 40, dtype=np.uint64)])
    for radius in (0, 1, 3, 4, 7):
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if int(a[i] ^ b[j]).bit_count() <= radius}
        assert set(zip(*(x.tolist() for x in simhash.close_pairs(a, b, radius)), strict=True)) == want


def components(values, radius):
    root = list(range(len(values)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def test_components_with_hot_groups(spark):
    """Chains, copies and one dense group larger than a tile."""
    r = np.random.default_rng(2)
    base = int(r.integers(0, 2**63))
    values = [base ^ (1 << int(x)) ^ (1 << int(y)) for x, y in r.integers(0, 64, (120, 2))]
    chain = int(r.integers(0, 2**63))
    for k in range(12):
        values.append(chain := chain ^ (0b1111 << 4 * k))
    values += [0, 0, 0b111] + [int(x) for x in r.integers(0, 2**63, 60)]
    want = components(values, 4)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long").withColumnRenamed("doc_id", "doc_id")
    prints = df.select("fingerprint").distinct().withColumnRenamed("fingerprint", "fp")
    small = simhash.fingerprint_links(prints, tile=16).collect()
    assert len(small) < 8 * len(values) * 8
    got = dict(simhash.near_duplicates(df).select("doc_id", "component_id").collect())
    assert [got[i] for i in range(len(values))] == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "a b", "z"), (3, "a  B", "z"), (3, "a  B", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(simhash.with_fingerprint(df)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1), (2, 1), (None, 3), (3, 3), (3, 3)], key=str)
    empty = df.limit(0)
    assert simhash.near_duplicates(simhash.with_fingerprint(empty)).count() == 0


def test_similar_texts(spark):
    """Groups by five-word shingles against all pairs, with copies that differ in case and blanks, and ties of ids."""
    import random

    r = random.Random(17)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = []
    for k in range(30):
        body = [word() for _ in range(r.choice([3, 60, 200]))]
        rows.append((10 * k, " ".join(body)))
        for x in range(1, r.randrange(1, 5)):
            own = list(body)
            for _ in range(r.choice([0, 1, 2, 12]) if len(body) > 3 else 0):
                own[r.randrange(len(own))] = word()
            rows.append((10 * k + x, ("  " if x % 2 else " ").join(own).upper() if x % 3 == 0 else " ".join(own)))
    rows += [(500, None), (501, ""), (None, rows[0][1]), rows[4], rows[4], (502, "long " * 30_000), (503, "Long " * 30_000)]
    df = spark.createDataFrame([(*x, "n") for x in rows], "doc_id long, text string, t string")
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in ((t or "").lower().split() for _, t in rows)]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                group = [group[b] if g == group[a] else g for g in group]
    want = {}
    for g, (k, _) in zip(group, rows, strict=True):
        want[g] = min(want.get(g, k), k) if k is not None and want.get(g) is not None else (want.get(g) if k is None else k)
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted((x["doc_id"] for x in got.collect()), key=str) == sorted(want.values(), key=str)
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_nearest_forest():
    a, b, d = np.array([0, 0, 1, 3]), np.array([1, 2, 2, 4]), np.array([5, 1, 1, 9])
    kept = simhash.nearest_forest(6, a, b, d)
    assert sorted(zip(a[kept], b[kept], strict=True)) == [(0, 2), (1, 2), (3, 4)]


def test_pairs_at_the_threshold(spark):
    """Pairs of exactly the similarity among texts that are alike to 0.77, and small ones that share a line with all others."""
    import random

    r = random.Random(23)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    base, line, rows = words(208), words(5), []
    for k in range(300):  # 208 of 260 shingles in both, or 8 of 10
        body, n = (base + words(4), 26) if k < 40 else (line + words(7), 1)
        rows += [(2 * k + x, " ".join(body + words(n))) for x in range(2)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    links = {(a, b) for a in range(600) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert links == {(2 * k + 1, 2 * k) for k in range(300)}
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"] for x in got} == set(range(0, 600, 2))


def test_parities():
    """Bits of two sets, folded to one width, differ in no more places than the sets in members."""
    r = np.random.default_rng(3)
    for n in (20, 60, 900, 20_000):
        a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: max(1, int(0.9 * n))], r.integers(0, 2**64, max(1, n // 20), dtype=np.uint64)]))
        z = simhash.size_class(np.array([len(a), len(b)]), 0.8)
        assert abs(z[0] - z[1]) <= 1
        bits = simhash.parity_bits(int(z.max()), 0.8)
        x, y = simhash._folded(simhash.pa.array([simhash.parities(s, 0.8) for s in (a, b)], "binary"), bits)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        assert np.isin(simhash.least_shingles(a, 0.8), simhash.least_shingles(b, 0.8)).any() or len(np.intersect1d(a, b)) < 0.8 * len(np.union1d(a, b))


def test_rest_tiles_return_links_not_pairs():
    """Texts of one tile that may all be alike: a link a text at most, that connect them; then exactly the links of the similarity."""
    import pyarrow as pa

    r, n = np.random.default_rng(3), 90
    core = r.integers(0, 1 << 63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([r.choice(core, 92, replace=False), r.integers(0, 1 << 63, 4).astype(np.uint64)])) for _ in range(n)]
    same = {"c": 0, "key": 1, "i": 0, "j": 0, "first": False}
    kinds = [("c", pa.int32()), ("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("first", pa.bool_())]
    sizes = [len(x) for x in sets]
    z = simhash.size_class(np.array(sizes), 0.8)
    rows = [{**same, "c": int(z[0]), "u": k, "k": bytes([k]), "r": k, "n": sizes[k], "z": int(z[k]), "sk": simhash.parities(x, 0.8)} for k, x in enumerate(sets)]
    schema = pa.schema([*kinds, ("u", pa.int64()), ("k", pa.binary()), ("r", pa.int64()), ("n", pa.int32()), ("z", pa.int32()), ("sk", pa.binary())])
    got = [x for b in simhash._rest_tiles(0.8)(iter([pa.RecordBatch.from_pylist(rows, schema)])) for x in b.to_pylist()]

    def groups(pairs):
        low = list(range(n))
        for a, b in pairs:
            low = [min(low[a], low[b]) if x in (low[a], low[b]) else x for x in low]
        return low

    want = [(a, b) for b in range(n) for a in range(b) if (m := len(np.intersect1d(sets[a], sets[b]))) >= 0.8 * (sizes[a] + sizes[b] - m)]
    assert 0 < len(got) < n < len(want)
    may = groups([(x["u"], x["v"]) for x in got])
    assert all(may[a] == may[b] for a, b in want)
    rows = [{**same, "k": bytes([k]), "r": k, "s": x.tobytes()} for k, x in enumerate(sets)]
    schema = pa.schema([*kinds, ("k", pa.binary()), ("r", pa.int64()), ("s", pa.binary())])
    got = [(x["u"][0], x["v"][0]) for b in simhash._similar_sets(0.8)(iter([pa.RecordBatch.from_pylist(rows, schema)])) for x in b.to_pylist()]
    assert len(got) < n and {tuple(sorted(x)) for x in got} <= set(want) and groups(got) == groups(want)


def test_least_shingles_with_frequent_ones_last():
    """Whatever comes last in the order of all sets, sets of the similarity share one of their least shingles."""
    r = np.random.default_rng(4)
    for n in (1, 5, 30, 400):
        common = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        a = np.unique(np.concatenate([common, r.integers(0, 2**64, n, dtype=np.uint64)]))
        b = np.setxor1d(a, r.choice(a, len(a) // 12, replace=False))
        b = np.unique(np.concatenate([b, r.integers(0, 2**64, len(a) // 12, dtype=np.uint64)]))
        assert len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
        for frequent in (common, np.sort(r.choice(common, (n + 1) // 2, replace=False)), a, np.zeros(0, np.uint64)):
            x, y = (simhash.least_shingles(s, 0.8, frequent) for s in (a, b))
            assert np.isin(x, y).any()


def test_frequent_shingles(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x b c d e f"), (3, None), (4, "lone words that nobody else has")], "t long, text string")
    found = simhash.frequent_shingles(df, 5)
    assert np.isin(simhash.shingle_set(b"b c d e f".split(), 5), found).all() and not np.isin(simhash.shingle_set(b"lone words that nobody else".split(), 5), found).any()
    assert not len(simhash.frequent_shingles(df.limit(0), 5))
