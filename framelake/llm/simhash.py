"""SimHash near-duplicates: bit-sliced comparison of 64-bit fingerprints.

Fingerprints that differ in at most r bits agree on at least B - r of B bit blocks. Every choice of B - r blocks is a
key; equal fingerprints are taken once; those with an equal key are compared in tiles. A tile stores one side as bit
planes, 64 fingerprints to a word, and counts differing bits of all lanes at once in carry-save counters. Rows whose
lanes have all passed the radius leave the tile early. A key that more rows share than a tile holds is cut into
blocks, and each pair of blocks is a tile of its own: work spreads over tasks and no pair is lost. A tile returns a
spanning set of its links, never all pairs.

A radius of a few bits of 64 holds little but copies. `one_of_each`, for shingles of five words and a similarity of 0.8,
takes 256 bits: texts of that similarity differ in 39 bits on the average, and texts that share nothing in 128. Keys
are then bands of bits, in a number that leaves one pair of SPLIT_MISS unfound; tiles compare bit planes as above; and
each link of a tile's nearest-first spanning forest is checked on the texts' shingles themselves. That brings large groups
together in a few links. What bits miss is found exactly: sets of that similarity share one of their least shingles (a
fifth of them and one), so texts of different groups that share such a shingle meet in tiles too. There, only pairs are
left out whose sizes or parity bits, a bit for each class of hashes, prove that they differ in too many shingles. The
order puts shingles last that are frequent in a sample, so that few texts meet for what many have in common. A tile
returns links that connect what is left, never all pairs; of each group that these make, the texts' shingles are
compared, all with all, in tiles once more, which return spanning links of the similarity.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from framelake.llm.common import checked_broadcast, group_bounds, key_runs, lean, ready, sliced, spanning_links, split_join, stored
from framelake.llm.components import connected_components

SEED = 42
TILE = 1024
#: Mean rows of a key above which fingerprints are cut into more blocks.
MEAN_KEY_ROWS = 4096
#: 64-bit words of a wide fingerprint, the share of pairs at the threshold that bands may miss, and rows of a band's key on the average.
WIDE, SPLIT_MISS, BAND_ROWS = 4, 0.005, 512
#: Parity bits that a text has at most.
PARITY_BITS = 1 << 15
#: Shingles of a row of a tile of sets; a text of more counts as several.
SET_SHINGLES = 1024
#: Texts, in expectation, that frequent shingles are counted in, and how many of these come last in a set's order.
FREQUENT_TEXTS, FREQUENT = 8000, 500_000


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # bytes: A-Z only, and ASCII blanks only


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of every `width` words in a row, or of all words of a shorter text."""
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[: n - 1] + 1)
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[len(words) - n :].tolist(), strict=True)), np.uint64, n)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Hashes (n x words) -> words: bit i is set where over half of the n hashes have it."""
    hashes = hashes.reshape(len(hashes), -1)
    n, counts = len(hashes), np.zeros(64 * hashes.shape[1], np.int64)
    for k in range(0, n, 4096):
        part = np.ascontiguousarray(hashes[k : k + 4096]).view(np.uint8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > n, bitorder="little").view("<u8")


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """The majority of the shingles' hashes; 0 if there is no word."""
    words = words_of(text)
    return int(majority(shingle_hashes(words, width))[0]) if words else 0


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Distinct 64-bit hashes of every `width` words in a row, or of all words of a shorter text; mixed from word hashes."""
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    h = np.full(n if width else 0, np.uint64(width))
    for j in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + one[j : j + n]
        h ^= h >> np.uint64(29)
    return np.unique(h)


def wide_fingerprint(shingles: np.ndarray) -> np.ndarray:
    """WIDE fingerprints of a set of shingles, each by hashes that are mixed anew; zeros if it is empty."""
    if not len(shingles):
        return np.zeros(WIDE, np.uint64)
    x = shingles[:, None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(1, WIDE + 1, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return majority(x ^ (x >> np.uint64(31)))


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", width: int = 4) -> DataFrame:
    """df with a long column out; a column of that name in df is replaced. Null text has no words."""
    kept = [c for c in df.columns if c != out]
    df = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = df.select("*", F.lit(0).cast("long").alias(out)).schema
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            found = np.fromiter((fingerprint(x.as_py(), width) for x in texts), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, out])

    return df.mapInArrow(lean(run), schema)


def _over(planes: np.ndarray, rows: np.ndarray, radius: int) -> np.ndarray:
    """Lanes (rows x words, bits) of planes (bits x words) that differ from each of rows (n x bits / 64) in more than radius bits."""
    need = max(1, radius.bit_length())
    n, (bits, words) = len(rows), planes.shape
    out = np.full((n, words), ~np.uint64(0))
    alive = np.arange(n)
    spread = (rows[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    masks = np.where(spread.reshape(n, bits).T, ~np.uint64(0), np.uint64(0))
    digits = [np.zeros((n, words), np.uint64) for _ in range(need)]
    full = np.zeros((n, words), np.uint64)  # lanes whose counter has run over
    for p in range(bits):
        carry = planes[p][None, :] ^ masks[p][alive][:, None]
        for d in digits:
            was = d & carry
            d ^= carry
            carry = was
        full |= carry
        if p == bits - 1 or (p % 8 == 7 and p > max(15, radius)):
            passed = full | _above(digits, radius)
            live = (passed != ~np.uint64(0)).any(axis=1)
            if p == bits - 1:
                out[alive] = passed
            elif not live.all():
                alive, full, digits = alive[live], full[live], [d[live] for d in digits]
                if not len(alive):
                    break
    return out


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose binary counter exceeds radius."""
    more, same = np.zeros_like(digits[0]), np.full_like(digits[0], ~np.uint64(0))
    for k in reversed(range(len(digits))):
        if radius >> k & 1:
            same &= digits[k]
        else:
            more |= same & digits[k]
            same &= ~digits[k]
    return more


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two uint64 arrays (a value a row, or a row of words each) that differ in at most radius bits."""
    a, b = a.reshape(len(a), -1), b.reshape(len(b), -1)
    if b.shape[1] > WIDE:  # so many planes cost more than counts of words
        step = max(1, (1 << 18) // max(1, b.size))
        parts = [np.bitwise_count(a[k : k + step, None] ^ b[None]).sum(axis=2, dtype=np.int32) <= radius for k in range(0, len(a), step)]
        return np.nonzero(np.concatenate(parts))
    lanes, bits = -(-len(b) // 64), 64 * b.shape[1]
    flags = np.zeros((bits, lanes * 64), bool)
    flags[:, : len(b)] = ((b[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).reshape(len(b), bits).T
    planes = np.packbits(flags, axis=1, bitorder="little").view("<u8")
    over = _over(planes, a, radius)
    near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(b)]
    return np.nonzero(near)


#: Rows of a group up to which its pairs join those of other groups in one comparison.
FEW = 24


def few_pairs(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray, sides: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs inside small groups that differ in at most radius bits; with sides, only pairs of a true and a false one.

    Pairs of all groups are the lanes of one bit-sliced comparison: planes of their differing bits are added up.
    """
    size = np.repeat(ends - starts, ends - starts)
    rows = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends, strict=True)]) if len(starts) else np.zeros(0, np.int64)
    left = size - (rows - np.repeat(starts, ends - starts))  # rows of the group from this one on
    us, vs = [], []
    for gap in range(1, int(size.max(initial=0))):
        a = rows[left > gap]
        b = a + gap
        if sides is not None:
            apart = sides[a] != sides[b]
            a, b = a[apart], b[apart]
        step = max(64, (1 << 18) // prints.shape[1])
        for k in range(0, len(a), step):
            x, y = a[k : k + step], b[k : k + step]
            near = ~_summed(prints[x] ^ prints[y], radius)
            us.append(x[near])
            vs.append(y[near])
    none = np.zeros(0, np.int64)
    return np.concatenate(us or [none]), np.concatenate(vs or [none])


def _summed(differ: np.ndarray, radius: int) -> np.ndarray:
    """Whether each of differ (n x words) has more than radius bits set: carry-save counters over bit planes, a lane a row; counts, if rows are long."""
    n = len(differ)
    if not n or differ.shape[1] > WIDE:
        return np.bitwise_count(differ).sum(axis=1, dtype=np.int32) > radius
    lanes = -(-n // 64)
    padded = np.zeros((lanes * 64, differ.shape[1]), np.uint64)
    padded[:n] = differ
    out = np.full(lanes, ~np.uint64(0))
    digits = [np.zeros(lanes, np.uint64) for _ in range(max(1, radius.bit_length()))]
    full, alive = np.zeros(lanes, np.uint64), np.arange(lanes)
    for w in range(differ.shape[1]):
        own = np.ascontiguousarray(padded[:, w]).reshape(lanes, 64)[alive]
        flags = np.unpackbits(own.view(np.uint8).reshape(len(alive), 64, 8), axis=2, bitorder="little")  # lanes x rows x bits
        planes = np.ascontiguousarray(np.packbits(flags.transpose(2, 0, 1), axis=2, bitorder="little")).view("<u8")[..., 0]  # bits x lanes
        for carry in planes:
            for d in digits:
                was = d & carry
                d ^= carry
                carry = was
            full |= carry
        passed = full | _above(digits, radius)
        live = passed != ~np.uint64(0)
        if w == differ.shape[1] - 1:
            out[alive] = passed
        elif not live.all():  # whole words of lanes are over the radius
            alive, full, digits = alive[live], full[live], [d[live] for d in digits]
            if not len(alive):
                break
    return np.unpackbits(out.view(np.uint8), bitorder="little")[:n].astype(bool)


def _close(piece: pa.Table, prints: np.ndarray, keys: list[str], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Close pairs of rows of sorted tiles, as (a, b): those of all small tiles at once, then tile by tile."""
    first, i, j = piece.column("first").to_numpy(), piece.column("i").to_numpy(), piece.column("j").to_numpy()
    starts, ends = group_bounds(piece, keys)
    own, size = i[starts] == j[starts], ends - starts
    for same in (True, False):
        few = (size > 1) & (size <= FEW) & (own == same)
        yield few_pairs(prints, starts[few], ends[few], None if same else first, radius)
    wide = size > FEW
    for s, e in zip(starts[wide], ends[wide], strict=True):
        if i[s] == j[s]:
            a, b = close_pairs(prints[s:e], prints[s:e], radius)
            yield s + a[a < b], s + b[a < b]
        else:
            left, right = s + np.flatnonzero(first[s:e]), s + np.flatnonzero(~first[s:e])
            if len(left) and len(right):
                a, b = close_pairs(prints[left], prints[right], radius)
                yield left[a], right[b]


def _tile_links(radius: int):
    keys = ["c", "key", "i", "j"]

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        fps = piece.column("fp").to_numpy().view(np.uint64)
        for a, b in _close(piece, fps.reshape(-1, 1), keys, radius):
            if len(a):
                rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                x, y = spanning_links(len(rows), at[: len(a)], at[len(a) :])
                yield pa.RecordBatch.from_arrays([pa.array(fps[rows[z]].view(np.int64)) for z in (x, y)], ["u", "v"])

    return lambda batches: key_runs(batches, keys, handle)


def blocks_for(n: int, radius: int) -> int:
    """The least number of bit blocks with which a key's expected rows stay near MEAN_KEY_ROWS."""
    b = radius + 1
    while b < 16 and n / 2 ** (64 * (b - radius) / b) > MEAN_KEY_ROWS:
        b += 1
    return b


def fingerprint_links(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """prints(fp long, distinct) -> links(u, v): connected exactly as all pairs within radius bits are."""
    blocks = blocks_for(prints.count(), radius)
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum(((1 << cuts[k + 1]) - (1 << cuts[k])) for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("c", "key"))
    dealt = tiled(keyed, ["fp"], ["fp"], tile)
    return dealt.mapInArrow(lean(_tile_links(radius)), "u long, v long")


def tiled(keyed: DataFrame, ident: list[str], columns: list[str], tile: int, wide: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Rows of (c, key) dealt to tiles (i, j): blocks of a key that has more rows than a tile holds, each with itself and each other.

    wide has more columns for each ident, which rows meet when they are dealt. weight: how many rows a row counts as.
    """
    keys = ["c", "key", "i", "j"]
    hot = keyed.groupBy("c", "key").agg((F.sum(weight) if weight else F.count("*")).alias("count")).where(F.col("count") > tile)
    parts = F.ceil(F.coalesce("count", F.lit(1)) / F.lit(tile)).cast("int")
    dealt = (
        keyed.join(hot, ["c", "key"], "left")
        .select("c", "key", *columns, parts.alias("m"))
        .withColumn("x", F.pmod(F.xxhash64(*ident), F.col("m")).cast("int"))
        .select("c", "key", *columns, "x", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("y"))
        .select("c", "key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), (F.col("x") < F.col("y")).alias("first"), *columns)
    )
    if wide is not None:
        dealt = dealt.join(wide, ident)
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", fp_col: str = "fingerprint", radius: int = 4) -> DataFrame:
    """df(id, fp) -> (id, fp, component_id): the smallest id reachable over links between fingerprints.

    Equal fingerprints are linked; rows with a null id take part and take the group's smallest id (null if it has none).
    Repeated rows stay as they are. A tie, a bit that half of the hashes have, is no set bit.
    """
    rows, _ = stored(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{fp_col}`").alias("fp")), "prints")
    prints, _ = stored(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n")), "distinct")
    total = prints.agg(F.sum("n")).head()[0] or 0
    linked, _ = stored(connected_components(fingerprint_links(prints.select("fp"), radius)).withColumnRenamed("node", "fp"), "linked")
    members = linked.count()
    roots = prints.join(linked, "fp").groupBy("root").agg(F.min("low").alias("least"), F.count("*").alias("members"))
    roots, _ = stored(roots, "roots")
    named = split_join(linked, roots, ["root"], "members", members).select("fp", "least")
    classes = prints.join(named, "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id"), "n")
    classes, _ = stored(classes, "classes")
    return split_join(rows, classes, ["fp"], "n", total).select(F.col("id").alias(id_col), F.col("fp").alias(fp_col), "component_id")


# --- similar texts: wide fingerprints, bands, and a check on the shingles


def bands_for(n: int, similarity: float) -> tuple[list[np.ndarray], int]:
    """(bits of each band, radius) for n fingerprints: of sets with this Jaccard similarity, SPLIT_MISS share no band at most."""
    apart = math.acos(2 * similarity / (1 + similarity)) / math.pi  # share of bits that differ, of sets of one size; else fewer
    bits = 64 * WIDE
    width = max(1, math.ceil(math.log2(max(2, n / BAND_ROWS))))
    count = math.ceil(math.log(SPLIT_MISS) / math.log(1 - (1 - apart) ** width))
    r = np.random.default_rng(SEED)
    order = np.concatenate([r.permutation(bits) for _ in range(-(-count * width // bits) + 1)])
    return [np.sort(order[k * width : (k + 1) * width]) for k in range(count)], math.ceil(bits * apart + 3.5 * math.sqrt(bits * apart * (1 - apart)))


def _banded(bands: list[np.ndarray]):
    """Rows (k, f0, f1, ...) -> a row for each band: c, key, k, f0, f1, ..."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            prints = np.stack([batch.column(f"f{k}").to_numpy() for k in range(WIDE)], axis=1).view(np.uint64)
            flags = ((prints[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).reshape(len(prints), -1).astype(np.int64)
            for c, at in enumerate(bands):
                key = flags[:, at] @ (1 << np.arange(len(at)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key), *batch.columns], ["c", "key", *batch.schema.names])

    return run


def nearest_forest(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Of links a-b among 0..n-1, those of a spanning forest with the least distances d, as indices."""
    order = np.lexsort((b, a, d))
    a, b, label, kept = a[order], b[order], np.arange(n), []
    at = np.arange(len(order))
    while True:
        x, y = label[a[at]], label[b[at]]
        at, x, y = at[x != y], x[x != y], y[x != y]
        if not len(at):
            return order[np.unique(np.concatenate(kept))] if kept else np.zeros(0, np.int64)
        best = np.full(n, len(order))
        np.minimum.at(best, x, at)
        np.minimum.at(best, y, at)
        chosen = np.unique(best[best < len(order)])
        kept.append(chosen)
        low = np.arange(n)
        u, v = spanning_links(n, label[a[chosen]], label[b[chosen]])
        low[u] = v
        label = low[label]


def _similar_tiles(radius: int):
    """Sorted tiles -> links (u, v) of each tile's nearest-first forest."""
    keys = ["c", "key", "i", "j"]

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        prints = np.stack([piece.column(f"f{k}").to_numpy() for k in range(WIDE)], axis=1).view(np.uint64)
        us, vs = [], []
        for a, b in _close(piece, prints, keys, radius):
            if len(a):
                rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                distance = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64)
                keep = nearest_forest(len(rows), at[: len(a)], at[len(a) :], distance)
                us.append(a[keep])
                vs.append(b[keep])
        if us:
            k = piece.column("k")
            u, v = (k.take(pa.array(np.concatenate(x))).combine_chunks() for x in (us, vs))
            yield pa.RecordBatch.from_arrays([x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (u, v)], ["u", "v"])

    return lambda batches: key_runs(batches, keys, handle)


def _similar(similarity: float):
    """Links with the shingle sets of both ends -> links of the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a"), batch.column("b"), strict=True):
                x, y = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def least_shingles(shingles: np.ndarray, similarity: float, frequent: np.ndarray | None = None) -> np.ndarray:
    """Of a sorted set, the least ones that it shares one of with every set of this Jaccard similarity.

    frequent: sorted shingles that come behind all others. Any order that all sets have in common will do; with this one,
    what many texts have in common seldom brings them together.
    """
    if frequent is not None and len(frequent):
        last = frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles
        shingles = np.concatenate([shingles[~last], shingles[last]])
    return shingles[: len(shingles) - math.ceil(similarity * len(shingles) - 1e-6) + 1]


def frequent_shingles(texts: DataFrame, width: int) -> np.ndarray:
    """Sorted shingles that several of some FREQUENT_TEXTS texts(t, text) have, FREQUENT at most, the most frequent ones.

    The texts are those whose hash t falls in a share of all hashes; a task counts equal texts once. What is found decides
    on speed alone.
    """
    share = min(1.0, FREQUENT_TEXTS / max(1, texts.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in sliced(batches):
            found = []
            for t, x in zip(batch.column("t").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                if t not in seen:
                    seen.add(t)
                    found.append(shingle_set(words_of(x.as_py()), width))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["s"])

    some = texts.where(F.pmod(F.xxhash64("t"), F.lit(1 << 40)) < int(share * (1 << 40))).select("t", "text")
    counts = some.mapInArrow(lean(run), "s long").groupBy("s").agg(F.count("*").alias("n")).where("n > 1")
    return np.sort(counts.orderBy(F.desc("n"), "s").limit(FREQUENT).select("s").toArrow().column("s").to_numpy().view(np.uint64))


def size_class(n, similarity: float) -> np.ndarray:
    """Classes of set sizes; sizes of sets of this similarity are in one or in two that follow each other."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(1.01 / similarity)).astype(np.int64)


def parity_bits(c: int, similarity: float) -> int:
    """Parity bits in tiles of sizes of class c and the one before it: about as many as shingles."""
    return min(PARITY_BITS, 1 << max(6, math.ceil(c * math.log2(1.01 / similarity))))


def parities(shingles: np.ndarray, similarity: float) -> bytes:
    """Of each class of hashes, whether the set has an odd number; two sets differ in as many shingles as bits at least."""
    bits = parity_bits(int(size_class(len(shingles), similarity)) + 1, similarity)
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()


def _folded(column: pa.Array, bits: int) -> np.ndarray:
    """Parities of `bits` or of twice as many classes -> rows of words for `bits`."""
    words, found = bits // 64, column.to_pylist()
    out, wide = np.empty((len(found), words), np.uint64), np.fromiter((len(x) * 8 > bits for x in found), bool, len(found))
    out[~wide] = np.frombuffer(b"".join(x for x, w in zip(found, wide, strict=True) if not w), "<u8").reshape(-1, words)
    both = np.frombuffer(b"".join(x for x, w in zip(found, wide, strict=True) if w), "<u8").reshape(-1, 2 * words)
    out[wide] = both[:, :words] ^ both[:, words:]
    return out


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, u, r, z) sorted by key -> (c, key, u, r): each in tiles of two classes of sizes, where these have rows of another r."""

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        starts, ends = group_bounds(piece, ["key"])
        r = piece.column("r").to_numpy()
        some = np.minimum.reduceat(r, starts) < np.maximum.reduceat(r, starts)
        if not some.any():
            return
        rows = np.flatnonzero(np.repeat(some, ends - starts))
        key, u, r, z = (piece.column(x).to_numpy()[rows] for x in ("key", "u", "r", "z"))
        c, at = np.concatenate([z, z + 1]), np.tile(np.arange(len(rows)), 2)
        order = np.lexsort((c, key[at]))
        c, at = c[order], at[order]
        new = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (key[at[1:]] != key[at[:-1]])))
        some = np.minimum.reduceat(r[at], new) < np.maximum.reduceat(r[at], new)
        keep = np.repeat(some, np.diff(np.append(new, len(at))))
        at = at[keep]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (c[keep].astype(np.int32), key[at], u[at], r[at])], ["c", "key", "u", "r"])

    return key_runs(batches, ["key"], handle)


def _rest_tiles(similarity: float):
    """Sorted tiles of texts (u, r, n, z, sk) -> links (u, v): as connected as all pairs of different r that may have the similarity."""
    keys, least = ["c", "key", "i", "j"], (1 - similarity) / (1 + similarity)

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        starts, ends = group_bounds(piece, ["c"])
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            part = piece.slice(s, e - s).combine_chunks()
            c = part.column("c")[0].as_py()
            u, r, n = part.column("u").to_numpy(), part.column("r").to_numpy(), part.column("n").to_numpy().astype(np.int64)
            lower = part.column("z").to_numpy() < c
            prints = _folded(part.column("sk").combine_chunks(), parity_bits(c, similarity))
            radius = math.floor(least * 2 * math.ceil((1.01 / similarity) ** (c + 1)) + 1e-6)
            for a, b in _close(part, prints, keys, radius):
                if not len(a):
                    continue
                small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
                may = (r[a] != r[b]) & ~(lower[a] & lower[b]) & (small >= similarity * large - 1e-6)
                a, b, sizes = a[may], b[may], (small + large)[may]
                may = np.zeros(len(a), bool)
                step = max(64, (1 << 20) // prints.shape[1])
                for at in range(0, len(a), step):
                    differ = np.bitwise_count(prints[a[at : at + step]] ^ prints[b[at : at + step]]).sum(axis=1, dtype=np.int64)
                    may[at : at + step] = differ <= least * sizes[at : at + step] + 1e-6
                if may.any():
                    own, at = np.unique(np.concatenate([u[a[may]], u[b[may]]]), return_inverse=True)
                    x, y = spanning_links(len(own), at[: len(at) // 2], at[len(at) // 2 :])
                    yield pa.RecordBatch.from_arrays([pa.array(own[x]), pa.array(own[y])], ["u", "v"])

    return lambda batches: key_runs(batches, keys, handle)


def _shared(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set, how many members it shares with each of them."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(at, kind="stable")
    ends = np.cumsum(np.bincount(at))
    starts, holders, to = np.append(0, ends[:-1]), owner[order], np.cumsum([0, *map(len, sets)])
    for k in range(len(sets)):
        members = at[to[k] : to[k + 1]]
        sizes = ends[members] - starts[members]
        places = np.arange(sizes.sum()) + np.repeat(starts[members] - np.append(0, np.cumsum(sizes)[:-1]), sizes)
        yield np.bincount(holders[places], minlength=len(sets))


def _similar_sets(similarity: float):
    """Sorted tiles of texts (k, r, s) -> links (u, v) of the similarity between different r, as connected as all of them."""
    keys = ["c", "key", "i", "j"]

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        k, r, first = piece.column("k").to_pylist(), piece.column("r").to_numpy(), piece.column("first").to_numpy()
        across = piece.column("i").to_numpy() != piece.column("j").to_numpy()
        us, vs = [], []
        for s, e in zip(*(x.tolist() for x in group_bounds(piece, keys)), strict=True):
            sets = [np.frombuffer(x, np.uint64) for x in piece.column("s").slice(s, e - s).to_pylist()]
            sizes, label = np.array([len(x) for x in sets]), r[s:e].copy()
            if (label == label[0]).all():
                continue
            for x, both in enumerate(_shared(sets)):
                near = (label != label[x]) & (both >= similarity * (sizes + sizes[x] - both))
                if across[s]:
                    near &= first[s:e] != first[s + x]
                for y in np.flatnonzero(near).tolist():
                    if label[x] != label[y]:
                        us.append(k[s + x])
                        vs.append(k[s + y])
                        label[label == label[y]] = label[x]
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])

    return lambda batches: key_runs(batches, keys, handle)


def _rest(prints: DataFrame, linked: DataFrame, similarity: float, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links between texts of different groups that have the similarity, whatever their fingerprints say; as connected as all."""
    members, _ = stored(linked.withColumnRenamed("node", "k").join(prints.select("k", "u"), "k").select("u", "root"), "members")
    roots = members.groupBy("root").agg(F.min("u").alias("r"), F.count("*").alias("n"))
    groups, _ = stored(split_join(members, roots, ["root"], "n", members.count()).select("u", "r"), "groups")
    least = prints.select("u", "z", "pre").join(groups, "u", "left").select("u", F.coalesce("r", "u").alias("r"), "z", F.explode("pre").alias("key"))
    # sorted, not aggregated: nearly every shingle is in one text alone, and a hash table of them all takes much memory
    tied = least.repartition("key").sortWithinPartitions("key").mapInArrow(lean(_across), "c int, key long, u long, r long")
    tied, _ = stored(tied, "tied")
    tiles = tiled(tied, ["u"], ["u", "r"], TILE, prints.select("u", "n", "z", "sk"))
    may, _ = stored(connected_components(tiles.mapInArrow(lean(_rest_tiles(similarity)), "u long, v long")).toDF("u", "key"), "may")
    size = F.ceil(F.col("n") / F.lit(SET_SHINGLES)).alias("w")
    texts = may.join(prints.select("u", "k", "n"), "u").join(groups, "u", "left")
    texts, _ = stored(texts.select(F.lit(0).alias("c"), "key", "k", F.coalesce("r", "u").alias("r"), F.greatest(size, F.lit(1)).alias("w")), "texts")
    tiles = tiled(texts, ["k"], ["k", "r"], TILE, sets_of(texts.select("k")), "w")
    return stored(tiles.mapInArrow(lean(_similar_sets(similarity)), "u binary, v binary"), "similar")[0]


def similar_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """df -> rows(id, t, k), a row a row of df, and links(node, root) between the texts k of groups of similar texts.

    t is XXH64 of the text, k names its lower-cased words; texts with equal words have one k. Two texts are linked if
    their sets of `width`-word shingles have this Jaccard similarity at least; groups are exactly those of all such links.
    """
    spark = df.sparkSession
    ready(spark)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("t"), F.col(f"`{text}`").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(texts, width))
    schema = texts.select("id", "t").schema.add("k", "binary")
    for n in range(WIDE):
        schema = schema.add(f"f{n}", "long")
    schema = schema.add("n", "integer").add("z", "integer").add("pre", ArrayType(LongType())).add("sk", "binary")

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            names, prints, sizes, least, odd = [], [], [], [], []
            for x in batch.column("text").cast(pa.binary()):
                words = words_of(x.as_py())
                names.append(xxhash.xxh3_128_digest(b" ".join(words)))
                shingles = shingle_set(words, width)
                prints.append(wide_fingerprint(shingles))
                sizes.append(len(shingles))
                least.append(least_shingles(shingles, similarity, frequent.value).view(np.int64))
                odd.append(parities(shingles, similarity))
            found = np.array(prints, np.uint64).reshape(-1, WIDE).view(np.int64)
            classes = size_class(np.array(sizes, np.int64), similarity)
            sets = [pa.array(sizes, pa.int32()), pa.array(classes, pa.int32()), pa.array(least, pa.list_(pa.int64())), pa.array(odd, pa.binary())]
            columns = [batch.column("id"), batch.column("t"), pa.array(names, pa.binary()), *(pa.array(found[:, n]) for n in range(WIDE)), *sets]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    rows, _ = stored(texts.mapInArrow(lean(printed), schema), "prints")
    ends = [f"f{n}" for n in range(WIDE)]
    of_each = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("first")
    own = [F.first(c).alias(c) for c in (*ends, "n", "z", "pre", "sk")]
    prints = rows.groupBy("k").agg(of_each, *own).withColumn("u", F.monotonically_increasing_id())
    prints, _ = stored(prints, "distinct")
    bands, radius = bands_for(prints.count(), similarity)
    kinds = ", ".join(f"{f} long" for f in ends)
    keyed = prints.select("k", *ends).mapInArrow(lean(_banded(bands)), f"c int, key long, k binary, {kinds}")
    near = tiled(keyed, ["k"], ["k", *ends], TILE).mapInArrow(lean(_similar_tiles(radius)), "u binary, v binary")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [shingle_set(words_of(x.as_py()), width).tobytes() for x in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(found, pa.binary())], ["k", "s"])

    def sets_of(ids: DataFrame) -> DataFrame:
        """The shingles s of texts k."""
        met, _ = stored(ids.join(prints.select("k", "first"), "k").select("k", F.col("first.id").alias("own"), F.col("first.t").alias("hash")), "met")
        n_met = met.count()
        there = texts.join(checked_broadcast(met, n_met), F.col("id").eqNullSafe(F.col("own")) & (F.col("t") == F.col("hash")))
        sets = there.select("k", "text").mapInArrow(lean(shingled), "k binary, s binary")
        return stored(sets.groupBy("k").agg(F.first("s").alias("s")), "sets")[0]

    def checked(near: DataFrame) -> DataFrame:
        """Those of the pairs whose sets have the similarity."""
        near, _ = stored(near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "near")
        sets = sets_of(near.select(F.col("u").alias("k")).union(near.select("v")).distinct())
        pairs = near.join(sets.toDF("u", "a").hint("merge"), "u").join(sets.toDF("v", "b").hint("merge"), "v")
        return stored(pairs.select("u", "v", "a", "b").mapInArrow(lean(_similar(similarity)), "u binary, v binary"), "similar")[0]

    linked, _ = stored(connected_components(checked(near)), "linked")
    more = _rest(prints, linked, similarity, sets_of)
    if not more.isEmpty():
        linked = connected_components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
    return rows.select("id", "t", "k"), linked


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """df without near-duplicates: of each group of similar texts the row with the least id stays.

    Null ids come last; of rows with one id the one with the least XXH64 of its text stays, and of repeated rows one.
    Texts without words, null and empty, are one group. What goes is decided on narrow rows; texts meet the list of rows
    that go, broadcast if it is small, else in one merge join.
    """
    rows, linked = similar_texts(df, id_col, text, width, similarity)
    linked, _ = stored(linked.withColumnRenamed("node", "k"), "linked")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "t")
    alone, _ = stored(rows.groupBy("k").agg(F.min(first).alias("first"), F.count("*").alias("n")), "texts")
    roots, _ = stored(alone.join(linked, "k").groupBy("root").agg(F.min("first").alias("stays"), F.count("*").alias("n")), "groups")
    named = split_join(linked, roots, ["root"], "n", linked.count()).select("k", "stays")
    classes, _ = stored(alone.join(named, "k", "left").select("k", F.coalesce("stays", "first").alias("stays"), "n"), "classes")
    # a text that stands once and stays needs no second look
    more = classes.join(alone.select("k", "first"), "k").where("n > 1 OR first <> stays").select("k", "stays", "n")
    judged = split_join(rows, more, ["k"], "n", rows.count())
    same = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("t") == F.col("stays.t"))
    found, _ = stored(judged.groupBy("id", "t").agg(F.max(same).alias("stays"), F.count("*").alias("n")).where("NOT stays OR n > 1"), "judged")
    n_found = found.count()
    marks = found.select(F.col("id").alias("__own"), F.col("t").alias("__hash"), F.col("stays").alias("__stays"))
    own = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(*own, F.xxhash64(F.col(f"`{text}`")).alias("__t"))
    meets = F.col(f"`{id_col}`").eqNullSafe(F.col("__own")) & (F.col("__t") == F.col("__hash"))
    kept = keyed.join(checked_broadcast(marks.select("__own", "__hash"), n_found), meets, "left_anti").select(*own)
    repeated = marks.where("__stays")
    n_repeated = repeated.count()
    if not n_repeated:
        return kept
    # rows that repeat with all of id and text: one of each
    again = keyed.join(checked_broadcast(repeated.select("__own", "__hash"), n_repeated), meets, "left_semi")
    one = again.groupBy(id_col, "__t").agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("__row"))
    return kept.union(one.select(*[F.col("__row")[c].alias(c) for c in df.columns]))
