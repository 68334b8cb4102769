"""Substring dedup by collinear chaining: repeated passages, edits included.

Each text is a sequence of words. Hashes of k consecutive words, thinned to the least one of every `window` of them,
are its seeds; texts that share k + window - 1 words in a row share a seed. A seed meets its first place in the corpus
(least text, least position), so a seed that many texts share costs a row each, not a row a pair. Seeds that a text
shares with another text are chained in order in both: a Fenwick tree over positions in the other text gives each
seed its best predecessor, under a cost linear in the gaps. Chains are aligned on the texts: gaps between seeds word
by word, and both ends outward until mismatches outweigh matches. Alignments of `min_words` words and `identity` are
passages.

A seed's first place may be in a text that shares little else: then what two later texts share is in no chain. So places
of a seed that no passage ties to its first one meet all its other places, in tiles: the words around them are extended
over edits, and of those that make a passage a tile returns a spanning set of links, never all pairs. Texts that share
a seed in words like enough are linked so, whatever else their seeds stand in, equal or edited.

Equal texts go under one hash of the text and are processed once after seeding; a copy's passage is the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import BROADCAST_ROWS, checked_broadcast, group_bounds, key_runs, sliced, stored
from framelake.llm.simhash import FEW, TILE, tiled

K, WINDOW = 6, 16
GAP_COST = 0.05
LOOK = 8  # words that an extension may look at beyond its place
EDIT = 4  # words that an edit steps over at most
#: Words beyond a chain's ends that an alignment looks at first; where it comes to the end of these, it is made anew on whole texts.
REACH = 512
#: Bits of the set of words around a place of a seed.
BAG = 1024


def tokens(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.lower().split()


def _hashes(one: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words, of the words' hashes."""
    m = max(0, len(one) - k + 1)
    h = np.zeros(m, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + one[j : j + m]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _least_places(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the least value, the first of equal ones, of each `window` values."""
    at, width = np.arange(len(h)), 1
    while width < window:
        step = min(width, window - width)
        less = h[step:] < h[:-step]
        at = np.where(less, at[step:], at[:-step])
        h, width = np.where(less, h[step:], h[:-step]), width + step
    return at


def seeds(words: list[bytes], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the thinned k-word seeds of a text; runs of up to k words over and over begin and end with one."""
    m = len(words) - k + 1
    if m < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = _hashes(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), k)
    if m <= window:
        at = np.array([int(h.argmin())])
    else:
        at = np.unique(_least_places(h, window))
    for d in range(1, min(k + 1, m)):
        like = np.flatnonzero(h[d:] == h[:-d])
        if len(like):
            at = np.union1d(at, np.concatenate([np.setdiff1d(like, like + d), np.setdiff1d(like + d, like)]))
    return at, h[at].view(np.int64)


def seeds_of(texts: list[list[bytes]], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, place, hash) of the seeds of many texts, as `seeds` has them of each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin, total = np.cumsum(sizes) - sizes, int(sizes.sum())
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, (w for words in texts for w in words)), np.uint64, total)
    h = _hashes(one, k)
    m = np.maximum(sizes - k + 1, 0)  # seeds that a text may have
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(h)]
    left = (begin + m)[owner] - np.arange(len(h))  # those of a place's text from it on
    mark = np.zeros(len(h), bool)
    if len(h) >= window:
        least = _least_places(h, window)
        mark[least[left[: len(least)] >= window]] = True
    for s, n in zip(begin[(m > 0) & (m < window)].tolist(), m[(m > 0) & (m < window)].tolist(), strict=True):
        mark[s + int(h[s : s + n].argmin())] = True
    for d in range(1, min(k + 1, len(h))):
        like = np.zeros(len(h) + d, bool)  # d places on
        like[d:-d] = (h[d:] == h[:-d]) & (left[:-d] > d)
        here, before = like[d:], like[:-d]
        mark |= here != before
    at = np.flatnonzero(mark)
    return owner[at], at - begin[owner[at]], h[at].view(np.int64)


def occurrences(h: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """How many equal values (of the same owner) stand before each."""
    if owner is None:
        order = np.argsort(h, kind="stable")
        first = np.append(True, h[order][1:] != h[order][:-1])[: len(h)]
    else:
        order = np.lexsort((h, owner))
        first = np.append(True, (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1]))[: len(h)]
    place = np.arange(len(h))
    out = np.empty(len(h), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return out


def seed_keys(words: list[bytes], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, key, fresh) of a text's seeds.

    A seed that stands in a text before has its hash as key, and a second key of hash and occurrence: so in runs of like
    words, too, n-th places meet n-th places. fresh marks one place for each key.
    """
    return _keyed(*seeds(words, k, window))


def _keyed(at: np.ndarray, h: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = occurrences(h) if n is None else n
    more = n > 0
    second = (h[more].view(np.uint64) ^ n[more].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
    return np.concatenate([at, at[more]]), np.concatenate([h, second]), np.concatenate([~more, np.ones(len(second), bool)])


def inner(at: np.ndarray, h: np.ndarray, k: int, owner: np.ndarray) -> np.ndarray:
    """Seeds between two like them at equal distances of k at most: inside a run of a few words over and over.

    Runs of two texts that are shifted against each other have no more in common than with their first or last places
    at one place.
    """
    order = np.lexsort((at, h, owner))
    gap = np.where((np.diff(h[order]) == 0) & (np.diff(owner[order]) == 0), np.diff(at[order]), 0)
    out = np.zeros(len(at), bool)
    out[order[1:-1]] = (gap[1:] == gap[:-1]) & (gap[1:] > 0) & (gap[1:] <= k)
    return out


def chains(pb: np.ndarray, pa_: np.ndarray, k: int = K) -> list[list[int]]:
    """Index lists of collinear chains over anchors (pb not falling, pa_): each anchor in one chain, best chains first."""
    n = len(pb)
    _, ranks = np.unique(pa_, return_inverse=True)
    size = int(ranks.max()) + 1
    tree = [(-np.inf, -1)] * (size + 1)
    score, back, waiting = np.empty(n), np.full(n, -1), []

    def settle() -> None:
        for i in waiting:
            put, r = (score[i] + GAP_COST * (int(pb[i]) + int(pa_[i])), i), int(ranks[i]) + 1
            while r <= size:
                if tree[r] < put:
                    tree[r] = put
                r += r & -r
        waiting.clear()

    for i in range(n):
        if i and pb[i] != pb[i - 1]:
            settle()  # anchors at one place don't follow each other
        diagonal = GAP_COST * (int(pb[i]) + int(pa_[i]))
        best, r = (-np.inf, -1), int(ranks[i])
        while r > 0:
            best = max(best, tree[r])
            r -= r & -r
        gain = best[0] - diagonal
        score[i] = k + max(0.0, gain)
        back[i] = best[1] if gain > 0 else -1
        waiting.append(i)
    used, found = np.zeros(n, bool), []
    for i in np.argsort(-score, kind="stable"):
        chain, i = [], int(i)
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = int(back[i])
        if chain:
            found.append(chain[::-1])
    return found


def _edit(b, a, i: int, j: int) -> tuple[int, int]:
    """Fewest words of b and a, of both or of one, after which three are equal; one of both if there are none."""
    u, v, n_b, n_a = b[i], a[j], len(b), len(a)
    for n in range(1, EDIT + 1):
        x, y = i + n, j + n
        if x < n_b:
            if y < n_a and b[x] == a[y] and b[x : x + 3] == a[y : y + 3]:
                return n, n
            if b[x] == v and b[x : x + 3] == a[j : j + 3]:
                return n, 0
        if y < n_a and a[y] == u and b[i : i + 3] == a[y : y + 3]:
            return 0, n
    return 1, 1


def _outward(b, a) -> tuple[int, int, int, int]:
    """Longest worthwhile extension: (length in b, in a, matches, words of b seen); a match is worth 1, each word of an edit costs 2.

    An edit is stepped over by the fewest words, of both or of one, after which three are equal.
    """
    i = j = best = score = matches = 0
    out, n_b, n_a = (0, 0, 0), len(b), len(a)
    while i < n_b and j < n_a:
        if b[i] == a[j]:
            n, most = 1, min(n_b - i, n_a - j)
            while n + 8 <= most and b[i + n : i + n + 8] == a[j + n : j + n + 8]:
                n += 8
            while n < most and b[i + n] == a[j + n]:
                n += 1
            i, j, score, matches = i + n, j + n, score + n, matches + n
            if score > best:
                best, out = score, (i, j, matches)
            continue
        x, y = _edit(b, a, i, j)
        i, j, score = i + x, j + y, score - 2 * max(x, y)
        if score < best - 8:
            break
    return *out, i + LOOK


def align(b: list, a: list, pb: list[int], pa_: list[int], k: int = K) -> tuple[int, int, int, int, int, int, int]:
    """(b from, b to, a from, a to, equal words) of the passage around anchors, and the range of b that was looked at."""
    same, last_b, last_a = 0, pb[0], pa_[0]
    for x, y in zip(pb, pa_, strict=True):
        if x > last_b or y > last_a:
            left, right = b[last_b : max(x, last_b)], a[last_a : max(y, last_a)]
            same += len(left) if left == right else sum(m.size for m in SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks())
        fresh = min(x + k - max(x, last_b), y + k - max(y, last_a))  # anchors may overlap
        same += max(0, fresh)
        last_b, last_a = max(last_b, x + k), max(last_a, y + k)
    first_b, first_a = pb[0], pa_[0]
    up_b, up_a, more, up = _outward(b[last_b:], a[last_a:])
    down_b, down_a, less, down = _outward(b[:first_b][::-1], a[:first_a][::-1])
    return first_b - down_b, last_b + up_b, first_a - down_a, last_a + up_a, same + more + less, first_b - down, last_b + up


def _chain_rows(k: int, window: int, min_words: int):
    """All chains. weak: a lone seed, or seeds so near to each other that without edits more would follow in a passage of min_words."""
    keys, tail = ["tb", "ta"], 2 * (window + k - 2)

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        tb, ta, pb, pa_ = (piece.column(c).to_numpy() for c in ("tb", "ta", "pb", "pa"))
        starts, ends = group_bounds(piece, keys)
        lone = starts[ends - starts == 1]  # most groups: their arrays are made at once
        if len(lone):
            yield _chains(tb[lone], ta[lone], np.ones(len(lone), np.int64), pb[lone], pa_[lone], np.ones(len(lone), bool))
        owner, sizes, order, weak = [], [], [], []
        many = ends - starts > 1
        for s, e in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
            x, y = pb[s:e], pa_[s:e]
            for c in chains(x, y, k):
                owner.append(s)
                sizes.append(len(c))
                order += [s + i for i in c]
                weak.append(len(c) < 2 or bool(x[c[-1]] - x[c[0]] + k + tail < min_words))
            if len(order) > 100_000:
                yield _chains(tb[owner], ta[owner], np.array(sizes), pb[order], pa_[order], np.array(weak))
                owner, sizes, order, weak = [], [], [], []
        if owner:
            yield _chains(tb[owner], ta[owner], np.array(sizes), pb[order], pa_[order], np.array(weak))

    return lambda batches: key_runs(batches, keys, handle)


def _chains(tb: np.ndarray, ta: np.ndarray, sizes: np.ndarray, pb: np.ndarray, pa_: np.ndarray, weak: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(p.astype(np.int32))) for p in (pb, pa_)]
    return pa.RecordBatch.from_arrays([pa.array(tb), pa.array(ta), *lists, pa.array(weak)], ["tb", "ta", "pb", "pa", "weak"])


def _side(k: int, min_words: int) -> int:
    """Words beside a seed, as far as min_words may need with edits."""
    return min_words - k + EDIT


def _around(k: int, min_words: int):
    """Texts with places of seeds -> a byte for each of the words before and after each."""
    side = _side(k, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 100):
            t, places, before, after = [], [], [], []
            for own, at, text in zip(batch.column("t"), batch.column("at"), batch.column("text").cast(pa.binary()), strict=True):
                words = tokens(text.as_py())
                marks = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).astype(np.uint8).tobytes()
                for p in at.as_py():
                    t.append(own.as_py())
                    places.append(p)
                    before.append(marks[max(0, p - side) : p][::-1])
                    after.append(marks[p + k : p + k + side])
            columns = [pa.array(t, pa.int64()), pa.array(places, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["t", "p", "before", "after"])

    return run


def _rows_of(around: list[bytes], width: int, kind: type = np.uint32) -> np.ndarray:
    """Words around places, a number of this kind each, as rows of numbers from 1 on that end with zeros."""
    sizes = np.fromiter(map(len, around), np.int64, len(around)) // np.dtype(kind).itemsize
    out = np.zeros((len(around), width), np.uint32)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(around), kind).astype(np.uint32) + np.uint32(1)
    return out


def _straight(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal words that rows begin with, and whether `_outward` ends with these: no edit, nor words left out, has it go on."""
    unlike = (x != y) | (x == 0)
    n = unlike.argmax(axis=1)
    at = np.minimum(n[:, None] + np.arange(EDIT + 3), x.shape[1] - 1)
    b, a = np.take_along_axis(x, at, 1), np.take_along_axis(y, at, 1)
    on = (b[:, 1 : EDIT + 1] == a[:, 1 : EDIT + 1]).any(axis=1)  # 8 points are lost with EDIT words
    for step in range(1, EDIT + 1):
        for v, w in ((b, a), (a, b)):
            like = v[:, step:] == w[:, :-step]
            on |= (like[:, :-2] & like[:, 1:-1] & like[:, 2:]).any(axis=1)
    return n, ~on | (b[:, 0] == 0) | (a[:, 0] == 0)


def _reaching(k: int, min_words: int):
    """Weak chains whose first seed extends to min_words in both texts."""
    width = _side(k, min_words) + EDIT + 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 5000):
            b0, b1, a0, a1 = (batch.column(c).to_pylist() for c in ("before", "after", "before_a", "after_a"))
            (down, no_edit), (up, nor_here) = (_straight(*(_rows_of(v, width, np.uint8) for v in x)) for x in ((b0, a0), (b1, a1)))
            keep = down + up + k >= min_words
            for x in np.flatnonzero(~(keep | (no_edit & nor_here))).tolist():
                lower, upper = _outward(b0[x], a0[x]), _outward(b1[x], a1[x])
                keep[x] = min(lower[0] + upper[0], lower[1] + upper[1]) + k >= min_words
            yield batch.select(["tb", "ta", "pb", "pa"]).filter(pa.array(keep))

    return run


def _contexts(k: int, side: int):
    """Texts with places of seeds -> `side` words before each, last first, and after each: a character of 20 bits a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 100):
            t, places, before, after = [], [], [], []
            for own, at, text in zip(batch.column("t"), batch.column("at"), batch.column("text").cast(pa.binary()), strict=True):
                words = tokens(text.as_py())
                marks = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                marks = (marks & np.uint64(0xFFFFF)).astype("<u4") + np.uint32(0x10000)
                for p in at.as_py():
                    t.append(own.as_py())
                    places.append(p)
                    before.append(marks[max(0, p - side) : p][::-1].tobytes())
                    after.append(marks[p + k : p + k + side].tobytes())
            columns = [pa.array(t, pa.int64()), pa.array(places, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["t", "p", "before", "after"])

    return run


def _bags(before: list[bytes], after: list[bytes], run: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Sets of (side, words, n-th such words) of each row, for each `run` words in a row, hashed to BAG bits, and how many of their members share a bit with others."""
    sizes = np.array([len(x) // 4 for x in (*before, *after)])
    side = np.repeat(np.arange(len(sizes)), sizes)
    mark = np.frombuffer(b"".join([*before, *after]), "<u4").astype(np.int64)
    if run == 2:
        mark, side = (mark[:-1] << 21 | mark[1:])[side[1:] == side[:-1]], side[1:][side[1:] == side[:-1]]
        mark = (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)).astype(np.int64)  # 40 bits
    nth = occurrences((side << 40) ^ mark)
    row = side % max(1, len(before))
    x = (mark.astype(np.uint64) << np.uint64(12)) + (nth.astype(np.uint64) << np.uint64(1)) + (side >= len(before)).astype(np.uint64)
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    flags = np.zeros((len(before), BAG), bool)
    flags[row, (x >> np.uint64(40)).astype(np.int64) % BAG] = True
    bits = np.packbits(flags, axis=1, bitorder="little").view("<u8")
    return bits, np.bincount(row, minlength=len(before)) - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _ties(k: int, min_words: int, identity: float):
    """Sorted tiles of a seed's places (t, p, own, words around) -> links (tb, ta, pb, pa) that make passages, as connected as all.

    Places that are not own are tied to the seed's first place already. Extensions to min_words, whose words match
    twice for each word of an edit, have two thirds of the words beyond the seed in common, and as many as identity
    asks. On a side with m equal words, edits are (m - 1) / 2 at most, and runs of equal words one more: so at least
    (m - 1) / 2 pairs of neighbours are in common as well. Where no edit goes on, as between runs of like words, the
    equal words beside the seed tell the passage. So few pairs are extended word by word.
    """
    keys = ["c", "key", "i", "j"]
    common = max(-(-2 * (min_words - k) // 3), math.ceil(identity * min_words - k - 1e-6))
    least = (common, -(-(common - 2) // 2))

    def handle(piece: pa.Table) -> Iterator[pa.RecordBatch]:
        starts, ends = group_bounds(piece, keys)
        t, p, own, first, i, j = (piece.column(c).to_numpy() for c in ("t", "p", "own", "first", "i", "j"))
        before, after = (piece.column(c).to_pylist() for c in ("before", "after"))
        around = [_rows_of(x, _side(k, min_words) + EDIT + 3) for x in (before, after)]
        bags = []
        for run, n in zip((1, 2), least, strict=True):
            some = [_bags(before[x : x + 1000], after[x : x + 1000], run) for x in range(0, len(before), 1000)]
            bags.append((tuple(np.concatenate(x) for x in zip(*some, strict=True)), n))
        across = i != j
        tile = np.repeat(np.arange(len(starts)), ends - starts)
        label = np.where(own, np.arange(len(t)), -1 - tile)  # all that are not own are one
        links: list[tuple[int, int]] = []
        read: dict[int, tuple[str, str]] = {}

        def apart(a, b) -> np.ndarray:
            """Pairs that may make a passage and are not connected yet."""
            some = (label[a] != label[b]) & (t[a] != t[b]) & (~across[a] | (first[a] != first[b]))
            for (bits, clash), n in bags:
                x, y = a[some], b[some]
                some[some] = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64) >= n - np.minimum(clash[x], clash[y])
            x, y = a[some], b[some]
            (down, no_edit), (up, nor_here) = (_straight(w[x], w[y]) for w in around)
            some[some] = ~(no_edit & nor_here) | (down + up + k >= min_words)
            return some

        def words(x: int) -> tuple[str, str]:
            if x not in read:
                read[x] = before[x].decode("utf-32-le"), after[x].decode("utf-32-le")
            return read[x]

        def tie(x: int, y: int, s: int, e: int) -> None:
            if label[x] == label[y]:
                return
            if t[x] < t[y]:
                x, y = y, x
            down, up = (_outward(v, w) for v, w in zip(words(x), words(y), strict=True))
            b, a = (down[n] + up[n] + k for n in (0, 1))
            if min(b, a) >= min_words and down[2] + up[2] + k >= identity * max(b, a):
                links.append((x, y))
                own_labels = label[s:e]
                own_labels[own_labels == label[x]] = label[y]

        rows = np.arange(len(t))
        left = np.where((ends - starts)[tile] <= FEW, ends[tile] - rows, 0)  # rows of a small group from this one on
        for gap in range(1, int(left.max(initial=0))):
            a = rows[left > gap]
            a = a[apart(a, a + gap)]
            for x in a.tolist():
                tie(x, x + gap, int(starts[tile[x]]), int(ends[tile[x]]))
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s > FEW:
                many = max(1, 32768 // (e - s))  # rows at once: what they tie is known to the next ones
                for x in range(s, e - 1, many):
                    a, b = np.nonzero(label[x : x + many, None] != label[x:e])
                    a, b = a[a < b] + x, b[a < b] + x
                    some = apart(a, b)
                    for v, w in zip(a[some].tolist(), b[some].tolist(), strict=True):
                        tie(v, w, s, e)
        if links:
            x, y = np.array(links).T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (t[x], t[y], p[x], p[y])], ["tb", "ta", "pb", "pa"])

    return lambda batches: key_runs(batches, keys, handle)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a partition once, so that groups of copies shrink before anything is shuffled."""
    seen: set[int] = set()
    for batch in batches:
        t = batch.column("t").to_numpy()
        fresh = np.zeros(len(t), bool)
        fresh[np.unique(t, return_index=True)[1]] = True
        fresh &= np.fromiter((x not in seen for x in t.tolist()), bool, len(t))
        seen.update(t[fresh].tolist())
        yield batch if fresh.all() else batch.filter(pa.array(fresh))


def _cut(reach: int | None):
    """Of text b, the part that lies up to `reach` words beyond a pair's anchors, where it begins, and whether it is cut; all of it for None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 100):
            parts, froms, cuts = [], [], []
            of, words = None, []
            cols = (batch.column("tb").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("first").to_pylist(), batch.column("last").to_pylist())
            for tb, text, lo, hi in zip(*cols, strict=True):
                if tb != of:  # rows come by text
                    of, words = tb, tokens(text.as_py())
                lo, hi = (0, len(words)) if reach is None else (max(0, lo - reach), hi + K + reach)
                parts.append(b" ".join(words[lo:hi]))
                froms.append(lo)
                cuts.append(hi < len(words))
            names = ["tb", "ta", "c"]
            columns = [*(batch.column(c) for c in names), pa.array(parts, pa.binary()), pa.array(froms, pa.int32()), pa.array(cuts, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "part", "lo", "cut"])

    return run


def pair_passages(b: list, a: list, chains_: list[tuple[list[int], list[int]]], k: int, min_words: int, identity: float, cut: tuple[bool, bool] = (False, False)):
    """Passages (b0, b1, a0, a1, share) of two texts around chains, and the chains whose search came to an end of b that is cut.

    Chains go longest first, and one that lies inside a passage in both texts is part of it, or a repeat of its words a
    few places on: runs of like lines are aligned once, not on each of their diagonals. Where an alignment as a whole is
    no passage, the words near each of its seeds may be one.
    """
    found: list[tuple[int, int, int, int, float]] = []
    again, side = [], _side(k, min_words)
    for pb, pa_ in sorted(chains_, key=lambda c: (c[0][0] - c[0][-1], c[0], c[1])):
        if any(x[0] <= pb[0] and pb[-1] + k <= x[1] and x[2] <= min(pa_) and max(pa_) + k <= x[3] for x in found):
            continue
        b0, b1, a0, a1, same, first, last = align(b, a, pb, pa_, k)
        share = same / max(b1 - b0, a1 - a0)
        if (cut[0] and first < 0) or (cut[1] and last > len(b)):
            again.append((pb, pa_))
        if min(b1 - b0, a1 - a0) >= min_words and share >= identity:
            found.append((b0, b1, a0, a1, min(1.0, share)))
            continue
        for x, y in zip(pb, pa_, strict=True):
            if any(f[0] <= x and x + k <= f[1] and f[2] <= y and y + k <= f[3] for f in found):
                continue
            lo, lo_a = max(0, x - side), max(0, y - side)
            b0, b1, a0, a1, same, _, _ = align(b[lo : x + k + side], a[lo_a : y + k + side], [x - lo], [y - lo_a], k)
            share = same / max(b1 - b0, a1 - a0)
            if min(b1 - b0, a1 - a0) >= min_words and share >= identity:
                found.append((lo + b0, lo + b1, lo_a + a0, lo_a + a1, min(1.0, share)))
    return found, again


def _aligned(k: int, min_words: int, identity: float):
    """Pairs with texts -> passages; pairs that have to be looked at again on whole texts get one row, with all their chains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 100):
            rows, of, words = [], None, []
            cols = (batch.column(c) for c in ("tb", "ta", "c", "part", "lo", "cut"))
            for tb, ta, c, part, lo, cut, text in zip(*cols, batch.column("text").cast(pa.binary()), strict=True):
                lo, own = lo.as_py(), c.as_py()
                own_chains = [([p - lo for p in x["pb"]], x["pa"]) for x in own]
                if ta.as_py() != of:
                    of, words = ta.as_py(), tokens(text.as_py())
                found, again = pair_passages(part.as_py().split(), words, own_chains, k, min_words, identity, (lo > 0, cut.as_py()))
                if again:
                    rows.append((tb.as_py(), ta.as_py(), 0, 0, 0, 0, 0.0, own))
                else:
                    rows += [(tb.as_py(), ta.as_py(), b0 + lo, b1 + lo, a0, a1, share, None) for b0, b1, a0, a1, share in found]
            if rows:
                chain = pa.struct([("pb", pa.list_(pa.int32())), ("pa", pa.list_(pa.int32()))])
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64(), pa.list_(chain)]
                names = ["tb", "ta", "b0", "b1", "a0", "a1", "identity", "c"]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def repeated_passages(
    df: DataFrame, ident: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW, min_words: int = 50, identity: float = 0.8
) -> DataFrame:
    """df -> passages(ident, start_word, end_word, other, other_start, other_end, identity), ends exclusive.

    A row says that words start_word..end_word of a document repeat, with this share of equal words, at other_start..
    of the document with the least id that has the other text. A copy of a whole text has one row to the least id with
    that text; of copies, each has the text's other passages. A null text has no words; a null id stays null and is
    least of nothing. Words compare with A-Z lower-cased.
    """
    rows = df.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{ident}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("t"))
    rows, _ = stored(rows, "ids")
    texts = df.select(F.xxhash64(F.col(f"`{text}`")).alias("t"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    texts = texts.mapInArrow(_once, "t long, text string")

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            some: list[list[bytes]] = []
            begin, n = 0, 0
            for x in batch.column("text").cast(pa.binary()):
                some.append(tokens(x.as_py()))
                n += len(some[-1])
                if n > 50_000:
                    yield keyed(batch.column("t").to_numpy()[begin : begin + len(some)], some)
                    begin, n, some = begin + len(some), 0, []
            if some:
                yield keyed(batch.column("t").to_numpy()[begin:], some)

    def keyed(t: np.ndarray, some: list[list[bytes]]) -> pa.RecordBatch:
        owner, at, h = seeds_of(some, k, window)
        ends, n = ~inner(at, h, k, owner), occurrences(h, owner)
        at, h, fresh = _keyed(at, h, n)
        sizes = np.fromiter(map(len, some), np.int64, len(some))  # place -1 carries the number of words
        more = len(at) - len(ends)
        columns = [np.append(sizes, h), np.concatenate([t, t[owner], t[owner[n > 0]]]), np.append(np.full(len(some), -1), at).astype(np.int32)]
        columns += [np.append(np.zeros(len(some), bool), fresh), np.concatenate([np.zeros(len(some), bool), ends, np.zeros(more, bool)])]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "t", "p", "fresh", "outer"])

    everything, _ = stored(texts.mapInArrow(seeded, "h long, t long, p int, fresh boolean, outer boolean"), "seeds")
    sizes = everything.where("p = -1").groupBy("t").agg(F.max("h").alias("n"))
    found = everything.where("p >= 0")
    # fixed-width aggregates keep to hash aggregation; a text's first place with a hash stands for it
    first = found.groupBy("h").agg(F.min("t").alias("ta"), F.min_by("p", F.when(F.col("fresh"), F.col("t"))).alias("pa"), F.max("t").alias("most"), F.count_if("outer").alias("n"))
    first, _ = stored(first.where("ta < most").drop("most"), "first")
    met = found.join(first, "h").where("t <> ta").select(F.col("t").alias("tb"), "ta", F.col("p").alias("pb"), "pa").repartition("tb", "ta").distinct()
    met = met.sortWithinPartitions("tb", "ta", "pb", "pa")
    chain = "tb long, ta long, pb array<int>, pa array<int>"
    linked, _ = stored(met.mapInArrow(_chain_rows(k, window, min_words), f"{chain}, weak boolean"), "chains")
    used, _ = stored(linked.select(F.col("tb").alias("t")).union(linked.select("ta")).distinct(), "used")
    # these tables grow with the corpus, so that no small size shall tempt Spark to broadcast them
    whole = texts.join(checked_broadcast(used, used.count()), "t", "left_semi").groupBy("t").agg(F.first("text").alias("text"))
    whole, _ = stored(whole, "texts")

    def aligned(linked: DataFrame) -> DataFrame:
        ends = [F.min(F.col("pb")[0]).alias("first"), F.max(F.element_at("pb", -1)).alias("last")]
        ids = linked.select("tb", "ta").distinct()
        pairs = linked.groupBy("tb", "ta").agg(F.collect_list(F.struct("pb", "pa")).alias("c"), *ends)
        kind = "array<struct<pb:array<int>,pa:array<int>>>"

        def step(some: DataFrame, ids: DataFrame, reach: int | None) -> DataFrame:
            few = ids.count() <= BROADCAST_ROWS  # then only their texts are shuffled
            of_b, of_a = ((whole.join(F.broadcast(ids.select(F.col(x).alias("t"))), "t", "left_semi") if few else whole).withColumnRenamed("t", x) for x in ("tb", "ta"))
            parts = some.join(of_b.hint("merge"), "tb").mapInArrow(_cut(reach), f"tb long, ta long, c {kind}, part binary, lo int, cut boolean")
            both = parts.join(of_a.hint("merge"), "ta")
            columns = f"tb long, ta long, b0 int, b1 int, a0 int, a1 int, identity double, c {kind}"
            return stored(both.mapInArrow(_aligned(k, min_words, identity), columns), "passages")[0]

        near = step(pairs, ids, REACH)
        again = near.where("c IS NOT NULL").select("tb", "ta", "c", F.lit(0).alias("first"), F.lit(0).alias("last"))
        far = step(again, again, None)
        return near.where("c IS NULL").union(far).drop("c")

    def spans_of(passages: DataFrame) -> DataFrame:
        return passages.groupBy("tb", "ta").agg(F.collect_set(F.struct("b0", "b1", "a0", "a1")).alias("spans")).hint("merge")

    def inside_one(b0, b1, a0, a1):
        """Whether these words lie inside one of the passages of their texts, in both."""
        return F.coalesce(F.exists("spans", lambda x: (x["b0"] <= b0) & (x["b1"] >= b1) & (x["a0"] <= a0) & (x["a1"] >= a1)), F.lit(False))

    # weak chains inside passages of the others say nothing new: in runs of like words each place has one
    passages = aligned(linked.where("NOT weak").drop("weak"))
    weak = linked.where("weak").join(spans_of(passages), ["tb", "ta"], "left")
    weak = weak.where(~inside_one(F.col("pb")[0], F.element_at("pb", -1) + k, F.array_min("pa"), F.array_max("pa") + k))
    weak, _ = stored(weak.select("tb", "ta", "pb", "pa", F.col("pb")[0].alias("p"), F.col("pa")[0].alias("p_a")), "weak")
    # words around them go as bytes: few of these chains need the texts
    places = weak.select(F.col("tb").alias("t"), "p").union(weak.select("ta", "p_a")).distinct().groupBy("t").agg(F.collect_list("p").alias("at"))
    around, _ = stored(places.hint("merge").join(whole, "t").mapInArrow(_around(k, min_words), "t long, p int, before binary, after binary"), "around")
    weak = weak.join(around.withColumnRenamed("t", "tb").hint("merge"), ["tb", "p"])
    weak = weak.join(around.toDF("ta", "p_a", "before_a", "after_a").hint("merge"), ["ta", "p_a"])
    reaching, _ = stored(weak.mapInArrow(_reaching(k, min_words), chain), "reaching")
    passages = passages.union(aligned(reaching))
    # a seed's places, if they are more than two; own: in no passage that ties them to its first place
    places = found.where("outer").join(first.where("n > 2"), "h").select("h", F.col("t").alias("tb"), "ta", F.col("p").alias("pb"), "pa")
    tied = inside_one(F.col("pb"), F.col("pb") + k, F.col("pa"), F.col("pa") + k)
    places = places.join(spans_of(passages), ["tb", "ta"], "left")
    places = places.select("h", F.col("tb").alias("t"), F.col("pb").alias("p"), (~F.when(F.col("tb") == F.col("ta"), F.col("pb") == F.col("pa")).otherwise(tied)).alias("own"))
    places, _ = stored(places, "places")
    open_seeds = places.groupBy("h").agg(F.max("own").alias("any"), F.min("t").alias("least"), F.max("t").alias("most")).where("any AND least < most")
    places, _ = stored(places.join(open_seeds.select("h"), "h", "left_semi"), "places")
    at = places.select("t", "p").distinct().groupBy("t").agg(F.collect_list("p").alias("at"))
    contexts = at.hint("merge").join(whole, "t").mapInArrow(_contexts(k, _side(k, min_words)), "t long, p int, before binary, after binary")
    contexts, _ = stored(contexts, "contexts")
    keyed = places.select(F.lit(0).alias("c"), F.col("h").alias("key"), "t", "p", "own")
    ties = tiled(keyed, ["t", "p"], ["t", "p", "own"], TILE, contexts).mapInArrow(_ties(k, min_words, identity), "tb long, ta long, pb int, pa int")
    more, _ = stored(ties.distinct().select("tb", "ta", F.array("pb").alias("pb"), F.array("pa").alias("pa")), "ties")
    # what lies inside another passage of the same two texts, in both, says nothing new
    before = Window.partitionBy("tb", "ta").orderBy("b0", F.desc("b1"), "a0", F.desc("a1"), F.desc("identity")).rowsBetween(Window.unboundedPreceding, -1)
    passages = passages.union(aligned(more)).distinct().withColumn("outer", F.max(F.struct("b1", "a1", "a0")).over(before))
    inside = (F.col("outer.b1") >= F.col("b1")) & (F.col("outer.a0") <= F.col("a0")) & (F.col("outer.a1") >= F.col("a1"))
    passages = passages.where(~F.coalesce(inside, F.lit(False))).drop("outer")
    least, _ = stored(rows.groupBy("t").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "least")
    named = passages.join(least.select(F.col("t").alias("ta"), F.col("least").alias("other")), "ta")
    out = rows.join(named, F.col("t") == F.col("tb")).select("id", "b0", "b1", "other", "a0", "a1", "identity")
    groups = least.where("copies > 1").join(sizes, "t").where(F.col("n") >= min_words).withColumn("n", F.col("n").cast("int"))
    copies = rows.join(groups, "t").where("NOT id <=> least")
    copies = copies.select("id", F.lit(0), F.col("n"), "least", F.lit(0), F.col("n"), F.lit(1.0))
    return out.union(copies).toDF(ident, "start_word", "end_word", "other", "other_start", "other_end", "identity")
