"""Benchmark decontamination by winnowing, in DataFrame expressions only.

A text is a sequence of words. Every `width` consecutive words of a benchmark item are a window (a shorter item is one
window). Hashes of k words, of which each window of `width` holds width - k + 1, are thinned to the least one of each
window: its fingerprint. Texts that share a window share its fingerprint. Items shorter than a window are too short to
be thinned; their fingerprint is the hash of all their words, and each of their lengths is looked for too.

Texts are read once. Each document's distinct fingerprints meet those of the benchmark where the document is, if the
benchmark's can be broadcast; what leaves the scan are narrow rows: a row a document with the number of its words, and
the windows that have a fingerprint in common. Beyond that, fingerprints are shuffled without texts. Candidate windows
are joined with the items' windows word by word, which extends fingerprints to whole windows and drops chance matches.

Equal texts are judged once, under the MD5 of the text, so groups of copies cost what one copy costs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import BROADCAST_ROWS, LOWER, UPPER, checked_broadcast, stored

#: Fixed value: a word is a run of ASCII letters and digits and characters beyond ASCII.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters beyond ASCII that lower() may change.
CASED = r"[[\p{Lu}\p{Lt}\p{Nl}\p{So}]&&[^A-Z]]"


def words(text: Column) -> Column:
    """A-Z lower-cased words of a text; null has none."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(text.rlike(CASED), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, BREAK), "")


def _hashes(w: str, k: int) -> str:
    """SQL of the hash of each k consecutive words of array column w."""
    at = "".join(f", get({w}, i + {j})" for j in range(1, k))
    return f"transform(slice({w}, 1, greatest(size({w}) - {k - 1}, 0)), (x, i) -> xxhash64(x{at}))"


#: Stands for a document itself among its fingerprints.
OWN = -1


def fingerprints(w: str, width: int, k: int) -> str:
    """SQL of an array: the least k-word hash of each window of `width` words of array column w, in order; none for a shorter text."""
    n = width - k
    at = "".join(f", get(h, i + {j})" for j in range(1, n + 1))
    least = f"transform(slice(h, 1, greatest(size(h) - {n}, 0)), (x, i) -> least(x{at}))" if n else "h"
    return f"transform(array({_hashes(w, k)}), h -> {least})[0]"


def item_windows(bench: DataFrame, width: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, n, win): windows of n words; n is `width`, or all words of a shorter item. Items without words have none."""
    w = bench.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    w = w.withColumn("n", F.least(F.size("w"), F.lit(width)))
    win = F.expr("transform(sequence(0, size(w) - n), i -> array_join(slice(w, i + 1, n), ' '))")
    return w.select("item", "n", F.explode_outer(win).alias("win")).distinct()


def candidates(docs: DataFrame, windows: DataFrame, lengths: list[int], text: str, width: int, k: int, carry: list[str], every: bool = True) -> DataFrame:
    """Rows of own (carried columns as c0, c1, ..., n_words) and key, the MD5 of the text: one with null cand a document, if

    every is set, and for each fingerprint that the document has in common with the benchmark one with cand, its windows
    (start, n, win). A filter on cand would have Spark carry the words with each fingerprint: leave documents out here.
    """
    inner = {n: k if n == width else n for n in lengths}
    prints = docs.sparkSession.createDataFrame([(OWN, OWN)] if every else [], "h long, j int")
    for j, n in enumerate(lengths):
        own = windows.where(F.col("n") == n).select(F.split("win", " ").alias("w"))
        prints = prints.union(own.select(F.explode_outer(F.expr(fingerprints("w", n, inner[n]))).alias("h"), F.lit(j).alias("j")).distinct())
    prints, _ = stored(prints, "fingerprints")
    seen = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col(f"`{text}`").alias("text"), words(F.col(f"`{text}`")).alias("w"))
    seen = seen.select("*", F.expr("array(" + ", ".join(fingerprints("w", n, inner[n]) for n in lengths) + ")").alias("l"))
    # explode_outer: for explode, Spark would compute the array once more, to leave out empty ones
    seen = seen.select("*", F.array_distinct(F.concat(F.array(F.lit(OWN).cast("long")), F.flatten("l"))).alias("hs"))
    own = F.struct(*[f"c{i}" for i in range(len(carry))], F.size("w").cast("long").alias("n_words")).alias("own")
    n = prints.count()
    if n <= BROADCAST_ROWS:
        met = seen.select("*", F.explode_outer("hs").alias("h")).join(F.broadcast(prints), "h")
    else:
        narrow = seen.select(F.md5("text").alias("key"), F.explode_outer("hs").alias("h")).where(F.col("h") != OWN).distinct()
        shared = narrow.join(prints.where(f"j <> {OWN}").hint("merge"), "h").select("key", "h", "j")
        met = seen.join(shared.hint("merge"), F.md5("text") == F.col("key")).drop("key")
        if every:
            met = met.unionByName(seen.withColumns({"h": F.lit(OWN).cast("long"), "j": F.lit(OWN)}))
    size = F.element_at(F.array(*map(F.lit, lengths)), F.col("j") + 1)
    places = F.expr("filter(transform(l[j], (x, i) -> IF(x = h, i, NULL)), i -> i IS NOT NULL)")
    cut = F.transform(places, lambda i: F.struct(i.alias("start"), size.alias("n"), F.array_join(F.slice("w", i + 1, size), " ").alias("win")))
    return met.select(own, F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.when(F.col("j") >= 0, cut).alias("cand"))


def hits_of(suspects: DataFrame, windows: DataFrame) -> DataFrame:
    """suspects(key, cand) -> (key, n_hit, items) of the texts that have a window of an item."""
    hits = suspects.select("key", F.inline("cand")).distinct().join(windows, ["n", "win"]).select("key", "start", "n", "item")
    hits, _ = stored(hits, "hits")
    by = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("key", "start", "n").distinct().withColumn("to", F.col("start") + F.col("n"))
    fresh = F.greatest(F.lit(0), F.col("to") - F.greatest("start", F.coalesce(F.max("to").over(by), F.lit(0))))
    covered = spans.select("key", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    items = hits.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return covered.join(items, "key")


def judged(
    docs: DataFrame, bench: DataFrame, text: str = "text", width: int = 10, k: int = 5, carry: list[str] | None = None, item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """docs with n_words, n_hit and items (empty array: clean) added; columns of these names in docs are replaced.

    n_hit is the number of a text's words inside occurrences of windows, items the sorted distinct ids, as strings, of
    items with such windows (a null id counts as a hit but isn't listed). Null texts and items have no words; items
    without words have no windows. Repeated rows are rows of their own. carry names the columns that go on, all unless
    given: a query that needs no texts stores none.
    """
    carry = [c for c in docs.columns if c not in ("n_words", "n_hit", "items") and (carry is None or c in carry)]
    windows, _ = stored(item_windows(bench, width, item, item_text), "windows")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most `width` values
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    own = [F.col(f"`{c}`") for c in carry]
    if not lengths:
        return docs.select(*own, F.size(words(F.col(f"`{text}`"))).cast("long").alias("n_words"), zero.alias("n_hit"), none.alias("items"))
    rows, _ = stored(candidates(docs, windows, lengths, text, width, k, carry), "candidates")
    found, _ = stored(hits_of(rows.where("cand IS NOT NULL"), windows), "contaminated")
    out = rows.where("cand IS NULL").join(checked_broadcast(found, found.count()), "key", "left")
    kept = [F.col(f"own.c{i}").alias(c) for i, c in enumerate(carry)]
    return out.select(*kept, "own.n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("items", none).alias("items"))


def clean(docs: DataFrame, bench: DataFrame, text: str = "text", width: int = 10, k: int = 5) -> DataFrame:
    """docs without those that share a window with an item. What goes is decided on narrow rows, under the MD5 of the text."""
    windows, _ = stored(item_windows(bench, width), "windows")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())
    if not lengths:
        return docs
    suspects = candidates(docs, windows, lengths, text, width, k, [], every=False).select("key", "cand")
    suspects, _ = stored(suspects, "candidates")
    gone, _ = stored(hits_of(suspects, windows).select(F.col("key").alias("__key")), "contaminated")
    return docs.join(checked_broadcast(gone, gone.count()), F.md5(F.col(f"`{text}`")) == F.col("__key"), "left_anti")
