"""URL filters as a sort-merge range join, in DataFrame expressions only.

A rule is a host and a path prefix. A URL's host lies under every suffix of its labels, so the URL gets a key for each
suffix: the suffix in reversed-label form ("com.example") and its path. Under one reversed host, a rule's path prefix is
the interval of paths that begin with it, and intervals of prefixes are nested or disjoint. Rules and URLs are sorted
together by path, and a sweep carries the stack of rules that are open: at a URL, of those on the stack, the last whose
prefix the path still begins with is the innermost. A rule's own stack (itself and the rules that enclose it) comes
with its interval's start.

Sweeps run per (reversed host, part). A reversed host that many URLs share is swept in as many parts as its rows need,
with its rules repeated in each, so that no part outgrows a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import LOWER, UPPER, stored

PART_ROWS = 2_000


def host_of(url: Column) -> Column:
    """A-Z lower-cased text after the first :// up to /, ?, # or the end; empty without :// or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """(rev, path, stack): a row each interval start, its stack the rules open there, outermost first.

    A fold over the sorted rules of one host pops what a path no longer begins with and pushes the rule itself.
    """
    rules = rules.groupBy("rev", "path").agg(F.min(F.struct("rank", "rule", "verdict")).alias("r"))
    rules = rules.groupBy("rev").agg(F.array_sort(F.collect_list(F.struct("path", "r.rank", "r.rule", "r.verdict"))).alias("sorted"))
    kind = "struct<path:string,rank:int,rule:string,verdict:string>"
    fold = f"""aggregate(sorted, CAST(array() AS array<array<{kind}>>), (done, one) -> concat(done, array(concat(
        filter(coalesce(get(done, size(done) - 1), CAST(array() AS array<{kind}>)), open -> startswith(one.path, open.path)), array(one)))))"""
    return rules.select("rev", F.explode(F.expr(fold)).alias("stack")).select("rev", F.expr("stack[size(stack) - 1].path").alias("path"), "stack")


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", part_rows: int = PART_ROWS) -> DataFrame:
    """pages with host, path, rule and verdict; columns of these names in pages are replaced.

    rules(host, path, verdict): a rule fits its host and all subdomains if the path begins with its path. The longest
    rule (host and path) wins; of equally long ones that with the longer host, then block before allow. Hosts in rules
    are lower-cased; a rule with a null is left out. A URL that no rule fits gets a null rule and the default verdict.
    Equal URLs are judged once.
    """
    spark = pages.sparkSession
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    at = F.col(f"`{url}`")
    rows = pages.select(*[F.col(f"`{c}`") for c in own], host_of(at).alias("host"), path_of(at).alias("path"))
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna()
    named = rules.select(
        reversed_host(F.col("host")).alias("rev"), "path", F.concat("host", "path").alias("rule"), "verdict", (F.col("verdict") != "block").cast("int").alias("rank")
    )
    stacks, _ = stored(_rule_stacks(named), "rules")
    urls = rows.select("host", "path").distinct()
    revs = F.expr("transform(sequence(1, size(labels)), n -> array_join(reverse(slice(labels, size(labels) - n + 1, n)), '.'))")
    keys = urls.select("host", "path", F.split("host", r"\.").alias("labels")).select("host", "path", F.explode(revs).alias("rev"))
    keys = keys.join(stacks.select("rev").distinct(), "rev", "left_semi")
    parts = keys.groupBy("rev").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("m"))
    parts, _ = stored(parts, "parts")
    dealt = keys.join(parts, "rev").select("rev", F.pmod(F.xxhash64("host", "path"), F.col("m")).cast("int").alias("part"), "path", "host")
    opened = stacks.join(parts, "rev").select("rev", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part"), "path", "stack")
    events = dealt.select("rev", "part", "path", F.lit(1).alias("kind"), "host", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    events = opened.select("rev", "part", "path", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "stack").union(events)
    sweep = Window.partitionBy("rev", "part").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1 AND stack IS NOT NULL")
    inner = F.expr("filter(stack, open -> startswith(path, open.path))")
    hits = swept.select("host", "path", "rev", inner.alias("open")).where("size(open) > 0").select("host", "path", "rev", F.expr("open[size(open) - 1]").alias("r"))
    best = hits.groupBy("host", "path").agg(F.max_by("r", F.struct(F.length("r.rule"), F.length("rev"))).alias("r"))
    best, _ = stored(best.select("host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict")), "verdicts")
    found = rows.join(best, ["host", "path"], "left")
    return found.select(*[F.col(f"`{c}`") for c in own], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
