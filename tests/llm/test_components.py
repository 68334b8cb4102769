import random

from framelake.llm.components import connected_components


def plain(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in parent)


def found(spark, links, kind="long"):
    return sorted(map(tuple, connected_components(spark.createDataFrame(links, f"u {kind}, v {kind}")).collect()))


def test_random_links(spark):
    r = random.Random(2)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(1, 1), (None, 2), (5, 6), (5, 6), (6, 5)]
    assert found(spark, links) == plain(links)
    chain = [(k, k + 1) for k in range(60)]
    r.shuffle(chain)
    assert found(spark, chain) == [(k, 0) for k in range(61)]
    assert found(spark, []) == []
    assert found(spark, [("b", "a"), ("c", "b")], "string") == [("a", "a"), ("b", "a"), ("c", "a")]


def test_a_star_is_no_partition(spark):
    """The rows of a vertex with many neighbours stay where they are: only small tables are sent to them."""
    n = 100_000
    links = spark.range(1, n + 1).selectExpr("id AS u", "0L AS v").union(spark.range(1, n, 100).selectExpr("id AS u", "id + 1 AS v"))
    out = connected_components(links)
    assert out.count() == n + 1 and out.where("root <> 0").count() == 0


def test_few_links_at_once(spark):
    """One task and the rounds say the same; few links take no more than a few jobs."""
    r = random.Random(5)
    links = [(r.randrange(900), r.randrange(900)) for _ in range(600)] + [(7, 7), (None, 3), (8, None)]
    df = spark.createDataFrame(links, "u long, v long")
    assert sorted(map(tuple, connected_components(df, few=0).collect())) == plain(links)
    spark.sparkContext.setJobGroup("few-links", "")
    got = sorted(map(tuple, connected_components(df).collect()))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == plain(links)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-links")) <= 8
