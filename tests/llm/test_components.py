import random

from lodestone.llm.components import connected_components, forest


def truth(edges):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            p, q = find(a), find(b)
            top[max(p, q)] = min(p, q)
    return sorted((x, find(x)) for x in top)


def check(spark, edges):
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == truth(edges)


def test_chain_star_and_random(spark):
    check(spark, [(k, k + 1) for k in range(40)])
    check(spark, [(100, k) for k in range(60)] + [(7, 7), (None, 3), (3, None)])
    rng = random.Random(1)
    check(spark, [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] * 2)


def test_empty(spark):
    check(spark, [])


def test_forest():
    assert len(forest(4, [0, 1, 0], [1, 2, 2])) == 2


def test_split_join_deals_the_aggregate_out_anew(spark):
    from pyspark.sql import functions as F

    from lodestone.llm.common import split_join

    rows = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    sums = rows.groupBy("k").agg(F.max("id").alias("m"))
    out = split_join(rows, sums, "k")
    assert out.columns == ["k", "id", "m"] and out.count() == 100 and out.filter("m % 7 != k").count() == 0
    kept = split_join(rows, sums.filter("k < 3"), "k", how="left")
    assert kept.count() == 100 and kept.filter("m is null and k >= 3").count() == kept.filter("k >= 3").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = split_join(rows, sums, "k")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ENSURE_REQUIREMENTS") == 3
