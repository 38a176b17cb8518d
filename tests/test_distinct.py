import random

from pyspark.sql import functions as F

from kpiwatch.operators.distinct import distinct_counts


def test_matches_count_distinct_with_a_hot_key(spark):
    rng = random.Random(3)
    # one key holds most rows; entity NULLs and condition NULLs included
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"),
             rng.choice([None] + list(range(40))),
             rng.choice([None, 0.0, 1.0, 5.0, 25.0])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, u long, v double")
    conds = {"ge2": F.col("v") >= 2, "ge20": F.col("v") >= 20}
    got = {r.k: tuple(r[1:]) for r in distinct_counts(df, ["k"], "u", conds).collect()}
    want = {r.k: tuple(r[1:]) for r in df.groupBy("k").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("u").alias("entities"),
        F.countDistinct(F.when(F.col("v") >= 2, F.col("u"))).alias("ge2"),
        F.countDistinct(F.when(F.col("v") >= 20, F.col("u"))).alias("ge20")).collect()}
    assert got == want and got["hot"][0] > 1500
