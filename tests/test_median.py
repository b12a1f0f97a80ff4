import random
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from vaultmart.operators.median import exact_median


def _brute(rows):
    df = pd.DataFrame(rows, columns=["g", "v"]).dropna(subset=["v"])
    out = {}
    for g, part in df.groupby("g", dropna=False):
        vals = sorted(part["v"])
        n = len(vals)
        out[None if pd.isna(g) else g] = (vals[(n - 1) // 2] + vals[n // 2]) / 2
    return out


def test_exact_median_with_a_hot_group(spark):
    rnd = random.Random(3)
    rows = []
    # a hot group with a third of all rows, many distinct values and duplicates
    for _ in range(3000):
        rows.append(("hot", Decimal(rnd.randint(0, 400000)) / 100))
    for i in range(6000):
        g = f"g{i % 97}" if i % 13 else None
        v = None if i % 31 == 0 else Decimal(rnd.randint(0, 5000)) / 100
        rows.append((g, v))
    rows += [("even", Decimal("1.00")), ("even", Decimal("2.01")), ("one", Decimal("7.50"))]
    df = spark.createDataFrame(rows, "g string, v decimal(14,2)").repartition(7)
    got = {r.g: r.median for r in exact_median(df, ["g"], "v", "median").collect()}
    want = _brute(rows)
    assert set(got) == set(want)
    for g, m in want.items():
        assert got[g] == m, (g, got[g], m)
    assert got["even"] == Decimal("1.505")


def test_exact_median_spreads_hot_group_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20000).select(F.lit("hot").alias("g"),
                                          (F.col("id") % 5000).cast("decimal(14,2)").alias("v"))
        counts = (df.groupBy("g", "v").count()
                  .repartitionByRange(8, "g", "v")
                  .groupBy(F.spark_partition_id()).count().collect())
        assert len(counts) > 1        # one group, several range partitions
        m = exact_median(df, ["g"], "v", "median").first()["median"]
        assert m == Decimal("2499.5")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
