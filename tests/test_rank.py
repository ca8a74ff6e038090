import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronage.operators import rank
from patronage.operators.rank import (Metric, add_tiles, checkpointed, ntile_border, number_rows, order_statistics,
                                      qcut_bin, qcut_border, quantiles)
from patronage.plans.oracle import qcut_bins


def _pandas_qcut(n, k):
    ranks = pd.Series(range(1, n + 1), dtype=float).rank(method="first")
    return (pd.qcut(ranks, k, labels=False) + 1).astype(int).tolist()


@pytest.mark.parametrize("k", [3, 5])
def test_qcut_bins_and_borders_match_pandas(k):
    con = duckdb.connect()
    for n in [*range(2, 400), 1425, 1426, 4334, 14434, 14435]:
        want = _pandas_qcut(n, k)
        assert [qcut_bin(r, n, k) for r in range(1, n + 1)] == want, (k, n)
        borders = [qcut_border(j, n, k) for j in range(1, k)]
        assert [1 + sum(r > b for b in borders) for r in range(1, n + 1)] == want, (k, n)
        if n < 120:  # the SQL twin's own definition
            got = con.execute(f"SELECT {qcut_bins('i', str(n), k)} FROM range(1, {n + 1}) r(i) ORDER BY i").fetchall()
            assert [g[0] for g in got] == want, (k, n)


@pytest.mark.parametrize("k", [3, 5])
def test_ntile_borders_match_spark(spark, k):
    for n in [1, 2, 3, 4, 5, 6, 7, 11, 13, 29, 31, 100, 1425]:
        got = [r[0] for r in spark.range(1, n + 1).select(F.ntile(k).over(Window.orderBy("id"))).collect()]
        borders = [ntile_border(j, n, k) for j in range(1, k)]
        assert [1 + sum(r > b for b in borders) for r in range(1, n + 1)] == got


def _frame(spark, n=3000):
    """Heavy ties: a third of all rows share one value; NULLs; a floating metric."""
    return spark.range(n).select(
        F.concat(F.lit("c"), F.col("id")).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101).alias("tied"),
        F.when(F.col("id") % 10 != 0, F.sin("id") * 100).alias("wave"),
        (F.col("id") % 7 < 5).alias("some"), F.expr("cast(id * 37 % 1009 as decimal(18,2)) / 100").cast("decimal(18,2)").alias("money"))


def test_tiles_equal_windows(spark):
    df = _frame(spark)
    got = add_tiles(df, "key", {"a": (Metric("tied"), 5), "b": (Metric("wave"), 3), "c": (Metric("money"), 5),
                                "d": (Metric("wave", only="some"), 3)})
    want = df.select("key", *[F.ntile(k).over(Window.orderBy(c, "key")).alias(name)
                              for name, c, k in (("a", "tied", 5), ("b", "wave", 3), ("c", "money", 5))])
    part = df.where("some").select("key", F.ntile(3).over(Window.orderBy("wave", "key")).alias("d"))
    assert got.select("key", "a", "b", "c").exceptAll(want).count() == 0
    assert got.where("some").select("key", "d").exceptAll(part).count() == 0 and got.count() == 3000


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 7])
def test_fewer_rows_than_tiles(spark, n):
    df = spark.createDataFrame([(i, 3) for i in range(1, n + 1)], "customer_id long, frequency int")
    got = [r[0] for r in add_tiles(df, "customer_id", {"t": (Metric("frequency"), 5)}).orderBy("customer_id").select("t").collect()]
    assert got == [1 + sum(r > ntile_border(j, n, 5) for j in range(1, 5)) for r in range(1, n + 1)]
    if n == 7:
        assert got == [1, 1, 2, 2, 3, 4, 5]


def test_quantiles_equal_numpy(spark):
    df = checkpointed(_frame(spark, 1001).where("wave is not null"))
    got = quantiles(df, "key", {"wave": [0.25, 0.5, 0.99], "money": [0.0, 1.0, 0.333]})
    for (c, q), v in got.items():
        values = [float(r[0]) for r in df.select(c).collect()]
        assert v == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12)
    empty = checkpointed(df.limit(0))
    assert quantiles(empty, "key", {"wave": [0.5]}) == {("wave", 0.5): None}


def test_number_rows(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10 ** 6), 2000)
    df = spark.createDataFrame([(i, i % 3) for i in ids], "id long, tied long").repartition(5)
    for partitions in (1, 7, 3000):  # more partitions than five digits' worth would be no different: they are numbers
        got = number_rows(df, [F.col("tied"), F.col("id")], "n", partitions=partitions).orderBy("n").collect()
        assert [(r["tied"], r["id"]) for r in got] == sorted((i % 3, i) for i in ids) and [r["n"] for r in got] == list(range(1, 2001))


def _sorted_keys(df, metric, key):
    rows = df.where(metric.only).collect() if metric.only else df.collect()
    def order(r):
        v = r[metric.value]
        return ((0, 0) if v is None else (2, 0) if v != v else (1, v)), r[key].encode() if isinstance(r[key], str) else r[key]
    return [(r[metric.value], r[key]) for r in sorted(rows, key=order)]


def _odd_frame(spark, n=4000):
    """One hot value, NULLs, NaN and infinities, decimals that are one double, keys that are prefixes of others."""
    return spark.range(n).select(
        F.concat(F.lit("key-of-customer-"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).otherwise(F.concat(F.col("id").cast("string"), F.lit("\0é")))).alias("key"),
        (F.col("id") * 0x123456789 % 0x3fffffffffff - 0x1fffffffffff).alias("number"),
        F.when(F.col("id") % 3 != 0, F.lit(5)).otherwise(F.lit(9)).alias("hot"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 5 == 1, F.lit(float("nan"))).when(F.col("id") % 5 == 2, F.lit(float("-inf")))
        .otherwise(F.sin("id")).alias("odd"),
        (F.lit("12345678901234567890.000001").cast("decimal(38,6)") + F.col("id").cast("decimal(38,6)") / 1000000).cast("decimal(38,6)").alias("close"),
        (F.col("id") % 4 != 0).alias("some"))


@pytest.mark.parametrize("few", [1, 20, 500])
@pytest.mark.parametrize("key", ["key", "number"])
def test_selection_equals_sorting(spark, monkeypatch, few, key):
    monkeypatch.setattr(rank, "FEW", few)
    monkeypatch.setattr(rank, "ACCURACY", 100)
    df = checkpointed(_odd_frame(spark))
    metrics = {c: Metric(c) for c in ("hot", "odd", "close")} | {"part": Metric("hot", only="some")}
    wanted = [1, 2, 777, 1333, 1334, 2000, 2667, 2999, 3000, 3999, 4000, 4001, 0]
    found, sizes = order_statistics(df, metrics, key, lambda name, n: wanted)
    assert sizes == {"hot": 4000, "odd": 4000, "close": 4000, "part": 3000}
    for name, metric in metrics.items():
        want = _sorted_keys(df, metric, key)
        assert set(found[name]) == {r for r in wanted if 1 <= r <= len(want)}
        for r, (out, exact, floating, at) in found[name].items():
            value = exact if exact is not None else floating
            assert not out and str(at) == str(want[r - 1][1]) and (value == want[r - 1][0] or value != value)


def test_selection_moves_no_rows(spark, monkeypatch):
    """Every frame that is read is the table itself or an aggregate without keys."""
    from pyspark.sql import DataFrame
    df, plans = checkpointed(_odd_frame(spark)), []
    for name in ("first", "collect"):
        real = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, real=real: plans.append(self._jdf.queryExecution().executedPlan().toString()) or real(self))
    order_statistics(df, {"hot": Metric("hot"), "close": Metric("close")}, "key", lambda name, n: [n // 5 * j for j in range(1, 5)])
    assert plans and isinstance(df, DataFrame)
    for plan in plans:
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort" not in plan, plan


def test_a_repeated_key_is_an_error(spark):
    df = checkpointed(spark.createDataFrame([("a", 1)] * 1000, "key string, v int"))
    with pytest.raises(ValueError, match="unique"):
        order_statistics(df, {"v": Metric("v")}, "key", lambda name, n: [500])
