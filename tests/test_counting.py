import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskwise.operators import counting

GROUPS = st.lists(
    st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 40))), min_size=1, max_size=80
)


def percentiles(spark, rows):
    frame = spark.createDataFrame(rows, "g string, v bigint")
    counts = frame.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    out = (
        counting.running_counts(counts, ["g"], "v", "n")
        .groupBy("g")
        .agg(
            counting.percentile("v", 50).alias("p50"),
            counting.percentile("v", 90).alias("p90"),
            counting.mean("v", "n").alias("mean"),
            counting.total("n", F.col("v") <= 10).alias("low"),
            counting.total("n").alias("all"),
        )
    )
    return {r["g"]: tuple(r)[1:] for r in out.collect()}


def expected(rows):
    out = {}
    for g in {g for g, _ in rows}:
        values = sorted(v for h, v in rows if h == g and v is not None)
        n = len(values)

        def rank(percent, values=values, n=n):
            return values[math.ceil(percent * n / 100) - 1] if n else None

        out[g] = (
            rank(50),
            rank(90),
            sum(values) / n if n else None,
            sum(v <= 10 for v in values),
            sum(h == g for h, _ in rows),
        )
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(GROUPS)
def test_percentiles_are_exact(spark, rows):
    assert percentiles(spark, rows) == expected(rows)


def test_a_hot_group_is_counted_down_before_it_is_ordered(spark):
    """Half a million rows of one group reach the window as at most 101 counts."""
    frame = spark.range(500_000).select(F.lit("hot").alias("g"), (F.col("id") % 101).alias("v"))
    counts = frame.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    assert counts.count() == 101
    out = counting.running_counts(counts, ["g"], "v", "n").groupBy("g").agg(counting.percentile("v", 50))
    assert out.first()[1] == 50
