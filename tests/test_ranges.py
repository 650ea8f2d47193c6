"""Places and runs counted over ranges against a plain window, with one key that holds most rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from bookaudit.functions.sliced import numbered
from bookaudit.operators import patching as P


def test_places_over_ranges(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.8 else rng.choice(["a", None]), rng.choice([None, 1, 1, 1, 2, 9]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "d string, us long, arrival long")
    order = [F.col("us").asc_nulls_first(), F.col("arrival")]
    got = numbered(df, ["d"], order, "place")
    want = df.withColumn("place", F.row_number().over(Window.partitionBy("d").orderBy(*order)).cast("long"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def chained(gap, candidates):
    """(step, complete, kept) of one gap's candidates in order, walked."""
    lo, hi = gap
    expected, broken, reached = lo, None, None
    for step, (first, last) in enumerate(candidates, 1):
        if first != expected and broken is None:
            broken = step
        if last >= hi and reached is None:
            reached = step
        expected = last + 1
    complete = reached is not None and (broken is None or reached < broken)
    return [(first, last, step, complete, complete and step <= reached) for step, (first, last) in enumerate(candidates, 1)]


def test_chain_over_ranges(spark):
    gaps = {(1, 6000): [(3 * i + 1, 3 * i + 3) for i in range(2100)], (7001, 7020): [(7001, 7009), (7012, 7030)], (8001, 8003): [(8001, 8001), (8002, 8005), (8009, 8009)], (9001, 9003): [(9000, 9003)]}
    rows = [("x", lo, hi, first, last, first, first) for (lo, hi), cs in gaps.items() for first, last in cs]
    df = spark.createDataFrame(rows, "d string, missing_from long, missing_to long, first_id long, last_id long, arrival long, us long").repartition(7)
    want = [(lo, hi, *row) for (lo, hi), cs in gaps.items() for row in chained((lo, hi), cs)]
    got = P.chain_cover(df, ["d"]).select("missing_from", "missing_to", "first_id", "last_id", "step", "complete", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_in_gap_keeps_repeated_rows_and_maps(spark):
    gaps = spark.createDataFrame([("x", 2, 100, 300), ("x", 1, 200, 400), ("x", 3, 50, 90)], "d string, gap_seq long, start_us long, end_us long")
    backup = spark.sql("SELECT 'x' AS d, us, map('a', us) AS m FROM VALUES (150L), (150L), (250L), (300L), (400L), (90L), (CAST(NULL AS BIGINT)) AS t(us)")
    got = P.in_gap(backup, gaps, ["d"], width=64).select("us", "gap_seq").collect()
    assert sorted(map(tuple, got)) == [(150, 2), (150, 2), (250, 1), (300, 1)]
    assert P.in_gap(backup, gaps.limit(0), ["d"]).count() == 0
