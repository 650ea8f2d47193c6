"""Overlap joins against all pairs, and id jumps that no list of cells could hold."""

import random

import pytest
from pyspark.sql import functions as F

from bookaudit.functions.intervals import cover
from bookaudit.operators import patching as P

GAPS, BACKUP = "d int, missing_from long, missing_to long", "d int, first_id long, last_id long, arrival long, us long"


def test_cover_is_exact_and_small(spark):
    rng = random.Random(5)
    spans = [(-8, -8), (-7, 9), (0, 0), (0, 63), (1, 62)] + [(a, a + rng.randint(0, 300)) for a in (rng.randint(-500, 500) for _ in range(200))] + [(-(2**43), 2**43 - 1), (3, 2**43 - 5)]
    rows = spark.createDataFrame(spans, "a long, b long").select("a", "b", cover(F.col("a"), F.col("b"), 44).alias("c")).collect()
    for r in rows:
        nodes = sorted((x["node"] << x["level"], (x["node"] + 1) << x["level"]) for x in r["c"])
        assert nodes[0][0] == r["a"] and nodes[-1][1] == r["b"] + 1 and all(p[1] == q[0] for p, q in zip(nodes, nodes[1:]))
        assert len(nodes) <= 2 * max(1, (r["b"] - r["a"] + 1).bit_length())


@pytest.mark.parametrize("bits", [0, 2, 20])
def test_candidates_against_all_pairs(spark, bits):
    rng = random.Random(11)
    gaps = [(d, a, a + rng.choice([-6, -1, 0, 1, 3, 50, 400])) for d in (1, 2) for a in (rng.randint(-100, 600) for _ in range(40))]
    gaps += [(1, None, 5), (3, 1, 2), (1, *gaps[0][1:])]
    backup = [(d, a, a + rng.choice([-2, 0, 1, 2, 30, 500]), i, i) for i, (d, a) in enumerate((rng.choice((1, 2)), rng.randint(-150, 700)) for _ in range(150))]
    backup += [(1, None, 3, 900, 1), (1, 5, None, 901, 1), backup[0], (4, 1, 2, 902, 1)]
    got = P.gap_candidates(spark.createDataFrame(gaps, GAPS), spark.createDataFrame(backup, BACKUP), ["d"], bits).collect()
    want = [(d, f, t, a, b, n, us) for d, f, t in gaps for e, a, b, n, us in backup if d == e and None not in (f, t, a, b) and b >= f and a <= t]
    assert sorted(map(tuple, got)) == sorted(want)


def test_jump_of_ids(spark):
    """A gap of 2e18 ids returns its candidates, among neighbours of ids that doubles can't tell apart."""
    far = 2 * 10**18
    gaps = spark.createDataFrame([(1, 100, far), (1, far + 50, far + 50)], GAPS)
    backup = spark.createDataFrame([(1, 98, 99, 0, 0), (1, 99, 100, 1, 0), (1, 10**15, 10**15 + 5, 2, 0), (1, far, far + 3, 3, 0), (1, far + 1, far + 49, 4, 0), (1, far + 49, far + 51, 5, 0), (1, 0, 2 * far, 6, 0)], BACKUP)
    got = P.gap_candidates(gaps, backup, ["d"]).select("missing_from", "arrival").collect()
    assert sorted(map(tuple, got)) == [(100, 1), (100, 2), (100, 3), (100, 6), (far + 50, 5), (far + 50, 6)]
    chained = P.chain_cover(P.gap_candidates(gaps.where("missing_from = missing_to"), backup.where("arrival = 5"), ["d"]), ["d"])
    assert [r["kept"] for r in chained.collect()] == [False]
    with_gap = P.gap_candidates(spark.createDataFrame([(1, -(2**62), 2**62)], GAPS), backup, ["d"])
    assert with_gap.count() == 7
