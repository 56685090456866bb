"""Values at a rank against sorting."""

import math
import random

import pytest
from millrace.operators.selection import value_at


@pytest.mark.parametrize("bins, few", [(1024, 10_000), (4, 3), (2, 1)])
def test_equals_sorting(spark, bins, few):
    r = random.Random(bins)
    rows = [(k, r.choice([None, float("nan"), 1.5, 1.5, r.gauss(0, 1), 10 ** r.uniform(-200, 200), -(10 ** r.uniform(0, 300)), math.inf, -math.inf])) for k in ["hot"] * 300 + ["b"] * 9 + [None] * 20 for _ in (0,)]
    rows += [("none", None), ("one", 2.0), ("same", 3.0), ("same", 3.0), ("wide", -1.7e308), ("wide", 1.7e308), ("wide", 0.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    for share in (0.5, 0.95, 1.0) if few > 3 else (0.5,):
        want = {}
        for k in {a for a, _ in rows}:
            xs = sorted(x for a, x in rows if a == k and x is not None and not math.isnan(x))
            if xs:
                want[k] = xs[min(math.floor(len(xs) * share), len(xs) - 1)]
        got = value_at(df, "x", share, ["k"], bins=bins, few=few).collect()
        assert {r["k"]: r["value"] for r in got} == want and len(got) == len(want)


def test_whole_table(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    assert [r["value"] for r in value_at(df, "x", 0.95, [], bins=4, few=5).collect()] == [95.0]
