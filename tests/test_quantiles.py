"""Exact quantiles by refined histograms equal linear-interpolation quantiles (numpy)."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.operators import quantiles as QU
from reviewlake.operators.profile import numeric_summary
from reviewlake.operators.quantiles import exact_quantile_values, exact_quantiles, exact_quantiles_of

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("n,kind", [(1, "normal"), (2, "ints"), (7, "normal"), (1000, "ints"), (5001, "hot"), (3000, "wide")])
def test_matches_numpy(spark, n, kind):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 50, n).astype(float) if kind == "ints" else rng.normal(size=n)
    if kind == "hot":
        vals[: n // 3] = 42.0  # one value holds a third of the rows
    if kind == "wide":
        vals = np.sign(vals) * 10.0 ** rng.integers(-300, 300, n)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),)], "x double")
    got = exact_quantiles(df, "x", PROBS).first()
    want = np.quantile(vals, PROBS)
    assert all(a == b or abs(a - b) <= 1e-12 * abs(b) for a, b in zip(got, want))


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert list(exact_quantiles(df, "x", [0.5]).first()) == [None]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=12))
def test_every_rank_of_any_doubles(spark, vals):
    probs = [i / max(len(vals) - 1, 1) for i in range(len(vals))]
    got = exact_quantile_values(spark.createDataFrame([(v,) for v in vals], "x double"), "x", probs)
    want = sorted(vals)
    for p, g in zip(probs, got):
        at = p * (len(vals) - 1)
        if at == int(at):
            assert g == want[int(at)]


def test_all_columns_in_a_few_passes(spark, monkeypatch):
    rounds = []
    histograms = QU._histograms
    monkeypatch.setattr(QU, "_histograms", lambda *a: rounds.append(histograms(*a)) or rounds[-1])
    df = spark.range(20_000).selectExpr("id % 5 AS score", "cast(id * id as double) / 7 AS `a.b`", "cast(null as int) AS none")
    got = exact_quantiles_of(df, df.columns, [0.25, 0.5])
    assert got["score"] == [1.0, 2.0] and got["none"] == [None, None]
    x = np.arange(20_000.0) ** 2 / 7
    assert got["a.b"] == pytest.approx(np.quantile(x, [0.25, 0.5]).tolist(), rel=1e-15)
    assert len(rounds) <= 5
    plan = rounds[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[1]
    assert "rangepartitioning" not in plan and "Sort" not in plan and plan.count("Exchange") == 1


def test_summary_equals_the_percentile_form(spark):
    df = spark.range(997).selectExpr("id % 5 AS s", "cast(id as double) / 3 AS x", "if(id = 3, null, id) AS y")
    rows = lambda m: sorted(map(tuple, numeric_summary(df, df.columns, method=m).collect()))
    assert rows("distributed") == rows("exact")
