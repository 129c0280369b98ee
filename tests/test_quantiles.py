"""Quantiles: exact distributed form against brute force on a skewed input,
rank-error bounds of the approximate and KLL forms."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverflow import fixtures as fx
from riverflow import schemas
from riverflow.operators import historical as H

from tests.conftest import SF_ORACLE, SF_SMALL

PERMILLE = [999, 990, 900, 100, 10, 1]


def brute(values, p):
    v = sorted(values)
    rank = max(1, math.ceil(len(v) * p / 1000))
    return v[rank - 1]


def rank_error(values, got, p):
    """How many ranks ``got`` is away from the exact discrete quantile."""
    v = np.sort(np.asarray(values))
    target = max(1, math.ceil(len(v) * p / 1000))
    lo = int(np.searchsorted(v, got, side="left")) + 1   # first rank of got
    hi = int(np.searchsorted(v, got, side="right"))      # last rank of got
    return 0 if lo <= target <= hi else min(abs(target - lo), abs(target - hi))


def test_exact_quantiles_skewed_groups(spark):
    rnd = random.Random(7)
    rows = []
    # one hot group holds well over a third of all rows, with many ties
    rows += [("HOT", 45.0, float(rnd.randint(1, 500))) for _ in range(6000)]
    for g in range(40):
        n = rnd.randint(1, 120)
        rows += [(f"S{g}", 44.0 + g % 3, rnd.uniform(0, 1000)) for _ in range(n)]
    rows += [("NULLLAT", None, float(i)) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "code_station string, latitude double, v double")
    names = [f"q{p}" for p in PERMILLE]
    got = H.exact_quantiles(df, ["code_station", "latitude"], "v", PERMILLE, names,
                            partitions=16).collect()
    groups = {}
    for s, lat, v in rows:
        groups.setdefault((s, lat), []).append(v)
    assert len(got) == len(groups)
    for r in got:
        vals = groups[(r.code_station, r.latitude)]
        for p, n in zip(PERMILLE, names):
            assert r[n] == brute(vals, p), (r.code_station, p)


def test_hist_agg_exact_matches_approx_on_small_groups(spark):
    flat = fx.fx_hist_flat(spark, SF_SMALL)
    a = H.hist_agg(flat)
    e = H.hist_agg(flat, exact=True)
    assert e.columns == a.columns == [f.name for f in schemas.HIST_AGG.fields]
    assert e.count() == a.count()
    assert e.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def pooled(spark):
    """All positive history values of sf0.01 as one group (~50,000 rows)."""
    flat = H.positive_measure(fx.fx_hist_flat(spark, SF_ORACLE))
    df = flat.select(F.lit("ALL").alias("g"), "resultat_obs_elab")
    values = [r[0] for r in df.select("resultat_obs_elab").collect()]
    return df, values


@pytest.mark.parametrize("accuracy", [1000, 10000])
def test_approx_rank_error_bound(pooled, accuracy):
    df, values = pooled
    fr = schemas.QUANTILE_FRACTIONS
    [row] = df.groupBy("g").agg(F.percentile_approx("resultat_obs_elab", fr, accuracy)
                                .alias("q")).collect()
    bound = math.ceil(len(values) / accuracy)
    for p, got in zip(PERMILLE, row.q):
        assert rank_error(values, got, p) <= bound


def test_kll_rank_error(pooled):
    df, values = pooled
    flat = df.select(F.lit("S").alias("code_station"), F.lit(1.0).alias("latitude"),
                     F.lit(1.0).alias("longitude"), F.lit("QmJ").alias("grandeur_hydro_elab"),
                     "resultat_obs_elab", F.lit("f").alias("json_file"),
                     F.current_date().alias("date_obs_elab"))
    [row] = H.kll_hist_agg(flat).collect()
    # KLL with k=2000 has a normalized rank error well under 1%
    bound = math.ceil(0.01 * len(values))
    for p, c in zip(PERMILLE, schemas.QUANTILE_COLUMNS):
        assert rank_error(values, row[c], p) <= bound
