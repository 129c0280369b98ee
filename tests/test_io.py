"""JSON sources and sinks, idempotent loads and the refresh pipelines."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from riverflow import fixtures as fx
from riverflow import schemas
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.plans import pipelines as P
from riverflow.sources import readers as R
from riverflow.sources import writers as W

from tests.conftest import SF_SMALL, plan_text


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


LIVE_RECORD = {
    "code_site": "T1", "code_station": "S1", "grandeur_hydro": "Q",
    "date_debut_serie": "2024-01-01T00:00:00Z", "date_fin_serie": "2024-01-02T00:00:00Z",
    "statut_serie": 4, "code_systeme_alti_serie": 31, "date_obs": "2024-01-01T10:05:00Z",
    "resultat_obs": 12, "code_methode_obs": 12, "libelle_methode_obs": "Mesure",
    "code_qualification_obs": 16, "libelle_qualification_obs": "Non qualifiée",
    "continuite_obs_hydro": True, "longitude": 2.5, "latitude": 45.1,
    "unknown_key": "ignored",
}


def test_read_live_raw_types(spark, scratch):
    rec = dict(LIVE_RECORD, ingestion_timestamp="2024-01-01T10:10:00Z")
    write_lines(f"{scratch}/live/a.json", [json.dumps(rec)])
    df = R.read_live_raw(spark, f"{scratch}/live")
    assert df.schema == schemas.LIVE_RAW
    [row] = df.collect()
    assert row.date_obs == dt.datetime(2024, 1, 1, 10, 5)
    assert row.resultat_obs == 12.0 and isinstance(row.resultat_obs, float)
    assert row.ingestion_timestamp == dt.datetime(2024, 1, 1, 10, 10)


def test_malformed_line_failfast_and_permissive(spark, scratch):
    write_lines(f"{scratch}/bad/a.json", [json.dumps(LIVE_RECORD), "{not json"])
    with pytest.raises(Exception):
        R.read_live_records(spark, f"{scratch}/bad").collect()
    df = R.read_live_raw(spark, f"{scratch}/bad", mode="PERMISSIVE",
                         corrupt_column="_corrupt_record").cache()
    assert df.count() == 2
    assert df.where(F.col("_corrupt_record").isNotNull()).count() == 1


def test_live_pages_merge(spark, scratch):
    p1 = {"count": 3, "next": "page=2", "data": [LIVE_RECORD, LIVE_RECORD]}
    p2 = {"count": 3, "next": None, "data": [dict(LIVE_RECORD, resultat_obs=13)]}
    write_lines(f"{scratch}/pages/p1.json", [json.dumps(p1)])
    write_lines(f"{scratch}/pages/p2.json", [json.dumps(p2)])
    df = R.read_live_pages(spark, f"{scratch}/pages")
    # bag union: the duplicate on page 1 is kept
    assert df.count() == 3
    assert df.columns == schemas.LIVE_DEDUP_COLUMNS


def test_stations_read_and_overwrite(spark, scratch):
    st = {"code_station": "S1", "libelle_commune": "Ville", "code_departement": "75",
          "en_service": True, "code_sandre_reseau_station": ["a", "b"],
          "geometry": {"type": "Point", "crs": {"type": "name", "properties": {"name": "EPSG"}},
                       "coordinates": [2.5, 45.1]}}
    write_lines(f"{scratch}/st/a.json", [json.dumps({"count": 2, "data": [st, dict(st, code_station="S2")]})])
    paths = P.Paths(f"{scratch}/out")
    assert P.refresh_stations(spark, f"{scratch}/st", paths) == 2
    assert P.refresh_stations(spark, f"{scratch}/st", paths) == 2
    out = spark.read.parquet(paths.stations)
    assert out.count() == 2  # replaced, not appended
    row = out.where("code_station = 'S1'").first()
    assert row.geometry.coordinates == [2.5, 45.1]
    assert row.code_sandre_reseau_station == ["a", "b"]


def test_land_and_read_history_roundtrip(spark, scratch):
    env = fx.fx_hist_envelopes(spark, SF_SMALL)
    n_files = env.count()
    assert W.land_hist(env, f"{scratch}/landed") == n_files
    years = sorted(d for d in os.listdir(f"{scratch}/landed") if d.startswith("year="))
    assert years[0] == "year=1995"
    back = R.read_hist_raw(spark, f"{scratch}/landed")
    flat = H.hist_flatten(back)
    assert flat.count() == fx.fx_hist_flat(spark, SF_SMALL).count()


def test_land_live_roundtrip(spark, scratch):
    raw = L.stamp_ingestion(fx.fx_live_base(spark, SF_SMALL).drop("date_debut_serie")
                            .withColumn("date_debut_serie", F.lit(None).cast("timestamp")))
    raw = raw.select(*[F.col(c).cast(t) for c, t in
                       [(f.name, f.dataType) for f in schemas.LIVE_RAW.fields]])
    n = W.land_live(raw, f"{scratch}/live")
    back = R.read_live_raw(spark, f"{scratch}/live")
    assert back.count() == n == 1000
    assert L.live_dedup(back).count() == L.live_dedup(raw).count()


def test_historical_pipeline_idempotent(spark, scratch):
    env = fx.fx_hist_envelopes(spark, SF_SMALL)
    W.land_hist(env.where(F.col("json_file") < "obs_elab_QmJ_1998-01-01.json"), f"{scratch}/l1")
    W.land_hist(env, f"{scratch}/l2")
    paths = P.Paths(f"{scratch}/out")
    first = P.load_hist_files(spark, f"{scratch}/l1", paths)
    second = P.load_hist_files(spark, f"{scratch}/l2", paths)
    again = P.load_hist_files(spark, f"{scratch}/l2", paths)
    assert first + second == env.count() and again == 0
    P.run_historical(spark, paths)
    flat_rows = spark.read.parquet(paths.flat).count()
    hist = P.run_historical(spark, paths)  # second run appends nothing
    assert spark.read.parquet(paths.flat).count() == flat_rows == fx.fx_hist_flat(spark, SF_SMALL).count()
    expected = H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL))
    assert hist.count() == expected.count()
    assert hist.exceptAll(expected.select(*hist.columns)).count() == 0


def test_live_pipeline(spark, scratch):
    paths = P.Paths(f"{scratch}/out")
    W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), paths.hist_agg)
    raw = fx.fx_live_raw(spark, SF_SMALL)
    raw = raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields])
    W.append(raw, paths.raw_live)
    as_of = dt.datetime(2024, 1, 31)
    models = P.run_live(spark, paths, as_of=as_of)
    assert models["live_dedup"].count() == 1000
    assert models["live_latest"].count() == L.latest(L.live_dedup(raw)).count()
    assert models["indicator_latest"].count() > 0
    assert "BroadcastHashJoin" in plan_text(models["indicator"])


def test_ingest_live_pages(spark, scratch):
    write_lines(f"{scratch}/pages/p1.json",
                [json.dumps({"count": 1, "next": None, "data": [LIVE_RECORD]})])
    paths = P.Paths(f"{scratch}/out")
    assert P.ingest_live(spark, f"{scratch}/pages", paths, now=dt.datetime(2024, 1, 1, 0, 0, 1, 5)) == 1
    [row] = spark.read.parquet(paths.raw_live).collect()
    assert row.ingestion_timestamp == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_json_encode_decode(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": 7, "x": 1}')], "id long, props string")
    dec = R.decode_json_column(df, "props", "k bigint", out="p")
    enc = R.encode_json_column(dec.select("id", F.col("p.k").alias("k")), ["k"])
    assert [r.json for r in enc.orderBy("id").collect()] == ['{"k":5}', '{"k":7}']


def test_incremental_live_refresh_equals_full(spark, scratch):
    hist_path = f"{scratch}/hist"
    W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), hist_path)
    raw = fx.fx_live_raw(spark, SF_SMALL)
    raw = raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields])
    cut = dt.datetime(2024, 1, 15)
    first = raw.where(F.col("ingestion_timestamp") < F.lit(cut))
    second = raw.where(F.col("ingestion_timestamp") >= F.lit(cut))
    paths = P.Paths(f"{scratch}/inc")
    paths.hist_agg = hist_path
    P.run_live_incremental(spark, paths, first, run_id=1)
    # a run that stopped right after appending its dedup increment ...
    W.append(L.with_obs_day(L.live_dedup_increment(second, spark.read.parquet(paths.live_dedup)))
             .withColumn("ingest_batch", F.lit(2).cast("bigint")), paths.live_dedup,
             partition_by=[L.OBS_DAY])
    # ... is completed by the next run, and a replay changes nothing
    P.run_live_incremental(spark, paths, second, run_id=3)
    inc = P.run_live_incremental(spark, paths, second, run_id=4)
    full_paths = P.Paths(f"{scratch}/full")
    full_paths.hist_agg = hist_path
    W.append(raw, full_paths.raw_live)
    full = P.run_live(spark, full_paths)
    for key in ("live_dedup", "live_latest", "indicator", "indicator_latest"):
        a, b = inc[key], full[key].select(*inc[key].columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, key
    ra = {(r.code_station, r.month): r.avg_resultat_obs for r in inc["live_avg"].collect()}
    rb = {(r.code_station, r.month): r.avg_resultat_obs for r in full["live_avg"].collect()}
    assert ra.keys() == rb.keys()
    assert all(ra[k] == pytest.approx(rb[k], rel=1e-12) for k in ra)


def test_historical_pipeline_kll_incremental(spark, scratch):
    import math
    env = fx.fx_hist_envelopes(spark, SF_SMALL)
    W.land_hist(env.where(F.col("json_file") < "obs_elab_QmJ_1998-01-01.json"), f"{scratch}/l1")
    W.land_hist(env, f"{scratch}/l2")
    paths = P.Paths(f"{scratch}/out")
    P.load_hist_files(spark, f"{scratch}/l1", paths)
    P.run_historical(spark, paths, method="kll")
    n_sketches = spark.read.parquet(paths.hist_sketches).count()
    P.load_hist_files(spark, f"{scratch}/l2", paths)
    rows = P.run_historical(spark, paths, method="kll").collect()
    grown = spark.read.parquet(paths.hist_sketches).count()
    P.run_historical(spark, paths, method="kll")  # nothing new: no new sketches
    assert spark.read.parquet(paths.hist_sketches).count() == grown > n_sketches
    exact = {tuple(r[:4]): r for r in H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL), exact=True).collect()}
    values = {}
    for r in H.positive_measure(fx.fx_hist_flat(spark, SF_SMALL)).collect():
        values.setdefault((r.code_station, r.latitude, r.longitude, r.grandeur_hydro_elab), []).append(
            r.resultat_obs_elab)
    assert len(rows) == len(exact)
    for r in rows:
        key = tuple(r[:4])
        v = sorted(values[key])
        assert r.minimum_date_window == exact[key].minimum_date_window
        for c, p in zip(schemas.QUANTILE_COLUMNS, [999, 990, 900, 100, 10, 1]):
            target = max(1, math.ceil(len(v) * p / 1000))
            got = v.index(r[c]) + 1  # rank of the returned value
            assert abs(got - target) <= max(2, math.ceil(0.01 * len(v))), (key, c)


def test_envelope_pages_are_bounded(spark):
    env = fx.fx_hist_envelopes(spark, SF_SMALL, max_records=5)
    flat = fx.fx_hist_flat(spark, SF_SMALL)
    sizes = [r["count"] for r in env.select("count").collect()]
    assert max(sizes) <= 4 * 5  # hash pages: about max_records each
    assert env.select("json_file").distinct().count() < env.count()  # days were split
    got = H.hist_flatten(env)
    assert got.count() == flat.count() and got.exceptAll(flat).count() == 0


def test_recent_view_prunes_day_partitions(spark, scratch):
    paths = P.Paths(f"{scratch}/out")
    W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), paths.hist_agg)
    raw = fx.fx_live_raw(spark, SF_SMALL)
    W.append(raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields]),
             paths.raw_live)
    models = P.run_live(spark, paths, as_of=dt.datetime(2024, 1, 20))
    text = plan_text(models["live_recent"])
    assert "PartitionFilters: [isnotnull(obs_day" in text and "obs_day#" in text
    assert models["live_recent"].count() == L.recent(
        L.live_dedup(raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields])),
        as_of=dt.datetime(2024, 1, 20)).count()


def test_bucketed_tables_join_without_shuffle(spark):
    from riverflow.operators.indicator import indicator
    raw = fx.fx_live_raw(spark, SF_SMALL)
    dedup = L.live_dedup(raw)
    hist = H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL))
    W.overwrite(dedup, "t_live_dedup_b", bucket_by=(4, ["code_station"]))
    W.overwrite(hist, "t_hist_agg_b", bucket_by=(4, ["code_station"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the planned join itself
    try:
        joined = indicator(spark.table("t_live_dedup_b"), spark.table("t_hist_agg_b"))
        text = plan_text(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert joined.count() == indicator(dedup, hist).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError):
        W.overwrite(dedup, "/tmp/not-a-table", bucket_by=(4, ["code_station"]))


def test_stations_multiline_document(spark, scratch):
    doc = {"count": 1, "data": [{"code_station": "S9", "libelle_commune": "Ville",
                                 "en_service": False, "coordonnee_x_station": 650000}]}
    write_lines(f"{scratch}/st/a.json", [json.dumps(doc, indent=2)])
    [row] = R.read_stations(spark, f"{scratch}/st", multiline=True).collect()
    assert (row.code_station, row.en_service, row.coordonnee_x_station) == ("S9", False, 650000.0)


def test_read_api_style_envelope(spark, scratch):
    rec = {"code_site": "A0010101", "code_station": "A001010101", "date_obs_elab": "2023-05-01",
           "resultat_obs_elab": 1234.5, "date_prod": "2023-05-02T06:00:00Z",
           "code_statut": 4, "libelle_statut": "Donnee validee", "code_methode": 12,
           "libelle_methode": "Interpolee", "code_qualification": 20,
           "libelle_qualification": "Bonne", "longitude": 7.1, "latitude": 47.9,
           "grandeur_hydro_elab": "QmJ", "extra_field": "ignored"}
    env = {"count": 2, "first": "f", "prev": None, "next": None, "api_version": "1.0.1",
           "data": [rec, dict(rec, resultat_obs_elab=0)],
           "json_file": "obs_elab_QmJ_2023-05-01.json"}
    write_lines(f"{scratch}/env/2023/obs_elab_QmJ_2023-05-01.json", [json.dumps(env)])
    raw = R.read_hist_raw(spark, f"{scratch}/env/2023")
    flat = H.hist_flatten(raw)
    rows = flat.collect()
    assert len(rows) == 2 and flat.columns == schemas.HIST_FLAT_COLUMNS
    r = rows[0]
    assert r.date_obs_elab == dt.date(2023, 5, 1) and r.code_statut == 4
    assert r.json_file == "obs_elab_QmJ_2023-05-01.json"
    # only the positive value enters the quantiles
    [q] = H.hist_agg(flat).collect()
    assert q.quantile_999 == q.quantile_001 == 1234.5


def test_full_then_incremental_refresh(spark, scratch):
    hist_path = f"{scratch}/hist"
    W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), hist_path)
    raw = fx.fx_live_raw(spark, SF_SMALL)
    raw = raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields])
    cut = dt.datetime(2024, 1, 15)
    paths = P.Paths(f"{scratch}/mixed")
    paths.hist_agg = hist_path
    W.append(raw.where(F.col("ingestion_timestamp") < F.lit(cut)), paths.raw_live)
    P.run_live(spark, paths, run_id=10)
    mixed = P.run_live_incremental(spark, paths, raw.where(F.col("ingestion_timestamp") >= F.lit(cut)),
                                   run_id=11)
    full_paths = P.Paths(f"{scratch}/full")
    full_paths.hist_agg = hist_path
    W.append(raw, full_paths.raw_live)
    full = P.run_live(spark, full_paths)
    for key in ("live_dedup", "live_latest", "indicator_latest"):
        a, b = mixed[key], full[key].select(*mixed[key].columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, key
    ra = {(r.code_station, r.month): r.avg_resultat_obs for r in mixed["live_avg"].collect()}
    rb = {(r.code_station, r.month): r.avg_resultat_obs for r in full["live_avg"].collect()}
    assert ra.keys() == rb.keys() and all(ra[k] == pytest.approx(rb[k], rel=1e-12) for k in ra)


def _typed_raw(spark):
    raw = fx.fx_live_raw(spark, SF_SMALL)
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields])


def test_batch_that_commits_late_is_folded(spark, scratch):
    """A batch with a smaller id, committed after a refresh, is folded next time."""
    raw = _typed_raw(spark)
    cut = F.col("ingestion_timestamp") < F.lit(dt.datetime(2024, 1, 15))
    paths = P.Paths(f"{scratch}/late")
    P.run_live_incremental(spark, paths, raw.where(cut), run_id=100)
    W.append(L.with_obs_day(L.live_dedup_increment(raw.where(~cut), spark.read.parquet(paths.live_dedup)))
             .withColumn("ingest_batch", F.lit(7).cast("bigint")), paths.live_dedup,
             partition_by=[L.OBS_DAY])
    models = P.run_live_incremental(spark, paths, raw.where("false"), run_id=101)
    batch = L.latest(L.live_dedup(raw))
    latest = models["live_latest"].select(*batch.columns)
    assert latest.count() == batch.count() and latest.exceptAll(batch).count() == 0
    parts = {(r.code_station, r.month): r.avg_resultat_obs for r in models["live_avg"].collect()}
    want = {(r.code_station, r.month): r.avg_resultat_obs
            for r in L.live_avg(L.live_dedup(raw)).collect()}
    assert parts.keys() == want.keys()
    assert all(parts[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_late_row_reads_its_own_day_only(spark, scratch):
    raw = _typed_raw(spark)
    W.append(L.with_obs_day(L.live_dedup(raw)), f"{scratch}/dedup", partition_by=[L.OBS_DAY])
    stored = spark.read.parquet(f"{scratch}/dedup")
    late = raw.orderBy("date_obs").limit(1)
    days = L.batch_days(late)
    assert len(days) == 1
    read = L.on_days(stored, days)
    assert len(read.inputFiles()) >= 1 and read.select("obs_day").distinct().count() == 1
    assert "PartitionFilters: [" in plan_text(read) and "obs_day" in plan_text(read)
    assert L.live_dedup_increment(late, stored, days=days).count() == 0
    null_time = late.withColumn("date_obs", F.lit(None).cast("timestamp"))
    assert L.live_dedup_increment(null_time, stored, days=L.batch_days(null_time)).count() == 1


@pytest.mark.parametrize("max_paths", [P.MAX_FOLD_PATHS, 0])
def test_fold_opens_new_files_only(spark, scratch, max_paths):
    """The rows of the files a log does not name, without opening another one."""
    raw = _typed_raw(spark)
    table, late = f"{scratch}/dedup", F.col("date_obs") >= F.lit(dt.datetime(2024, 1, 20))
    dedup = L.with_obs_day(L.live_dedup(raw))
    W.append(dedup.where(~late), table, partition_by=[L.OBS_DAY])
    old = P.dedup_files(spark, table)
    W.append(dedup.where(late), table, partition_by=[L.OBS_DAY])
    files = P.dedup_files(spark, table)
    new = files.join(old, P.FOLD_LOG, "left_anti")
    assert 0 < new.count() < files.count()
    stored = spark.read.schema(dedup.schema).parquet(table)
    if max_paths:   # files in the log are no longer readable
        for r in old.collect():
            with open("/" + r.path.split(":", 1)[1].lstrip("/"), "w") as f:
                f.write("x")
    rows, want = P.rows_of(stored, new, max_paths), L.live_dedup(raw).where(late)
    assert rows.count() == want.count() > 0 and rows.exceptAll(want).count() == 0
    assert P.rows_of(stored, new.where("false"), max_paths).count() == 0


def test_table_without_a_log_of_files_is_folded_anew(spark, scratch):
    """Derived tables that logged batch ids are rebuilt from the dedup table once."""
    raw = _typed_raw(spark)
    paths = P.Paths(f"{scratch}/old")
    P.run_live_incremental(spark, paths, raw, run_id=1)
    for path in (paths.live_latest, paths.live_avg_parts):
        rows = P.stage(P.fold_rows(spark.read.parquet(path)).withColumn(P.FOLD_LOG, F.lit(None).cast("bigint")), "t_old")
        W.overwrite(rows, path)
    models = P.run_live_incremental(spark, paths, raw, run_id=2)
    want = L.live_avg(L.live_dedup(raw))
    got = {(r.code_station, r.month): r.avg_resultat_obs for r in models["live_avg"].collect()}
    assert got == {(r.code_station, r.month): pytest.approx(r.avg_resultat_obs, rel=1e-12) for r in want.collect()}
    assert models["live_latest"].count() == L.latest(L.live_dedup(raw)).count()


def test_landing_tree_with_plain_year_folders(spark, scratch):
    env = {"count": 0, "data": [], "json_file": "obs_elab_QmJ_2023-05-01.json"}
    write_lines(f"{scratch}/tree/2023/obs_elab_QmJ_2023-05-01.json", [json.dumps(env)])
    write_lines(f"{scratch}/tree/2024/obs_elab_QmJ_2024-05-01.json",
                [json.dumps(env | {"json_file": "obs_elab_QmJ_2024-05-01.json"})])
    paths = P.Paths(f"{scratch}/out")
    assert P.load_hist_files(spark, f"{scratch}/tree", paths) == 2
    assert P.load_hist_files(spark, f"{scratch}/tree", paths) == 0


def test_envelopes_of_some_files_shuffle_rows_once(spark):
    early = F.col("json_file") < F.lit("obs_elab_QmJ_1998-01-01.json")
    key = lambda df: sorted((r.json_file, r["count"], sorted(map(str, r.data))) for r in df.collect())
    every = fx.fx_hist_envelopes(spark, SF_SMALL, max_records=3)
    some = fx.fx_hist_envelopes(spark, SF_SMALL, max_records=3, files=early)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert key(some) == key(every.where(early)) != []
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan
