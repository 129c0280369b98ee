"""End to end through the command line, from landed JSON files."""

import json
import os

from pyspark.sql import functions as F

from riverflow import fixtures as fx
from riverflow import schemas
from riverflow.__main__ import main
from riverflow.operators import live as L
from riverflow.sources import writers as W

from tests.conftest import SF_SMALL


def test_cli_end_to_end(spark, scratch, capsys):
    out = f"{scratch}/tables"
    # landed history envelopes, live API pages and the station list
    W.land_hist(fx.fx_hist_envelopes(spark, SF_SMALL), f"{scratch}/hist")
    pages = fx.fx_live_pages(spark, SF_SMALL).select("count", "next", "data")
    W.append(pages.select(*[F.col(c) for c in pages.columns]), f"{scratch}/pages", fmt="json")
    stations = fx.fx_stations(spark, SF_SMALL)
    W.append(stations.select(F.lit(10).cast("bigint").alias("count"),
                             F.array(F.struct(*stations.columns)).alias("data")),
             f"{scratch}/stations", fmt="json")

    assert main(["load-hist", "--out", out, "--landed", f"{scratch}/hist"]) == 0
    assert main(["refresh-hist", "--out", out]) == 0
    assert main(["ingest-live", "--out", out, "--pages", f"{scratch}/pages"]) == 0
    assert main(["refresh-live", "--out", out]) == 0
    assert main(["refresh-stations", "--out", out, "--landed", f"{scratch}/stations"]) == 0
    capsys.readouterr()

    assert main(["top20", "--out", out]) == 0
    top = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert len(top) == 20
    assert main(["map", "--out", out, "--as-of", "2024-01-31T00:00:00"]) == 0
    marks = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert marks and all(0 < m["map_ratio"] <= 5 for m in marks)
    assert main(["station", "--out", out, "--code", "S7", "--as-of", "2024-01-31T00:00:00"]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert any("libelle_commune" in line for line in lines)
    assert any(set(json.loads(line)) == {"resultat_obs", "quantile_999", "quantile_990", "quantile_900"}
               for line in lines)

    raw = spark.read.parquet(f"{out}/live_raw")
    assert raw.count() == 1000 and raw.schema["ingestion_timestamp"].dataType == schemas.TS


def test_cli_stream_live(spark, scratch):
    out = f"{scratch}/tables"
    records = fx.fx_live_raw(spark, SF_SMALL).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RECORD.fields])
    W.land_live(records.repartition(3), f"{scratch}/landed")  # no ingestion stamp yet
    assert main(["stream-live", "--out", out, "--landed", f"{scratch}/landed"]) == 0
    raw = spark.read.parquet(f"{out}/live_raw")
    assert raw.count() == 2000 and raw.where("ingestion_timestamp IS NULL").count() == 0
    dedup = spark.read.parquet(f"{out}/live_dedup")
    assert {"obs_day", "ingest_batch"} <= set(dedup.columns)
    assert dedup.select(*schemas.LIVE_DEDUP_COLUMNS).distinct().count() == dedup.count() == 1000
    # a second run over the same landing adds nothing: the checkpoints sit
    # next to the tables, so a new application resumes from them
    assert os.path.isdir(f"{out}/_checkpoints/live_ingest")
    assert main(["stream-live", "--out", out, "--landed", f"{scratch}/landed"]) == 0
    assert spark.read.parquet(f"{out}/live_dedup").count() == 1000
    assert spark.read.parquet(f"{out}/live_raw").count() == 2000


def test_cli_stream_and_batch_share_one_root(spark, scratch):
    out = f"{scratch}/tables"
    records = fx.fx_live_raw(spark, SF_SMALL).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RECORD.fields])
    early = F.col("date_obs") < F.lit("2024-01-15").cast("timestamp")
    W.land_live(records.where(early), f"{scratch}/landed")
    W.append(fx.fx_live_pages(spark, SF_SMALL).select("count", "next", "data"), f"{scratch}/pages",
             fmt="json")
    W.land_hist(fx.fx_hist_envelopes(spark, SF_SMALL), f"{scratch}/hist")
    assert main(["load-hist", "--out", out, "--landed", f"{scratch}/hist"]) == 0
    assert main(["refresh-hist", "--out", out]) == 0
    assert main(["stream-live", "--out", out, "--landed", f"{scratch}/landed"]) == 0
    assert main(["ingest-live", "--out", out, "--pages", f"{scratch}/pages"]) == 0
    assert main(["refresh-live", "--out", out]) == 0
    want = L.live_dedup(records)
    got = spark.read.parquet(f"{out}/live_dedup").select(*schemas.LIVE_DEDUP_COLUMNS)
    assert got.count() == want.count() == 1000 and got.exceptAll(want).count() == 0
