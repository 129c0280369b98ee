"""Streaming forms equal the batch results on the same landed files."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from riverflow import fixtures as fx
from riverflow import schemas
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.operators.indicator import indicator
from riverflow.sources import writers as W
from riverflow.streaming import live_stream as S
from riverflow.streaming.windows import pull_windows

from tests.conftest import SF_SMALL


def landed_raw(spark, scratch, files=4):
    """fx_live_raw with domain types, landed as ``files`` NDJSON files."""
    raw = fx.fx_live_raw(spark, SF_SMALL)
    raw = raw.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIVE_RAW.fields])
    path = f"{scratch}/landed"
    W.land_live(raw.repartition(files), path)
    return raw, path


def run_to_end(df, name, mode, scratch):
    q = S.start(df, name, sink="memory", mode=mode, available_now=True,
                checkpoint=f"{scratch}/ckpt-{name}")
    q.awaitTermination(300)
    return df.sparkSession.table(name)


def same_rows(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_dedup_equals_batch(spark, scratch):
    raw, path = landed_raw(spark, scratch)
    out = run_to_end(S.stream_dedup(S.stream_live_raw(spark, path)), "t_dedup", "append", scratch)
    batch = L.live_dedup(raw)
    assert batch.count() == 1000
    assert same_rows(out, batch)


def test_stream_latest_equals_batch(spark, scratch):
    raw, path = landed_raw(spark, scratch)
    out = run_to_end(S.stream_latest(S.stream_live_raw(spark, path)), "t_latest", "complete",
                     scratch)
    assert same_rows(out, L.latest(L.live_dedup(raw)))


def test_stream_indicator_equals_batch(spark, scratch):
    raw, path = landed_raw(spark, scratch)
    hist = W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), f"{scratch}/hist")
    out = run_to_end(S.stream_indicator(S.stream_live_raw(spark, path), hist), "t_ind", "append",
                     scratch)
    batch = indicator(L.live_dedup(raw), hist)
    assert batch.count() > 0
    assert same_rows(out, batch)


def test_stream_pull_windows_equals_batch(spark, scratch):
    raw, path = landed_raw(spark, scratch)
    stream = S.stream_dedup(S.stream_live_raw(spark, path))  # sets the watermark
    out = run_to_end(pull_windows(stream), "t_win", "append", scratch)
    # append mode emits a window once the watermark (newest time - delay)
    # passes its end; the newest windows are still open
    watermark = raw.agg(F.max("date_obs")).first()[0] - dt.timedelta(minutes=15)
    batch = pull_windows(L.live_dedup(raw))
    closed = batch.where(F.col("window_end") <= F.lit(watermark))
    assert closed.count() < batch.count()
    assert same_rows(out, closed)


def test_late_row_dropped_by_stream_kept_by_batch(spark, scratch):
    """A row later than the watermark is dropped by the stream only."""
    def rec(minute, value):
        t = dt.datetime(2024, 1, 1, 12, 0) + dt.timedelta(minutes=minute)
        return json.dumps({"code_station": "S1", "grandeur_hydro": "Q",
                           "date_obs": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "resultat_obs": value,
                           "ingestion_timestamp": "2024-01-01T14:00:00Z"})
    land = f"{scratch}/late"
    os.makedirs(land)
    with open(f"{land}/1.json", "w") as f:
        f.write("\n".join([rec(0, 1.0), rec(60, 2.0)]) + "\n")
    stream = S.stream_dedup(S.stream_live_raw(spark, land, max_files_per_trigger=1), "15 minutes")
    q = S.start(stream, "t_late", sink="memory", checkpoint=f"{scratch}/ckpt-late")
    q.processAllAvailable()
    with open(f"{land}/2.json", "w") as f:
        f.write(rec(5, 3.0) + "\n")  # 55 minutes behind the newest row: beyond the watermark
    q.processAllAvailable()
    q.stop()
    streamed = {r.resultat_obs for r in spark.table("t_late").collect()}
    batch = {r.resultat_obs for r in L.live_dedup(spark.read.schema(schemas.LIVE_RAW)
                                                  .json(land)).collect()}
    assert streamed == {1.0, 2.0}
    assert batch == {1.0, 2.0, 3.0}


def test_ingest_exactly_once(spark, scratch):
    raw, path = landed_raw(spark, scratch)
    target = f"{scratch}/raw_table"
    ckpt = f"{scratch}/ckpt-ingest"
    S.ingest(S.stream_live_raw(spark, path), target, checkpoint=ckpt).awaitTermination(300)
    # a second run over the same landing and checkpoint adds nothing
    S.ingest(S.stream_live_raw(spark, path), target, checkpoint=ckpt).awaitTermination(300)
    assert spark.read.parquet(target).count() == raw.count() == 2000


def test_dedup_to_table_incremental_equals_batch(spark, scratch):
    raw, path = landed_raw(spark, scratch, files=4)
    table = f"{scratch}/dedup_table"
    stream = S.stream_live_raw(spark, path, max_files_per_trigger=1)
    S.dedup_to_table(stream, table, name="t_dedup_tbl", checkpoint=f"{scratch}/ck1").awaitTermination(300)
    stored = spark.read.parquet(table)
    assert "ingest_batch" in stored.columns
    assert same_rows(stored.select(*schemas.LIVE_DEDUP_COLUMNS), L.live_dedup(raw))
    # the same files replayed from a fresh checkpoint append nothing
    again = S.stream_live_raw(spark, path, max_files_per_trigger=2)
    S.dedup_to_table(again, table, name="t_dedup_tbl2", checkpoint=f"{scratch}/ck2").awaitTermination(300)
    assert spark.read.parquet(table).count() == 1000


def test_dedup_increment_null_safe(spark):
    from tests.test_semantics import live_df, T0
    old = live_df(spark, [{"code_station": None, "date_obs": None, "resultat_obs": 1.0},
                          {"code_station": "S1", "date_obs": T0, "resultat_obs": 2.0}])
    new = live_df(spark, [{"code_station": None, "date_obs": None, "resultat_obs": 1.0},
                          {"code_station": "S1", "date_obs": T0, "resultat_obs": 2.0},
                          {"code_station": "S1", "date_obs": T0, "resultat_obs": 3.0}])
    out = L.live_dedup_increment(new, old).collect()
    assert [r.resultat_obs for r in out] == [3.0]


def test_stream_indicator_broadcasts_counted_history(spark, scratch):
    import contextlib
    import io
    _, path = landed_raw(spark, scratch, files=1)
    hist = W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), f"{scratch}/hist")
    q = S.start(S.stream_indicator(S.stream_live_raw(spark, path), hist), "t_ind_plan",
                sink="memory", available_now=True, checkpoint=f"{scratch}/ck-plan")
    q.awaitTermination(300)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    text = buf.getvalue()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # above the row cap the static side is not broadcast
    unhinted = S.stream_indicator(S.stream_live_raw(spark, path), hist, max_broadcast_rows=1)
    assert unhinted.isStreaming


def test_stream_permissive_keeps_bad_lines_visible(spark, scratch):
    land = f"{scratch}/bad"
    os.makedirs(land)
    with open(f"{land}/1.json", "w") as f:
        f.write(json.dumps({"code_station": "S1", "date_obs": "2024-01-01T00:00:00Z"}) + "\n")
        f.write("{broken\n")
    stream = S.stream_live_raw(spark, land, mode="PERMISSIVE", corrupt_column="_corrupt_record")
    out = run_to_end(stream, "t_bad", "append", scratch)
    assert out.count() == 2
    assert out.where(F.col("_corrupt_record").isNotNull()).count() == 1


def test_exact_indicator_and_windows_over_many_micro_batches(spark, scratch):
    raw, path = landed_raw(spark, scratch)
    hist = W.materialize(H.hist_agg(fx.fx_hist_flat(spark, SF_SMALL)), f"{scratch}/hist")
    for k in range(2):  # the same landing again, by a new stream: windows are counted per stream
        stream = S.stream_live_raw(spark, path, max_files_per_trigger=1)
        S.indicator_to_table(stream, hist, f"{scratch}/ind", name=f"t_ind_exact{k}",
                             checkpoint=f"{scratch}/ck-ind{k}").awaitTermination(300)
        out = spark.read.parquet(f"{scratch}/ind/indicator")
        assert out.select("load").distinct().count() >= 4 - 3 * k
        assert same_rows(out.drop("load"), indicator(L.live_dedup(raw), hist))
    S.windows_to_table(S.stream_live_raw(spark, path, max_files_per_trigger=1), f"{scratch}/win",
                       name="t_win_exact", checkpoint=f"{scratch}/ck-win").awaitTermination(300)
    assert same_rows(S.stored_windows(spark, f"{scratch}/win"), pull_windows(raw))
