"""Small-file merges, the log of changes, quarantined lines and loads by listing."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from riverflow import schemas
from riverflow.operators import historical as H
from riverflow.operators import live as L
from riverflow.plans import pipelines as P
from riverflow.sources import compaction
from riverflow.sources import readers as R
from riverflow.sources import writers as W
from riverflow.streaming import live_stream as S

from tests.test_stores import data_files, raw_rows
from tests.test_streaming import same_rows


def loads(spark, store, n, seed=1):
    """n loads of rows over three days, as a stream leaves them."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        mine = [(f"S{rnd.randint(0, 9)}", dt.datetime(2024, 3, rnd.randint(1, 3), 5, rnd.randint(0, 59)), float(i * 100 + j)) for j in range(5)]
        mine.append((None, None, float(i)))
        rows += mine
        S.write_dedup_store(S.staged_batch(raw_rows(spark, mine)), W.load_path(store, f"q-{i}"))
    return raw_rows(spark, rows)


def test_compaction_keeps_rows_and_bounds_files(spark, scratch, monkeypatch):
    store = f"{scratch}/dedup"
    want = L.live_dedup(loads(spark, store, 12))
    rows = lambda: S.read_dedup_store(spark, store).select(*schemas.LIVE_DEDUP_COLUMNS)
    before = data_files(store)
    assert len(before) > 30 and same_rows(rows(), want)
    options = {"min_files": 3, "schema": S.STORE_SCHEMA, "blooms": {L.ROW_HASH: 100}}
    # stops between write and commit: nothing has changed for readers
    commit = compaction.commit
    monkeypatch.setattr(compaction, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        compaction.compact(spark, store, L.OBS_DAY, **options)
    monkeypatch.setattr(compaction, "commit", commit)
    assert same_rows(rows(), want)
    # the newest load may be replayed and stays
    replaced = compaction.compact(spark, store, L.OBS_DAY, without=("q-11",), **options)
    assert 0 < replaced < len(before) and same_rows(rows(), want)
    live = [r.path for r in compaction.current_files(spark, store).collect()]
    assert len([p for p in live if "load=q-11" not in p]) == 4      # three days and rows without a time
    assert compaction.vacuum(spark, store) == replaced
    assert same_rows(rows(), want) and compaction.vacuum(spark, store) == 0
    # by day still, and a merged file can be merged again
    more = L.live_dedup(loads(spark, f"{scratch}/other", 1, seed=5))
    for i in range(3):
        S.write_dedup_store(S.staged_batch(more.withColumn("ingestion_timestamp", F.current_timestamp())), W.load_path(store, f"r-{i}"))
    assert compaction.compact(spark, store, L.OBS_DAY, **options) > 0
    assert rows().distinct().count() == want.unionByName(more).distinct().count()
    assert L.on_days(S.read_dedup_store(spark, store), [dt.date(2024, 3, 2)]).where("day(date_obs) <> 2").count() == 0


def test_bins_are_cut_by_size(spark, scratch):
    store = f"{scratch}/t"
    for i in range(9):
        spark.range(i * 1000, i * 1000 + 1000).coalesce(1).write.parquet(W.load_path(store, f"a-{i}"))
    size = max(r.bytes for r in compaction.files(spark, store).collect())
    assert compaction.compact(spark, store, target_bytes=3 * size, min_files=2) == 9
    assert 3 <= compaction.current_files(spark, store).count() <= 5
    found = compaction.read(spark, store)
    assert found.count() == 9000 and found.select("id").distinct().count() == 9000
    assert compaction.compact(spark, f"{scratch}/none") == 0 and compaction.read(spark, f"{scratch}/none") is None


def test_latest_log_equals_batch(spark, scratch):
    rnd = random.Random(4)
    rows = [(rnd.choice(["S1", "S2", "S3", None]), rnd.choice([None, dt.datetime(2024, 1, rnd.randint(1, 9))]), rnd.choice([None, 1.0, 2.0, 3.0]))
            for _ in range(200)]
    raw = raw_rows(spark, rows)
    W.land_live(raw.repartition(7), f"{scratch}/landed")
    q = S.latest_to_table(S.stream_live_raw(spark, f"{scratch}/landed", max_files_per_trigger=1), f"{scratch}/out",
                          name="latest_log", checkpoint=f"{scratch}/ckpt", merge_every=3)
    q.awaitTermination()
    assert q.exception() is None
    assert same_rows(S.stored_latest(spark, f"{scratch}/out"), L.latest(L.live_dedup(raw)))
    assert compaction.current_files(spark, f"{scratch}/out").select("load").distinct().count() <= 4
    S.merge_latest(spark, f"{scratch}/out")
    assert compaction.current_files(spark, f"{scratch}/out").select("load").distinct().count() == 1
    assert same_rows(S.stored_latest(spark, f"{scratch}/out"), L.latest(L.live_dedup(raw)))


def test_bad_lines_are_quarantined_once(spark, scratch):
    os.makedirs(f"{scratch}/landed")
    good = '{"code_station":"S%d","date_obs":"2024-01-01T00:00:00Z","resultat_obs":%d,"unknown":1}'
    with open(f"{scratch}/landed/a.json", "w") as f:
        f.write("\n".join([good % (1, 5), "{broken", "", "  ", good % (2, 6), '{"resultat_obs": "no number"}', "[1]"]) + "\n")
    with open(f"{scratch}/landed/b.json", "w", newline="") as f:
        f.write(good % (3, 7) + "\r\n" + "truncated {" + "\r\n")
    open(f"{scratch}/landed/empty.json", "w").close()
    for ckpt in ("one", "one"):     # started again, nothing is stored twice
        q = S.ingest_lines(spark, f"{scratch}/landed", f"{scratch}/raw", f"{scratch}/dead", f"{scratch}/counts", name="lines",
                           checkpoint=f"{scratch}/{ckpt}", max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None
    rows = R.read_live_table(spark, f"{scratch}/raw")
    assert sorted((r.code_station, r.resultat_obs) for r in rows.collect()) == [("S1", 5.0), ("S2", 6.0), ("S3", 7.0)]
    dead = {(os.path.basename(r.file), r.position): r.line for r in spark.read.parquet(f"{scratch}/dead").collect()}
    assert dead == {("a.json", 2): "{broken", ("a.json", 6): '{"resultat_obs": "no number"}', ("a.json", 7): "[1]",
                    ("b.json", 2): "truncated {"}
    counts = spark.read.parquet(f"{scratch}/counts").agg(F.sum("n_rows"), F.sum("n_bad"), F.count("*")).first()
    assert tuple(counts)[:2] == (3, 4) and counts[2] >= 2


def test_loaded_files_are_not_opened_again(spark, scratch):
    def envelopes(days):
        rows = [(f"obs_elab_QmJ_2020-01-{d:02d}.json", [(f"S{d}", float(d))]) for d in days]
        df = spark.createDataFrame(rows, "json_file string, data array<struct<code_station:string,resultat_obs_elab:double>>")
        return df.select(F.lit(1).cast("bigint").alias("count"), "json_file", "data")
    paths, landed = P.Paths(f"{scratch}/tables"), f"{scratch}/landed"
    W.land_hist(envelopes([1, 2, 3]), landed, by_file=True)
    assert P.load_hist_files(spark, landed, paths) == 3
    for d, _, names in os.walk(landed):
        for f in names:
            if f.endswith(".json"):
                with open(os.path.join(d, f), "w") as out:
                    out.write("{not json")      # FAILFAST if it were parsed
            elif f.endswith(".crc"):
                os.truncate(os.path.join(d, f), 0)
    assert P.load_hist_files(spark, landed, paths) == 0
    W.land_hist(envelopes([4, 5]), landed, by_file=True)
    assert P.load_hist_files(spark, landed, paths) == 2
    stored = spark.read.parquet(paths.raw_hist)
    assert sorted(r.json_file[-7:-5] for r in stored.collect()) == ["01", "02", "03", "04", "05"]
    assert H.loaded_files(stored).count() == 5
    # plain files of the reference's layout, and names that tell nothing
    os.makedirs(f"{scratch}/plain/2020")
    for name, tag in (("obs_elab_QmJ_2020-01-05.json", 5), ("obs_elab_QmJ_2020-01-06.json", 6), ("part-0.json", 7)):
        with open(f"{scratch}/plain/2020/{name}", "w") as f:
            f.write('{"count":1,"json_file":"obs_elab_QmJ_2020-01-%02d.json","data":[]}' % tag)
    assert {r.json_file for r in R.list_hist_files(spark, f"{scratch}/plain").collect()} == {
        "obs_elab_QmJ_2020-01-05.json", "obs_elab_QmJ_2020-01-06.json", None}
    assert P.load_hist_files(spark, f"{scratch}/plain", paths) == 2
