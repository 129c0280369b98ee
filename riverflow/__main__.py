"""Command line: one sub-command per scheduled job or dashboard read.

    python -m riverflow load-hist     --out ROOT --landed PATH
    python -m riverflow refresh-hist  --out ROOT [--method approx|exact|kll]
    python -m riverflow ingest-live   --out ROOT --pages PATH
    python -m riverflow refresh-live  --out ROOT [--incremental --new PATH]
    python -m riverflow refresh-stations --out ROOT --landed PATH
    python -m riverflow stream-live   --out ROOT --landed PATH [--every "5 minutes"]
    python -m riverflow map           --out ROOT [--quantile quantile_990]
    python -m riverflow station       --out ROOT --code CODE   (history, live, maximum, thresholds)
    python -m riverflow top20         --out ROOT

The session comes from the environment (``spark-submit`` / cluster
defaults); only unset library settings are filled in.  Each command is one
run: scheduling (every 5 minutes, daily, weekly) is left to the caller.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import SparkSession

from riverflow.operators.indicator import indicator
from riverflow.operators import serving as V
from riverflow.plans import pipelines as P
from riverflow.session import configure
from riverflow.sources import readers as R
from riverflow.streaming import live_stream as S


def _session() -> SparkSession:
    return configure(SparkSession.builder.appName("riverflow").getOrCreate())


def _show(df) -> None:
    """Print every row, one partition at a time."""
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="riverflow")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def cmd(name, **extra):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True, help="root folder of the tables")
        for flag, kw in extra.items():
            p.add_argument(f"--{flag.replace('_', '-')}", **kw)
        return p

    cmd("load-hist", landed={"required": True})
    cmd("refresh-hist", method={"default": "approx", "choices": ["approx", "exact", "kll"]})
    cmd("ingest-live", pages={"required": True})
    cmd("refresh-live", incremental={"action": "store_true"}, new={"default": None})
    cmd("refresh-stations", landed={"required": True})
    cmd("stream-live", landed={"required": True}, every={"default": None})
    as_of = {"default": None, "type": _dt.datetime.fromisoformat,
             "help": "instant the 24-hour window ends at (default: now)"}
    cmd("map", quantile={"default": V.DEFAULT_MAP_QUANTILE, "choices": list(V.MAP_QUANTILES)},
        as_of=as_of)
    cmd("station", code={"required": True}, as_of=as_of)
    cmd("top20")
    args = ap.parse_args(argv)

    spark = _session()
    paths = P.Paths(args.out)
    if args.cmd == "load-hist":
        print(json.dumps({"rows_loaded": P.load_hist_files(spark, args.landed, paths)}))
    elif args.cmd == "refresh-hist":
        print(json.dumps({"groups": P.run_historical(spark, paths, method=args.method).count()}))
    elif args.cmd == "ingest-live":
        print(json.dumps({"rows_loaded": P.ingest_live(spark, args.pages, paths)}))
    elif args.cmd == "refresh-live":
        if args.incremental:
            new = R.read_live_table(spark, args.new or paths.raw_live)
            models = P.run_live_incremental(spark, paths, new)
        else:
            models = P.run_live(spark, paths)
        print(json.dumps({"latest_rows": models["live_latest"].count()}))
    elif args.cmd == "refresh-stations":
        print(json.dumps({"stations": P.refresh_stations(spark, args.landed, paths)}))
    elif args.cmd == "stream-live":
        # Raw append (exactly once) and exact incremental dedup, one query each.
        # Checkpoints live next to the tables, so every run resumes.
        once = args.every is None
        ckpt = f"{args.out.rstrip('/')}/_checkpoints"
        q1 = S.ingest(S.stream_live_raw(spark, args.landed, with_stamp=False), paths.raw_live,
                      name="live_ingest", checkpoint=f"{ckpt}/live_ingest",
                      available_now=once, processing_time=args.every)
        q2 = S.dedup_to_table(S.stream_live_raw(spark, args.landed, with_stamp=False),
                              paths.live_dedup, name="live_dedup",
                              checkpoint=f"{ckpt}/live_dedup", available_now=once,
                              processing_time=args.every)
        for q in (q1, q2):
            q.awaitTermination()
    elif args.cmd == "map":
        latest = P.fold_rows(spark.read.parquet(paths.live_latest))
        hist = P.checked_broadcast(spark.read.parquet(paths.hist_agg), P.HIST_BROADCAST_MAX_ROWS)
        _show(V.map_stations(indicator(latest, hist), quantile=args.quantile, as_of=args.as_of))
    elif args.cmd == "station":
        flat = spark.read.parquet(paths.flat)
        stations = spark.read.parquet(paths.stations)
        recent = P.recent_from_store(spark.read.parquet(paths.live_dedup), as_of=args.as_of)
        _show(V.station_history(flat, stations, args.code))
        _show(V.station_live(recent, args.code))
        _show(V.station_ymax(flat, recent, args.code))
        latest = P.fold_rows(spark.read.parquet(paths.live_latest))
        _show(V.station_thresholds(indicator(latest, spark.read.parquet(paths.hist_agg)), args.code))
    elif args.cmd == "top20":
        _show(V.live_top20(P.fold_rows(spark.read.parquet(paths.live_latest))))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
