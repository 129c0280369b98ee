"""Domain-shaped views over the driver's test tables.

The reference ships no data; these views map the generic test tables onto
the river-flow schemas so that every query reads real, growing tables.  The
live, observation and history views are projections/filters of one scan
(the modulo arithmetic assigns synthetic station codes and coordinates;
nothing is sampled or capped); the stations are a dimension join, and the
landed envelopes and API pages group those rows into bounded pages.
Columns the mapping cannot fill are typed NULLs, so the frames carry the full
domain schema; timestamps stay ``timestamp_ntz`` like the test tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverflow import schemas
from riverflow.functions import file_tag
from riverflow.operators.joins import checked_broadcast
from riverflow.session import stage

NTZ = T.TimestampNTZType()
# History before this instant, live readings from it on.
HISTORY_END = "2001-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Named table read (parquet, schema from the file footer)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast(NTZ)


def conform(df: DataFrame, schema: T.StructType, ntz_timestamps: bool = True) -> DataFrame:
    """Select ``schema``'s columns in order; absent ones become typed NULLs."""
    target = schemas.with_ntz(schema) if ntz_timestamps else schema
    have = set(df.columns)
    cols = []
    for f in target.fields:
        src = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _station_code(key: Column) -> Column:
    return F.concat(F.lit("S"), key.cast("string"))


def _site_code(key: Column) -> Column:
    return F.concat(F.lit("T"), (key % 20).cast("string"))


def _lon(key: Column) -> Column:
    return (F.lit(-6) + key % 17).cast("double")


def _lat(key: Column) -> Column:
    return (F.lit(40) + key % 14).cast("double")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream (schema from the file footer)."""
    schema = table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .parquet(sf_dir))


def live_mapped(ev: DataFrame) -> DataFrame:
    """Events mapped to live records, keeping the event id (batch or stream)."""
    uid, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    mapped = ev.select(
        eid.alias("event_id"),
        _site_code(uid).alias("code_site"),
        F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(_station_code(uid))
        .alias("code_station"),
        F.when(et.isin("click", "view"), F.lit("Q")).when(et.isin("error", "signup"), F.lit("H"))
        .alias("grandeur_hydro"),
        (eid % 3).cast("bigint").alias("statut_serie"),
        F.col("ts").alias("date_obs"),
        (F.col("value") * 400).alias("resultat_obs"),
        _lon(uid).alias("longitude"),
        _lat(uid).alias("latitude"),
    )
    return conform(mapped, schemas.struct([("event_id", schemas.L)] + schemas.LIVE_FIELDS))


def _live_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_mapped(table(spark, sf_dir, "events"))


def fx_live_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One live observation per event; NULL stations (1 in 97) and NULL
    measures are deliberate, coordinates straddle the bounding box."""
    return _live_mapped(spark, sf_dir).drop("event_id")


def fx_live_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation landed twice, 5 and 10 minutes after it was taken,
    as the overlapping 10-minute pulls every 5 minutes do.  One scan."""
    return live_raw_from(table(spark, sf_dir, "events"))


def live_raw_from(ev: DataFrame) -> DataFrame:
    """fx_live_raw over any events frame (batch or stream)."""
    base = live_mapped(ev).drop("event_id")
    pulled = base.withColumn("_lag", F.explode(F.array(F.lit(5), F.lit(10))))
    return pulled.select(
        *[F.col(c) for c in schemas.LIVE_DEDUP_COLUMNS],
        (F.col("date_obs") + F.make_dt_interval(mins=F.col("_lag"))).alias("ingestion_timestamp"),
    )


def fx_hist_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily history before 2001: zeros for the ``> 0`` filter and an
    'other' measure for the measure filter; one day-file per ship date."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < ntz(HISTORY_END))
    sk = F.col("l_suppkey")
    day = F.col("l_shipdate").cast("date")
    mapped = li.select(
        _station_code(sk).alias("code_station"),
        _site_code(sk).alias("code_site"),
        F.when(F.col("l_linestatus") == "F", F.lit("QmJ")).otherwise(F.lit("other"))
        .alias("grandeur_hydro_elab"),
        F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
        .alias("resultat_obs_elab"),
        day.alias("date_obs_elab"),
        _lon(sk).alias("longitude"),
        _lat(sk).alias("latitude"),
        file_tag(day).alias("json_file"),
    )
    return conform(mapped, schemas.HIST_FLAT)


def fx_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live readings on the history's own scale, 2001 onward."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= ntz(HISTORY_END))
    sk = F.col("l_suppkey")
    mapped = li.select(
        _site_code(sk).alias("code_site"),
        _station_code(sk).alias("code_station"),
        F.when(F.col("l_linestatus") == "F", F.lit("Q")).otherwise(F.lit("H")).alias("grandeur_hydro"),
        F.col("l_shipdate").alias("date_obs"),
        F.col("l_extendedprice").alias("resultat_obs"),
        _lon(sk).alias("longitude"),
        _lat(sk).alias("latitude"),
    )
    return conform(mapped, schemas.LIVE_RECORD)


def fx_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension from supplier, nation and region."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = (s.join(n, s.s_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey))
    mapped = joined.select(
        _station_code(F.col("s_suppkey")).alias("code_station"),
        F.col("s_name").alias("libelle_station"),
        F.col("n_name").alias("libelle_commune"),
        F.col("n_nationkey").cast("string").alias("code_departement"),
        F.col("r_name").alias("libelle_region"),
    )
    return conform(mapped, schemas.STATION)


# Records per landed envelope page (a day-file larger than this is landed
# as several pages carrying the same json_file).
ENVELOPE_MAX_RECORDS = 5000
DAY_FILES_MAX_ROWS = 500_000  # (day-file, size) rows of a broadcast list


def fx_hist_envelopes(spark: SparkSession, sf_dir: str, max_records: int = ENVELOPE_MAX_RECORDS,
                      files: Column | None = None) -> DataFrame:
    """Day envelopes as landed: rows of one day-file with their records, of all
    day-files or of those that ``files`` (a test of ``json_file``) holds for.

    A day-file is cut into ceil(n / max_records) pages by a hash of each
    record, so no envelope (one row, built by one task) grows with the data:
    a day holding a third of all rows becomes many bounded pages.  The day
    sizes (one row per day-file, map-side counted) are stored, counted and
    broadcast, so rows are shuffled once, by day-file and page, which bounds
    what a task gets of one day.
    """
    flat = fx_hist_flat(spark, sf_dir)
    if files is not None:
        flat = flat.where(files)
    sizes = stage(flat.groupBy("json_file").agg(F.count(F.lit(1)).alias("_n")), "day_sizes")
    sized = flat.join(checked_broadcast(sizes, DAY_FILES_MAX_ROWS), on="json_file", how="inner")
    pages = F.ceil(F.col("_n") / F.lit(max_records))
    page = F.pmod(F.xxhash64(*[F.col(c) for c in flat.columns]), pages)
    record = F.struct(*[
        (F.col(n) if n != "date_prod" else F.lit(None).cast(t)).alias(n)
        for n, t in schemas.HIST_RECORD_FIELDS
    ])
    dealt = sized.withColumn("_page", page).repartition("json_file", "_page")
    env = dealt.groupBy("json_file", "_page").agg(
        F.collect_list(record).alias("data"),
        F.count(F.lit(1)).alias("count"),
    )
    return conform(env, schemas.HIST_RAW, ntz_timestamps=False)


def fx_live_pages(spark: SparkSession, sf_dir: str, page_size: int = 1000) -> DataFrame:
    """Live observations cut into API pages of ``page_size`` records by event
    id, each page pointing at the next one.  A page is bounded by page_size."""
    mapped = _live_mapped(spark, sf_dir)
    page = F.floor(F.col("event_id") / F.lit(page_size)).cast("bigint")
    record = F.struct(*[F.col(n) for n in schemas.LIVE_DEDUP_COLUMNS])
    pages = mapped.groupBy(page.alias("page")).agg(
        F.collect_list(record).alias("data"), F.count(F.lit(1)).alias("count"))
    return pages.select(
        "page", "count",
        F.concat(F.lit("page="), (F.col("page") + 1).cast("string")).alias("next"),
        "data",
    )
