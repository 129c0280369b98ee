"""Storage layout for point lookups.

Rows are ordered along a Morton curve of the station's hash and the day: the
bits of both are interleaved, so a file holds a small square of stations and
days, and a lookup by either key opens about the square root of the files.  The
stored ``station_hash`` carries the min/max statistics for it, and a Parquet
Bloom filter on the station's code skips row groups whose range of hashes holds
the station but that have no row of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

STATION_HASH = "station_hash"
BITS = 16


def station_hash(station: str | Column) -> Column:
    """16 bits of a station's hash; NULL stations share the hash of NULL."""
    return F.pmod(F.xxhash64(station), F.lit(1 << BITS)).cast("int")


def _spread(x: Column) -> Column:
    """The 16 bits of ``x`` moved to the even places of 32."""
    x = x.cast("bigint")
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def morton(a: Column, b: Column) -> Column:
    """Interleaved low 16 bits of two non-negative numbers, those of ``a`` in
    the even places."""
    return _spread(a).bitwiseOR(F.shiftleft(_spread(b), 1))


def along_curve(df: DataFrame, station: str = "code_station", day: str = "date_obs_elab",
                partitions: int | None = None) -> DataFrame:
    """``df`` (best a stored table: it is scanned for its first and last day,
    and sampled) with STATION_HASH, range-partitioned and sorted along the curve.

    The days between the first and the last are stretched over all BITS bits,
    so both keys are cut equally often.  A NULL day counts as the first.  A row
    hash is the last range key, so one station's day in bulk is cut too."""
    first, last = df.agg(F.min(day), F.max(day)).first()
    days = (last - first).days + 1 if first is not None else 1
    place_of_day = F.floor(F.coalesce(F.datediff(day, F.lit(first).cast("date")), F.lit(0)) * F.lit((1 << BITS) / days))
    place = morton(station_hash(station), place_of_day)
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = df.withColumns({STATION_HASH: station_hash(station), "place_": place, "spread_": spread})
    parts = [partitions] if partitions else []
    return keyed.repartitionByRange(*parts, "place_", "spread_").sortWithinPartitions("place_").drop("place_", "spread_")


def with_blooms(writer: DataFrameWriter, columns: dict[str, int]) -> DataFrameWriter:
    """Parquet Bloom filters on ``columns`` (expected distinct values of a file)."""
    for name, distinct in columns.items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct)))
    return writer


def of_station(df: DataFrame, code: str, station: str = "code_station") -> DataFrame:
    """One station's rows; the hash is compared too where the table has it."""
    out = df.where(F.col(station) == F.lit(code))
    if STATION_HASH in df.columns:
        out = out.where(F.col(STATION_HASH) == station_hash(F.lit(code)))
    return out
