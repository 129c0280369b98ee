"""Tables replaced as a whole, atomically (K2, K5).

Every version of a table is a folder of its own that is never written again;
the catalog entry names the current one.  A replacement writes the new folder
completely and then commits with one catalog statement (``ALTER TABLE ... SET
LOCATION``): a reader sees the old rows or the new ones, never half a table, and
a run that dies before the commit leaves the old table as it was.  Old versions
stay until ``vacuum``, so running queries end and ``roll_back`` is possible.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riverflow.sources.writers import clustered

HISTORY = "riverflow.versions"   # table property: locations, oldest first


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def versions(spark: SparkSession, name: str) -> list[str]:
    """Locations of the table's versions, the current one last; empty if there
    is no such table."""
    if not spark.catalog.tableExists(name):
        return []
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return [x for x in found.get(HISTORY, "").split("\n") if x]


def _commit(spark: SparkSession, name: str, location: str, history: list[str]) -> None:
    """Make ``location`` the table's content.  The properties go first: a run
    that stops between the two statements leaves the old content current."""
    listed = _quoted("\n".join(history))
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{HISTORY}' = {listed})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(location)}")
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(location)} TBLPROPERTIES ('{HISTORY}' = {listed})")
    spark.catalog.refreshTable(name)


def current(spark: SparkSession, name: str) -> str | None:
    """Folder of the table's current version."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def replace(df: DataFrame, name: str, root: str, cluster_by: list[str] | None = None) -> int:
    """Replace the catalog table ``name`` by ``df`` (its versions are folders
    of ``root``); returns the rows written.  ``df`` may read the table itself:
    its files are not touched."""
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/v-{int(time.time() * 1e6)}-{uuid.uuid4().hex[:8]}"
    seen = Observation("rows_written")
    clustered(df, cluster_by).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(location)
    _commit(spark, name, location, [*versions(spark, name), location])
    return int(seen.get.get("rows", 0))


def _same(a: str | None, b: str) -> bool:
    return a is not None and a.split(":", 1)[-1].rstrip("/").lstrip("/") == b.split(":", 1)[-1].rstrip("/").lstrip("/")


def roll_back(spark: SparkSession, name: str) -> str:
    """Make the version before the current one current again."""
    known, now = versions(spark, name), current(spark, name)
    at = next((i for i, x in enumerate(known) if _same(now, x)), len(known))
    if at == 0 or not known:
        raise ValueError(f"{name} has no earlier version")
    _commit(spark, name, known[at - 1], known[:at])
    return known[at - 1]


def vacuum(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest versions; returns their folders.  The
    current version is never deleted."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    known, now = versions(spark, name), current(spark, name)
    gone = [x for x in known[:-keep] if not _same(now, x)]
    if gone:
        left = [x for x in known if x not in gone]
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{HISTORY}' = {_quoted(chr(10).join(left))})")
    for folder in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)
    return gone
