"""Every registered query equals its DuckDB oracle (rows, names, types, values)."""

import os
import sys

import pytest

import __spark_entry__ as E
from riverflow.plans.catalog import QUERIES

from tests.conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from compare import _hash, duck  # noqa: E402

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cols, types, drows = duck(SF_SMALL, E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(cols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dict(zip(cols, types))
    assert len(rows) == len(drows)
    assert _hash(df.columns, rows) == _hash(cols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "flood_indicateur"
    assert df.count() > 0


def test_every_query_names_its_survey_ids():
    import re
    for name, fn in QUERIES.items():
        doc = fn.__doc__ or ""
        assert re.search(r"\b([A-Z]\d+[a-c]?|G2 incremental)\b", doc), name
