"""The driver contract: names agree, and every query with SQL equals it on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from corvid.plans import catalog, site_queries  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def rows(frame) -> list:  # noqa: ANN001
    def plain(v):  # noqa: ANN001, ANN202
        if v is None or str(v) in ("<NA>", "nan"):
            return None
        return round(float(v), 6) if hasattr(v, "__float__") and not isinstance(v, (str, bool)) else str(v)

    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


def test_names() -> None:
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark) -> None:  # noqa: ANN001
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, name) -> None:  # noqa: ANN001
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), con.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
