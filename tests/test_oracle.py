"""Every registered query against its DuckDB twin (row count, columns,
order-insensitive value hash), on the smallest driver tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from patronage.plans.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem").split()


def _norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, int, decimal.Decimal)):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["customer_id", "recency_days"]


def test_decimal_column_list_is_current(spark):
    from scripts.gen_decimal_columns import decimal_columns
    from patronage.plans.decimal_columns import DECIMAL_COLUMNS, TEMPORAL_COLUMNS
    assert decimal_columns(spark, SF_SMALL) == (DECIMAL_COLUMNS, TEMPORAL_COLUMNS)


def test_driver_facing_outputs_have_no_decimals(spark, con):
    for name in ("rfm_scores", "clv_scores", "category_revenue", "order_details"):
        df = entry.queries()[name](spark, SF_SMALL)
        assert not [f for f in df.schema.fields
                    if f.dataType.typeName() in ("decimal", "date", "timestamp", "timestamp_ntz")], name
        types = [d[1] for d in con.execute(entry.oracle_sql()[name]).description]
        assert not [t for t in types if any(k in str(t) for k in ("DECIMAL", "DATE", "TIMESTAMP"))], name
