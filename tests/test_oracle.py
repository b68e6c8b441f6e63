"""Every catalog query that has oracle SQL must match DuckDB on sf0.001."""

import math

import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return "-0.0" if (v == 0.0 and math.copysign(1.0, v) < 0) else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


def _types(schema):
    alias = {"large_string": "string", "string_view": "string"}
    return {f.name: alias.get(str(f.type), str(f.type)) for f in schema}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, duck, name):
    got_arrow = entry.queries()[name](spark, SF_SMALL).toArrow()
    want_arrow = duck.sql(ORACLES[name]).to_arrow_table()
    assert _types(got_arrow.schema) == _types(want_arrow.schema)
    c1, r1 = _rows(got_arrow.to_pandas())
    c2, r2 = _rows(want_arrow.to_pandas())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "Gini" in df.columns
