"""Each headline query against its DuckDB statement on the sf0.001 tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

KEYS = ["monthly_value", "top_contracts", "top_contracts_compat", "top_miners", "overhead_columns",
        "overhead_total", "monthly_gas", "above_below_mean", "top_scams", "top_scams_compat",
        "scam_monthly", "zero_filled_series", "chart_series", "quality_report", "scan_transactions",
        "scan_registry", "read_pair_result", "filter_lenient", "valid_contract_compat", "exact_amount",
        "quality_report_contracts", "quality_report_blocks", "top_scams_columnar", "sink_full_result", "saved_series",
        "quality_report_registry", "block_overhead_columns", "block_reconcile", "monthly_gas_contracts",
        "filter_numeric_compat", "valid_tx_value_time_compat", "project_fields_compat"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def canon(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


def test_every_ledger_query_has_an_oracle():
    from chaintally.plans.catalog import QUERIES
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["month", "n", "avg_value"] and df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, duck, key):
    df = queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    mine = [tuple(r[c] for c in cols) for r in df.collect()]
    res = duck.sql(oracle_sql()[key])
    assert sorted(res.columns) == cols
    idx = [res.columns.index(c) for c in cols]
    theirs = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert canon(mine) == canon(theirs)
