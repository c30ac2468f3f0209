"""Registered queries against their SQL on DuckDB, with generated code. FULL_QUERIES=1 runs all of them, otherwise one of each
kind that builds the whole star or runs a stream, and all others."""

import os

import pytest

import __spark_entry__ as entry
from rodovia.workload import catalog
from tools.check_queries import connect, rows_of

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
LIGHT = ("status_", "tipo_", "mecan", "placa", "dias_inc", "dias_atr", "km_", "valor_", "chave", "rotulo", "imputacao", "dedup", "extract_",
         "source_mapping", "literal", "distinct", "calendar_gaps", "q03", "q05", "q06", "q07", "q08", "i1", "i2", "i3", "i4", "i5", "p")
SAMPLE = [n for n in catalog.QUERIES if n.startswith(LIGHT)] + [
    "conf_empresa", "conf_cobranca", "upsert_scd1", "gate_counts_reserva", "q09_staging_vs_conformed", "z_usage", "z_order", "z_session",
    "z_rental_usage", "z_clip_join", "z_alerts"]


@pytest.fixture(scope="module", autouse=True)
def generated_code(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("FULL_QUERIES") else SAMPLE)
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, SF)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(frame.columns)
    assert got == rows_of(names, cur.fetchall())


def test_every_query_has_sql():
    assert not set(catalog.QUERIES) - set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
