"""Mappings of the other sources, failure isolation and incremental windows."""

import datetime as dt

import pytest

from conftest import RUN_TS, at
from fixtures import d, frames, g1_tables, g2_tables, g3_tables, g4_tables
from rodovia.operators.store import TableStore
from rodovia.schemas import STAGING, column_names
from rodovia.sources import extract as X, mappings as M
from rodovia.sources.registry import JdbcSource, MissingTable

MARKS = {}


def staged(spark, source, tables, options=M.Options(), marks=None):
    return X.source_frames(source, frames(spark, tables), marks or {}, RUN_TS, options)


def rows(df, *columns, key="src_id"):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def test_source_2(spark):
    out = staged(spark, 2, g2_tables())
    assert all(df.columns == column_names(STAGING[e]) for e, df in out.items())
    assert rows(out["cliente"], "tipo", "cidade", "uf") == {1: ("PF", "Santos", "sp"), 2: ("PF", "Campinas", "SP")}
    assert rows(out["condutor"], "src_cliente_id", "cnh") == {1: (1, "123")}
    assert rows(out["veiculo"], "tipo_mecanizacao", "ar_condicionado", "status", "src_empresa_id", "nome_empresa") == {
        1: ("automatico", True, "alugado", 7, "Locadora Dois"), 2: ("manual", False, "disponivel", 7, "Locadora Dois")}
    assert rows(out["patio"], "capacidade", "cidade") == {1: (2, "Santos"), 2: (0, "Campinas")}
    assert rows(out["vaga"], "status", key="codigo") == {"1": ("ocupada",), "2": ("livre",)}
    # 5 is old and not cancelled, so it stays behind; code 9 has no label.
    assert rows(out["reserva"], "status") == {1: ("ativa",), 2: ("cancelada",), 3: ("confirmada",), 4: (None,)}
    assert rows(out["locacao"], "src_devolucao_id", "src_patio_devolucao_id", "gasolina_entrega",
                "gasolina_devolucao", "valor_atraso", "preco_final") == {
        1: (11, 1, 90, 40, d(50), d(240)), 2: (None, None, 90, None, None, d(160))}
    assert rows(out["cobranca"], "valor", "status") == {1: (d(320), "pago"), 2: (d(160), "pendente")}


def test_source_2_slot_option(spark):
    out = staged(spark, 2, g2_tables(), M.Options(g2_slot_means_rented=False))
    assert rows(out["veiculo"], "status") == {1: ("disponivel",), 2: ("disponivel",)}


def test_source_3(spark):
    out = staged(spark, 3, g3_tables())
    assert rows(out["cliente"], "nome", "tipo") == {1: ("Edu", "PF"), 2: ("Frete SA", "PJ")}
    assert rows(out["patio"], "capacidade", "nome_empresa") == {1: (40, "Locadora Tres")}
    assert rows(out["veiculo"], "tipo_mecanizacao", "ar_condicionado", "src_empresa_id") == {
        1: ("Automatica", True, 2)}
    assert rows(out["reserva"], "preco_previsto") == {1: (d(900),), 2: (d(1),)}
    assert rows(out["locacao"], "src_cliente_id", "valor_total") == {1: (2, d(600)), 2: (2, None)}
    assert rows(out["cobranca"], "valor", "status") == {1: (d(600), "pago"), 2: (d(0), "pendente")}


def test_source_4(spark):
    out = staged(spark, 4, g4_tables())
    assert rows(out["veiculo"], "ar_condicionado", "nome_empresa") == {
        1: (True, None), 2: (True, None), 3: (False, None), 4: (False, None)}
    assert rows(out["cliente"], "cidade") == {1: (None,)}
    assert rows(out["patio"], "src_empresa_id", "nome_empresa") == {1: (None, "Dona & Filhos")}
    assert rows(out["locacao"], "valor_final", "src_cliente_id") == {1: (d(700), 1)}


def test_source_1_without_daily_rate(spark):
    tables = g1_tables()
    tables["grupo_veiculo"] = ("id int, nome string, categoria string", [(1, "Economico", "Hatch")])
    out = staged(spark, 1, tables)
    assert rows(out["grupo_veiculo"], "diaria") == {1: (None,)}


def test_windows_of_source_1(spark):
    """Rows before the mark stay behind unless they are still open."""
    marks = {t: at(-1) for t in ("reserva", "locacao", "cobranca", "movimentacao_patio")}
    tables = g1_tables()
    ddl, rentals = tables["locacao"]
    out_now = (4, None, 1, 1, 1, 2, at(-99), at(-99), at(-90), None, 10, None, "ok", None, at(-99))
    tables["locacao"] = (ddl, [*rentals, out_now])
    out = staged(spark, 1, tables, marks=marks)
    assert set(rows(out["reserva"], "status")) == {2}       # cancelled
    assert set(rows(out["locacao"], "status")) == {4}       # picked up, not returned
    assert set(rows(out["cobranca"], "status")) == {1, 3}   # paid since, or pending
    assert set(rows(out["movimentacao_patio"], "motivo")) == {2}


def test_marks(spark):
    log = spark.createDataFrame([
        (1, "reserva", at(-3), 5, "OK", None), (1, "reserva", at(-2), 5, "OK", None),
        (1, "reserva", at(-1), 0, "ERR", "x"), (2, "reserva", at(0), 5, "OK", None)], X.EXTRACTION_LOG)
    marks = X.high_water_marks(log, 1, RUN_TS)
    assert marks == {"reserva": at(-2) - dt.timedelta(hours=1)}
    assert X.mark_for("locacao", marks, RUN_TS) == RUN_TS - dt.timedelta(days=7)


def test_one_failing_source_does_not_stop_the_others(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    two_firms, parked_twice = g2_tables(), g2_tables()
    two_firms["empresa"] = (two_firms["empresa"][0], [(7, "A"), (8, "B")])
    parked_twice["vaga"] = (parked_twice["vaga"][0], [(1, 1, 1), (2, 1, 1)])
    good = X.extract_all(store, {2: frames(spark, g2_tables())}, RUN_TS)
    assert good[0].ok
    later = RUN_TS + dt.timedelta(days=1)
    bad = X.extract_all(store, {2: frames(spark, two_firms), 3: frames(spark, g3_tables())}, later)
    assert [o.ok for o in bad] == [False, True]
    assert "2 companies" in bad[0].error
    clash = X.extract_source(store, 2, frames(spark, parked_twice), later)
    assert not clash.ok and "veiculo" in clash.error
    missing = g3_tables()
    del missing["patio"]
    gone = X.extract_source(store, 3, frames(spark, missing), later)
    assert not gone.ok and "patio" in gone.error
    # The failed sources kept their earlier slice; ids of different sources do not collide.
    held = {(r.grupo_fonte, r.src_id) for r in store.read("veiculo").collect()}
    assert held == {(2, 1), (2, 2), (3, 1)}
    log = X.Log(spark, store.root).read()
    errors = {(r.grupo_fonte, r.tabela_stg, r.qtd_registros) for r in log.filter("status = 'ERR'").collect()}
    assert errors == {(2, "GRUPO_2", 0), (3, "GRUPO_3", 0)}
    assert X.high_water_marks(log, 2, later)["reserva"] == RUN_TS - X.OVERLAP  # errors set no mark


def test_unknown_table():
    with pytest.raises(MissingTable):
        frames(None, {}).table("nada")


def test_jdbc_source_splits_reads():
    class Reader:
        seen = {}

        def __getattr__(self, name):
            def call(*a, **k):
                self.seen.update(k)
                if len(a) == 2:
                    self.seen[a[0]] = a[1]
                return self
            return call

    class Session:
        read = Reader()

    JdbcSource(Session(), "jdbc:x", "oltp_g1", split={"locacao": ("id", 1, 9)}, partitions=3).table("locacao")
    assert Reader.seen["dbtable"] == "oltp_g1.locacao"
    assert (Reader.seen["partitionColumn"], Reader.seen["numPartitions"]) == ("id", 3)
