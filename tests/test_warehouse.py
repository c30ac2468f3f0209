"""Source 1 through the whole run: golden values, gates, idempotency, incremental behaviour."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import AS_OF, RUN_TS, at
from fixtures import d, frames, g1_tables, g4_tables
from pyspark.sql import functions as F
from rodovia.plans import maintained, quality as Q, refresh, reports, views
from rodovia.plans.star import GateError
from rodovia.sources.extract import Log


def config(tmp, **kw):
    return refresh.Config(str(tmp), AS_OF, kw.pop("run_ts", RUN_TS), **kw)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    cfg = config(tmp_path_factory.mktemp("g1"))
    report = refresh.run_all(spark, {1: frames(spark, g1_tables())}, cfg)
    return cfg, report, refresh.warehouse(report.store)


def one(df, key, value, *columns):
    return tuple(df.filter(F.col(key) == value).select(*columns).first())


def test_counts(spark, loaded):
    cfg, report, dw = loaded
    conf = cfg.store(spark, "conf")
    assert report.outcomes[0].ok and report.outcomes[0].rows["locacao"] == 3
    assert dw["fato_locacao"].count() == conf.read("conf_locacao").count() == 3
    assert dw["fato_reserva"].count() == conf.read("conf_reserva").count() == 3
    assert dw["fato_veiculo_no_patio"].count() == 2
    assert dw["dim_cliente"].count() == 3


def test_rental_measures(loaded):
    rentals = loaded[2]["fato_locacao"]
    assert one(rentals, "locacao_id", "1-1", "dias_realizados", "atraso_devolucao_dias", "km_rodado",
               "valor_multa_atraso", "status_cobranca") == (5, 2, 350, Decimal("200.00"), "pago")
    assert one(rentals, "locacao_id", "1-2", "atraso_devolucao_dias") == (0,)
    assert one(rentals, "locacao_id", "1-3", "km_rodado", "valor_cobranca", "status_cobranca") == (
        0, Decimal("300.00"), "pendente")


def test_imputation_and_domains(loaded):
    dw = loaded[2]
    assert one(dw["dim_cliente"], "cliente_id", "1-3", "nome", "flag_nome_imputado") == (
        "Cliente nao informado", True)
    assert one(dw["dim_veiculo"], "veiculo_id", "1-3", "placa", "flag_placa_imputada") == ("SEMPLACA", True)
    assert one(dw["dim_veiculo"], "veiculo_id", "1-2", "status") == ("desconhecido",)
    assert one(dw["fato_reserva"], "reserva_id", "1-3", "status_reserva") == ("desconhecida",)


def test_facts_of_some_months(loaded):
    cfg, report, dw = loaded
    day = at(-4)
    some = refresh.warehouse(report.store, [day.year * 100 + day.month])
    assert some["fato_locacao"].count() == 3 and len(some["fato_locacao"].inputFiles()) <= len(dw["fato_locacao"].inputFiles())
    none = refresh.warehouse(report.store, [199001])
    assert none["fato_locacao"].count() == 0 and none["fato_locacao"].columns == dw["fato_locacao"].columns
    assert none["dim_cliente"].count() == 3


def test_no_missing_keys_and_continuous_calendar(loaded):
    dw = loaded[2]
    Q.run_gates(dw)
    row = Q.calendar_continuity(dw["dim_tempo"]).first()
    assert row.dias == row.intervalo


def test_views_agree_with_facts(loaded):
    assert all(r.total_view == r.total_fato for r in Q.view_reconciliation(loaded[2]).collect())


def test_views_are_queryable_by_name(spark, loaded):
    views.register(spark, loaded[2])
    row = spark.sql("SELECT sum(total_locacoes) n FROM vw_locacoes_por_mes").first()
    assert row.n == 3


def test_reports(loaded):
    dw = loaded[2]
    late = reports.late_returns(dw).collect()
    assert [(r.nome_cliente, r.atraso_em_dias) for r in late] == [("Alice Prado", 2), ("Alice Prado", 1)]
    assert late[0].veiculo == "ABC1D23 - Fiat Mobi"
    use = {r.patio: (r.retiradas, r.devolucoes, r.giro_por_vaga) for r in reports.yard_use(dw).collect()}
    assert use == {"Patio Centro": (2, 1, None), "Patio Sul": (1, 2, None)}
    assert reports.never_rented(dw).count() == 0
    assert reports.cancellation_rate(dw).count() == 0  # no group has five reservations
    assert reports.cancellation_rate(dw, at_least=1).count() == 2
    top = reports.top_clients(dw).collect()
    assert [(r.nome_cliente, r.receita_total, r.ticket_medio) for r in top] == [
        ("Alice Prado", Decimal("800.00"), Decimal("400.00")), ("Comercio Delta", Decimal("750.00"), Decimal("750.00"))]


def content(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_second_load_changes_nothing(spark, tmp_path):
    cfg = config(tmp_path, conformed_markers=True)
    source = {1: frames(spark, g1_tables())}
    refresh.run_all(spark, source, cfg)
    marked = cfg.store(spark, "conf").read("conf_locacao")
    assert marked.filter("sk_cliente IS NULL OR sk_veiculo IS NULL OR sk_reserva IS NULL").isEmpty()
    first = {n: content(t) for n, t in refresh.warehouse(cfg.store(spark, "dw")).items()}
    folders = cfg.store(spark, "dw").current()[1]
    refresh.run_load(spark, cfg)
    now = cfg.store(spark, "dw").current()[1]
    assert all(now[n] == folders[n] for n in ("fato_reserva", "fato_locacao", "fato_veiculo_no_patio"))  # no month rewritten
    assert cfg.store(spark, "dw").vacuum(keep=1) and cfg.store(spark, "dw").vacuum(keep=1) == []
    again = {n: content(t) for n, t in refresh.warehouse(cfg.store(spark, "dw")).items()}
    assert first == again  # surrogate keys included


def test_incremental_run_keeps_history_and_keys(spark, tmp_path):
    tables = g1_tables()
    cfg = config(tmp_path, maintain_views=True)
    refresh.run_all(spark, {1: frames(spark, tables)}, cfg)
    before = {r.locacao_id: r.sk_fato_locacao for r in cfg.store(spark, "dw").read("fato_locacao").collect()}
    parts = cfg.store(spark, "dw").current()[1]

    # Four weeks on: rental 3 is corrected into another month, rental 4 is new, 1 and 2 left the window.
    ddl, rows = tables["locacao"]
    third = list(rows[2])
    third[7], third[9], third[14] = at(25), at(27), at(25)
    fourth = (4, None, 1, 1, 1, 2, at(26), at(26), at(28), None, 10350, None, "ok", None, at(26))
    tables["locacao"] = (ddl, [rows[0], rows[1], tuple(third), fourth])
    tables["cliente"] = (tables["cliente"][0], [(1, "Alice P.", "PF", "Niteroi"), *tables["cliente"][1][1:]])
    later = config(tmp_path, run_ts=RUN_TS + dt.timedelta(days=20), maintain_views=True, keep_versions=2)
    refresh.run_all(spark, {1: frames(spark, tables)}, later)
    staged = cfg.store(spark, "stg").read("locacao")
    assert sorted(r.src_id for r in staged.collect()) == [3, 4]
    rows = {r.locacao_id: r for r in cfg.store(spark, "dw").read("fato_locacao").collect()}
    assert set(rows) == {"1-1", "1-2", "1-3", "1-4"}
    assert all(rows[k].sk_fato_locacao == sk for k, sk in before.items())
    assert rows["1-4"].sk_fato_locacao == max(before.values()) + 1
    assert rows["1-3"].mes_particao == at(25).year * 100 + at(25).month
    names = {r.cliente_id: r.nome for r in cfg.store(spark, "dw").read("dim_cliente").collect()}
    assert names["1-1"] == "Alice P."
    # The maintained views follow; only the parts of the two months of rental 3 and of the new one were computed.
    store, dw = cfg.store(spark, "dw"), refresh.warehouse(cfg.store(spark, "dw"))
    now = store.current()[1]
    assert now["parte_reservas_status"] == parts["parte_reservas_status"]
    assert {m for m, p in now["parte_locacoes_dia"].items() if parts["parte_locacoes_dia"].get(m) != p} == {
        str(day.year * 100 + day.month) for day in (at(-4), at(25), at(26))}
    kept = maintained.current(store)
    for name, frame in kept.items():
        whole = reports.monthly_revenue(dw) if name == "r1_monthly_revenue" else views.VIEWS[name](dw)
        assert content(frame) == content(whole), name


def test_orphan_rental_stops_or_is_set_aside(spark, tmp_path):
    tables = g1_tables()
    ddl, rows = tables["locacao"]
    stray = list(rows[0])
    stray[0], stray[2] = 9, 77  # no such vehicle
    tables["locacao"] = (ddl, [*rows, tuple(stray)])
    source = {1: frames(spark, tables)}
    with pytest.raises(GateError, match="fato_locacao: 1 row"):
        refresh.run_all(spark, source, config(tmp_path / "strict"))
    strict = config(tmp_path / "strict").store(spark, "dw")
    assert strict.get("fato_locacao") is None and strict.get("fato_reserva") is None
    cfg = config(tmp_path / "lenient", quarantine=True)
    dw = refresh.run_all(spark, source, cfg).store
    assert dw.read("fato_locacao").count() == 3
    assert [r.locacao_id for r in dw.read("quarentena_fato_locacao").collect()] == ["1-9"]
    tables["locacao"] = (ddl, rows)
    dw = refresh.run_all(spark, {1: frames(spark, tables)}, cfg).store
    assert dw.get("quarentena_fato_locacao") is None


def test_vehicle_without_company(spark, tmp_path):
    source = {4: frames(spark, g4_tables())}
    with pytest.raises(GateError, match="dim_veiculo: 4 row"):
        refresh.run_all(spark, source, config(tmp_path / "strict", unknown_company=False))
    dw = refresh.run_all(spark, source, config(tmp_path / "member")).store
    firms = {r.empresa_id: r.nome for r in dw.read("dim_empresa").collect()}
    assert firms == {"4-EMPRESA_ND": "Empresa G4", "4-DONA_FILHOS": "Dona & Filhos"}


def test_failed_load_leaves_the_old_version(spark, tmp_path):
    cfg = config(tmp_path)
    refresh.run_all(spark, {1: frames(spark, g1_tables())}, cfg)
    tables = g1_tables()
    ddl, rows = tables["reserva"]
    tables["reserva"] = (ddl, [*rows, (9, 88, 1, 1, 1, at(0), at(1), "ativa")])  # no such client
    with pytest.raises(GateError):
        refresh.run_all(spark, {1: frames(spark, tables)}, cfg)
    dw = cfg.store(spark, "dw")
    assert dw.read("fato_reserva").count() == 3
    with pytest.raises(PermissionError):
        refresh.rebuild(dw)
    assert dw.read("dim_cliente").count() == 3
    refresh.rebuild(dw, confirm=True)
    assert dw.get("dim_cliente") is None


def test_gates_raise(spark, loaded):
    dw = dict(loaded[2])
    bad = dw["dim_cliente"].withColumn("tipo", F.lit("XX"))
    with pytest.raises(Q.DataQualityError, match="domains"):
        Q.run_gates({**dw, "dim_cliente": bad})
    with pytest.raises(Q.DataQualityError, match="duplicate"):
        Q.run_gates({**dw, "dim_cliente": dw["dim_cliente"].union(dw["dim_cliente"])})
    with pytest.raises(Q.DataQualityError, match="empty"):
        Q.run_gates({**dw, "fato_locacao": dw["fato_locacao"].limit(0)})
    negative = dw["fato_reserva"].withColumn("dias_reservados", F.lit(-1))
    with pytest.raises(Q.DataQualityError, match="dias_negativos"):
        Q.run_gates({**dw, "fato_reserva": negative})
    with pytest.raises(Q.DataQualityError, match="orphan"):
        Q.run_gates({**dw, "dim_patio": dw["dim_patio"].limit(1)})


def test_log(spark, loaded):
    cfg = loaded[0]
    entries = Log(spark, cfg.store(spark, "stg").root).read()
    assert {(r.tabela_stg, r.qtd_registros) for r in entries.collect()} >= {("vaga", 3), ("cobranca", 3)}
    stg = refresh.staging_tables(spark, cfg.store(spark, "stg"))
    assert all(r.qtd_registrada_no_log == r.qtd_atual_staging for r in Q.log_against_staging(entries, stg).collect())
    assert d(1) == Decimal("1.00")
