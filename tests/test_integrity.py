"""Operational audits: one bad row per rule, delete impact, seed scenarios."""

import pytest

from conftest import at, on
from fixtures import d
from rodovia.plans import integrity as I, operational as P

SEED = {
    "empresa_locadora": ("id int, nome string, cnpj string", [(1, "Um", "1"), (2, "Dois", "2")]),
    "cliente": ("id int, nome string, tipo string", [(i, f"C{i}", "PF") for i in range(1, 11)]),
    "condutor": ("id int, cliente_id int, nome string, cnh string", [(i, i, f"D{i}", f"cnh{i}") for i in range(1, 8)]),
    "grupo_veiculo": ("id int, nome string", [(1, "Eco"), (2, "Exec")]),
    "veiculo": ("id int, placa string, chassi string, tipo_mecanizacao string, status string, grupo_id int, empresa_id int",
                [(i, f"P{i}", f"X{i}", "manual", "manutencao" if i == 9 else "disponivel", 1, 1) for i in range(1, 11)]),
    "acessorio": ("id int, nome string", [(1, "GPS"), (2, "Rack")]),
    "veiculo_acessorio": ("veiculo_id int, acessorio_id int", [(1, 1), (1, 2), (4, 1)]),
    "patio": ("id int, nome string", [(1, "Centro"), (2, "Barra"), (3, "Vazio")]),
    "vaga": ("codigo string, patio_id int, status string", [("A1", 1, "livre"), ("B1", 2, "ocupada"), ("C1", 3, "livre"),
                                                           ("C2", 3, "livre")]),
    "reserva": ("id int, cliente_id int, grupo_id int, patio_retirada_id int, patio_devolucao_id int, data_inicio date, "
                "data_fim date, status string", [(i, (i - 1) % 7 + 1, 1, 1, 2, on(0), on(3), "confirmada") for i in range(1, 10)]),
    "locacao": ("id int, reserva_id int, veiculo_id int, condutor_id int, patio_retirada_id int, patio_devolucao_id int, "
                "data_retirada_prevista timestamp_ntz, data_retirada_realizada timestamp_ntz, "
                "data_devolucao_prevista timestamp_ntz, data_devolucao_realizada timestamp_ntz, km_entrega int, km_devolucao int",
                [(i, None if i == 5 else i, i + 1, i, 1, 2, at(-9), at(-9), at(-5), back, 10, None if back is None else 20)
                 for i, back in enumerate([at(-6), at(-1), None, None, at(-5), at(0), at(-6)], 1)]),
    "cobranca": ("id int, locacao_id int, valor decimal(12,2), status string",
                 [(1, 1, d(500), "pago"), (2, 2, d(20), "pago"), (3, 5, d(1), "pago"), (4, 6, d(9), "pendente"),
                  (5, 7, d(3), "cancelado")]),
    "seguro": ("id int, tipo string, valor decimal(10,2)", [(1, "Basico", d(89))]),
    "locacao_seguro": ("locacao_id int, seguro_id int", [(1, 1), (2, 1)]),
    "foto": ("id int, veiculo_id int", [(1, 1), (2, 1), (3, 4)]),
    "manutencao": ("id int, veiculo_id int", [(1, 9), (2, 1)]),
    "movimentacao_patio": ("id int, veiculo_id int, origem_patio_id int, destino_patio_id int, data_movimentacao timestamp_ntz, "
                           "motivo string", [(1, 1, 1, 2, at(-3), "x")]),
}


def oltp(spark, **extra):
    tables = {n: (ddl, [*rows, *extra.get(n, [])]) for n, (ddl, rows) in SEED.items()}
    return {n: spark.createDataFrame(rows, ddl) for n, (ddl, rows) in tables.items()}


def found(df, count="violacoes"):
    return {(r["tabela"], r[1]): r[count] for r in df.collect() if r[count]}


def rental(i, **kw):
    names = [p.split()[0] for p in SEED["locacao"][0].split(", ")]
    base = dict(zip(names, SEED["locacao"][1][0]))
    return tuple({**base, "id": i, "reserva_id": None, **kw}[n] for n in names)


def test_clean_seed_passes(spark):
    t = oltp(spark)
    rules = {**I.domain_rules(), **I.temporal_rules(), **I.odometer_rules(), **I.value_rules()}
    assert found(I.audit(t, rules)) == {}
    assert found(I.uniqueness(t), "chaves") == {}
    assert found(I.foreign_keys(t), "orfaos") == {}


def test_each_rule_finds_its_bad_row(spark):
    t = oltp(
        spark,
        cliente=[(11, "Ruim", "XX")],
        veiculo=[(11, "P11", "X11", "cvt", "vendido", 1, 1), (12, "P1", "X12", "manual", "disponivel", 1, 1)],
        condutor=[(8, 1, "Copia", "cnh1")],
        reserva=[(10, 1, 1, 1, 2, on(4), on(3), "ativa"), (11, 1, 7, 1, 2, on(0), on(0), "ativa")],
        locacao=[rental(8, data_devolucao_prevista=at(-20)), rental(9, km_entrega=None), rental(10, reserva_id=1),
                 rental(11, km_devolucao=None), rental(12, data_retirada_realizada=None)],
        cobranca=[(6, None, d(-1), "pendente"), (7, None, d(1), "pendente")],
        seguro=[(2, "Neg", d(-10))],
        movimentacao_patio=[(2, 1, 1, 1, at(-1), "parado")])
    assert found(I.audit(t, I.domain_rules())) == {
        ("cliente", "tipo_fora_do_dominio"): 1, ("veiculo", "tipo_mecanizacao_fora_do_dominio"): 1,
        ("veiculo", "status_fora_do_dominio"): 1}
    assert found(I.audit(t, I.temporal_rules())) == {
        ("reserva", "fim_antes_do_inicio"): 1, ("locacao", "devolucao_prevista_antes_da_retirada"): 1,
        ("locacao", "devolucao_sem_retirada_ou_anterior"): 1}
    assert found(I.audit(t, I.odometer_rules())) == {
        ("locacao", "retirada_sem_km"): 1, ("locacao", "devolucao_sem_km"): 1}
    assert found(I.audit(t, I.value_rules())) == {
        ("cobranca", "valor_negativo"): 1, ("seguro", "valor_negativo"): 1, ("movimentacao_patio", "origem_igual_destino"): 1}
    assert found(I.uniqueness(t), "linhas") == {
        ("veiculo", "placa"): 2, ("condutor", "cnh"): 2, ("locacao", "reserva_id"): 2}  # NULL billings may repeat
    assert found(I.foreign_keys(t), "orfaos") == {("reserva", "grupo_id"): 1}
    bad = I.violations(t, "cliente", I.domain_rules()["cliente", "tipo_fora_do_dominio"])
    assert [r.id for r in bad.collect()] == [11]


@pytest.mark.parametrize("table,where,want,free", [
    ("veiculo", "id = 1", {("veiculo_acessorio", "veiculo_id", "CASCADE"): 2, ("foto", "veiculo_id", "CASCADE"): 2,
                           ("manutencao", "veiculo_id", "CASCADE"): 1, ("movimentacao_patio", "veiculo_id", "RESTRICT"): 1}, False),
    ("veiculo", "id = 9", {("manutencao", "veiculo_id", "CASCADE"): 1}, True),
    ("patio", "id = 3", {("vaga", "patio_id", "CASCADE"): 2}, True),
    ("reserva", "id = 1", {("locacao", "reserva_id", "SET NULL"): 1}, True),
    ("locacao", "id = 1", {("cobranca", "locacao_id", "SET NULL"): 1, ("locacao_seguro", "locacao_id", "CASCADE"): 1}, True),
    ("seguro", "id = 1", {("locacao_seguro", "seguro_id", "RESTRICT"): 2}, False),
    ("cliente", "id = 10", {}, True),
])
def test_delete_impact(spark, table, where, want, free):
    t = oltp(spark)
    doomed = t[table].filter(where)
    got = {(r.tabela, r.coluna, r.acao): r.linhas for r in I.delete_impact(t, table, doomed).collect() if r.linhas}
    assert got == want and I.deletable(t, table, doomed) is free


def test_seed_scenarios(spark):
    t = oltp(spark)
    assert {r.cenario: r.total for r in P.scenario_counts(t).collect()} == {
        "locacoes_ativas": 2, "locacoes_encerradas": 5, "locacoes_com_atraso": 2, "veiculos_em_manutencao": 1,
        "cobranca_pago": 3, "cobranca_pendente": 1, "cobranca_cancelado": 1}
    assert sorted(r.id for r in P.clients_without_reservation(t).collect()) == [8, 9, 10]
    assert [(r.patio_retirada, r.total_reservas) for r in P.reservations_per_yard(t).collect()] == [("Centro", 9)]
    assert P.rental_details(t).count() == 6  # the walk-in has no reservation
    assert P.yard_moves(t).first().patio_destino == "Barra"
    assert P.billing_per_rental(t).count() == 5
    assert P.vehicles_per_company_and_group(t).first().total_veiculos == 10
