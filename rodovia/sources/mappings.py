"""Projections of each company's tables onto the staging entities.

A mapping is a function ``(source, options, mark) -> DataFrame`` of staging columns; ``mark`` is the
incremental lower bound (a datetime) or None for a full load. Extraction adds the source tag, the load
time and any staging column the source lacks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Options:
    # Source 2 treats a vehicle parked in a slot as rented; False reads it as available.
    g2_slot_means_rented: bool = True


@dataclass(frozen=True)
class EntityMapping:
    entity: str
    frame: Callable[[object, Options, dt.datetime | None], DataFrame]
    incremental: bool = False


def _since(column: str, mark: dt.datetime | None, whole_day: bool = False) -> Column:
    """``column >= mark`` with a literal bound, so the predicate reaches the scan."""
    if mark is None:
        return F.lit(True)
    bound = dt.datetime.combine(mark.date(), dt.time()) if whole_day else mark
    return F.col(column) >= F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")


def _renamed(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Select staging columns: keyword = source column name or expression."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def _paid(returned: str) -> Column:
    return F.when(F.col(returned).isNotNull(), "pago").otherwise("pendente")


def _amount(column: str) -> Column:
    return F.coalesce(F.col(column).cast("decimal(10,2)"), F.lit(0).cast("decimal(10,2)"))


# --- source 1: own system; the only one with planned dates, colours and yard movements ------------

def g1_cliente(src, opts, mark):
    return _renamed(src.table("cliente"), src_id="id", nome="nome", tipo="tipo", cidade="cidade")


def g1_condutor(src, opts, mark):
    return _renamed(src.table("condutor"), src_id="id", src_cliente_id="cliente_id", nome="nome",
                    cnh="cnh", validade="validade", categoria="categoria")


def g1_grupo(src, opts, mark):
    groups = src.table("grupo_veiculo")
    # The operational schema has no daily rate; it is read when the source was extended with one.
    rate = "diaria" if "diaria" in groups.columns else F.lit(None)
    return _renamed(groups, src_id="id", nome="nome", categoria="categoria", diaria=rate)


def g1_veiculo(src, opts, mark):
    company = _renamed(src.table("empresa_locadora"), empresa_id="id", nome_empresa="nome")
    return _renamed(src.table("veiculo").join(company, "empresa_id"), src_id="id", placa="placa",
                    chassi="chassi", modelo="modelo", marca="marca", cor="cor",
                    tipo_mecanizacao="tipo_mecanizacao", ar_condicionado="ar_condicionado",
                    adaptado_cadeirante="adaptado_cadeirante", status="status",
                    src_grupo_id="grupo_id", src_empresa_id="empresa_id",
                    nome_empresa="nome_empresa")


def g1_patio(src, opts, mark):
    return _renamed(src.table("patio"), src_id="id", nome="nome", cidade="cidade")


def g1_vaga(src, opts, mark):
    return _renamed(src.table("vaga"), codigo="codigo", src_patio_id="patio_id", status="status")


def g1_reserva(src, opts, mark):
    open_ended = F.col("status").isin("cancelada", "espera")
    rows = src.table("reserva").filter(_since("data_inicio", mark, whole_day=True) | open_ended)
    return _renamed(rows, src_id="id", src_cliente_id="cliente_id", src_grupo_id="grupo_id",
                    src_patio_retirada_id="patio_retirada_id",
                    src_patio_devolucao_id="patio_devolucao_id", data_inicio="data_inicio",
                    data_fim="data_fim", status="status")


def g1_locacao(src, opts, mark):
    in_progress = (F.col("data_devolucao_realizada").isNull()
                   & F.col("data_retirada_realizada").isNotNull())
    rows = src.table("locacao").filter(_since("created_at", mark) | in_progress)
    driver = _renamed(src.table("condutor"), condutor_id="id", cliente_id="cliente_id")
    return _renamed(rows.join(driver, "condutor_id"), src_id="id", src_reserva_id="reserva_id",
                    src_veiculo_id="veiculo_id", src_condutor_id="condutor_id",
                    src_cliente_id="cliente_id", src_patio_retirada_id="patio_retirada_id",
                    src_patio_devolucao_id="patio_devolucao_id",
                    data_retirada_prevista="data_retirada_prevista",
                    data_retirada_realizada="data_retirada_realizada",
                    data_devolucao_prevista="data_devolucao_prevista",
                    data_devolucao_realizada="data_devolucao_realizada", km_entrega="km_entrega",
                    km_devolucao="km_devolucao", estado_entrega="estado_entrega",
                    estado_devolucao="estado_devolucao", created_at="created_at")


def g1_cobranca(src, opts, mark):
    rows = src.table("cobranca").filter(
        (F.col("status") == "pendente") | _since("data_pagamento", mark, whole_day=True))
    return _renamed(rows, src_id="id", src_locacao_id="locacao_id", valor="valor", status="status",
                    data_pagamento="data_pagamento")


def g1_movimentacao(src, opts, mark):
    rows = src.table("movimentacao_patio").filter(_since("data_movimentacao", mark))
    return _renamed(rows, src_id="id", src_veiculo_id="veiculo_id", src_origem_id="origem_patio_id",
                    src_destino_id="destino_patio_id", data_movimentacao="data_movimentacao",
                    motivo="motivo")


# --- source 2: rental and return apart, coded statuses, slots counted into capacity ---------------

def _g2_company(src):
    """The only company, as (id, name); raises when the source does not hold exactly one."""
    rows = src.table("empresa").select("id_empresa", "nome_empresa").limit(2).collect()
    if len(rows) != 1:
        total = src.table("empresa").count()
        raise ValueError(f"source 2 holds {total} companies; its vehicles can only be assigned to "
                         "exactly 1")
    return rows[0]["id_empresa"], rows[0]["nome_empresa"]


def g2_cliente(src, opts, mark):
    rows = src.table("cliente").join(src.table("endereco").select("id_endereco", "cidade", "uf"),
                                     "id_endereco")
    return _renamed(rows, src_id="id_cliente", nome="nome_completo", tipo=F.lit("PF"),
                    cidade="cidade", uf="uf", email="email", telefone="telefone")


def g2_condutor(src, opts, mark):
    licence = (src.table("documento_cliente").filter("cnh IS NOT NULL")
               .select("id_documento", "cnh"))
    rows = src.table("cliente").join(licence, "id_documento")
    return _renamed(rows, src_id="id_cliente", src_cliente_id="id_cliente", cnh="cnh",
                    nome="nome_completo")


def g2_grupo(src, opts, mark):
    return _renamed(src.table("grupo"), src_id="id_grupo", nome="nome", categoria="descricao",
                    diaria="diaria_grupo")


def g2_veiculo(src, opts, mark):
    company_id, company_name = _g2_company(src)
    fixed = src.table("especificacoes_const").select("id_spec_const", "direcao_automatica",
                                                     F.col("ar_condicionado").alias("_ar"))
    slot = src.table("vaga").filter("id_veiculo IS NOT NULL").select(
        "id_veiculo", F.lit(True).alias("_em_vaga"))
    rows = src.table("veiculo").join(fixed, "id_spec_const").join(slot, "id_veiculo", "left")
    parked = F.col("_em_vaga").isNotNull()
    rented = parked if opts.g2_slot_means_rented else F.lit(False)
    return _renamed(rows, src_id="id_veiculo", placa="placa", chassi="chassi", modelo="modelo",
                    marca="marca",
                    tipo_mecanizacao=F.when(F.col("direcao_automatica") == 1, "automatico")
                    .otherwise("manual"),
                    ar_condicionado=F.col("_ar") == 1,
                    status=F.when(rented, "alugado").otherwise("disponivel"),
                    src_grupo_id="id_grupo", nome_empresa=F.lit(company_name),
                    src_empresa_id=F.lit(company_id))


def g2_patio(src, opts, mark):
    slots = src.table("vaga").groupBy("id_patio").agg(F.count("id_vaga").alias("vagas"))
    rows = (src.table("patio")
            .join(src.table("endereco").select("id_endereco", "cidade"), "id_endereco")
            .join(src.table("empresa").select("id_empresa", "nome_empresa"), "id_empresa")
            .join(slots, "id_patio", "left"))
    return _renamed(rows, src_id="id_patio", nome="nome_patio", cidade="cidade",
                    capacidade=F.coalesce("vagas", F.lit(0)), src_empresa_id="id_empresa",
                    nome_empresa="nome_empresa")


def g2_vaga(src, opts, mark):
    return _renamed(src.table("vaga"), codigo=F.col("id_vaga").cast("string"),
                    src_patio_id="id_patio",
                    status=F.when(F.col("id_veiculo").isNotNull(), "ocupada").otherwise("livre"))


# Reservation state codes of source 2; any other code stays NULL.
G2_RESERVATION_CODES = ((0, "ativa"), (1, "cancelada"), (2, "confirmada"))


def g2_reserva(src, opts, mark):
    code = F.col("estado_reserva")
    rows = src.table("reserva").filter(
        _since("data_inicio_combinada", mark, whole_day=True) | (code == 1))
    status = F.coalesce(*[F.when(code == n, label) for n, label in G2_RESERVATION_CODES])
    return _renamed(rows, src_id="id_reserva", src_cliente_id="id_cliente", src_grupo_id="id_grupo",
                    src_patio_retirada_id="id_patio_origem", src_patio_devolucao_id="id_patio_fim",
                    data_inicio="data_inicio_combinada", data_fim="data_fim_combinada",
                    data_reserva="data_reserva", status=status, preco_final="preco_final")


def g2_locacao(src, opts, mark):
    state = src.table("especificacoes_var")
    booking = src.table("reserva").select("id_reserva", "id_cliente", "preco_final")
    given_back = _renamed(src.table("devolucao"), id_locacao="id_locacao",
                          id_devolucao="id_devolucao", data_devolucao="data_devolucao",
                          _spec_dev="id_spec_var", id_vaga="id_vaga")
    fuel_in = _renamed(state, _spec_dev="id_spec_var", _gas_dev="gasolina")
    fees = src.table("custos_devolucao").select("id_caucao", "valor_atraso", "valor_reparos")
    slot = _renamed(src.table("vaga"), id_vaga="id_vaga", _patio_dev="id_patio")
    rentals, recent = src.table("locacao"), F.coalesce(_since("data_locacao", mark), F.lit(False))
    # Rentals past the mark with their returns, older ones only without: both sides of the mark reach the scan, and what has
    # come back long ago meets nothing but the returns' keys.
    rows = rentals.filter(recent).join(given_back, "id_locacao", "left")
    if mark is not None:
        still_out = rentals.filter(~recent).join(given_back.filter("id_devolucao IS NOT NULL").select("id_locacao"), "id_locacao", "left_anti")
        rows = rows.unionByName(still_out, allowMissingColumns=True)
    rows = (rows
            .join(booking, "id_reserva")
            .join(_renamed(state, id_spec_var="id_spec_var", _gas_ret="gasolina"), "id_spec_var")
            .join(fuel_in, "_spec_dev", "left")
            .join(fees, "id_caucao", "left")
            .join(slot, "id_vaga", "left"))
    return _renamed(rows, src_id="id_locacao", src_devolucao_id="id_devolucao",
                    src_reserva_id="id_reserva", src_veiculo_id="id_veiculo",
                    src_condutor_id="id_cliente", src_cliente_id="id_cliente",
                    src_patio_retirada_id="id_patio", src_patio_devolucao_id="_patio_dev",
                    data_retirada_realizada="data_locacao",
                    data_devolucao_realizada="data_devolucao", gasolina_entrega="_gas_ret",
                    gasolina_devolucao="_gas_dev", valor_atraso="valor_atraso",
                    valor_reparos="valor_reparos", preco_final="preco_final")


def g2_cobranca(src, opts, mark):
    """Derived billing, one per rental: price plus fees, paid once returned. Never windowed."""
    booking = src.table("reserva").select("id_reserva", "preco_final")
    given_back = src.table("devolucao").select("id_locacao", "id_devolucao", "data_devolucao")
    fees = src.table("custos_devolucao").select("id_caucao", "valor_atraso", "valor_reparos")
    rows = (src.table("locacao").select("id_locacao", "id_reserva", "id_caucao")
            .join(booking, "id_reserva")
            .join(given_back, "id_locacao", "left")
            .join(fees, "id_caucao", "left"))
    total = _amount("preco_final") + _amount("valor_atraso") + _amount("valor_reparos")
    return _renamed(rows, src_id="id_locacao", src_locacao_id="id_locacao", valor=total,
                    status=_paid("id_devolucao"),
                    data_pagamento=F.col("data_devolucao").cast("date"))


# --- source 3: client inheritance, yards with capacity --------------------------------------------

def g3_cliente(src, opts, mark):
    person = _renamed(src.table("cliente_pf"), id_cliente="id_cliente", _pf="nome_cliente")
    firm = _renamed(src.table("cliente_pj"), id_cliente="id_cliente", _pj="razao_social")
    rows = (src.table("cliente")
            .join(src.table("endereco").select("id_endereco", "cidade", "uf"), "id_endereco")
            .join(person, "id_cliente", "left").join(firm, "id_cliente", "left"))
    return _renamed(rows, src_id="id_cliente", nome=F.coalesce("_pf", "_pj"), tipo="tipo_cliente",
                    cidade="cidade", uf="uf", email="email_cliente", telefone="telefone_cliente")


def g3_condutor(src, opts, mark):
    return _renamed(src.table("motorista"), src_id="id_motorista", src_cliente_id="id_cliente",
                    nome="nome_motorista", cnh="numero_cnh", validade="validade_cnh",
                    categoria="categoria_cnh")


def g3_grupo(src, opts, mark):
    return _renamed(src.table("categoria"), src_id="id_categoria", nome="nome_categoria",
                    categoria="descricao_categoria", diaria="valor_diaria_base")


def g3_veiculo(src, opts, mark):
    company = src.table("empresa").select("id_empresa", "nome_empresa")
    return _renamed(src.table("veiculo").join(company, "id_empresa"), src_id="id_veiculo",
                    placa="placa", chassi="chassi", modelo="modelo", marca="marca",
                    tipo_mecanizacao="tipo_cambio",
                    ar_condicionado=F.col("possui_ar_condicionado") == 1, status="status_veiculo",
                    src_grupo_id="id_categoria", nome_empresa="nome_empresa",
                    src_empresa_id="id_empresa")


def g3_patio(src, opts, mark):
    rows = (src.table("patio")
            .join(src.table("endereco").select("id_endereco", "cidade"), "id_endereco")
            .join(src.table("empresa").select("id_empresa", "nome_empresa"), "id_empresa"))
    return _renamed(rows, src_id="id_patio", nome="nome_patio", cidade="cidade",
                    capacidade="capacidade", src_empresa_id="id_empresa",
                    nome_empresa="nome_empresa")


def g3_reserva(src, opts, mark):
    rows = src.table("reserva").filter(_since("data_hora_reserva", mark)
                                       | F.lower("status_reserva").contains("cancel"))
    return _renamed(rows, src_id="id_reserva", src_cliente_id="id_cliente",
                    src_grupo_id="id_categoria", src_patio_retirada_id="id_patio_previsto_retirada",
                    src_patio_devolucao_id="id_patio_previsto_devolucao",
                    data_reserva="data_hora_reserva", data_inicio="data_previsao_retirada",
                    data_fim="data_previsao_devolucao", status="status_reserva",
                    preco_previsto="valor_previsto")


def g3_locacao(src, opts, mark):
    driver = src.table("motorista").select("id_motorista", "id_cliente")
    rows = src.table("locacao").filter(_since("data_hora_retirada_real", mark)
                                       | F.col("data_hora_devolucao_real").isNull())
    return _renamed(rows.join(driver, "id_motorista"), src_id="id_locacao",
                    src_reserva_id="id_reserva", src_veiculo_id="id_veiculo",
                    src_condutor_id="id_motorista", src_cliente_id="id_cliente",
                    src_patio_retirada_id="id_patio_real_retirada",
                    src_patio_devolucao_id="id_patio_real_devolucao",
                    data_retirada_realizada="data_hora_retirada_real",
                    data_devolucao_realizada="data_hora_devolucao_real", km_entrega="km_retirada",
                    km_devolucao="km_devolucao", valor_total="valor_total_final",
                    status="status_locacao")


def g3_cobranca(src, opts, mark):
    return _renamed(src.table("locacao"), src_id="id_locacao", src_locacao_id="id_locacao",
                    valor=_amount("valor_total_final"), status=_paid("data_hora_devolucao_real"),
                    data_pagamento=F.col("data_hora_devolucao_real").cast("date"))


# --- source 4: no company table, free-typed booleans ----------------------------------------------

# Spellings of "true" in source 4.
TRUE_WORDS = ("1", "t", "true", "s", "sim")


def truthy(column: str) -> Column:
    return F.coalesce(F.lower(F.col(column).cast("string")).isin(*TRUE_WORDS), F.lit(False))


def g4_cliente(src, opts, mark):
    return _renamed(src.table("cliente"), src_id="id_cliente", nome="nome_razao_social",
                    tipo="tipo_cliente")


def g4_condutor(src, opts, mark):
    return _renamed(src.table("motorista"), src_id="id_motorista", src_cliente_id="id_cliente",
                    nome="nome_condutor", cnh="numero_cnh", validade="data_expiracao_cnh",
                    categoria="categoria_habilitacao")


def g4_grupo(src, opts, mark):
    return _renamed(src.table("grupo_veiculo"), src_id="id_grupo", nome="nome_categoria",
                    categoria="classe_luxo", diaria="valor_diaria")


def g4_veiculo(src, opts, mark):
    return _renamed(src.table("veiculo"), src_id="id_veiculo", placa="placa", chassi="chassi",
                    modelo="modelo", marca="marca", tipo_mecanizacao="mecanizacao",
                    ar_condicionado=truthy("ar_condicionado"), adaptado_cadeirante=F.lit(False),
                    status="status_disponibilidade", src_grupo_id="id_grupo")


def g4_patio(src, opts, mark):
    return _renamed(src.table("patio"), src_id="id_patio", nome="nome_localizacao",
                    capacidade="capacidade_vagas", nome_empresa="empresa_dona")


def g4_reserva(src, opts, mark):
    rows = src.table("reserva").filter(_since("data_hora_solicitacao", mark)
                                       | F.lower("status_reserva").contains("cancel"))
    return _renamed(rows, src_id="id_reserva", src_cliente_id="id_cliente", src_grupo_id="id_grupo",
                    src_patio_retirada_id="id_patio_retirada",
                    data_solicitacao="data_hora_solicitacao",
                    data_inicio="data_hora_retirada_prevista",
                    data_fim="data_hora_devolucao_prevista", status="status_reserva")


def g4_locacao(src, opts, mark):
    driver = src.table("motorista").select("id_motorista", "id_cliente")
    rows = src.table("locacao").filter(_since("data_hora_retirada", mark)
                                       | F.col("data_hora_devolucao_realizada").isNull())
    return _renamed(rows.join(driver, "id_motorista"), src_id="id_locacao",
                    src_reserva_id="id_reserva", src_veiculo_id="id_veiculo",
                    src_condutor_id="id_motorista", src_cliente_id="id_cliente",
                    src_patio_retirada_id="id_patio_saida",
                    src_patio_devolucao_id="id_patio_chegada_realizada",
                    data_retirada_realizada="data_hora_retirada",
                    data_devolucao_realizada="data_hora_devolucao_realizada",
                    valor_final="valor_final")


def g4_cobranca(src, opts, mark):
    return _renamed(src.table("locacao"), src_id="id_locacao", src_locacao_id="id_locacao",
                    valor=_amount("valor_final"), status=_paid("data_hora_devolucao_realizada"),
                    data_pagamento=F.col("data_hora_devolucao_realizada").cast("date"))


def _entities(cliente, condutor, grupo, veiculo, patio, reserva, locacao, cobranca, vaga=None,
              movimentacao=None, windowed_billing=False) -> list[EntityMapping]:
    out = [EntityMapping("cliente", cliente), EntityMapping("condutor", condutor),
           EntityMapping("grupo_veiculo", grupo), EntityMapping("veiculo", veiculo),
           EntityMapping("patio", patio)]
    if vaga:
        out.append(EntityMapping("vaga", vaga))
    out += [EntityMapping("reserva", reserva, True), EntityMapping("locacao", locacao, True),
            EntityMapping("cobranca", cobranca, windowed_billing)]
    if movimentacao:
        out.append(EntityMapping("movimentacao_patio", movimentacao, True))
    return out


MAPPINGS: dict[int, list[EntityMapping]] = {
    1: _entities(g1_cliente, g1_condutor, g1_grupo, g1_veiculo, g1_patio, g1_reserva, g1_locacao,
                 g1_cobranca, vaga=g1_vaga, movimentacao=g1_movimentacao, windowed_billing=True),
    2: _entities(g2_cliente, g2_condutor, g2_grupo, g2_veiculo, g2_patio, g2_reserva, g2_locacao,
                 g2_cobranca, vaga=g2_vaga),
    3: _entities(g3_cliente, g3_condutor, g3_grupo, g3_veiculo, g3_patio, g3_reserva, g3_locacao,
                 g3_cobranca),
    4: _entities(g4_cliente, g4_condutor, g4_grupo, g4_veiculo, g4_patio, g4_reserva, g4_locacao,
                 g4_cobranca),
}
