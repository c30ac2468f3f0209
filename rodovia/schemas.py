"""Column lists of every tier. Ids are BIGINT: a fleet that fills 100 TB outgrows INT."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

SOURCES = (1, 2, 3, 4)

_AUDIT = "grupo_fonte smallint, dt_extracao timestamp_ntz"

STAGING = {
    "cliente": "src_id bigint, nome string, tipo string, cidade string, uf string, email string, "
               f"telefone string, {_AUDIT}",
    "condutor": "src_id bigint, src_cliente_id bigint, nome string, cnh string, validade date, "
                f"categoria string, telefone string, {_AUDIT}",
    "grupo_veiculo": f"src_id bigint, nome string, categoria string, diaria decimal(10,2), {_AUDIT}",
    "veiculo": "src_id bigint, placa string, chassi string, modelo string, marca string, cor string, "
               "tipo_mecanizacao string, ar_condicionado boolean, adaptado_cadeirante boolean, "
               "status string, src_grupo_id bigint, src_empresa_id bigint, nome_empresa string, "
               f"{_AUDIT}",
    "patio": "src_id bigint, nome string, cidade string, capacidade int, src_empresa_id bigint, "
             f"nome_empresa string, {_AUDIT}",
    "vaga": f"codigo string, src_patio_id bigint, status string, {_AUDIT}",
    "reserva": "src_id bigint, src_cliente_id bigint, src_grupo_id bigint, "
               "src_patio_retirada_id bigint, src_patio_devolucao_id bigint, "
               "data_solicitacao timestamp_ntz, data_reserva timestamp_ntz, "
               "data_inicio timestamp_ntz, data_fim timestamp_ntz, status string, "
               f"preco_final decimal(10,2), preco_previsto decimal(10,2), {_AUDIT}",
    "locacao": "src_id bigint, src_devolucao_id bigint, src_reserva_id bigint, src_veiculo_id bigint, "
               "src_condutor_id bigint, src_cliente_id bigint, src_patio_retirada_id bigint, "
               "src_patio_devolucao_id bigint, data_retirada_prevista timestamp_ntz, "
               "data_retirada_realizada timestamp_ntz, data_devolucao_prevista timestamp_ntz, "
               "data_devolucao_realizada timestamp_ntz, km_entrega int, km_devolucao int, "
               "gasolina_entrega int, gasolina_devolucao int, valor_atraso decimal(10,2), "
               "valor_reparos decimal(10,2), preco_final decimal(10,2), valor_total decimal(10,2), "
               "valor_final decimal(10,2), status string, estado_entrega string, "
               "estado_devolucao string, created_at timestamp_ntz, updated_at timestamp_ntz, "
               f"{_AUDIT}",
    "cobranca": "src_id bigint, src_locacao_id bigint, valor decimal(10,2), status string, "
                f"data_pagamento date, {_AUDIT}",
    "movimentacao_patio": "src_id bigint, src_veiculo_id bigint, src_origem_id bigint, "
                          "src_destino_id bigint, data_movimentacao timestamp_ntz, motivo string, "
                          f"{_AUDIT}",
}

STAGING_KEYS = {name: ("grupo_fonte", "src_id") for name in STAGING}
STAGING_KEYS["vaga"] = ("grupo_fonte", "codigo", "src_patio_id")

EXTRACTION_LOG = ("grupo_fonte smallint, tabela_stg string, dt_extracao timestamp_ntz, "
                  "qtd_registros bigint, status string, observacao string")

DIM_TEMPO = ("sk_tempo int, data date, ano int, mes int, nome_mes string, trimestre int, dia int, "
             "dia_semana int, nome_dia_semana string, flag_fim_de_semana boolean")


def column_names(ddl: str) -> list[str]:
    """Names in a column list, without asking a session to parse it."""
    return list(column_types(ddl))


def column_types(ddl: str) -> dict[str, str]:
    parts = re.findall(r"(\w+) (\w+(?:\(.*?\))?)", ddl)
    return dict(parts)


def to_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Cast to ``ddl``; columns the frame lacks become typed NULLs, extra columns are refused."""
    types, present = column_types(ddl), set(df.columns)
    extra = present - set(types)
    if extra:
        raise ValueError(f"unexpected columns {sorted(extra)}")
    return df.selectExpr(*[f"CAST({n if n in present else 'NULL'} AS {t}) AS {n}"
                           for n, t in types.items()])
