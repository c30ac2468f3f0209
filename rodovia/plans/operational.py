"""Small queries over the operational tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

Tables = Mapping[str, DataFrame]


def reservations_per_yard(oltp: Tables) -> DataFrame:
    per_yard = oltp["reserva"].groupBy(F.col("patio_retirada_id").alias("id")).agg(
        F.count("*").alias("_n"))
    return (per_yard.join(oltp["patio"].select("id", "nome"), "id")
            .groupBy(F.col("nome").alias("patio_retirada")).agg(F.sum("_n").alias("total_reservas")))


def vehicles_per_company_and_group(oltp: Tables) -> DataFrame:
    firms = oltp["empresa_locadora"].select(F.col("id").alias("empresa_id"),
                                            F.col("nome").alias("empresa"))
    groups = oltp["grupo_veiculo"].select(F.col("id").alias("grupo_id"), F.col("nome").alias("grupo"))
    per_pair = oltp["veiculo"].groupBy("empresa_id", "grupo_id").agg(F.count("*").alias("_n"))
    return (per_pair.join(firms, "empresa_id").join(groups, "grupo_id").groupBy("empresa", "grupo")
            .agg(F.sum("_n").alias("total_veiculos")))


def rental_details(oltp: Tables) -> DataFrame:
    """Rentals with client, driver, vehicle and both yards; rentals without reservation drop out."""
    def labels(table: str, key: str, **columns: str) -> DataFrame:
        return oltp[table].select(F.col("id").alias(key),
                                  *[F.col(c).alias(n) for n, c in columns.items()])

    return (oltp["locacao"]
            .join(labels("reserva", "reserva_id", cliente_id="cliente_id"), "reserva_id")
            .join(labels("cliente", "cliente_id", cliente="nome"), "cliente_id")
            .join(labels("condutor", "condutor_id", condutor="nome"), "condutor_id")
            .join(labels("veiculo", "veiculo_id", placa="placa"), "veiculo_id")
            .join(labels("patio", "patio_retirada_id", patio_retirada="nome"), "patio_retirada_id")
            .join(labels("patio", "patio_devolucao_id", patio_devolucao="nome"),
                  "patio_devolucao_id")
            .select(F.col("id").alias("locacao_id"), "cliente", "condutor", "placa",
                    "patio_retirada", "patio_devolucao"))


def yard_moves(oltp: Tables) -> DataFrame:
    yards = oltp["patio"]
    return (oltp["movimentacao_patio"]
            .join(yards.select(F.col("id").alias("origem_patio_id"),
                               F.col("nome").alias("patio_origem")), "origem_patio_id")
            .join(yards.select(F.col("id").alias("destino_patio_id"),
                               F.col("nome").alias("patio_destino")), "destino_patio_id")
            .select("id", "veiculo_id", "patio_origem", "patio_destino", "data_movimentacao",
                    "motivo"))


def billing_per_rental(oltp: Tables) -> DataFrame:
    return oltp["cobranca"].filter("locacao_id IS NOT NULL").select("locacao_id", "valor", "status")


def scenario_counts(oltp: Tables) -> DataFrame:
    """(cenario, total): active, closed and late rentals, vehicles in maintenance, billings by status."""
    from rodovia.plans.conform import unpivot_counts
    c = F.col
    rentals = oltp["locacao"].agg(
        F.count_if(c("data_devolucao_realizada").isNull()).alias("locacoes_ativas"),
        F.count_if(c("data_devolucao_realizada").isNotNull()).alias("locacoes_encerradas"),
        F.count_if(c("data_devolucao_realizada") > c("data_devolucao_prevista"))
        .alias("locacoes_com_atraso"))
    shop = oltp["veiculo"].agg(
        F.count_if(c("status") == "manutencao").alias("veiculos_em_manutencao"))
    bills = oltp["cobranca"].groupBy(F.concat(F.lit("cobranca_"), c("status")).alias("cenario")).agg(
        F.count("*").alias("total"))
    return (unpivot_counts(rentals, "cenario", "total")
            .union(unpivot_counts(shop, "cenario", "total")).union(bills))


def clients_without_reservation(oltp: Tables) -> DataFrame:
    booked = oltp["reserva"].select(F.col("cliente_id").alias("id")).distinct()
    return oltp["cliente"].join(booked, "id", "left_anti").select("id", "nome")
