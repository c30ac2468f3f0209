"""The eight business reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from rodovia.functions import rules as R
from rodovia.plans import views as V

Tables = Mapping[str, DataFrame]


def monthly_revenue(dw: Tables) -> DataFrame:
    return revenue_of(V.locacoes_por_mes(dw))


def revenue_of(months: DataFrame) -> DataFrame:
    """Revenue per month, its three-month moving average and the change on the month before.

    The ordered window runs over one row per month of history.
    """
    chronological = Window.orderBy(F.col("ano").asc_nulls_last(), F.col("mes").asc_nulls_last())
    revenue = F.col("valor_total_cobrado")
    return months.select(
        "ano", "mes", "nome_mes", "total_locacoes",
        F.round(revenue, 2).alias("receita_total"),
        F.round(F.avg(revenue).over(chronological.rowsBetween(-2, 0)), 2).alias("media_movel_3m"),
        F.round(revenue - F.lag(revenue).over(chronological), 2).alias("variacao_mes_anterior"),
        F.round("km_medio_rodado", 1).alias("km_medio_por_locacao"),
    ).orderBy(F.col("ano").asc_nulls_last(), F.col("mes").asc_nulls_last())


def top_clients(dw: Tables, n: int = 10) -> DataFrame:
    """Best clients by revenue; equal revenue is ordered by client key."""
    rentals = F.col("total_locacoes").cast("decimal(20,0)")
    return (V.clientes_mais_frequentes(dw, with_id=True).filter("total_locacoes > 0")
            .orderBy(F.col("valor_total_cobrado").desc(), "cliente_id").limit(n)
            .select(F.col("cliente").alias("nome_cliente"), "total_reservas", "total_locacoes",
                    F.round("valor_total_cobrado", 2).alias("receita_total"),
                    F.round(F.col("valor_total_cobrado") / rentals, 2).alias("ticket_medio")))


def cancellation_rate(dw: Tables, at_least: int = 5) -> DataFrame:
    groups = dw["dim_grupo_veiculo"].select("sk_grupo_veiculo", F.col("nome").alias("grupo_veiculo"))
    per_key = dw["fato_reserva"].groupBy("sk_grupo_veiculo").agg(
        F.count("*").alias("_n"), F.count_if("flag_cancelada").alias("_c"))
    return (per_key.join(groups, "sk_grupo_veiculo").groupBy("grupo_veiculo")
            .agg(F.sum("_n").alias("total_reservas"), F.sum("_c").alias("canceladas"))
            .filter(F.col("total_reservas") >= at_least)
            .withColumn("pct_cancelamento", R.percent("canceladas", "total_reservas", 1))
            .orderBy(F.col("pct_cancelamento").desc(), "grupo_veiculo"))


def yard_use(dw: Tables) -> DataFrame:
    """Pickups, returns and turns per slot of every yard.

    Each rental is counted under both of its yards by exploding the two roles and aggregating them
    per yard before the yards are joined: an equi-join of totals in place of an OR-join of rentals.
    """
    role = F.explode(F.array(
        F.struct(F.col("sk_patio_retirada").alias("sk_patio"), F.lit(1).alias("r"), F.lit(0).alias("d")),
        F.struct(F.col("sk_patio_devolucao").alias("sk_patio"), F.lit(0).alias("r"), F.lit(1).alias("d"))))
    used = (dw["fato_locacao"].select(role.alias("x")).select("x.*").filter("sk_patio IS NOT NULL")
            .groupBy("sk_patio").agg(F.sum("r").alias("_r"), F.sum("d").alias("_d")))
    zero = F.lit(0).cast("bigint")
    total = F.col("retiradas") + F.col("devolucoes")
    slots = F.col("capacidade_vagas").cast("decimal(20,0)")
    return (dw["dim_patio"].join(used, "sk_patio", "left")
            .select("patio_id", F.col("nome").alias("patio"), "cidade",
                    F.nullif(F.col("capacidade"), F.lit(0)).alias("capacidade_vagas"),
                    F.coalesce("_r", zero).alias("retiradas"),
                    F.coalesce("_d", zero).alias("devolucoes"))
            .withColumn("movimento_total", total)
            .withColumn("giro_por_vaga",
                        F.round(F.col("movimento_total").cast("decimal(20,0)") / slots, 2))
            .orderBy(F.col("movimento_total").desc(), "patio_id").drop("patio_id"))


def late_returns(dw: Tables, n: int = 20) -> DataFrame:
    return (V.atrasos_devolucao(dw)
            .orderBy(F.col("atraso_em_dias").desc(), "locacao_id").limit(n)
            .select(F.col("cliente").alias("nome_cliente"), "veiculo", "patio_devolucao",
                    "data_prevista", "data_realizada", "atraso_em_dias"))


def flow_matrix(dw: Tables) -> DataFrame:
    return (V.matriz_transicao_patios(dw)
            .select("origem", "destino", "total_movimentacoes",
                    F.round("percentual_transicao_origem", 1).alias("pct_do_total_de_saidas"))
            .orderBy(F.col("total_movimentacoes").desc(), "origem", "destino"))


def never_rented(dw: Tables) -> DataFrame:
    """Vehicles without a rental. The rented keys are made distinct map-side before the anti join."""
    rented = dw["fato_locacao"].select("sk_veiculo").distinct()
    groups = dw["dim_grupo_veiculo"].select("sk_grupo_veiculo", F.col("nome").alias("grupo_veiculo"))
    firms = dw["dim_empresa"].select("sk_empresa", F.col("nome").alias("empresa"))
    return (dw["dim_veiculo"].join(rented, "sk_veiculo", "left_anti")
            .join(groups, "sk_grupo_veiculo").join(firms, "sk_empresa")
            .orderBy("empresa", "placa", "veiculo_id")
            .select("placa", "marca", "modelo", "status", "grupo_veiculo", "empresa"))


def weekday_demand(dw: Tables) -> DataFrame:
    per_day = dw["fato_reserva"].groupBy(F.col("sk_tempo_inicio").alias("sk_tempo")).agg(
        F.count("*").alias("_n"), F.sum("qtd_reservas").alias("_q"))
    return (per_day.join(dw["dim_tempo"].select("sk_tempo", "nome_dia_semana", "dia_semana"),
                         "sk_tempo")
            .groupBy("nome_dia_semana", "dia_semana")
            .agg(F.sum("_n").alias("total_reservas"), F.sum("_q").alias("qtd_total"))
            .orderBy("dia_semana"))


REPORTS = {
    "r1_monthly_revenue": monthly_revenue,
    "r2_top_clients": top_clients,
    "r3_cancellation_rate": cancellation_rate,
    "r4_yard_use": yard_use,
    "r5_late_returns": late_returns,
    "r6_flow_matrix": flow_matrix,
    "r7_never_rented": never_rented,
    "r8_weekday": weekday_demand,
}
