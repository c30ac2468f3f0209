"""The seven analytical views over the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rodovia.functions import rules as R

Tables = Mapping[str, DataFrame]


def _no_money():
    return F.lit(0).cast("decimal(12,2)")


def status_parts(reservas: DataFrame, *by: str) -> DataFrame:
    return reservas.groupBy(*by, "status_reserva").agg(F.sum("qtd_reservas").alias("total_reservas"))


def status_shares(totals: DataFrame) -> DataFrame:
    # The window runs over one row per status, a closed list of five labels.
    whole = F.sum("total_reservas").over(Window.partitionBy())
    return totals.withColumn("percentual_status", R.percent("total_reservas", whole, 2))


def reservas_por_status(dw: Tables) -> DataFrame:
    return status_shares(status_parts(dw["fato_reserva"]))


def day_parts(locacoes: DataFrame, *by: str) -> DataFrame:
    """Sums per day of actual, else planned, pickup."""
    return (locacoes.groupBy(*by, F.coalesce("sk_tempo_retirada_realizada", "sk_tempo_retirada_prevista").alias("_dia"))
            .agg(F.sum("qtd_locacoes").alias("_n"),
                 F.sum(F.col("km_rodado").cast("bigint")).alias("_km"),
                 F.count("km_rodado").alias("_com_km"),
                 F.sum(F.coalesce("valor_cobranca", _no_money())).alias("_valor")))


def months_of(per_day: DataFrame, dim_tempo: DataFrame) -> DataFrame:
    days = dim_tempo.select("sk_tempo", "ano", "mes", "nome_mes")
    km_mean = (F.sum("_km").cast("decimal(20,0)")
               / F.nullif(F.sum("_com_km").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")))
    return (per_day.join(days, F.col("_dia") == F.col("sk_tempo"), "left")
            .groupBy("ano", "mes", "nome_mes")
            .agg(F.sum("_n").alias("total_locacoes"),
                 F.round(km_mean, 2).alias("km_medio_rodado"),
                 F.sum("_valor").alias("valor_total_cobrado")))


def locacoes_por_mes(dw: Tables) -> DataFrame:
    """Rentals per month of actual, else planned, pickup; rentals without either share a NULL month.

    Rentals are summed per day before the calendar is joined, so the join sees days, not rentals.
    """
    return months_of(day_parts(dw["fato_locacao"]), dw["dim_tempo"])


def group_parts(locacoes: DataFrame, *by: str) -> DataFrame:
    return locacoes.groupBy(*by, "sk_grupo_veiculo").agg(
        F.sum("qtd_locacoes").alias("_n"),
        F.sum(F.coalesce("dias_realizados", F.lit(0)).cast("bigint")).alias("_dias"),
        F.sum(F.coalesce("km_rodado", F.lit(0)).cast("bigint")).alias("_km"))


def groups_of(per_key: DataFrame, dim_grupo: DataFrame, by_key: bool = False) -> DataFrame:
    groups = dim_grupo.select("sk_grupo_veiculo", F.col("nome").alias("grupo"), "categoria", "grupo_id")
    keys = (["grupo_id"] if by_key else []) + ["grupo", "categoria"]
    return (per_key.join(groups, "sk_grupo_veiculo").groupBy(*keys)
            .agg(F.sum("_n").alias("total_locacoes"), F.sum("_dias").alias("dias_realizados"),
                 F.sum("_km").alias("km_total_rodado")))


def ocupacao_por_grupo_veiculo(dw: Tables, by_key: bool = False) -> DataFrame:
    """Per group name and category; ``by_key`` keeps same-named groups of different companies apart."""
    return groups_of(group_parts(dw["fato_locacao"]), dw["dim_grupo_veiculo"], by_key)


def move_parts(movimentos: DataFrame, *by: str) -> DataFrame:
    return movimentos.groupBy(*by, "sk_patio_origem", "sk_patio_destino").agg(F.sum("qtd_movimentacoes").alias("_n"))


def moves_of(pairs: DataFrame, yards: DataFrame, by_key: bool = False) -> DataFrame:
    start = yards.select(F.col("sk_patio").alias("sk_patio_origem"), F.col("nome").alias("patio_origem"),
                         F.col("patio_id").alias("origem_id"))
    end = yards.select(F.col("sk_patio").alias("sk_patio_destino"), F.col("nome").alias("patio_destino"),
                       F.col("patio_id").alias("destino_id"))
    keys = (["origem_id", "destino_id"] if by_key else []) + ["patio_origem", "patio_destino"]
    return (pairs.join(start, "sk_patio_origem").join(end, "sk_patio_destino").groupBy(*keys)
            .agg(F.sum("_n").alias("total_movimentacoes")))


def movimentacao_entre_patios(dw: Tables, by_key: bool = False) -> DataFrame:
    """Moves per origin and destination name; ``by_key`` keeps same-named yards apart."""
    return moves_of(move_parts(dw["fato_veiculo_no_patio"]), dw["dim_patio"], by_key)


def transitions_of(moves: DataFrame) -> DataFrame:
    leaving = F.sum("total_movimentacoes").over(Window.partitionBy("patio_origem"))
    return moves.select(F.col("patio_origem").alias("origem"), F.col("patio_destino").alias("destino"),
                        "total_movimentacoes",
                        R.percent("total_movimentacoes", leaving, 2)
                        .alias("percentual_transicao_origem"))


def matriz_transicao_patios(dw: Tables) -> DataFrame:
    """Share of each destination in the departures of its origin: rows of a Markov matrix."""
    return transitions_of(movimentacao_entre_patios(dw))


def booking_parts(reservas: DataFrame, *by: str) -> DataFrame:
    return reservas.groupBy(*by, "sk_cliente").agg(F.sum("qtd_reservas").alias("_r"), F.lit(0).cast("bigint").alias("_l"),
                                                   F.lit(0).cast("decimal(22,2)").alias("_v"))


def rental_parts(locacoes: DataFrame, *by: str) -> DataFrame:
    return locacoes.groupBy(*by, "sk_cliente").agg(
        F.lit(0).cast("bigint").alias("_r"), F.sum("qtd_locacoes").alias("_l"),
        F.sum(F.coalesce("valor_cobranca", _no_money())).cast("decimal(22,2)").alias("_v"))


def totals_of(parts: DataFrame) -> DataFrame:
    return parts.groupBy("sk_cliente").agg(
        F.sum("_r").alias("total_reservas"), F.sum("_l").alias("total_locacoes"),
        F.sum("_v").alias("valor_total_cobrado"))


def client_totals(dw: Tables) -> DataFrame:
    """Reservations, rentals and billing per client key.

    Both facts go into one aggregate instead of a full join of two: one shuffle, combined map-side,
    and no multiplication of rows of different grain.
    """
    none = F.lit(0)
    booked = dw["fato_reserva"].select("sk_cliente", F.col("qtd_reservas").alias("_r"),
                                       none.alias("_l"), _no_money().alias("_v"))
    rented = dw["fato_locacao"].select("sk_cliente", none.alias("_r"),
                                       F.col("qtd_locacoes").alias("_l"),
                                       F.coalesce("valor_cobranca", _no_money()).alias("_v"))
    return totals_of(booked.union(rented))


def clients_of(totals: DataFrame, dim_cliente: DataFrame, with_id: bool = False) -> DataFrame:
    clients = dim_cliente.select("sk_cliente", F.col("nome").alias("cliente"), "tipo", "cidade", "cliente_id")
    return (totals.join(clients, "sk_cliente")
            .select(*(["cliente_id"] if with_id else []), "cliente", "tipo", "cidade",
                    "total_reservas", "total_locacoes", "valor_total_cobrado"))


def clientes_mais_frequentes(dw: Tables, with_id: bool = False) -> DataFrame:
    return clients_of(client_totals(dw), dw["dim_cliente"], with_id)


def atrasos_devolucao(dw: Tables) -> DataFrame:
    """Late returns with labels. Only late rentals take part in the joins."""
    late = dw["fato_locacao"].filter("atraso_devolucao_dias > 0").select(
        "locacao_id", "sk_cliente", "sk_veiculo", "sk_patio_devolucao",
        "sk_tempo_devolucao_prevista", "sk_tempo_devolucao_realizada", "atraso_devolucao_dias")
    clients = dw["dim_cliente"].select("sk_cliente", F.col("nome").alias("cliente"))
    vehicles = dw["dim_veiculo"].select(
        "sk_veiculo", R.vehicle_label("placa", "marca", "modelo").alias("veiculo"))
    yards = dw["dim_patio"].select(F.col("sk_patio").alias("sk_patio_devolucao"),
                                   F.col("nome").alias("patio_devolucao"))

    def days(role: str, name: str) -> DataFrame:
        return dw["dim_tempo"].select(F.col("sk_tempo").alias(role), F.col("data").alias(name))

    return (late.join(clients, "sk_cliente").join(vehicles, "sk_veiculo")
            .join(yards, "sk_patio_devolucao", "left")
            .join(days("sk_tempo_devolucao_prevista", "data_prevista"),
                  "sk_tempo_devolucao_prevista", "left")
            .join(days("sk_tempo_devolucao_realizada", "data_realizada"),
                  "sk_tempo_devolucao_realizada", "left")
            .select("locacao_id", "cliente", "veiculo", "patio_devolucao", "data_prevista",
                    "data_realizada", F.col("atraso_devolucao_dias").alias("atraso_em_dias")))


VIEWS = {
    "vw_reservas_por_status": reservas_por_status,
    "vw_locacoes_por_mes": locacoes_por_mes,
    "vw_ocupacao_por_grupo_veiculo": ocupacao_por_grupo_veiculo,
    "vw_movimentacao_entre_patios": movimentacao_entre_patios,
    "vw_matriz_transicao_patios": matriz_transicao_patios,
    "vw_clientes_mais_frequentes": clientes_mais_frequentes,
    "vw_atrasos_devolucao": atrasos_devolucao,
}


# What the views read of each fact.
FACT_COLUMNS = {
    "fato_reserva": ("sk_cliente", "status_reserva", "qtd_reservas"),
    "fato_locacao": ("locacao_id", "sk_cliente", "sk_veiculo", "sk_grupo_veiculo", "sk_patio_devolucao", "sk_tempo_retirada_prevista",
                     "sk_tempo_retirada_realizada", "sk_tempo_devolucao_prevista", "sk_tempo_devolucao_realizada", "km_rodado",
                     "dias_realizados", "atraso_devolucao_dias", "qtd_locacoes", "valor_cobranca"),
    "fato_veiculo_no_patio": ("sk_patio_origem", "sk_patio_destino", "qtd_movimentacoes"),
}


def register(spark: SparkSession, dw: Tables, read: Tables | None = None) -> None:
    """Make tables and views queryable by name from Spark SQL; the views are built on ``read``, else on the same tables."""
    for name, df in dw.items():
        df.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(dw if read is None else read).createOrReplaceTempView(name)
