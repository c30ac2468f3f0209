"""Staging -> conformed tables: one latest, cleaned row per source record."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rodovia.functions import rules as R
from rodovia.functions.calendar import calendar_attributes, observed_dates
from rodovia.operators.dedup import latest_per_key
from rodovia.plans.lazy import LazyTables
from rodovia.session import release, scratch_path

log = logging.getLogger(__name__)

KEY = ("grupo_fonte", "src_id")
Tables = Mapping[str, DataFrame]


def _latest(stg: Tables, name: str) -> DataFrame:
    return latest_per_key(stg[name], KEY)


def _nk(column: str) -> Column:
    return R.natural_key("grupo_fonte", column)


def conf_cliente(stg: Tables) -> DataFrame:
    return _latest(stg, "cliente").select(
        _nk("src_id").alias("cliente_nk"), "src_id", "grupo_fonte",
        R.or_sentinel("nome", "Cliente nao informado").alias("nome"),
        R.blank_to_null("nome").isNull().alias("flag_nome_imputado"),
        R.client_type("tipo").alias("tipo"),
        R.blank_to_null("cidade").alias("cidade"),
        F.upper(R.blank_to_null("uf")).alias("uf"),
        F.lower(R.blank_to_null("email")).alias("email"),
        R.digits_only("telefone").alias("telefone"),
        "dt_extracao")


def conf_condutor(stg: Tables) -> DataFrame:
    return _latest(stg, "condutor").select(
        _nk("src_id").alias("condutor_nk"), _nk("src_cliente_id").alias("cliente_nk"),
        "src_id", "grupo_fonte", "src_cliente_id",
        R.or_sentinel("nome", "Condutor nao informado").alias("nome"),
        R.digits_only("cnh").alias("cnh"),
        "validade",
        F.upper(R.blank_to_null("categoria")).alias("categoria"),
        "dt_extracao")


def conf_grupo_veiculo(stg: Tables) -> DataFrame:
    return _latest(stg, "grupo_veiculo").select(
        _nk("src_id").alias("grupo_veiculo_nk"), "src_id", "grupo_fonte",
        R.or_sentinel("nome", "Grupo nao informado").alias("nome"),
        R.or_sentinel("categoria", "Sem categoria").alias("categoria"),
        F.col("diaria").cast(R.MONEY).alias("diaria"),
        "dt_extracao")


def conf_empresa(stg: Tables, unknown_company: bool = True) -> DataFrame:
    """Companies named by yards and vehicles.

    With ``unknown_company`` a vehicle with neither company id nor name contributes its source's
    unknown member, so it can be loaded; without it such vehicles stop the load at the gate.
    """
    named = F.col("src_empresa_id").isNotNull() | F.col("_nome").isNotNull()

    def mentions(name: str, keep_unknown: bool) -> DataFrame:
        rows = stg[name].select("grupo_fonte", "src_empresa_id",
                                R.blank_to_null("nome_empresa").alias("_nome"), "dt_extracao")
        return rows if keep_unknown else rows.filter(named)

    # Grouped by the raw name, before the placeholder; duplicates fall together in the aggregate.
    groups = (mentions("patio", False).union(mentions("veiculo", unknown_company))
              .groupBy("grupo_fonte", "src_empresa_id", "_nome")
              .agg(F.max("dt_extracao").alias("dt_extracao")))
    companies = groups.select(
        R.company_key("grupo_fonte", "src_empresa_id", "_nome").alias("empresa_nk"),
        "src_empresa_id", "grupo_fonte",
        R.company_label("grupo_fonte", "_nome").alias("nome_empresa"), "dt_extracao")
    # One name per key: ascending by id (unknown last), then by name. The key fixes the source.
    return latest_per_key(companies.withColumn("_um", F.lit(1)), ["empresa_nk"], newest="_um",
                          tie_break=["src_empresa_id", "nome_empresa", "dt_extracao"]).drop("_um")


def conf_patio(stg: Tables) -> DataFrame:
    return _latest(stg, "patio").select(
        _nk("src_id").alias("patio_nk"),
        R.company_key("grupo_fonte", "src_empresa_id", "nome_empresa").alias("empresa_nk"),
        "src_id", "grupo_fonte", "src_empresa_id",
        R.or_sentinel("nome", "Patio nao informado").alias("nome"),
        R.blank_to_null("cidade").alias("cidade"),
        F.coalesce("capacidade", F.lit(0)).cast("int").alias("capacidade"),
        R.company_label("grupo_fonte", "nome_empresa").alias("nome_empresa"),
        "dt_extracao")


def conf_veiculo(stg: Tables) -> DataFrame:
    no = F.lit(False)
    return _latest(stg, "veiculo").select(
        _nk("src_id").alias("veiculo_nk"), _nk("src_grupo_id").alias("grupo_veiculo_nk"),
        R.company_key("grupo_fonte", "src_empresa_id", "nome_empresa").alias("empresa_nk"),
        "src_id", "grupo_fonte", "src_grupo_id", "src_empresa_id",
        R.plate("placa").alias("placa"),
        R.plate_is_imputed("placa").alias("flag_placa_imputada"),
        R.blank_to_null("chassi").alias("chassi"),
        R.or_sentinel("modelo", "Modelo nao informado").alias("modelo"),
        R.or_sentinel("marca", "Marca nao informada").alias("marca"),
        R.blank_to_null("cor").alias("cor"),
        R.transmission("tipo_mecanizacao").alias("tipo_mecanizacao"),
        F.coalesce("ar_condicionado", no).alias("ar_condicionado"),
        F.coalesce("adaptado_cadeirante", no).alias("adaptado_cadeirante"),
        R.vehicle_status("status").alias("status"),
        R.company_label("grupo_fonte", "nome_empresa").alias("nome_empresa"),
        "dt_extracao")


def staging_dates(stg: Tables) -> list[tuple[DataFrame, list[Column]]]:
    """The date columns that define the calendar, grouped so each table is scanned once."""
    c = F.col
    return [
        (stg["reserva"], [F.coalesce(c("data_reserva"), c("data_solicitacao")), c("data_inicio"),
                          c("data_fim")]),
        (stg["locacao"], [F.coalesce(c("created_at"), c("data_retirada_realizada"),
                                     c("data_retirada_prevista")),
                          c("data_retirada_realizada"), c("data_devolucao_realizada")]),
        (stg["movimentacao_patio"], [c("data_movimentacao")]),
    ]


def conf_tempo(stg: Tables) -> DataFrame:
    days = calendar_attributes(observed_dates(staging_dates(stg)))
    return days.select(F.col("sk_tempo").alias("id_tempo"), "data", "ano", "mes", "dia", "trimestre",
                       "dia_semana", "nome_dia_semana", "nome_mes",
                       F.col("flag_fim_de_semana").alias("fim_de_semana"))


def conf_reserva(stg: Tables) -> DataFrame:
    rows = _latest(stg, "reserva").select(
        "*",
        F.coalesce("data_reserva", "data_solicitacao", "dt_extracao").cast("date").alias("_reserva"),
        F.col("data_inicio").cast("date").alias("_inicio"),
        F.col("data_fim").cast("date").alias("_fim"))
    return rows.select(
        _nk("src_id").alias("reserva_nk"), _nk("src_cliente_id").alias("cliente_nk"),
        _nk("src_grupo_id").alias("grupo_veiculo_nk"),
        _nk("src_patio_retirada_id").alias("patio_retirada_nk"),
        _nk("src_patio_devolucao_id").alias("patio_devolucao_nk"),
        "src_id", "grupo_fonte", "src_cliente_id", "src_grupo_id", "src_patio_retirada_id",
        "src_patio_devolucao_id",
        F.col("_reserva").alias("data_reserva"), F.col("_inicio").alias("data_inicio"),
        F.col("_fim").alias("data_fim"),
        R.date_key("_reserva").alias("id_data_reserva"),
        R.date_key("_inicio").alias("id_data_inicio"),
        R.date_key("_fim").alias("id_data_fim"),
        R.lead_days("_reserva", "_inicio").alias("antecedencia_dias"),
        R.planned_days("_inicio", "_fim").alias("duracao_prevista_dias"),
        R.reservation_status("status").alias("status"),
        F.col("preco_previsto").cast(R.MONEY).alias("preco_previsto"),
        F.col("preco_final").cast(R.MONEY).alias("preco_final"),
        "dt_extracao")


LINE = "_linha"


def line(key: tuple[str, str] = KEY) -> Column:
    """A row's natural key with a mark in place of a missing part, so that it is never NULL."""
    source, own = (F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in key)
    return F.concat(source, F.lit("-"), own)


def rentals(stg: Tables, as_of, latest: DataFrame | None = None) -> DataFrame:
    """Rentals with their canonical measures, all but the late fee; ``latest`` are the rows of a de-duplication dealt by LINE."""
    rows = (_latest(stg, "locacao") if latest is None else latest).select(
        "*",
        F.coalesce("created_at", "data_retirada_realizada", "data_retirada_prevista", "dt_extracao").cast("date").alias("_registro"),
        F.col("data_retirada_prevista").cast("date").alias("_ret_prev"),
        F.col("data_retirada_realizada").cast("date").alias("_ret"),
        F.col("data_devolucao_prevista").cast("date").alias("_dev_prev"),
        F.col("data_devolucao_realizada").cast("date").alias("_dev"))
    return rows.select(
        _nk("src_id").alias("locacao_nk"), _nk("src_reserva_id").alias("reserva_nk"),
        _nk("src_veiculo_id").alias("veiculo_nk"), _nk("src_condutor_id").alias("condutor_nk"),
        _nk("src_cliente_id").alias("cliente_nk"),
        _nk("src_patio_retirada_id").alias("patio_retirada_nk"),
        _nk("src_patio_devolucao_id").alias("patio_devolucao_nk"),
        "src_id", "grupo_fonte", "src_devolucao_id", "src_reserva_id", "src_veiculo_id",
        "src_condutor_id", "src_cliente_id", "src_patio_retirada_id", "src_patio_devolucao_id",
        F.col("_registro").alias("data_registro"),
        F.col("_ret_prev").alias("data_retirada_prevista"), F.col("_ret").alias("data_retirada"),
        F.col("_dev_prev").alias("data_devolucao_prevista"), F.col("_dev").alias("data_devolucao"),
        "km_entrega", "km_devolucao",
        R.date_key("_registro").alias("id_data_registro"),
        R.date_key("_ret").alias("id_data_retirada"),
        R.date_key("_dev").alias("id_data_devolucao"),
        R.days_inclusive("_ret_prev", "_dev_prev").alias("dias_previstos"),
        R.days_inclusive("_ret", "_dev").alias("dias_realizados"),
        R.days_late("_dev", "_dev_prev").alias("atraso_devolucao_dias"),
        R.days_until_due("_dev", "_dev_prev", as_of).alias("dias_para_devolucao"),
        R.km_driven("km_entrega", "km_devolucao").alias("km_rodado"),
        "gasolina_entrega", "gasolina_devolucao",
        F.col("valor_atraso").cast(R.MONEY).alias("valor_atraso"),
        F.col("valor_reparos").cast(R.MONEY).alias("valor_reparos"),
        R.charged_amount("preco_final", "valor_total", "valor_final", "valor_atraso",
                         "valor_reparos").alias("valor_cobrado"),
        R.late_fee_is_estimated("valor_atraso").alias("flag_multa_estimada"),
        F.col("src_reserva_id").isNotNull().alias("reserva_previa"),
        R.rental_status("status", "data_retirada_realizada", "data_devolucao_realizada")
        .alias("status"),
        "estado_entrega", "estado_devolucao", "dt_extracao", *([] if latest is None else [LINE]))


def daily_rates(veiculo: DataFrame, grupo: DataFrame) -> DataFrame:
    """(veiculo_nk, _diaria): the rate of each vehicle's group.

    There is one rate per vehicle already; grouping by its key tells Catalyst so, and the join falls away, with the move of all
    rentals by vehicle, where nobody asks for the late fee.
    """
    return (veiculo.select("grupo_fonte", "veiculo_nk", F.col("src_grupo_id").alias("_grupo"))
            .join(grupo.select("grupo_fonte", F.col("src_id").alias("_grupo"), F.col("diaria").alias("_diaria")),
                  ["grupo_fonte", "_grupo"], "left")
            .groupBy("veiculo_nk").agg(F.max("_diaria").alias("_diaria")))


def with_late_fee(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Rentals with valor_multa_atraso, from columns they have and the rate of their vehicle."""
    return with_fee_of(rows.join(rates, "veiculo_nk", "left"))


def with_fee_of(rows: DataFrame) -> DataFrame:
    fee = R.late_fee("valor_atraso", "data_devolucao", "data_devolucao_prevista", "_diaria")
    return rows.withColumn("valor_multa_atraso", fee).drop("_diaria")


def conf_locacao(stg: Tables, veiculo: DataFrame, grupo: DataFrame, as_of) -> DataFrame:
    """Rentals with their canonical measures. The daily rate comes from the vehicle's group."""
    rows = rentals(stg, as_of)
    at = rows.columns.index("flag_multa_estimada")
    return with_late_fee(rows, daily_rates(veiculo, grupo)).select(*rows.columns[:at], "valor_multa_atraso", *rows.columns[at:])


def rated_in_place(stg: Tables, veiculo: DataFrame, grupo: DataFrame, as_of) -> DataFrame:
    """``conf_locacao`` for a table that is stored whole. Only rentals whose late fee is estimated from a rate go to the vehicles, and these
    as keys alone; the whole ones stay where the de-duplication has put them, dealt by a key that is never NULL."""
    return _rated(rentals_by_line(stg, as_of), daily_rates(veiculo, grupo)).drop(LINE)


def rentals_by_line(stg: Tables, as_of) -> DataFrame:
    """``rentals`` dealt by a key that is never NULL, with that key."""
    staged = stg["locacao"]
    # The parts of the key decide no tie, but so all readers of the de-duplication ask for all columns and share one shuffle.
    rest = [c for c in staged.columns if c != "dt_extracao"]
    return rentals(stg, as_of, latest_per_key(staged.withColumn(LINE, line()), [LINE], tie_break=rest))


def _rated(rows: DataFrame, rates: DataFrame) -> DataFrame:
    late = rows.filter(F.col("flag_multa_estimada") & (F.col("atraso_devolucao_dias") != 0)).select(LINE, "veiculo_nk")
    # There is one row per rental already; grouping tells Catalyst so, and the join falls away where nobody asks for the late fee.
    estimated = late.join(rates, "veiculo_nk", "left").groupBy(F.col(LINE).alias("_l")).agg(F.max("_diaria").alias("_diaria"))
    at = rows.columns.index("flag_multa_estimada")
    fee = R.late_fee("valor_atraso", "data_devolucao", "data_devolucao_prevista", "_diaria")
    return (rows.join(estimated, F.col(LINE) == F.col("_l"), "left").withColumn("valor_multa_atraso", fee)
            .select(*rows.columns[:at], "valor_multa_atraso", *rows.columns[at:]))


# What the billings of a rental come to together.
BILLING_LABELS = PENDING, LATE, PAID, CANCELLED, MIXED = "pendente", "em_atraso", "pago", "cancelada", "parcial"


def conf_cobranca(stg: Tables, by_line: bool = False) -> DataFrame:
    """One row per rental. A plain aggregate: partial counts and sums are combined map-side. With ``by_line`` it is dealt by LINE, which
    is one column more."""
    status = R.billing_status("status")
    rows = stg["cobranca"].filter("src_locacao_id IS NOT NULL").withColumn("_status", status)

    def having(label: str) -> Column:
        return F.count_if(F.col("_status") == label)

    every = F.count(F.lit(1))
    key = ("grupo_fonte", "src_locacao_id")
    own = [F.any_value(c).alias(c) for c in key] if by_line else []
    totals = rows.groupBy(*[line(key).alias(LINE)] if by_line else key).agg(
        *own, every.alias("qtd_cobrancas"),
        F.sum(F.coalesce("valor", F.lit(0).cast(R.MONEY))).cast("decimal(12,2)")
        .alias("valor_cobranca"),
        having(PENDING).alias("_pendente"), having(LATE).alias("_atraso"),
        having(PAID).alias("_pago"), having(CANCELLED).alias("_cancelada"),
        F.max("data_pagamento").alias("data_ultimo_pagamento"),
        F.max("dt_extracao").alias("dt_extracao"))
    consolidated = (F.when(F.col("_pendente") > 0, PENDING)
                    .when(F.col("_atraso") > 0, LATE)
                    .when(F.col("_pago") == F.col("qtd_cobrancas"), PAID)
                    .when(F.col("_cancelada") == F.col("qtd_cobrancas"), CANCELLED)
                    .otherwise(MIXED))
    return totals.select(
        _nk("src_locacao_id").alias("locacao_nk"), "grupo_fonte", "src_locacao_id",
        "qtd_cobrancas", "valor_cobranca", consolidated.alias("status_cobranca"),
        "data_ultimo_pagamento", "dt_extracao", *([LINE] if by_line else []))


def billing_by_line(stg: Tables) -> DataFrame:
    """What conf_cobranca has of each rental that has a source, dealt by LINE."""
    keyed = conf_cobranca(stg, by_line=True)
    return keyed.filter("grupo_fonte IS NOT NULL").drop("locacao_nk")


def conf_movimentacao_patio(stg: Tables) -> DataFrame:
    day = F.col("data_movimentacao").cast("date")
    return _latest(stg, "movimentacao_patio").select(
        _nk("src_id").alias("movimentacao_patio_nk"), _nk("src_veiculo_id").alias("veiculo_nk"),
        _nk("src_origem_id").alias("patio_origem_nk"),
        _nk("src_destino_id").alias("patio_destino_nk"),
        "src_id", "grupo_fonte", "src_veiculo_id", "src_origem_id", "src_destino_id",
        day.alias("data_movimentacao"), R.date_key(day).alias("id_data_movimentacao"),
        R.blank_to_null("motivo").alias("motivo"), "dt_extracao")


# Which conformed dimension each id column of a conformed fact points at, and the marker it yields.
REFERENCES = {
    "conf_veiculo": [("grupo_veiculo_nk", "conf_grupo_veiculo", "grupo_veiculo_nk", "sk_grupo"),
                     ("empresa_nk", "conf_empresa", "empresa_nk", "sk_empresa")],
    "conf_reserva": [("cliente_nk", "conf_cliente", "cliente_nk", "sk_cliente"),
                     ("grupo_veiculo_nk", "conf_grupo_veiculo", "grupo_veiculo_nk", "sk_grupo"),
                     ("patio_retirada_nk", "conf_patio", "patio_nk", "sk_patio_retirada"),
                     ("patio_devolucao_nk", "conf_patio", "patio_nk", "sk_patio_devolucao")],
    "conf_locacao": [("cliente_nk", "conf_cliente", "cliente_nk", "sk_cliente"),
                     ("condutor_nk", "conf_condutor", "condutor_nk", "sk_condutor"),
                     ("veiculo_nk", "conf_veiculo", "veiculo_nk", "sk_veiculo"),
                     ("patio_retirada_nk", "conf_patio", "patio_nk", "sk_patio_retirada"),
                     ("patio_devolucao_nk", "conf_patio", "patio_nk", "sk_patio_devolucao"),
                     ("reserva_nk", "conf_reserva", "reserva_nk", "sk_reserva")],
    "conf_movimentacao_patio": [("veiculo_nk", "conf_veiculo", "veiculo_nk", "sk_veiculo"),
                                ("patio_origem_nk", "conf_patio", "patio_nk", "sk_patio_origem"),
                                ("patio_destino_nk", "conf_patio", "patio_nk", "sk_patio_destino")],
}


def resolve(conf: Tables, name: str) -> DataFrame:
    """Left-join a conformed table to its dimensions and add one marker per reference.

    A marker holds the natural key of the row it found and NULL when there is none. It stands for
    the conformance-only key; warehouse keys are assigned at load. Loading does not need the
    markers, so the stored tables go without these joins unless asked for.
    """
    if name == "conf_locacao" and isinstance(conf, LazyTables) and "by_line" in conf.traits:
        return _resolved_in_place(conf, name)
    rows = conf[name]
    for i, (column, target, key, marker) in enumerate(REFERENCES[name]):
        # Natural keys are unique; distinct tells Catalyst so, and the join of a marker that nobody asks for falls away.
        found = conf[target].select(F.col(key).alias(f"_k{i}")).distinct().withColumn(marker, F.col(f"_k{i}"))
        rows = rows.join(found, F.col(column) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    return rows


def _resolved_in_place(conf: LazyTables, name: str) -> DataFrame:
    """``resolve`` of rentals, which stay where the de-duplication has put them: they meet the values that no row of a dimension has. Where
    these are too many to be broadcast, the references alone go to them and come back by rental."""
    rows = _rated(conf.traits["by_line"](), conf.traits["rates"]())
    absent, lost, columns = _absent_values(conf, name), [], rows.columns
    for i, (column, _, _, marker) in enumerate(REFERENCES[name]):
        values, few = absent[i]
        # They are distinct already; this tells Catalyst so, and the join of a marker that nobody asks for falls away.
        gone = values.select(F.col("_nk").alias(f"_k{i}")).distinct().withColumn(f"_sem{i}", F.lit(True))
        if few:
            rows = rows.join(gone, F.col(column) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        else:
            keys = conf.traits["by_line"]().select(F.col(LINE).alias("_l"), F.col(column).alias("_v"))
            lost.append((i, keys.join(gone, F.col("_v") == F.col(f"_k{i}")).select("_l", F.lit(i).alias("_i"))))
    if lost:
        found = lost[0][1]
        for _, more in lost[1:]:
            found = found.unionByName(more)
        marks = found.groupBy("_l").agg(*[F.max(F.when(F.col("_i") == i, F.lit(True))).alias(f"_sem{i}") for i, _ in lost])
        rows = rows.join(marks, F.col(LINE) == F.col("_l"), "left")
    return rows.select(*[c for c in columns if c != LINE], *[
        F.when(F.col(f"_sem{i}").isNull(), F.col(column)).alias(marker) for i, (column, _, _, marker) in enumerate(REFERENCES[name])])


def _absent_values(conf: LazyTables, name: str) -> list[tuple[DataFrame, bool]]:
    """For each reference the values (_nk) that its dimension lacks, written to the shared folder, and whether Catalyst will broadcast them.

    They come from one pass over the rows before the de-duplication, of which the others are a part.
    """
    references = REFERENCES[name]
    staged = conf.traits["staged"][name.removeprefix("conf_")]
    used = staged.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_ref"), _nk(f"src_{column.removesuffix('_nk')}_id").alias("_nk"))
        for i, (column, *_) in enumerate(references)])).alias("r")).select("r.*").filter("_nk IS NOT NULL").distinct()
    held = None
    for i, (_, target, key, _) in enumerate(references):
        one = conf[target].select(F.lit(i).alias("_ref"), F.col(key).alias("_nk"))
        held = one if held is None else held.unionByName(one)
    spark = used.sparkSession
    path = scratch_path(spark, "sem")
    used.join(held, ["_ref", "_nk"], "left_anti").write.partitionBy("_ref").parquet(path)
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    found = []
    for i in range(len(references)):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_ref={i}")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(folder)  # nothing may be absent
        found.append((spark.read.schema("_nk string").parquet(f"{path}/_ref={i}"), 2 * fs.getContentSummary(folder).getLength() <= limit))
    release(spark)
    return found


def staging_warnings(stg: Tables) -> DataFrame:
    """Rows that load but deserve a look, as (aviso, qtd); one pass per table."""
    loc = stg["locacao"].agg(
        F.count_if(F.col("km_devolucao") < F.col("km_entrega")).alias("odometro_invertido"),
        F.count_if(F.col("data_devolucao_realizada") < F.col("data_retirada_realizada"))
        .alias("devolucao_antes_da_retirada"))
    res = stg["reserva"].agg(
        F.count_if(F.col("src_patio_retirada_id").isNull()).alias("reserva_sem_patio_retirada"))
    return unpivot_counts(loc, "aviso").union(unpivot_counts(res, "aviso"))


def unpivot_counts(one_row: DataFrame, label: str, value: str = "qtd") -> DataFrame:
    """(label, value) rows from a one-row frame of counts."""
    return one_row.unpivot([], list(one_row.columns), label, value)


def warn(stg: Tables) -> list[tuple[str, int]]:
    """Log the non-zero staging warnings; never blocks."""
    found = [(r["aviso"], r["qtd"]) for r in staging_warnings(stg).collect() if r["qtd"]]
    for name, n in found:
        log.warning("staging quality: %s = %d", name, n)
    return found


def conformed(stg: Tables, as_of, unknown_company: bool = True) -> LazyTables:
    """Plans of all conformed tables, dimensions first.

    ``unrated`` and ``rates`` are the two halves of conf_locacao, for readers that meet the vehicles anyway; ``by_line`` and ``bills`` are
    rentals and their billing dealt by LINE, for readers that leave rentals in place; ``staged`` are the rows before their de-duplication.
    """
    plans = LazyTables({
        "conf_cliente": lambda t: conf_cliente(stg),
        "conf_condutor": lambda t: conf_condutor(stg),
        "conf_grupo_veiculo": lambda t: conf_grupo_veiculo(stg),
        "conf_empresa": lambda t: conf_empresa(stg, unknown_company),
        "conf_patio": lambda t: conf_patio(stg),
        "conf_veiculo": lambda t: conf_veiculo(stg),
        "conf_tempo": lambda t: conf_tempo(stg),
        "conf_reserva": lambda t: conf_reserva(stg),
        "conf_locacao": lambda t: conf_locacao(stg, t["conf_veiculo"], t["conf_grupo_veiculo"],
                                               as_of),
        "conf_cobranca": lambda t: conf_cobranca(stg),
        "conf_movimentacao_patio": lambda t: conf_movimentacao_patio(stg),
    }, staged=stg, unrated=lambda: rentals(stg, as_of), by_line=lambda: rentals_by_line(stg, as_of), bills=lambda: billing_by_line(stg),
        rates=lambda: daily_rates(plans["conf_veiculo"], plans["conf_grupo_veiculo"]))
    return plans


def store_conformed(stg: Tables, keep: Callable[[str, DataFrame], DataFrame], as_of,
                    unknown_company: bool = True, markers: bool = False) -> dict[str, DataFrame]:
    """Store every conformed table with ``keep``, which returns the stored version; later tables
    read that instead of recomputing what they build on."""
    stored: dict[str, DataFrame] = {}
    plans = conformed(stg, as_of, unknown_company)
    for name in plans:
        if name == "conf_locacao":
            rows = rated_in_place(stg, stored["conf_veiculo"], stored["conf_grupo_veiculo"], as_of)
        else:
            rows = plans[name]
        if markers and name in REFERENCES:
            rows = resolve({**stored, name: rows}, name)
        stored[name] = keep(name, rows)
        release(stored[name].sparkSession)
    return stored
