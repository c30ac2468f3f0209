"""Data-quality checks. Each returns counts or rows; the gates raise :class:`DataQualityError`."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rodovia.functions import rules as R
from rodovia.operators.distinct import distinct_counts
from rodovia.plans import star
from rodovia.plans.conform import BILLING_LABELS, REFERENCES, resolve, unpivot_counts
from rodovia.plans.views import VIEWS
from rodovia.sources.extract import duplicate_keys

Tables = Mapping[str, DataFrame]


class DataQualityError(Exception):
    """A quality gate found violations."""


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count(df: DataFrame, **labels) -> DataFrame:
    """One row: the labels and the number of rows."""
    return df.agg(F.count("*").alias("qtd")).select(
        *[F.lit(v).alias(k) for k, v in labels.items()], "qtd")


# --- volumes and reconciliation -------------------------------------------------------------------

def volumes(tables: Tables, by: str | None = "grupo_fonte") -> DataFrame:
    """Rows per table and source."""
    if by is None:
        return stack(_count(df, tabela=name) for name, df in tables.items())
    return stack(df.groupBy(by).agg(F.count("*").alias("qtd"))
                 .select(F.lit(name).alias("tabela"), by, "qtd") for name, df in tables.items())


def reconcile(pairs: Mapping[str, tuple[DataFrame, DataFrame]], left: str, right: str) -> DataFrame:
    """Row counts of the same entity in two tiers, side by side."""
    sides = stack(
        _count(df, entidade=name, lado=side)
        for name, frames in pairs.items() for side, df in zip((left, right), frames))
    return sides.groupBy("entidade").agg(
        *[F.sum(F.when(F.col("lado") == s, F.col("qtd"))).alias(s) for s in (left, right)])


def staged_and_conformed(stg: Tables, conf: Tables, entities: Sequence[str]) -> DataFrame:
    """Rows per entity in both tiers; companies have no staging table and count as the distinct ones that yards name."""
    name = F.coalesce(F.col("src_empresa_id").cast("string"), "nome_empresa")
    companies = distinct_counts(stg["patio"], {"empresa": F.concat(F.col("grupo_fonte").cast("string"), F.lit("-"), name)})
    counted = reconcile({e: (stg[e], conf[f"conf_{e}"]) for e in entities}, "qtd_staging", "qtd_transform")
    held = _count(conf["conf_empresa"], expressao="empresa").withColumnRenamed("qtd", "qtd_transform")
    return counted.unionByName(companies.join(held, "expressao").select(
        F.col("expressao").alias("entidade"), F.col("qtd").alias("qtd_staging"), "qtd_transform"))


def additive_reconciliation(conf: Tables, dw: Tables) -> DataFrame:
    """Conformed row counts against the summed counters of the facts."""
    parts = (("reservas", "conf_reserva", "fato_reserva", "qtd_reservas"),
             ("locacoes", "conf_locacao", "fato_locacao", "qtd_locacoes"),
             ("movimentacoes", "conf_movimentacao_patio", "fato_veiculo_no_patio",
              "qtd_movimentacoes"))

    def one(entity, c, f, measure):
        zero = F.lit(0).cast("bigint")
        rows = conf[c].select(F.lit(1).cast("bigint").alias("a"), zero.alias("b")).union(
            dw[f].select(zero.alias("a"), F.col(measure).cast("bigint").alias("b")))
        return rows.agg(F.coalesce(F.sum("a"), zero).alias("qtd_transform"),
                        F.coalesce(F.sum("b"), zero).alias("soma_qtd_dw")).select(
            F.lit(entity).alias("entidade"), "qtd_transform", "soma_qtd_dw")

    return stack(one(*p) for p in parts)


def view_row_counts(dw: Tables) -> DataFrame:
    return stack(_count(build(dw), view_name=name) for name, build in VIEWS.items())


def view_reconciliation(dw: Tables) -> DataFrame:
    """Totals of each view against the fact they come from."""
    zero = F.lit(0).cast("bigint")

    def total(df: DataFrame, measure: Column, check: str, side: str) -> DataFrame:
        return df.agg(F.coalesce(F.sum(measure.cast("bigint")), zero).alias("v")).select(
            F.lit(check).alias("validacao"), F.lit(side).alias("lado"), "v")

    one = F.lit(1)
    late = dw["fato_locacao"].filter("atraso_devolucao_dias > 0")
    plan = (
        ("vw_reservas_por_status", "vw_reservas_por_status", F.col("total_reservas"),
         dw["fato_reserva"], F.col("qtd_reservas")),
        ("vw_locacoes_por_mes", "vw_locacoes_por_mes", F.col("total_locacoes"),
         dw["fato_locacao"], F.col("qtd_locacoes")),
        ("vw_ocupacao_por_grupo_veiculo", "vw_ocupacao_por_grupo_veiculo", F.col("total_locacoes"),
         dw["fato_locacao"], F.col("qtd_locacoes")),
        ("vw_movimentacao_entre_patios", "vw_movimentacao_entre_patios",
         F.col("total_movimentacoes"), dw["fato_veiculo_no_patio"], F.col("qtd_movimentacoes")),
        ("vw_matriz_transicao_patios", "vw_matriz_transicao_patios", F.col("total_movimentacoes"),
         dw["fato_veiculo_no_patio"], F.col("qtd_movimentacoes")),
        ("vw_clientes_mais_frequentes_reservas", "vw_clientes_mais_frequentes",
         F.col("total_reservas"), dw["fato_reserva"], F.col("qtd_reservas")),
        ("vw_clientes_mais_frequentes_locacoes", "vw_clientes_mais_frequentes",
         F.col("total_locacoes"), dw["fato_locacao"], F.col("qtd_locacoes")),
        ("vw_atrasos_devolucao", "vw_atrasos_devolucao", one, late, one),
    )
    sides = stack(f for check, view, vm, fact, fm in plan for f in (
        total(VIEWS[view](dw), vm, check, "view"), total(fact, fm, check, "fato")))
    return sides.groupBy("validacao").agg(
        F.sum(F.when(F.col("lado") == "view", F.col("v"))).alias("total_view"),
        F.sum(F.when(F.col("lado") == "fato", F.col("v"))).alias("total_fato"))


def expected_counts(tables: Tables, expected: DataFrame) -> DataFrame:
    """Actual rows per table against (tabela, esperado)."""
    return (volumes(tables, by=None).join(expected, "tabela")
            .select("tabela", F.col("qtd").alias("total"), "esperado",
                    (F.col("qtd") == F.col("esperado")).alias("ok")))


# --- nulls and duplicates -------------------------------------------------------------------------

def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def null_audit(tables: Tables, required: Mapping[str, Sequence[str]],
               by: str | None = "grupo_fonte") -> DataFrame:
    """NULL or blank values per mandatory column; every table is read once."""
    def one(name: str, columns: Sequence[str]) -> DataFrame:
        rows = tables[name].groupBy(by) if by else tables[name].groupBy()
        counted = rows.agg(*[F.count_if(blank(c)).alias(c) for c in columns])
        keys = [by] if by else []
        long = counted.unpivot(keys, list(columns), "coluna", "nulos")
        return long.select(F.lit(name).alias("tabela"), *keys, "coluna", "nulos")
    return stack(one(n, c) for n, c in required.items())


# Columns that must be filled, per tier.
REQUIRED_STAGING = {"cliente": ["src_id", "nome"], "veiculo": ["src_id", "placa"],
                    "condutor": ["src_id", "cnh"]}
# Of the conformed tier: natural keys, and references and dates that a row must have (markers of ``resolve`` included).
REQUIRED_CONFORMED = {
    "conf_cliente": {"nk_nulo": ["cliente_nk"]},
    "conf_condutor": {"nk_nulo": ["condutor_nk", "cliente_nk"], "fk_nula": ["src_cliente_id"]},
    "conf_veiculo": {"nk_nulo": ["veiculo_nk"], "fk_nula": ["grupo_veiculo_nk", "sk_grupo"]},
    "conf_reserva": {"nk_nulo": ["reserva_nk"],
                     "fk_nula": ["sk_cliente", "sk_grupo", "sk_patio_retirada", "data_reserva", "data_inicio"]},
    "conf_locacao": {"nk_nulo": ["locacao_nk"],
                     "fk_nula": ["sk_cliente", "sk_condutor", "sk_veiculo", "sk_patio_retirada", "data_registro"]},
}
REQUIRED_DW = {
    "dim_cliente": ["cliente_id", "nome", "tipo"],
    "dim_veiculo": ["veiculo_id", "placa", "status", "sk_grupo_veiculo", "sk_empresa"],
    "fato_locacao": ["sk_cliente", "sk_condutor", "sk_veiculo", "sk_grupo_veiculo", "sk_empresa",
                     "sk_patio_retirada"],
    "fato_reserva": ["sk_cliente", "sk_grupo_veiculo", "sk_patio_retirada", "sk_tempo_inicio"],
}
UNIQUE_CONFORMED = {
    "conf_cliente": "cliente_nk", "conf_condutor": "condutor_nk",
    "conf_grupo_veiculo": "grupo_veiculo_nk", "conf_empresa": "empresa_nk",
    "conf_patio": "patio_nk", "conf_veiculo": "veiculo_nk", "conf_reserva": "reserva_nk",
    "conf_locacao": "locacao_nk", "conf_cobranca": "locacao_nk",
    "conf_movimentacao_patio": "movimentacao_patio_nk",
}
CONFORMED_BY_SOURCE = ("conf_cliente", "conf_condutor", "conf_grupo_veiculo", "conf_empresa", "conf_patio", "conf_veiculo",
                       "conf_reserva", "conf_locacao", "conf_movimentacao_patio")
UNIQUE_DW = {**{d.name: d.nk for d in star.DIMENSIONS.values()},
             **{f.name: f.nk for f in star.FACTS.values()}, "dim_tempo": "data"}


def conformed_nulls(conf: Tables) -> DataFrame:
    """(tabela, tipo, nulos): conformed rows without a natural key, or without a reference or date they must have."""
    def one(name: str, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
        rows = resolve(conf, name) if any(c.startswith("sk_") for cols in kinds.values() for c in cols) else conf[name]
        counted = rows.agg(*[F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])).alias(kind)
                             for kind, cols in kinds.items()])
        return unpivot_counts(counted, "tipo", "nulos").select(F.lit(name).alias("tabela"), "tipo", "nulos")
    return stack(one(n, k) for n, k in REQUIRED_CONFORMED.items())


def duplicates_summary(tables: Tables, keys: Mapping[str, Sequence[str] | str]) -> DataFrame:
    """Per table: how many keys occur more than once and how many rows they hold."""
    def one(name: str, key) -> DataFrame:
        names = [key] if isinstance(key, str) else list(key)
        zero = F.lit(0).cast("bigint")
        return duplicate_keys(tables[name], names).agg(
            F.count("*").alias("chaves"), F.coalesce(F.sum("ocorrencias"), zero).alias("linhas")
        ).select(F.lit(name).alias("tabela"), "chaves", "linhas")
    return stack(one(n, k) for n, k in keys.items())


# --- rentals --------------------------------------------------------------------------------------

def impossible_dates(locacao: DataFrame) -> DataFrame:
    """Rentals returned, or due, before they were picked up, or planned to be."""
    c = F.col
    return locacao.filter((c("data_devolucao_prevista") < c("data_retirada_prevista"))
                          | (c("data_devolucao_realizada") < c("data_retirada_realizada"))).select(
        "grupo_fonte", "src_id", "data_retirada_prevista", "data_devolucao_prevista",
        "data_retirada_realizada", "data_devolucao_realizada")


def inverted_odometer(locacao: DataFrame) -> DataFrame:
    return locacao.filter("km_devolucao < km_entrega").select(
        "grupo_fonte", "src_id", "km_entrega", "km_devolucao",
        (F.col("km_devolucao") - F.col("km_entrega")).alias("km_rodado_calculado"))


def missing_references(locacao: DataFrame) -> DataFrame:
    """Sources with rentals that lack a vehicle, driver or client."""
    names = {"sem_veiculo": "src_veiculo_id", "sem_condutor": "src_condutor_id",
             "sem_cliente": "src_cliente_id"}
    counted = locacao.groupBy("grupo_fonte").agg(
        *[F.count_if(F.col(c).isNull()).alias(n) for n, c in names.items()])
    return counted.filter(reduce(lambda a, b: a | b, [F.col(n) > 0 for n in names]))


# --- extraction log -------------------------------------------------------------------------------

def latest_log(entries: DataFrame) -> DataFrame:
    """Log rows of each (source, table)'s latest run; ties are all kept."""
    last = entries.groupBy("grupo_fonte", "tabela_stg").agg(F.max("dt_extracao").alias("dt_extracao"))
    return entries.join(last, ["grupo_fonte", "tabela_stg", "dt_extracao"]).select(
        "grupo_fonte", "tabela_stg", "dt_extracao", F.col("qtd_registros").alias("qtd_na_extracao"),
        "status")


def log_against_staging(entries: DataFrame, staging: Tables) -> DataFrame:
    """Logged row counts next to what staging holds now; one join instead of a lookup per row."""
    held = volumes(staging).select(F.col("tabela").alias("tabela_stg"), "grupo_fonte",
                                   F.col("qtd").alias("qtd_atual_staging"))
    return (entries.join(held, ["grupo_fonte", "tabela_stg"], "left")
            .select("grupo_fonte", "tabela_stg",
                    F.col("qtd_registros").alias("qtd_registrada_no_log"),
                    F.coalesce("qtd_atual_staging", F.lit(0)).alias("qtd_atual_staging")))


# --- references -----------------------------------------------------------------------------------

def reference_audit(tables: Tables, refs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(tabela, coluna, pai, nulos, orfaos) for references (child, column, parent, key).

    Every child is read once, whatever the number of its references, and every parent once: rows are counted per reference and
    value before they meet the keys, so a value that a third of a child shares reaches the join as a single row.
    """
    numbered = list(enumerate(refs))

    def used(df: DataFrame, columns: Sequence[tuple[int, str]]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(i).alias("_r"), F.col(c).cast("string").alias("_v")) for i, c in columns])
        return df.select(F.explode(pairs).alias("x")).select("x.*")

    def by_table(of: int, column: int) -> dict[str, list[tuple[int, str]]]:
        out: dict[str, list[tuple[int, str]]] = {}
        for i, ref in numbered:
            out.setdefault(ref[of], []).append((i, ref[column]))
        return out

    asked = stack(used(tables[t], columns).groupBy("_r", "_v").agg(F.count("*").alias("_n")) for t, columns in by_table(0, 1).items())
    held = stack(used(tables[t], columns).distinct() for t, columns in by_table(2, 3).items()).withColumn("_held", F.lit(True))
    missing = F.col("_v").isNotNull() & F.col("_held").isNull()
    found = asked.join(held, ["_r", "_v"], "left").groupBy("_r").agg(
        F.sum(F.when(F.col("_v").isNull(), F.col("_n"))).alias("nulos"), F.sum(F.when(missing, F.col("_n"))).alias("orfaos"))
    spark = tables[refs[0][0]].sparkSession
    labels = spark.createDataFrame([(i, t, c, p) for i, (t, c, p, _) in numbered], "_r int, tabela string, coluna string, pai string")
    zero = F.lit(0).cast("bigint")
    return labels.join(found, "_r", "left").select("tabela", "coluna", "pai", F.coalesce("nulos", zero).alias("nulos"),
                                                   F.coalesce("orfaos", zero).alias("orfaos"))


def unresolved_dimensions(conf: Tables) -> DataFrame:
    """Conformed rows whose reference is NULL or unknown, per fact and reference."""
    refs = [(name, column, target, key) for name in ("conf_reserva", "conf_locacao", "conf_movimentacao_patio")
            for column, target, key, _ in REFERENCES[name]]
    return reference_audit(conf, refs).select("tabela", F.col("coluna").alias("referencia"), "nulos", "orfaos")


# Surrogate keys of each fact (and of dim_veiculo) and the dimension they point at.
STAR_KEYS = [
    ("dim_veiculo", "sk_grupo_veiculo", "dim_grupo_veiculo", "sk_grupo_veiculo"),
    ("dim_veiculo", "sk_empresa", "dim_empresa", "sk_empresa"),
    ("fato_reserva", "sk_cliente", "dim_cliente", "sk_cliente"),
    ("fato_reserva", "sk_grupo_veiculo", "dim_grupo_veiculo", "sk_grupo_veiculo"),
    ("fato_reserva", "sk_patio_retirada", "dim_patio", "sk_patio"),
    ("fato_reserva", "sk_patio_devolucao", "dim_patio", "sk_patio"),
    ("fato_locacao", "sk_cliente", "dim_cliente", "sk_cliente"),
    ("fato_locacao", "sk_condutor", "dim_condutor", "sk_condutor"),
    ("fato_locacao", "sk_veiculo", "dim_veiculo", "sk_veiculo"),
    ("fato_locacao", "sk_grupo_veiculo", "dim_grupo_veiculo", "sk_grupo_veiculo"),
    ("fato_locacao", "sk_empresa", "dim_empresa", "sk_empresa"),
    ("fato_locacao", "sk_patio_retirada", "dim_patio", "sk_patio"),
    ("fato_locacao", "sk_patio_devolucao", "dim_patio", "sk_patio"),
    ("fato_veiculo_no_patio", "sk_veiculo", "dim_veiculo", "sk_veiculo"),
    ("fato_veiculo_no_patio", "sk_patio_origem", "dim_patio", "sk_patio"),
    ("fato_veiculo_no_patio", "sk_patio_destino", "dim_patio", "sk_patio"),
]
TIME_KEYS = [
    ("fato_reserva", ("sk_tempo_inicio", "sk_tempo_fim")),
    ("fato_locacao", ("sk_tempo_retirada_prevista", "sk_tempo_retirada_realizada",
                      "sk_tempo_devolucao_prevista", "sk_tempo_devolucao_realizada")),
    ("fato_veiculo_no_patio", ("sk_tempo_movimentacao",)),
]


def orphan_keys(dw: Tables) -> DataFrame:
    return reference_audit(dw, STAR_KEYS).select("tabela", F.col("coluna").alias("chave"), "orfaos")


def date_key_usage(dw: Tables) -> DataFrame:
    """(origem, sk_tempo, linhas): time keys in use per role; each fact is scanned once."""
    def one(fact: str, roles: Sequence[str]) -> DataFrame:
        pair = F.explode(F.array(*[
            F.struct(F.lit(f"{fact}.{r}").alias("origem"), F.col(r).alias("sk_tempo"))
            for r in roles]))
        return (dw[fact].select(pair.alias("p")).select("p.*").filter("sk_tempo IS NOT NULL")
                .groupBy("origem", "sk_tempo").agg(F.count("*").alias("linhas")))
    return stack(one(f, r) for f, r in TIME_KEYS)


def date_key_coverage(dw: Tables) -> DataFrame:
    """Per role: rows with a time key, and those whose key the calendar lacks."""
    days = dw["dim_tempo"].select("sk_tempo", F.lit(True).alias("_existe"))
    return (date_key_usage(dw).join(days, "sk_tempo", "left").groupBy("origem")
            .agg(F.sum("linhas").alias("linhas"),
                 F.coalesce(F.sum(F.when(F.col("_existe").isNull(), F.col("linhas"))),
                            F.lit(0).cast("bigint")).alias("qtd_chaves_sem_dim_tempo")))


# --- measures -------------------------------------------------------------------------------------

def conformed_measures(conf: Tables) -> DataFrame:
    """(tabela, regra, qtd): inverted periods and negative measures before the load."""
    c = F.col
    res = conf["conf_reserva"].agg(
        F.count_if(c("data_inicio").isNull()).alias("data_base_nula"),
        F.count_if(c("data_fim") < c("data_inicio")).alias("periodo_invertido"),
        F.count_if(c("antecedencia_dias") < 0).alias("antecedencia_negativa"),
        F.count_if(c("duracao_prevista_dias") < 0).alias("duracao_negativa"))
    loc = conf["conf_locacao"].agg(
        F.count_if(c("data_retirada_prevista").isNull() & c("data_retirada").isNull())
        .alias("data_base_nula"),
        F.count_if(c("data_devolucao") < c("data_retirada")).alias("periodo_invertido"),
        F.count_if(c("data_devolucao_prevista") < c("data_retirada_prevista"))
        .alias("periodo_previsto_invertido"),
        *[F.count_if(c(m) < 0).alias(f"{m}_negativo") for m in
          ("km_rodado", "valor_cobrado", "dias_realizados", "atraso_devolucao_dias",
           "valor_multa_atraso")])
    mov = conf["conf_movimentacao_patio"].agg(
        F.count_if(c("data_movimentacao").isNull()).alias("data_base_nula"))
    cob = conf["conf_cobranca"].agg(F.count_if(c("valor_cobranca") < 0).alias("valor_negativo"))
    return stack(unpivot_counts(df, "regra").select(F.lit(n).alias("tabela"), "regra", "qtd")
                 for n, df in (("conf_reserva", res), ("conf_locacao", loc),
                               ("conf_movimentacao_patio", mov), ("conf_cobranca", cob)))


def fact_measures(dw: Tables) -> DataFrame:
    """(tabela, regra, qtd): counters, negative measures, and lateness recomputed from the dates."""
    c = F.col

    def day(key: str) -> Column:
        return F.make_date((c(key) / 10000).cast("int"), (c(key) / 100).cast("int") % 100, c(key) % 100)

    late = F.greatest(F.datediff(day("sk_tempo_devolucao_realizada"),
                                 day("sk_tempo_devolucao_prevista")), F.lit(0))
    both = (c("sk_tempo_devolucao_realizada").isNotNull()
            & c("sk_tempo_devolucao_prevista").isNotNull())
    res = dw["fato_reserva"].agg(
        F.count_if(~c("qtd_reservas").eqNullSafe(1)).alias("qtd_invalida"),
        F.count_if(c("dias_reservados") <= 0).alias("dias_invalidos"),
        F.count_if(c("dias_reservados") < 0).alias("dias_negativos"))
    loc = dw["fato_locacao"].agg(
        F.count_if(~c("qtd_locacoes").eqNullSafe(1)).alias("qtd_invalida"),
        *[F.count_if(c(m) < 0).alias(f"{m}_negativo") for m in
          ("km_rodado", "dias_previstos", "dias_realizados", "atraso_devolucao_dias",
           "valor_cobranca", "valor_multa_atraso")],
        F.count_if(both & (c("atraso_devolucao_dias") != late)).alias("atraso_incoerente"))
    mov = dw["fato_veiculo_no_patio"].agg(
        F.count_if(~c("qtd_movimentacoes").eqNullSafe(1)).alias("qtd_invalida"))
    return stack(unpivot_counts(df, "regra").select(F.lit(n).alias("tabela"), "regra", "qtd")
                 for n, df in (("fato_reserva", res), ("fato_locacao", loc),
                               ("fato_veiculo_no_patio", mov)))


def billing_stats(cobranca: DataFrame) -> DataFrame:
    return cobranca.agg(F.count("*").alias("qtd_locacoes_com_cobranca"),
                        F.sum("qtd_cobrancas").alias("qtd_cobrancas_totais"),
                        F.round(F.sum("valor_cobranca"), 2).alias("valor_total"))


def orphan_billing(cobranca: DataFrame, locacao: DataFrame) -> DataFrame:
    """Billed rentals the conformed layer does not hold."""
    return cobranca.join(locacao.select("locacao_nk"), "locacao_nk", "left_anti").select(
        "locacao_nk", "grupo_fonte", "qtd_cobrancas", "valor_cobranca")


# --- domains and imputation -----------------------------------------------------------------------

CATEGORICALS = (("conf_reserva", "status"), ("conf_locacao", "status"), ("conf_veiculo", "status"),
                ("conf_veiculo", "tipo_mecanizacao"), ("conf_cliente", "tipo"))


def observed_domains(conf: Tables) -> DataFrame:
    return stack(conf[t].groupBy(F.col(c).alias("valor")).agg(F.count("*").alias("qtd"))
                 .select(F.lit(f"{t}.{c}").alias("campo"), "valor", "qtd")
                 for t, c in CATEGORICALS)


def _labels(table, other: str) -> list[str]:
    return sorted({label for _, label in table} | {other})


# Allowed labels of each warehouse categorical; NULL passes (a rental may have no billing).
DOMAINS = {
    ("dim_cliente", "tipo"): ["PF", "PJ"],
    ("dim_veiculo", "tipo_mecanizacao"): ["automatico", "manual"],
    ("dim_veiculo", "status"): _labels(R.VEHICLE_STATUS, R.VEHICLE_STATUS_OTHER),
    ("fato_reserva", "status_reserva"): _labels(R.RESERVATION_STATUS, R.RESERVATION_STATUS_OTHER),
    ("fato_locacao", "status_cobranca"): sorted(BILLING_LABELS),
}


def domain_violations(dw: Tables) -> DataFrame:
    return stack(dw[t].agg(F.count("*").alias("linhas"),
                           F.count_if(~F.col(c).isin(allowed)).alias("fora_do_dominio"))
                 .select(F.lit(f"{t}.{c}").alias("campo"), "linhas", "fora_do_dominio")
                 for (t, c), allowed in DOMAINS.items())


def imputation_audit(conf: Tables) -> DataFrame:
    flags = (("conf_cliente", "flag_nome_imputado"), ("conf_veiculo", "flag_placa_imputada"))
    return stack(conf[t].agg(F.count_if(f).alias("imputados"), F.count("*").alias("total"))
                 .select(F.lit(t).alias("tabela"), "imputados", "total") for t, f in flags)


def calendar_continuity(dim_tempo: DataFrame) -> DataFrame:
    return dim_tempo.agg(F.count("*").alias("dias"),
                         (F.datediff(F.max("data"), F.min("data")) + 1).alias("intervalo"))


# --- gates ----------------------------------------------------------------------------------------

def require_zero(df: DataFrame, count: str, label: str) -> None:
    """Raise when a check reports a non-zero count, with the number of such rows, their sum, and the first twenty."""
    failing = df.filter(F.col(count) != 0)
    bad = [r.asDict() for r in failing.limit(20).collect()]
    if bad:
        rows, total = failing.agg(F.count("*"), F.sum(F.col(count))).first()
        raise DataQualityError(f"{label}: {rows} failing check(s), {total} in all: {bad}")


def require_rows(dw: Tables, names: Sequence[str] = ("dim_cliente", "dim_veiculo", "fato_locacao")
                 ) -> None:
    empty = [n for n in names if dw[n].isEmpty()]
    if empty:
        raise DataQualityError(f"empty tables: {empty}")


def run_gates(dw: Tables) -> None:
    """Every blocking check of the warehouse, for use after a load."""
    require_rows(dw)
    require_zero(null_audit(dw, REQUIRED_DW, by=None), "nulos", "mandatory columns")
    require_zero(duplicates_summary(dw, UNIQUE_DW), "chaves", "duplicate keys")
    require_zero(domain_violations(dw), "fora_do_dominio", "domains")
    require_zero(orphan_keys(dw), "orfaos", "orphan keys")
    require_zero(date_key_coverage(dw), "qtd_chaves_sem_dim_tempo", "time keys")
    measures = fact_measures(dw).filter("regra <> 'dias_invalidos'")
    require_zero(measures, "qtd", "measures")
