"""Conformed tables -> star schema rows. Surrogate keys are resolved here, assigned in the upsert."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from rodovia.functions import rules as R
from rodovia.functions.calendar import calendar_attributes, continuous_days, date_bounds
from rodovia.plans.conform import LINE, line, unpivot_counts, with_fee_of, with_late_fee
from rodovia.plans.lazy import LazyTables
from rodovia.session import scratch_path

Tables = Mapping[str, DataFrame]


class GateError(Exception):
    """A load was stopped because rows miss a mandatory dimension."""


@dataclass(frozen=True)
class Dimension:
    name: str
    nk: str
    sk: str
    retain: tuple[str, ...] = ()


DIMENSIONS = {d.name: d for d in (
    Dimension("dim_cliente", "cliente_id", "sk_cliente"),
    Dimension("dim_condutor", "condutor_id", "sk_condutor"),
    Dimension("dim_grupo_veiculo", "grupo_id", "sk_grupo_veiculo"),
    Dimension("dim_empresa", "empresa_id", "sk_empresa", retain=("cnpj",)),
    Dimension("dim_patio", "patio_id", "sk_patio"),
    Dimension("dim_veiculo", "veiculo_id", "sk_veiculo"),
)}


@dataclass(frozen=True)
class Fact:
    name: str
    nk: str
    sk: str


FACTS = {f.name: f for f in (
    Fact("fato_reserva", "reserva_id", "sk_fato_reserva"),
    Fact("fato_locacao", "locacao_id", "sk_fato_locacao"),
    Fact("fato_veiculo_no_patio", "movimentacao_patio_id", "sk_fato_veiculo_no_patio"),
)}

# Facts are stored by month of this date key; 0 holds rows without it.
PARTITION_DATE = {"fato_reserva": "sk_tempo_inicio",
                  "fato_locacao": "sk_tempo_retirada_realizada",
                  "fato_veiculo_no_patio": "sk_tempo_movimentacao"}
PARTITION = "mes_particao"


def with_partition(fact: str, rows: DataFrame) -> DataFrame:
    month = F.floor(F.coalesce(F.col(PARTITION_DATE[fact]), F.lit(0)) / 100).cast("int")
    return rows.withColumn(PARTITION, month)


def calendar_dates(conf: Tables) -> list[tuple[DataFrame, list[Column]]]:
    c = F.col
    return [
        (conf["conf_tempo"], [c("data")]),
        (conf["conf_reserva"], [c("data_reserva"), c("data_inicio"), c("data_fim")]),
        (conf["conf_locacao"], [c("data_registro"), c("data_retirada_prevista"), c("data_retirada"),
                                c("data_devolucao_prevista"), c("data_devolucao")]),
        (conf["conf_movimentacao_patio"], [c("data_movimentacao")]),
    ]


def dim_tempo(conf: Tables) -> DataFrame:
    """Every day between the earliest and the latest date, without gaps.

    Only the two bounds are aggregated; the days themselves are generated.
    """
    return calendar_attributes(continuous_days(date_bounds(calendar_dates(conf))))


def dim_cliente(conf: Tables) -> DataFrame:
    return conf["conf_cliente"].select(F.col("cliente_nk").alias("cliente_id"), "nome", "tipo",
                                       "cidade", "flag_nome_imputado")


def dim_condutor(conf: Tables) -> DataFrame:
    return conf["conf_condutor"].select(
        F.col("condutor_nk").alias("condutor_id"), F.col("cliente_nk").alias("cliente_id"), "nome",
        F.col("categoria").alias("categoria_cnh"), F.col("validade").alias("validade_cnh"))


def dim_grupo_veiculo(conf: Tables) -> DataFrame:
    return conf["conf_grupo_veiculo"].select(F.col("grupo_veiculo_nk").alias("grupo_id"), "nome",
                                             "categoria")


def dim_empresa(conf: Tables) -> DataFrame:
    """The conformed layer carries no company registration number, hence the NULL."""
    return conf["conf_empresa"].select(F.col("empresa_nk").alias("empresa_id"),
                                       F.col("nome_empresa").alias("nome"),
                                       F.lit(None).cast("string").alias("cnpj"))


def dim_patio(conf: Tables) -> DataFrame:
    return conf["conf_patio"].select(F.col("patio_nk").alias("patio_id"), "nome", "cidade",
                                     "capacidade")


# Dimensions that depend on no other; dim_veiculo follows them.
ATTRIBUTES = {"dim_cliente": dim_cliente, "dim_condutor": dim_condutor,
              "dim_grupo_veiculo": dim_grupo_veiculo, "dim_empresa": dim_empresa,
              "dim_patio": dim_patio}

ORPHAN = "_orfao"


def _look_up(rows: DataFrame, dim: DataFrame, nk: str, by: str, take: Mapping[str, str]) -> DataFrame:
    """Left-join ``dim`` on its natural key; ``take`` maps dim columns to output names.

    No broadcast hint: Catalyst broadcasts a side whose size estimate is under the threshold, AQE
    does so when its shuffle output turns out to be, and either falls back to a sort-merge join
    whose skewed partitions AQE splits.
    """
    side = dim.select(F.col(nk).alias("_nk"), *[F.col(c).alias(n) for c, n in take.items()])
    # A stored conformed table may carry markers of the same names.
    return rows.drop(*take.values()).join(side, F.col(by) == F.col("_nk"), "left").drop("_nk")


def dim_veiculo_candidates(conf: Tables, dims: Tables) -> DataFrame:
    rows = conf["conf_veiculo"]
    rows = _look_up(rows, dims["dim_grupo_veiculo"], "grupo_id", "grupo_veiculo_nk",
                    {"sk_grupo_veiculo": "sk_grupo_veiculo"})
    rows = _look_up(rows, dims["dim_empresa"], "empresa_id", "empresa_nk",
                    {"sk_empresa": "sk_empresa"})
    return rows.select(
        F.col("veiculo_nk").alias("veiculo_id"), "placa", "chassi", "marca", "modelo", "cor",
        "tipo_mecanizacao", "ar_condicionado", "adaptado_cadeirante", "status",
        "flag_placa_imputada", "sk_grupo_veiculo", "sk_empresa",
        (F.col("sk_grupo_veiculo").isNull() | F.col("sk_empresa").isNull()).alias(ORPHAN))


@dataclass(frozen=True)
class Calendar:
    """What a gate needs to know of dim_tempo: its bounds, and the days it lacks between them."""

    low: dt.date
    high: dt.date
    missing: tuple[dt.date, ...] = ()


def calendar_gaps(dim_tempo: DataFrame) -> DataFrame:
    """(data): the days missing between the runs of consecutive days of a calendar.

    The window orders the calendar itself, a row per day of history.
    """
    following = dim_tempo.select("data", F.lead("data").over(Window.orderBy("data")).alias("proxima"))
    return (following.filter(F.datediff("proxima", "data") > 1)
            .select(F.explode(F.sequence(F.date_add("data", 1), F.date_sub("proxima", 1))).alias("data")))


def calendar_of(dim_tempo: DataFrame) -> Calendar | None:
    """None for an empty calendar. The driver gets at most a date per day of history."""
    days, order = dim_tempo.select("data").filter("data IS NOT NULL"), Window.orderBy("data")
    # Ends of the runs of consecutive days, in one pass over whatever the calendar is computed from.
    ends = (days.withColumns({"before": F.lag("data").over(order), "after": F.lead("data").over(order)})
            .filter("before IS NULL OR after IS NULL OR datediff(after, data) > 1").collect())
    if not ends:
        return None
    missing = sorted({e.data + dt.timedelta(n) for e in ends if e.after is not None for n in range(1, (e.after - e.data).days)})
    return Calendar(min(e.data for e in ends), max(e.data for e in ends), tuple(missing))


def _outside(calendar: Calendar | None, *dates: str) -> Column:
    """True when the calendar has no row for a non-null date: outside its bounds, or in a gap."""
    if calendar is None:
        return F.lit(False)
    low, high = (F.lit(d).cast("date") for d in (calendar.low, calendar.high))
    out = F.lit(False)
    for d in dates:
        absent = (F.col(d) < low) | (F.col(d) > high)
        if calendar.missing:
            absent = absent | F.col(d).cast("date").isin(*calendar.missing)
        out = out | F.coalesce(absent, F.lit(False))
    return out


def _missing(sk: str) -> Column:
    return F.col(sk).isNull()


def _dangling(nk: str, sk: str) -> Column:
    return F.col(nk).isNotNull() & F.col(sk).isNull()


def reserva_candidates(conf: Tables, dims: Tables, calendar: Calendar | None = None) -> DataFrame:
    """Reservation facts plus the orphan flags; time keys are a function of the date itself, so no
    calendar join is needed, only a check against the calendar's bounds and gaps."""
    rows = conf["conf_reserva"]
    rows = _look_up(rows, dims["dim_cliente"], "cliente_id", "cliente_nk",
                    {"sk_cliente": "sk_cliente"})
    rows = _look_up(rows, dims["dim_grupo_veiculo"], "grupo_id", "grupo_veiculo_nk",
                    {"sk_grupo_veiculo": "sk_grupo_veiculo"})
    rows = _look_up(rows, dims["dim_patio"], "patio_id", "patio_retirada_nk",
                    {"sk_patio": "sk_patio_retirada"})
    rows = _look_up(rows, dims["dim_patio"], "patio_id", "patio_devolucao_nk",
                    {"sk_patio": "sk_patio_devolucao"})
    return rows.select(
        F.col("reserva_nk").alias("reserva_id"), "sk_cliente", "sk_grupo_veiculo",
        "sk_patio_retirada", "sk_patio_devolucao",
        R.date_key("data_inicio").alias("sk_tempo_inicio"),
        R.date_key("data_fim").alias("sk_tempo_fim"),
        F.col("status").alias("status_reserva"),
        F.lit(1).alias("qtd_reservas"),
        R.days_inclusive("data_inicio", "data_fim").alias("dias_reservados"),
        (F.col("status") == "cancelada").alias("flag_cancelada"),
        (F.col("status") == "confirmada").alias("flag_confirmada"),
        (F.col("status") == "espera").alias("flag_espera"),
        _missing("sk_cliente").alias("_sem_cliente"),
        _missing("sk_grupo_veiculo").alias("_sem_grupo"),
        (_missing("sk_patio_retirada") | _dangling("patio_devolucao_nk", "sk_patio_devolucao"))
        .alias("_sem_patio"),
        (F.col("data_inicio").isNull() | _outside(calendar, "data_inicio", "data_fim"))
        .alias("_sem_tempo"))


def _traits(tables: Tables) -> Mapping[str, object]:
    return tables.traits if isinstance(tables, LazyTables) else {}


def _unheld(conf: Tables, dims: Tables, dim: str, nk: str, table: str, by: str) -> DataFrame:
    """(_nk): the values of a reference that no row of ``dim`` has, written to the shared folder.

    They come from the rows before the de-duplication, of which the others are a part. Usually they are few; then Catalyst sees
    it from the size of the files and the referring rows stay in place.
    """
    source = by.removesuffix("_nk")
    used = _traits(conf)["staged"][table].select(R.natural_key("grupo_fonte", f"src_{source}_id").alias("_nk")).distinct()
    held = dims[dim].select(F.col(nk).alias("_held"))
    absent = used.filter("_nk IS NOT NULL").join(held, F.col("_nk") == F.col("_held"), "left_anti")
    path = scratch_path(absent.sparkSession, f"sem_{source}")
    absent.write.parquet(path)
    return absent.sparkSession.read.schema(absent.schema).parquet(path)


def _refer(rows: DataFrame, conf: Tables, dims: Tables, dim: str, table: str, by: str) -> DataFrame:
    """``_look_up`` of a dimension's key alone. Where natural keys stand in for keys, only values without a member matter: they are
    found from the distinct values, instead of moving all rows to the dimension."""
    spec = DIMENSIONS[dim]
    if not ("natural" in _traits(dims) and "staged" in _traits(conf)):
        return _look_up(rows, dims[dim], spec.nk, by, {spec.sk: spec.sk})
    absent = _unheld(conf, dims, dim, spec.nk, table, by).withColumn("_sem", F.lit(True))
    return (rows.drop(spec.sk).join(absent, F.col(by) == F.col("_nk"), "left")
            .withColumn(spec.sk, F.when(F.col("_sem").isNull(), F.col(by))).drop("_nk", "_sem"))


def _yards(rows: DataFrame, dims: Tables) -> DataFrame:
    for side in ("retirada", "devolucao"):
        rows = _look_up(rows, dims["dim_patio"], "patio_id", f"patio_{side}_nk", {"sk_patio": f"sk_patio_{side}"})
    return rows.withColumn("_sem_patio", _missing("sk_patio_retirada") | _dangling("patio_devolucao_nk", "sk_patio_devolucao"))


def _look_up_apart(rows: DataFrame, table: DataFrame, dim: DataFrame, nk: str, by: str, take: Mapping[str, str]) -> DataFrame:
    """``_look_up`` for rows that are dealt by LINE and stay there: the references alone, read from the stored ``table``, go to the
    dimension and come back with what it has. Rows that repeat a key each find their own reference."""
    side = dim.select(F.col(nk).alias("_nk"), *[F.col(c).alias(n) for c, n in take.items()])
    found = (table.select(line().alias("_l"), F.col(by).alias("_v")).join(side, F.col("_v") == F.col("_nk")).drop("_nk")
             .repartition("_l").dropDuplicates())
    # Not written as an equality, which would deal the rows anew by both columns.
    own = (F.col(LINE) == F.col("_l")) & (F.col(by) <= F.col("_v")) & (F.col(by) >= F.col("_v"))
    return rows.drop(*take.values()).join(found, own, "left").drop("_l", "_v")


def locacao_candidates(conf: Tables, dims: Tables, calendar: Calendar | None = None) -> DataFrame:
    return rental_candidates(conf, dims, calendar).drop(LINE)


def rental_candidates(conf: Tables, dims: Tables, calendar: Calendar | None = None) -> DataFrame:
    """Rental facts plus the orphan flags. A flag is set where its reference is looked up, so that what follows need not carry the
    key; the vehicle comes last, with the daily rate where the late fee is still to be computed: one move serves both.
    Candidates of stored rentals keep the column they are dealt by, so that joins by rental find them in place."""
    traits = _traits(conf)
    billing = conf["conf_cobranca"].select(
        "grupo_fonte", F.col("src_locacao_id").alias("src_id"),
        F.col("valor_cobranca").alias("_cobrado"), "status_cobranca")
    vehicle = {"sk_veiculo": "sk_veiculo", "sk_grupo_veiculo": "sk_grupo_veiculo", "sk_empresa": "sk_empresa"}
    if "staged" in traits and "apart" in _traits(dims):
        # Rentals stay where the de-duplication has put them; their references alone go to the vehicles and come back by rental.
        bills = traits["bills"]().select(F.col(LINE).alias("_l"), F.col("valor_cobranca").alias("_cobrado"), "status_cobranca")
        rows = traits["by_line"]().join(bills, F.col(LINE) == F.col("_l"), "left").drop("_l")
        rows = _yards(rows, dims)
        rows = _refer(rows, conf, dims, "dim_cliente", "locacao", "cliente_nk").withColumn("_sem_cliente", _missing("sk_cliente"))
        rows = _refer(rows, conf, dims, "dim_condutor", "locacao", "condutor_nk").withColumn("_sem_condutor", _missing("sk_condutor"))
        found = traits["by_line"]().select(F.col(LINE).alias("_l"), "veiculo_nk").join(traits["rates"](), "veiculo_nk", "left")
        found = _look_up(found, dims["dim_veiculo"], "veiculo_id", "veiculo_nk", vehicle).drop("veiculo_nk")
        rows = with_fee_of(rows.join(found, F.col(LINE) == F.col("_l"), "left").drop("_l")).drop(LINE)
    elif "staged" in traits:
        # Same keys as the rentals' de-duplication: computed in one plan, the rentals stay in place.
        rows = (traits["unrated"]() if "unrated" in traits else conf["conf_locacao"]).join(billing, ["grupo_fonte", "src_id"], "left")
        rows = _yards(rows, dims)
        rows = _refer(rows, conf, dims, "dim_cliente", "locacao", "cliente_nk").withColumn("_sem_cliente", _missing("sk_cliente"))
        rows = _refer(rows, conf, dims, "dim_condutor", "locacao", "condutor_nk").withColumn("_sem_condutor", _missing("sk_condutor"))
        if "unrated" in traits:
            rows = with_late_fee(rows, traits["rates"]())
        rows = _look_up(rows, dims["dim_veiculo"], "veiculo_id", "veiculo_nk", vehicle)
    else:
        # Stored rentals are cheap to read again, so their references travel without them: whole rentals move once.
        stored = conf["conf_locacao"]
        bills = billing.select(R.natural_key("grupo_fonte", "src_id").alias("_l"), "_cobrado", "status_cobranca")
        rows = _yards(stored, dims).withColumn(LINE, line())
        rows = rows.join(bills, F.col(LINE) == F.col("_l"), "left").drop("_l")
        for name, by in (("dim_cliente", "cliente_nk"), ("dim_condutor", "condutor_nk")):
            spec = DIMENSIONS[name]
            rows = _look_up_apart(rows, stored, dims[name], spec.nk, by, {spec.sk: spec.sk})
        rows = _look_up_apart(rows, stored, dims["dim_veiculo"], "veiculo_id", "veiculo_nk", vehicle)
        rows = rows.withColumns({"_sem_cliente": _missing("sk_cliente"), "_sem_condutor": _missing("sk_condutor")})
    dates = ("data_retirada_prevista", "data_retirada", "data_devolucao_prevista", "data_devolucao")
    return rows.select(
        F.col("locacao_nk").alias("locacao_id"), F.col("reserva_nk").alias("reserva_id"),
        "sk_cliente", "sk_condutor", "sk_veiculo", "sk_grupo_veiculo", "sk_empresa",
        "sk_patio_retirada", "sk_patio_devolucao",
        R.date_key("data_retirada_prevista").alias("sk_tempo_retirada_prevista"),
        R.date_key("data_retirada").alias("sk_tempo_retirada_realizada"),
        R.date_key("data_devolucao_prevista").alias("sk_tempo_devolucao_prevista"),
        R.date_key("data_devolucao").alias("sk_tempo_devolucao_realizada"),
        "km_entrega", "km_devolucao", "km_rodado", "dias_previstos", "dias_realizados",
        "atraso_devolucao_dias",
        F.lit(1).alias("qtd_locacoes"),
        F.coalesce("_cobrado", "valor_cobrado").cast("decimal(12,2)").alias("valor_cobranca"),
        F.col("valor_multa_atraso").cast("decimal(12,2)").alias("valor_multa_atraso"),
        "flag_multa_estimada", "status_cobranca",
        "_sem_cliente", "_sem_condutor", _missing("sk_veiculo").alias("_sem_veiculo"), "_sem_patio",
        _outside(calendar, *dates).alias("_sem_tempo"), *([LINE] if LINE in rows.columns else []))


def movimentacao_candidates(conf: Tables, dims: Tables, calendar: Calendar | None = None) -> DataFrame:
    rows = conf["conf_movimentacao_patio"]
    rows = _look_up(rows, dims["dim_veiculo"], "veiculo_id", "veiculo_nk",
                    {"sk_veiculo": "sk_veiculo"})
    rows = _look_up(rows, dims["dim_patio"], "patio_id", "patio_origem_nk",
                    {"sk_patio": "sk_patio_origem"})
    rows = _look_up(rows, dims["dim_patio"], "patio_id", "patio_destino_nk",
                    {"sk_patio": "sk_patio_destino"})
    return rows.select(
        F.col("movimentacao_patio_nk").alias("movimentacao_patio_id"), "sk_veiculo",
        "sk_patio_origem", "sk_patio_destino",
        R.date_key("data_movimentacao").alias("sk_tempo_movimentacao"), "motivo",
        F.lit(1).alias("qtd_movimentacoes"),
        _missing("sk_veiculo").alias("_sem_veiculo"),
        (_missing("sk_patio_origem") | _missing("sk_patio_destino")).alias("_sem_patio"),
        (F.col("data_movimentacao").isNull() | _outside(calendar, "data_movimentacao"))
        .alias("_sem_tempo"))


CANDIDATES = {"fato_reserva": reserva_candidates, "fato_locacao": locacao_candidates,
              "fato_veiculo_no_patio": movimentacao_candidates}


def flags(candidates: DataFrame) -> list[str]:
    return [c for c in candidates.columns if c.startswith("_sem_") or c == ORPHAN]


def is_orphan(candidates: DataFrame) -> Column:
    bad = F.lit(False)
    for c in flags(candidates):
        bad = bad | F.col(c)
    return bad


def loadable(candidates: DataFrame) -> DataFrame:
    """Rows with every mandatory dimension. The filter rejects NULL keys, so Catalyst turns the
    left joins on mandatory dimensions back into inner joins."""
    return candidates.filter(~is_orphan(candidates)).drop(*flags(candidates))


def quarantined(candidates: DataFrame) -> DataFrame:
    return candidates.filter(is_orphan(candidates))


def gate_counts(candidates: DataFrame) -> DataFrame:
    """(motivo, qtd): rows missing each mandatory dimension, and rows missing any."""
    counted = candidates.agg(
        *[F.count_if(c).alias(c.lstrip("_")) for c in flags(candidates) if c != ORPHAN],
        F.count_if(is_orphan(candidates)).alias("orfaos"))
    return unpivot_counts(counted, "motivo")


def natural_warehouse(conf: Tables, days: DataFrame | None = None, apart: bool = False) -> LazyTables:
    """The star as lazy plans, with every surrogate key standing in as its natural key.

    Views and reports only need keys that join, so a report over the operational data can run
    without loading the warehouse first; Catalyst prunes what the report does not touch. ``apart`` is for readers of whole rentals, which
    then do not move to the vehicles; a few columns move there more cheaply than references go and come back.
    """
    def keyed(name: str, build):
        spec = DIMENSIONS[name]
        return lambda t: build(conf).withColumn(spec.sk, F.col(spec.nk))

    def fact(build):
        return lambda t: loadable(build(conf, t))

    return LazyTables({
        "dim_tempo": lambda t: dim_tempo(conf) if days is None else days,
        **{n: keyed(n, b) for n, b in ATTRIBUTES.items()},
        "dim_veiculo": lambda t: loadable(dim_veiculo_candidates(conf, t))
        .withColumn("sk_veiculo", F.col("veiculo_id")),
        **{n: fact(b) for n, b in CANDIDATES.items()},
    }, natural=True, **({"apart": True} if apart else {}))
