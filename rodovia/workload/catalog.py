"""The registered queries: name -> (Spark plan, output columns, independent SQL)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rodovia.functions import rules as R
from rodovia.functions.calendar import calendar_attributes, continuous_days, date_bounds
from rodovia.operators import keys as K, merge as M
from rodovia.operators.dedup import latest_per_key
from rodovia.operators.distinct import distinct_counts
from rodovia.operators.store import TableStore
from rodovia.operators.timeslice import with_sequence
from rodovia.plans import (integrity as I, maintained, operational as P, quality as Q, refresh, reports, star,
                           views)
from rodovia.plans.conform import (REFERENCES as CONF_REFERENCES, conf_tempo, conformed, resolve,
                                   staging_dates, staging_warnings, store_conformed)
from rodovia.plans.lazy import LazyTables
from rodovia.session import CLUSTER_SETTINGS, discard, release, scratch_path
from rodovia.sources import extract as X, mappings as MAP
from rodovia.sources.registry import FrameSource
from rodovia.streaming import jobs, parts, telemetry as T
from rodovia.streaming.handover import HandOver
from rodovia.streaming.ordered import in_order
from rodovia.streaming.tiers import RUNGS, Tiers
from rodovia.workload import oracle as O
from rodovia.workload.proxies import Inputs, money

AS_OF = dt.date.fromisoformat(O.AS_OF)
RUN_TS = dt.datetime.fromisoformat(O.RUN_TS)
SPARK_TYPES = {"i": "bigint", "d": "double", "s": "string", "b": "boolean"}


class Context(Inputs):
    """Everything a query may start from; nothing is computed before it is used."""

    @cached_property
    def conf(self) -> LazyTables:
        return conformed(self.staging, AS_OF)

    @cached_property
    def days(self) -> DataFrame:
        """A calendar wide enough for every fact, from the staging dates alone."""
        planned = [F.col("data_retirada_prevista"), F.col("data_devolucao_prevista")]
        rentals = self.staging["locacao"]
        # The planned dates of rentals join the other ones, so that rentals are read once.
        frames = [(rows, dates + planned if rows is rentals else dates) for rows, dates in staging_dates(self.staging)]
        return calendar_attributes(continuous_days(date_bounds(frames)))

    @cached_property
    def dw(self) -> LazyTables:
        """The star as plans: a report with one branch computes what it needs in one job."""
        return star.natural_warehouse(self.conf, self.days)

    @cached_property
    def dw_on_dims(self) -> LazyTables:
        """The star for checks that read each fact once: dimensions are written once, the facts stay plans that move only the
        columns the check reads."""
        return star.natural_warehouse(self.conf, self.days).kept(lambda name, rows: rows if name in star.FACTS else self._written(name, rows))

    @cached_property
    def dw_for_views(self) -> LazyTables:
        """The star for the views, which read each fact several times: each table is written once to the shared folder when first
        asked for, a fact with the columns that the views read."""
        def save(name: str, rows: DataFrame) -> DataFrame:
            return self._written(name, rows.select(*views.FACT_COLUMNS[name]) if name in star.FACTS else rows)

        return star.natural_warehouse(self.conf, self.days).kept(save)

    @cached_property
    def dw_to_count(self) -> LazyTables:
        """The star for checks that read a table twice and ask for rows only: each is written once, with its natural key."""
        def save(name: str, rows: DataFrame) -> DataFrame:
            return self._written(name, rows.select(star.FACTS[name].nk) if name in star.FACTS else rows)

        return star.natural_warehouse(self.conf, self.days).kept(save)

    @cached_property
    def dw_of_whole_rentals(self) -> LazyTables:
        """The star for a reader of all columns of the rentals."""
        return star.natural_warehouse(self.conf, self.days, apart=True)

    @cached_property
    def with_stored_lines(self) -> Context:
        """The same inputs for queries that read rentals and billings several times: the order lines that both are made of are joined
        and written once."""
        other = Context(self.spark, self.dir)
        other.__dict__["_lines"] = self._written("linhas", self._lines.drop("o_orderkey"))
        release(self.spark)
        return other

    def _written(self, name: str, rows: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, name)
        rows.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @cached_property
    def tel(self) -> DataFrame:
        return T.telemetry(self.table("events"))


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Context], DataFrame]
    columns: dict[str, str]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = self.build(Context(spark, sf_dir))
        return rows.select(*[F.col(c).cast(SPARK_TYPES[t]).alias(c) for c, t in self.columns.items()])

    def statement(self) -> str | None:
        return None if self.sql is None else O.typed(self.sql, self.columns)


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None):
    spec = dict(part.split(":") for part in columns.split())

    def add(build: Callable[[Context], DataFrame]):
        QUERIES[name] = Query(name, build, spec, sql)
        return build
    return add


def plain(name: str, columns: str, sql: str | None, build: Callable[[Context], DataFrame]) -> None:
    query(name, columns, sql)(build)


def ua(parts) -> str:
    return " union all ".join(parts)


# --- rules ----------------------------------------------------------------------------------------

def _rule(name: str, table: str, cte: str, sql: str, expr: Callable[[], Column], kind: str = "s",
          keys: str = "grupo_fonte:i src_id:i") -> None:
    names = [k.split(":")[0] for k in keys.split()]
    plain(name, f"{keys} valor:{kind}", f"select {', '.join(names)}, {sql} valor from {cte}",
          lambda x: x.staging[table].select(*names, expr().alias("valor")))


_rule("status_reserva", "reserva", "s_reserva", O.reserva_st("status"), lambda: R.reservation_status("status"))
_rule("status_veiculo", "veiculo", "s_veiculo", O.veiculo_st("status"), lambda: R.vehicle_status("status"))
_rule("status_cobranca", "cobranca", "s_cobranca", O.cobranca_st("status"), lambda: R.billing_status("status"))
_rule("tipo_cliente", "cliente", "s_cliente", O.cliente_tp("tipo"), lambda: R.client_type("tipo"))
_rule("mecanizacao", "veiculo", "s_veiculo",
      f"if({O.has('tipo_mecanizacao', 'auto')}, 'automatico', 'manual')",
      lambda: R.transmission("tipo_mecanizacao"))
_rule("placa", "veiculo", "s_veiculo", O.placa("placa"), lambda: R.plate("placa"))
_rule("placa_imputada", "veiculo", "s_veiculo", f"{O.placa('placa')} = 'SEMPLACA'",
      lambda: R.plate_is_imputed("placa"), "b")


def _day(name: str) -> Column:
    return F.col(name).cast("date")


def _sql_day(name: str) -> str:
    return f"cast({name} as date)"


_rule("dias_inclusivo", "reserva", "s_reserva",
      O.incl(_sql_day("data_inicio"), _sql_day("data_fim")),
      lambda: R.days_inclusive(_day("data_inicio"), _day("data_fim")), "i")
_rule("dias_atraso", "locacao", "s_locacao",
      O.late(_sql_day("data_devolucao_realizada"), _sql_day("data_devolucao_prevista")),
      lambda: R.days_late(_day("data_devolucao_realizada"), _day("data_devolucao_prevista")), "i")
_rule("km_rodado", "locacao", "s_locacao",
      "case when km_devolucao is not null then greatest(km_devolucao - km_entrega, 0) end",
      lambda: R.km_driven("km_entrega", "km_devolucao"), "i")
_rule("valor_cobrado", "locacao", "s_locacao",
      "coalesce(nullif(preco_final,0), nullif(valor_total,0), nullif(valor_final,0), "
      "nullif(valor_atraso + coalesce(valor_reparos,0),0), 0)",
      lambda: R.charged_amount("preco_final", "valor_total", "valor_final", "valor_atraso", "valor_reparos"),
      "d")
_rule("status_locacao", "locacao", "s_locacao",
      f"case when {O.has('status', 'cancel')} then 'cancelada' "
      "when data_devolucao_realizada is not null then 'finalizada' "
      "when data_retirada_realizada is not null then 'aberta' "
      "else coalesce(nullif(lower(trim(status)),''),'registrada') end",
      lambda: R.rental_status("status", "data_retirada_realizada", "data_devolucao_realizada"))
_rule("chave_data", "reserva", "s_reserva", O.ymd("data_fim"), lambda: R.date_key(_day("data_fim")), "i")
_rule("chave_nk", "condutor", "s_condutor", O.nk("src_cliente_id"),
      lambda: R.natural_key("grupo_fonte", "src_cliente_id"))
_rule("chave_slug", "veiculo", "s_veiculo", O.empresa_nk("src_empresa_id", "nome_empresa"),
      lambda: R.company_key("grupo_fonte", "src_empresa_id", "nome_empresa"))
_rule("rotulo_veiculo", "veiculo", "s_veiculo",
      "coalesce(placa,'') || ' - ' || coalesce(marca,'') || ' ' || coalesce(modelo,'')",
      lambda: R.vehicle_label("placa", "marca", "modelo"))

plain("multa_atraso", "locacao_nk:s valor_multa_atraso:d flag_multa_estimada:b",
      "select locacao_nk, valor_multa_atraso, flag_multa_estimada from k_locacao",
      lambda x: x.conf["conf_locacao"])
plain("imputacao", "src_id:i nome:s imputado:b uf:s email:s telefone:s",
      f"select src_id, coalesce({O.blank('nome')}, 'Cliente nao informado') nome, "
      f"{O.blank('nome')} is null imputado, upper({O.blank('uf')}) uf, "
      f"lower({O.blank('email')}) email, {O.digits('telefone')} telefone from s_cliente",
      lambda x: x.staging["cliente"].select(
          "src_id", R.or_sentinel("nome", "Cliente nao informado").alias("nome"),
          R.blank_to_null("nome").isNull().alias("imputado"),
          F.upper(R.blank_to_null("uf")).alias("uf"), F.lower(R.blank_to_null("email")).alias("email"),
          R.digits_only("telefone").alias("telefone")))
plain("antecedencia", "reserva_nk:s antecedencia_dias:i duracao_prevista_dias:i",
      "select reserva_nk, antecedencia_dias, duracao_prevista_dias from k_reserva",
      lambda x: x.conf["conf_reserva"])
plain("dias_para_devolucao", "locacao_nk:s dias_para_devolucao:i reserva_previa:b",
      "select locacao_nk, dias_para_devolucao, reserva_previa from k_locacao",
      lambda x: x.conf["conf_locacao"])
plain("medidas_reserva",
      "reserva_id:s dias_reservados:i flag_cancelada:b flag_confirmada:b flag_espera:b",
      "select reserva_id, dias_reservados, flag_cancelada, flag_confirmada, flag_espera from f_reserva",
      lambda x: x.dw["fato_reserva"])


@query("rules_sql", "grupo_fonte:i status:s n:i dias:i multa:d",
       f"select grupo_fonte, {O.reserva_st('status')} status, count(*) n, "
       f"sum({O.incl(_sql_day('data_inicio'), _sql_day('data_fim'))}) dias, "
       f"sum(2 * coalesce({O.late(_sql_day('data_fim'), _sql_day('data_inicio'))}, 0)) multa "
       "from s_reserva group by 1, 2")
def rules_sql(x: Context) -> DataFrame:
    """The rule library called from Spark SQL under its function names."""
    R.register_sql(x.spark)
    x.staging["reserva"].createOrReplaceTempView("stg_reserva_regras")
    return x.spark.sql("""
        SELECT grupo_fonte, fn_normaliza_status_reserva(status) AS status, count(*) AS n,
               sum(fn_dias_inclusivo(CAST(data_inicio AS DATE), CAST(data_fim AS DATE))) AS dias,
               sum(fn_multa_atraso(CAST(0 AS DECIMAL(10,2)), CAST(data_fim AS DATE),
                   CAST(data_inicio AS DATE), CAST(2 AS DECIMAL(10,2)))) AS multa
        FROM stg_reserva_regras GROUP BY ALL""")


# --- conformance ----------------------------------------------------------------------------------

plain("dedup_latest", "grupo_fonte:i src_id:i dt_extracao:s src_veiculo_id:i src_devolucao_id:i",
      f"select grupo_fonte, src_id, dt_extracao, src_veiculo_id, src_devolucao_id from ({O.latest('s_locacao')})",
      lambda x: latest_per_key(x.staging["locacao"], ["grupo_fonte", "src_id"]))
plain("conf_cliente", "cliente_nk:s src_id:i grupo_fonte:i nome:s flag_nome_imputado:b tipo:s cidade:s "
      "uf:s email:s telefone:s dt_extracao:s", "select * from k_cliente",
      lambda x: x.conf["conf_cliente"])
plain("conf_condutor", "condutor_nk:s cliente_nk:s src_id:i grupo_fonte:i src_cliente_id:i nome:s cnh:s "
      "validade:s categoria:s", "select * from k_condutor", lambda x: x.conf["conf_condutor"])
plain("conf_grupo_veiculo", "grupo_veiculo_nk:s nome:s categoria:s diaria:d", "select * from k_grupo",
      lambda x: x.conf["conf_grupo_veiculo"])
plain("conf_empresa", "empresa_nk:s src_empresa_id:i grupo_fonte:i nome_empresa:s dt_extracao:s",
      "select * from k_empresa", lambda x: x.conf["conf_empresa"])
plain("conf_patio", "patio_nk:s empresa_nk:s src_id:i grupo_fonte:i nome:s cidade:s capacidade:i "
      "nome_empresa:s", "select * from k_patio", lambda x: x.conf["conf_patio"])
plain("conf_veiculo", "veiculo_nk:s grupo_veiculo_nk:s empresa_nk:s placa:s flag_placa_imputada:b chassi:s "
      "modelo:s marca:s cor:s tipo_mecanizacao:s ar_condicionado:b adaptado_cadeirante:b status:s "
      "sk_grupo:s sk_empresa:s nome_empresa:s",
      "select v.*, g.grupo_veiculo_nk sk_grupo, e.empresa_nk sk_empresa from k_veiculo v "
      "left join k_grupo g using (grupo_veiculo_nk) left join k_empresa e on e.empresa_nk = v.empresa_nk",
      lambda x: resolve(x.conf, "conf_veiculo"))
plain("conf_tempo", "id_tempo:i data:s ano:i mes:i dia:i trimestre:i dia_semana:i nome_dia_semana:s "
      "nome_mes:s fim_de_semana:b",
      "select *, sk_tempo id_tempo, flag_fim_de_semana fim_de_semana from k_tempo",
      lambda x: conf_tempo(x.staging))
plain("conf_reserva", "reserva_nk:s cliente_nk:s grupo_veiculo_nk:s patio_retirada_nk:s "
      "patio_devolucao_nk:s sk_cliente:s sk_grupo:s sk_patio_retirada:s sk_patio_devolucao:s "
      "data_reserva:s data_inicio:s data_fim:s id_data_reserva:i id_data_inicio:i id_data_fim:i "
      "antecedencia_dias:i duracao_prevista_dias:i status:s preco_previsto:d preco_final:d",
      "select r.* exclude (data_reserva, data_inicio, data_fim), d_reserva data_reserva, "
      "d_inicio data_inicio, d_fim data_fim, c.cliente_nk sk_cliente, g.grupo_veiculo_nk sk_grupo, "
      "pr.patio_nk sk_patio_retirada, pd.patio_nk sk_patio_devolucao from k_reserva r "
      "left join k_cliente c on c.cliente_nk = r.cliente_nk "
      "left join k_grupo g on g.grupo_veiculo_nk = r.grupo_veiculo_nk "
      "left join k_patio pr on pr.patio_nk = r.patio_retirada_nk "
      "left join k_patio pd on pd.patio_nk = r.patio_devolucao_nk",
      lambda x: resolve(x.conf, "conf_reserva"))
plain("conf_locacao", "locacao_nk:s reserva_nk:s veiculo_nk:s condutor_nk:s cliente_nk:s "
      "patio_retirada_nk:s patio_devolucao_nk:s sk_cliente:s sk_condutor:s sk_veiculo:s "
      "sk_patio_retirada:s sk_patio_devolucao:s sk_reserva:s data_registro:s data_retirada_prevista:s "
      "data_retirada:s data_devolucao_prevista:s data_devolucao:s km_entrega:i km_devolucao:i "
      "dias_previstos:i dias_realizados:i atraso_devolucao_dias:i dias_para_devolucao:i km_rodado:i "
      "gasolina_entrega:i gasolina_devolucao:i valor_atraso:d valor_reparos:d valor_cobrado:d "
      "valor_multa_atraso:d flag_multa_estimada:b reserva_previa:b status:s",
      "select l.* exclude (data_retirada_prevista, data_devolucao_prevista), registro data_registro, "
      "ret_prev data_retirada_prevista, ret data_retirada, dev_prev data_devolucao_prevista, "
      "dev data_devolucao, c.cliente_nk sk_cliente, cd.condutor_nk sk_condutor, v.veiculo_nk sk_veiculo, "
      "pr.patio_nk sk_patio_retirada, pd.patio_nk sk_patio_devolucao, r.reserva_nk sk_reserva "
      "from k_locacao l left join k_cliente c on c.cliente_nk = l.cliente_nk "
      "left join k_condutor cd on cd.condutor_nk = l.condutor_nk "
      "left join k_veiculo v on v.veiculo_nk = l.veiculo_nk "
      "left join k_patio pr on pr.patio_nk = l.patio_retirada_nk "
      "left join k_patio pd on pd.patio_nk = l.patio_devolucao_nk "
      "left join k_reserva r on r.reserva_nk = l.reserva_nk",
      lambda x: resolve(x.with_stored_lines.conf, "conf_locacao"))
plain("conf_cobranca", "locacao_nk:s grupo_fonte:i qtd_cobrancas:i valor_cobranca:d status_cobranca:s "
      "data_ultimo_pagamento:s dt_extracao:s", "select * from k_cobranca",
      lambda x: x.conf["conf_cobranca"])
plain("conf_movimentacao", "movimentacao_patio_nk:s veiculo_nk:s patio_origem_nk:s patio_destino_nk:s "
      "sk_veiculo:s sk_patio_origem:s sk_patio_destino:s data_movimentacao:s id_data_movimentacao:i motivo:s",
      f"select m.*, {O.ymd('data_movimentacao')} id_data_movimentacao, v.veiculo_nk sk_veiculo, "
      "po.patio_nk sk_patio_origem, pd.patio_nk sk_patio_destino from k_mov m "
      "left join k_veiculo v on v.veiculo_nk = m.veiculo_nk "
      "left join k_patio po on po.patio_nk = m.patio_origem_nk "
      "left join k_patio pd on pd.patio_nk = m.patio_destino_nk",
      lambda x: resolve(x.conf, "conf_movimentacao_patio"))
plain("staging_warnings", "aviso:s qtd:i",
      "select 'odometro_invertido' aviso, count(*) qtd from s_locacao where km_devolucao < km_entrega "
      "union all select 'devolucao_antes_da_retirada', count(*) from s_locacao "
      "where data_devolucao_realizada < data_retirada_realizada "
      "union all select 'reserva_sem_patio_retirada', count(*) from s_reserva "
      "where src_patio_retirada_id is null",
      lambda x: staging_warnings(x.staging))

# --- extraction -----------------------------------------------------------------------------------

MARK = ("coalesce((select max(dt_extracao) - interval 1 hour from p_log where grupo_fonte = {g} "
        "and tabela_stg = '{t}' and status = 'OK'), timestamp '" + O.RUN_TS + "' - interval 7 day)")


def sql_mark(table: str, source: int = 1, whole_day: bool = False) -> str:
    text = MARK.format(g=source, t=table)
    return f"cast(date_trunc('day', {text}) as timestamp)" if whole_day else text


def mark(x: Context, table: str, source: int = 1) -> dt.datetime:
    return X.mark_for(table, X.high_water_marks(x.extraction_log, source, RUN_TS), RUN_TS)


plain("extract_mark", "grupo_fonte:i tabela_stg:s marca:s",
      "select grupo_fonte, tabela_stg, max(dt_extracao) - interval 1 hour marca from p_log "
      "where status = 'OK' group by 1, 2",
      lambda x: X.marks_from_log(x.extraction_log).select(
          "grupo_fonte", "tabela_stg", (F.col("ultima") - F.expr("INTERVAL 1 HOUR")).alias("marca")))


def _extract(name: str, entity: str, columns: str, sql: str, frame) -> None:
    plain(name, columns, sql, lambda x: X.staging_rows(
        frame(FrameSource(x.oltp), MAP.Options(), mark(x, entity)), entity, 1, RUN_TS))


_extract("extract_reserva_g1", "reserva",
         "grupo_fonte:i src_id:i src_cliente_id:i data_inicio:s data_fim:s status:s dt_extracao:s",
         "select 1 grupo_fonte, id src_id, cliente_id src_cliente_id, data_inicio, data_fim, status, "
         f"timestamp '{O.RUN_TS}' dt_extracao from o_reserva where data_inicio >= "
         f"{sql_mark('reserva', whole_day=True)} or status in ('cancelada', 'espera')", MAP.g1_reserva)
_extract("extract_locacao_g1", "locacao",
         "src_id:i src_reserva_id:i src_veiculo_id:i src_cliente_id:i data_devolucao_realizada:s km_entrega:i created_at:s",
         "select l.id src_id, reserva_id src_reserva_id, veiculo_id src_veiculo_id, c.cliente_id src_cliente_id, "
         "data_devolucao_realizada, km_entrega, created_at from o_locacao l join o_condutor c on c.id = l.condutor_id "
         f"where created_at >= {sql_mark('locacao')} or (data_devolucao_realizada is null "
         "and data_retirada_realizada is not null)", MAP.g1_locacao)
_extract("extract_cobranca_g1", "cobranca",
         "src_id:i src_locacao_id:i valor:d status:s data_pagamento:s",
         "select id src_id, locacao_id src_locacao_id, valor, status, data_pagamento from o_cobranca "
         f"where status = 'pendente' or data_pagamento >= {sql_mark('cobranca', whole_day=True)}",
         MAP.g1_cobranca)
_extract("extract_movimentacao_g1", "movimentacao_patio",
         "src_id:i src_veiculo_id:i src_origem_id:i src_destino_id:i data_movimentacao:s",
         "select id src_id, veiculo_id src_veiculo_id, origem_patio_id src_origem_id, destino_patio_id src_destino_id, "
         f"data_movimentacao from o_movimentacao_patio where data_movimentacao >= {sql_mark('movimentacao_patio')}",
         MAP.g1_movimentacao)


def g2_source(x: Context) -> FrameSource:
    c = F.col
    orders, lines = x.table("orders"), x.table("lineitem")
    client = x.table("customer")
    return FrameSource({
        "empresa": x.table("region").filter("r_regionkey = 2").select(
            c("r_regionkey").alias("id_empresa"), c("r_name").alias("nome_empresa")),
        "endereco": x.table("nation").select(c("n_nationkey").alias("id_endereco"),
                                             c("n_name").alias("cidade"), F.lit("RJ").alias("uf")),
        "patio": x.table("nation").select(c("n_nationkey").alias("id_patio"),
                                          c("n_name").alias("nome_patio"),
                                          c("n_nationkey").alias("id_endereco"),
                                          F.lit(2).alias("id_empresa")),
        "vaga": x.table("supplier").select(
            c("s_suppkey").alias("id_vaga"), c("s_nationkey").alias("id_patio"),
            F.when(c("s_suppkey") % 3 == 0, c("s_suppkey")).alias("id_veiculo")),
        "cliente": client.select(c("c_custkey").alias("id_cliente"), c("c_name").alias("nome_completo"),
                                 c("c_nationkey").alias("id_endereco"),
                                 c("c_custkey").alias("id_documento"),
                                 c("c_mktsegment").alias("email"), c("c_name").alias("telefone")),
        "documento_cliente": client.select(
            c("c_custkey").alias("id_documento"),
            F.when(c("c_custkey") % 4 != 0, c("c_custkey").cast("string")).alias("cnh")),
        "grupo": x.categories.select(c("tid").alias("id_grupo"), c("p_type").alias("nome"),
                                     c("p_type").alias("descricao"), c("diaria").alias("diaria_grupo")),
        "especificacoes_const": x.table("nation").select(
            c("n_nationkey").alias("id_spec_const"), (c("n_nationkey") % 2).alias("direcao_automatica"),
            (c("n_nationkey") % 3).alias("ar_condicionado")),
        "especificacoes_var": orders.select(c("o_orderkey").alias("id_spec_var"),
                                            (c("o_orderkey") % 9).alias("gasolina")),
        "veiculo": x.table("part").select(
            c("p_partkey").alias("id_veiculo"), c("p_name").alias("placa"), c("p_brand").alias("chassi"),
            c("p_name").alias("modelo"), c("p_brand").alias("marca"),
            (c("p_size") % 25).alias("id_spec_const"), (c("p_partkey") % 6).alias("id_grupo")),
        "reserva": orders.select(
            c("o_orderkey").alias("id_reserva"), c("o_custkey").alias("id_cliente"),
            (c("o_orderkey") % 6).alias("id_grupo"), (c("o_orderkey") % 25).alias("id_patio_origem"),
            (c("o_orderkey") % 7).alias("id_patio_fim"), c("o_orderdate").alias("data_inicio_combinada"),
            c("o_orderdate").alias("data_fim_combinada"), c("o_orderdate").alias("data_reserva"),
            (c("o_orderkey") % 4).alias("estado_reserva"), money("o_totalprice").alias("preco_final")),
        "locacao": orders.select(
            c("o_orderkey").alias("id_locacao"), c("o_orderkey").alias("id_reserva"),
            (c("o_orderkey") % 100).alias("id_veiculo"), (c("o_orderkey") % 25).alias("id_patio"),
            c("o_orderdate").alias("data_locacao"), c("o_orderkey").alias("id_spec_var"),
            F.when(c("o_orderkey") % 3 != 0, c("o_orderkey")).alias("id_caucao")),
        "devolucao": lines.groupBy(c("l_orderkey").alias("id_locacao")).agg(
            F.max("l_suppkey").alias("id_vaga"), F.max("l_shipdate").alias("data_devolucao"))
        .select((c("id_locacao") + 7).alias("id_devolucao"), "id_locacao", "id_vaga", "data_devolucao",
                (c("id_locacao") + 1).alias("id_spec_var")),
        "custos_devolucao": orders.filter("o_orderkey % 2 = 0").select(
            c("o_orderkey").alias("id_caucao"), money(c("o_orderkey") % 50).alias("valor_atraso"),
            money(c("o_orderkey") % 30).alias("valor_reparos")),
    })


G2_SQL = {
    "dev": "select l_orderkey id_locacao, max(l_suppkey) id_vaga, max(l_shipdate) data_devolucao from lineitem "
           "group by 1",
}
plain("source_mapping_g2_patio_capacity",
      "src_id:i nome:s cidade:s capacidade:i src_empresa_id:i nome_empresa:s",
      "select n_nationkey src_id, n_name nome, n_name cidade, count(s_suppkey) capacidade, 2 src_empresa_id, "
      "(select r_name from region where r_regionkey = 2) nome_empresa from nation "
      "left join supplier on s_nationkey = n_nationkey group by 1, 2",
      lambda x: MAP.g2_patio(g2_source(x), MAP.Options(), None))
plain("source_mapping_g2_veiculo",
      "src_id:i tipo_mecanizacao:s ar_condicionado:b status:s src_empresa_id:i nome_empresa:s",
      "select p_partkey src_id, case when (p_size%25)%2=1 then 'automatico' else 'manual' end tipo_mecanizacao, "
      "(p_size%25)%3=1 ar_condicionado, case when s_suppkey is not null then 'alugado' else 'disponivel' end status, "
      "2 src_empresa_id, (select r_name from region where r_regionkey = 2) nome_empresa "
      "from part left join supplier on s_suppkey = p_partkey and s_suppkey%3=0",
      lambda x: MAP.g2_veiculo(g2_source(x), MAP.Options(), None))
plain("source_mapping_g2_locacao",
      "src_id:i src_devolucao_id:i src_cliente_id:i src_patio_retirada_id:i src_patio_devolucao_id:i "
      "data_devolucao_realizada:s gasolina_entrega:i gasolina_devolucao:i valor_atraso:d valor_reparos:d preco_final:d",
      f"""select o.o_orderkey src_id, d.id_locacao + 7 src_devolucao_id, o.o_custkey src_cliente_id,
      o.o_orderkey%25 src_patio_retirada_id, s_nationkey src_patio_devolucao_id, d.data_devolucao data_devolucao_realizada,
      o.o_orderkey%9 gasolina_entrega, sd.o_orderkey%9 gasolina_devolucao,
      case when o.o_orderkey%6 in (2,4) then o.o_orderkey%50 end valor_atraso,
      case when o.o_orderkey%6 in (2,4) then o.o_orderkey%30 end valor_reparos,
      cast(o.o_totalprice as decimal(10,2)) preco_final
      from orders o left join ({G2_SQL['dev']}) d on d.id_locacao = o.o_orderkey
      left join orders sd on sd.o_orderkey = d.id_locacao + 1 left join supplier on s_suppkey = d.id_vaga
      where o.o_orderdate >= {sql_mark('locacao', 2)} or d.id_locacao is null""",
      lambda x: MAP.g2_locacao(g2_source(x), MAP.Options(), mark(x, "locacao", 2)))
plain("source_mapping_g2_reserva", "src_id:i src_grupo_id:i data_inicio:s status:s preco_final:d",
      "select o_orderkey src_id, o_orderkey%6 src_grupo_id, o_orderdate data_inicio, "
      "case o_orderkey%4 when 0 then 'ativa' when 1 then 'cancelada' when 2 then 'confirmada' end status, "
      f"cast(o_totalprice as decimal(10,2)) preco_final from orders where o_orderdate >= "
      f"{sql_mark('reserva', 2, True)} or o_orderkey%4=1",
      lambda x: MAP.g2_reserva(g2_source(x), MAP.Options(), mark(x, "reserva", 2)))
plain("source_mapping_g2_cobranca", "src_id:i valor:d status:s data_pagamento:s",
      f"""select o_orderkey src_id, cast(o_totalprice as decimal(10,2))
      + case when o_orderkey%6 in (2,4) then o_orderkey%50 + o_orderkey%30 else 0 end valor,
      case when d.id_locacao is not null then 'pago' else 'pendente' end status, cast(data_devolucao as date) data_pagamento
      from orders left join ({G2_SQL['dev']}) d on d.id_locacao = o_orderkey""",
      lambda x: MAP.g2_cobranca(g2_source(x), MAP.Options(), None))


def g3_source(x: Context) -> FrameSource:
    c, k = F.col, F.col("c_custkey")
    client, orders = x.table("customer"), x.table("orders")
    return FrameSource({
        "cliente": client.select(k.alias("id_cliente"), c("c_nationkey").alias("id_endereco"),
                                 F.when(k % 2 == 0, "PF").otherwise("PJ").alias("tipo_cliente"),
                                 c("c_mktsegment").alias("email_cliente"),
                                 c("c_name").alias("telefone_cliente")),
        "endereco": x.table("nation").select(c("n_nationkey").alias("id_endereco"),
                                             c("n_name").alias("cidade"), F.lit("SP").alias("uf")),
        "cliente_pf": client.filter(k % 2 == 0).select(k.alias("id_cliente"),
                                                       c("c_name").alias("nome_cliente")),
        "cliente_pj": client.filter(k % 3 == 0).select(
            k.alias("id_cliente"), F.concat(F.lit("Firma "), "c_name").alias("razao_social")),
        "motorista": client.select((k + 1).alias("id_motorista"), k.alias("id_cliente")),
        "reserva": orders.select(
            c("o_orderkey").alias("id_reserva"), c("o_custkey").alias("id_cliente"),
            (c("o_orderkey") % 6).alias("id_categoria"),
            (c("o_orderkey") % 25).alias("id_patio_previsto_retirada"),
            (c("o_orderkey") % 9).alias("id_patio_previsto_devolucao"),
            c("o_orderdate").alias("data_hora_reserva"), c("o_orderdate").alias("data_previsao_retirada"),
            c("o_orderdate").alias("data_previsao_devolucao"),
            F.when(c("o_orderkey") % 5 == 0, "Cancelado").when(c("o_orderkey") % 5 != 4, "OK")
            .alias("status_reserva"), money("o_totalprice").alias("valor_previsto")),
        "locacao": orders.select(
            c("o_orderkey").alias("id_locacao"), c("o_orderkey").alias("id_reserva"),
            (c("o_orderkey") % 99).alias("id_veiculo"), c("o_custkey").alias("id_motorista"),
            (c("o_orderkey") % 25).alias("id_patio_real_retirada"),
            (c("o_orderkey") % 7).alias("id_patio_real_devolucao"),
            c("o_orderdate").alias("data_hora_retirada_real"),
            F.when(c("o_orderstatus") != "O", c("o_orderdate")).alias("data_hora_devolucao_real"),
            (c("o_orderkey") % 1000).cast("int").alias("km_retirada"),
            (c("o_orderkey") % 1500).cast("int").alias("km_devolucao"),
            money("o_totalprice").alias("valor_total_final"), c("o_orderstatus").alias("status_locacao")),
    })


plain("source_mapping_g3_coalesce_name", "src_id:i nome:s tipo:s cidade:s uf:s email:s",
      "select c_custkey src_id, case when c_custkey%2=0 then c_name when c_custkey%3=0 then 'Firma ' || c_name end nome, "
      "case when c_custkey%2=0 then 'PF' else 'PJ' end tipo, n_name cidade, 'SP' uf, c_mktsegment email "
      "from customer join nation on n_nationkey = c_nationkey",
      lambda x: MAP.g3_cliente(g3_source(x), MAP.Options(), None))
plain("source_mapping_g3_locacao",
      "src_id:i src_condutor_id:i src_cliente_id:i data_devolucao_realizada:s km_entrega:i valor_total:d status:s",
      "select o_orderkey src_id, o_custkey src_condutor_id, c_custkey src_cliente_id, "
      "case when o_orderstatus<>'O' then o_orderdate end data_devolucao_realizada, o_orderkey%1000 km_entrega, "
      "cast(o_totalprice as decimal(10,2)) valor_total, o_orderstatus status from orders join customer "
      f"on c_custkey + 1 = o_custkey where o_orderdate >= {sql_mark('locacao', 3)} or o_orderstatus = 'O'",
      lambda x: MAP.g3_locacao(g3_source(x), MAP.Options(), mark(x, "locacao", 3)))
plain("source_mapping_g3_reserva", "src_id:i src_cliente_id:i status:s preco_previsto:d",
      "select o_orderkey src_id, o_custkey src_cliente_id, case when o_orderkey%5=0 then 'Cancelado' "
      "when o_orderkey%5<>4 then 'OK' end status, cast(o_totalprice as decimal(10,2)) preco_previsto from orders "
      f"where o_orderdate >= {sql_mark('reserva', 3)} or o_orderkey%5=0",
      lambda x: MAP.g3_reserva(g3_source(x), MAP.Options(), mark(x, "reserva", 3)))


def g4_source(x: Context) -> FrameSource:
    c = F.col
    spelled = F.element_at(F.array(*[F.lit(w) for w in ("S", "sim", "0", "1", "T", "N", "TRUE")]),
                           (c("p_size") % 8 + 1).cast("int"))
    orders = x.table("orders")
    return FrameSource({
        "veiculo": x.table("part").select(
            c("p_partkey").alias("id_veiculo"), c("p_name").alias("placa"), c("p_brand").alias("chassi"),
            c("p_name").alias("modelo"), c("p_brand").alias("marca"), c("p_type").alias("mecanizacao"),
            F.when(c("p_size") % 8 != 7, spelled).alias("ar_condicionado"),
            c("p_type").alias("status_disponibilidade"), (c("p_partkey") % 6).alias("id_grupo")),
        "motorista": x.table("customer").select(c("c_custkey").alias("id_motorista"),
                                                (c("c_custkey") % 50).alias("id_cliente")),
        "locacao": orders.select(
            c("o_orderkey").alias("id_locacao"), c("o_orderkey").alias("id_reserva"),
            (c("o_orderkey") % 99).alias("id_veiculo"), c("o_custkey").alias("id_motorista"),
            (c("o_orderkey") % 25).alias("id_patio_saida"),
            (c("o_orderkey") % 7).alias("id_patio_chegada_realizada"),
            c("o_orderdate").alias("data_hora_retirada"),
            F.when(c("o_orderstatus") != "P", c("o_orderdate")).alias("data_hora_devolucao_realizada"),
            money("o_totalprice").alias("valor_final")),
    })


plain("source_mapping_g4_bool", "src_id:i ar_condicionado:b adaptado_cadeirante:b",
      "select p_partkey src_id, p_size%8 in (0,1,3,4,6) ar_condicionado, false adaptado_cadeirante from part",
      lambda x: MAP.g4_veiculo(g4_source(x), MAP.Options(), None))
plain("source_mapping_g4_locacao", "src_id:i src_cliente_id:i data_devolucao_realizada:s valor_final:d",
      "select o_orderkey src_id, o_custkey%50 src_cliente_id, case when o_orderstatus<>'P' then o_orderdate end "
      "data_devolucao_realizada, cast(o_totalprice as decimal(10,2)) valor_final from orders "
      f"where o_orderdate >= {sql_mark('locacao', 4)} or o_orderstatus = 'P'",
      lambda x: MAP.g4_locacao(g4_source(x), MAP.Options(), mark(x, "locacao", 4)))
plain("source_mapping_g4_cobranca", "src_id:i valor:d status:s data_pagamento:s",
      "select o_orderkey src_id, cast(o_totalprice as decimal(10,2)) valor, "
      "case when o_orderstatus<>'P' then 'pago' else 'pendente' end status, "
      "case when o_orderstatus<>'P' then cast(o_orderdate as date) end data_pagamento from orders",
      lambda x: MAP.g4_cobranca(g4_source(x), MAP.Options(), None))

def g1_source(x: Context) -> FrameSource:
    c, k = F.col, F.col("c_custkey")
    yes = (c("p_size") % 2 == 0)
    return FrameSource({
        "cliente": x.table("customer").select(k.alias("id"), c("c_name").alias("nome"), c("c_mktsegment").alias("tipo"),
                                              c("c_nationkey").cast("string").alias("cidade")),
        "condutor": x.table("customer").select(
            (k + 1).alias("id"), k.alias("cliente_id"), c("c_name").alias("nome"), k.cast("string").alias("cnh"),
            F.lit("2027-01-01").cast("date").alias("validade"), c("c_mktsegment").alias("categoria")),
        "grupo_veiculo": x.categories.select(c("tid").alias("id"), c("p_type").alias("nome"), c("p_type").alias("categoria"), "diaria"),
        "empresa_locadora": x.table("region").select(c("r_regionkey").alias("id"), c("r_name").alias("nome")),
        "veiculo": x.table("part").select(
            c("p_partkey").alias("id"), c("p_name").alias("placa"), c("p_brand").alias("chassi"), c("p_name").alias("modelo"),
            c("p_brand").alias("marca"), F.lit("azul").alias("cor"), c("p_type").alias("tipo_mecanizacao"), yes.alias("ar_condicionado"),
            (~yes).alias("adaptado_cadeirante"), c("p_type").alias("status"), (c("p_partkey") % 6).alias("grupo_id"),
            (c("p_partkey") % 8).cast("int").alias("empresa_id")),
        "patio": x.table("nation").select(c("n_nationkey").alias("id"), c("n_name").alias("nome"),
                                          c("n_regionkey").cast("string").alias("cidade")),
        "vaga": x.table("supplier").select(c("s_name").alias("codigo"), c("s_nationkey").alias("patio_id"),
                                           F.when(c("s_suppkey") % 3 == 0, "ocupada").otherwise("livre").alias("status")),
        "reserva": x.table("orders").select(
            c("o_orderkey").alias("id"), c("o_custkey").alias("cliente_id"), (c("o_orderkey") % 6).alias("grupo_id"),
            (c("o_orderkey") % 25).alias("patio_retirada_id"), (c("o_orderkey") % 7).alias("patio_devolucao_id"),
            c("o_orderdate").alias("data_inicio"), c("o_orderdate").alias("data_fim"),
            F.when(c("o_orderkey") % 4 == 0, "cancelada").otherwise("confirmada").alias("status")),
        "locacao": x.table("orders").select(
            c("o_orderkey").alias("id"), c("o_orderkey").alias("reserva_id"), (c("o_orderkey") % 99).alias("veiculo_id"),
            (c("o_custkey") + 1).alias("condutor_id"), (c("o_orderkey") % 25).alias("patio_retirada_id"),
            (c("o_orderkey") % 7).alias("patio_devolucao_id"), c("o_orderdate").alias("data_retirada_prevista"),
            c("o_orderdate").alias("data_retirada_realizada"), c("o_orderdate").alias("data_devolucao_prevista"),
            F.when(c("o_orderkey") % 3 != 0, c("o_orderdate")).alias("data_devolucao_realizada"),
            (c("o_orderkey") % 1000).cast("int").alias("km_entrega"), (c("o_orderkey") % 1500).cast("int").alias("km_devolucao"),
            F.lit("ok").alias("estado_entrega"), F.lit("ok").alias("estado_devolucao"), c("o_orderdate").alias("created_at")),
        "cobranca": x.table("orders").select(
            c("o_orderkey").alias("id"), c("o_orderkey").alias("locacao_id"), money("o_totalprice").alias("valor"),
            F.when(c("o_orderkey") % 2 == 0, "pendente").otherwise("pago").alias("status"),
            c("o_orderdate").cast("date").alias("data_pagamento")),
        "movimentacao_patio": x.table("events").select(
            c("event_id").alias("id"), c("user_id").alias("veiculo_id"), (c("user_id") % 25).alias("origem_patio_id"),
            (c("event_id") % 25).alias("destino_patio_id"), c("ts").alias("data_movimentacao"), c("event_type").alias("motivo")),
    })


def _more_of_g3(x: Context) -> FrameSource:
    """Source 3 with the tables that its other mappings read."""
    c, k, g3 = F.col, F.col("c_custkey"), g3_source(x)
    return FrameSource({
        **g3.tables,
        "empresa": x.table("region").select(c("r_regionkey").alias("id_empresa"), c("r_name").alias("nome_empresa")),
        "motorista": x.table("customer").select(
            (k + 1).alias("id_motorista"), k.alias("id_cliente"), c("c_name").alias("nome_motorista"), k.cast("string").alias("numero_cnh"),
            F.lit("2027-01-01").cast("date").alias("validade_cnh"), c("c_mktsegment").alias("categoria_cnh")),
        "categoria": x.categories.select(c("tid").alias("id_categoria"), c("p_type").alias("nome_categoria"),
                                         c("p_type").alias("descricao_categoria"), c("diaria").alias("valor_diaria_base")),
        "veiculo": x.table("part").select(
            c("p_partkey").alias("id_veiculo"), c("p_name").alias("placa"), c("p_brand").alias("chassi"), c("p_name").alias("modelo"),
            c("p_brand").alias("marca"), c("p_type").alias("tipo_cambio"), (c("p_size") % 3).alias("possui_ar_condicionado"),
            c("p_type").alias("status_veiculo"), (c("p_partkey") % 6).alias("id_categoria"), (c("p_partkey") % 8).cast("int").alias("id_empresa")),
        "patio": x.table("nation").select(
            c("n_nationkey").alias("id_patio"), c("n_name").alias("nome_patio"), c("n_nationkey").alias("id_endereco"),
            (c("n_regionkey") * 2).alias("id_empresa"), (c("n_nationkey") * 20).alias("capacidade")),
    })


def _more_of_g4(x: Context) -> FrameSource:
    c, k, g4 = F.col, F.col("c_custkey"), g4_source(x)
    return FrameSource({
        **g4.tables,
        "cliente": x.table("customer").select(k.alias("id_cliente"), c("c_name").alias("nome_razao_social"),
                                              c("c_mktsegment").alias("tipo_cliente")),
        "motorista": x.table("customer").select(
            k.alias("id_motorista"), (k % 50).alias("id_cliente"), c("c_name").alias("nome_condutor"), k.cast("string").alias("numero_cnh"),
            F.lit("2027-01-01").cast("date").alias("data_expiracao_cnh"), c("c_mktsegment").alias("categoria_habilitacao")),
        "grupo_veiculo": x.categories.select(c("tid").alias("id_grupo"), c("p_type").alias("nome_categoria"),
                                             c("p_type").alias("classe_luxo"), c("diaria").alias("valor_diaria")),
        "patio": x.table("nation").select(c("n_nationkey").alias("id_patio"), c("n_name").alias("nome_localizacao"),
                                          (c("n_nationkey") * 20).alias("capacidade_vagas"), c("n_name").alias("empresa_dona")),
        "reserva": x.table("orders").select(
            c("o_orderkey").alias("id_reserva"), c("o_custkey").alias("id_cliente"), (c("o_orderkey") % 6).alias("id_grupo"),
            (c("o_orderkey") % 25).alias("id_patio_retirada"), c("o_orderdate").alias("data_hora_solicitacao"),
            c("o_orderdate").alias("data_hora_retirada_prevista"), c("o_orderdate").alias("data_hora_devolucao_prevista"),
            F.when(c("o_orderkey") % 5 == 0, "CANCELADA").when(c("o_orderkey") % 5 != 4, "ok").alias("status_reserva")),
    })


def _mapped(number: int, source: Callable[[Context], FrameSource], entity: str, columns: str, sql: str) -> None:
    """One mapping of a source, by the function that an extraction of the source would call."""
    mapping = next(m for m in MAP.MAPPINGS[number] if m.entity == entity)
    plain(f"source_mapping_g{number}_{entity}_all" if f"source_mapping_g{number}_{entity}" in QUERIES else f"source_mapping_g{number}_{entity}",
          columns, sql, lambda x: mapping.frame(source(x), MAP.Options(), mark(x, entity, number) if mapping.incremental else None))


_PEOPLE = "src_id:i nome:s tipo:s cidade:s"
_mapped(1, g1_source, "cliente", _PEOPLE,
        "select c_custkey src_id, c_name nome, c_mktsegment tipo, cast(c_nationkey as varchar) cidade from customer")
_mapped(2, g2_source, "cliente", _PEOPLE + " uf:s email:s telefone:s",
        "select c_custkey src_id, c_name nome, 'PF' tipo, n_name cidade, 'RJ' uf, c_mktsegment email, c_name telefone from customer "
        "join nation on n_nationkey = c_nationkey")
_mapped(4, _more_of_g4, "cliente", "src_id:i nome:s tipo:s", "select c_custkey src_id, c_name nome, c_mktsegment tipo from customer")
_DRIVERS = "src_id:i src_cliente_id:i nome:s cnh:s validade:s categoria:s"
for _n, _source, _id, _client in ((1, g1_source, "c_custkey + 1", "c_custkey"), (3, _more_of_g3, "c_custkey + 1", "c_custkey"),
                                  (4, _more_of_g4, "c_custkey", "c_custkey % 50")):
    _mapped(_n, _source, "condutor", _DRIVERS, f"select {_id} src_id, {_client} src_cliente_id, c_name nome, "
            "cast(c_custkey as varchar) cnh, date '2027-01-01' validade, c_mktsegment categoria from customer")
_mapped(2, g2_source, "condutor", "src_id:i src_cliente_id:i nome:s cnh:s",
        "select c_custkey src_id, c_custkey src_cliente_id, c_name nome, cast(c_custkey as varchar) cnh from customer where c_custkey%4<>0")
for _n, _source in ((1, g1_source), (2, g2_source), (3, _more_of_g3), (4, _more_of_g4)):
    _mapped(_n, _source, "grupo_veiculo", "src_id:i nome:s categoria:s diaria:d",
            "select tid src_id, p_type nome, p_type categoria, diaria from p_tipos")
_mapped(1, g1_source, "veiculo", "src_id:i placa:s marca:s cor:s ar_condicionado:b adaptado_cadeirante:b src_grupo_id:i src_empresa_id:i "
        "nome_empresa:s", "select p_partkey src_id, p_name placa, p_brand marca, 'azul' cor, p_size%2=0 ar_condicionado, "
        "p_size%2<>0 adaptado_cadeirante, p_partkey%6 src_grupo_id, p_partkey%8 src_empresa_id, r_name nome_empresa from part "
        "join region on r_regionkey = p_partkey%8")
_mapped(2, g2_source, "veiculo", "src_id:i placa:s chassi:s modelo:s marca:s src_grupo_id:i status:s",
        "select p_partkey src_id, p_name placa, p_brand chassi, p_name modelo, p_brand marca, p_partkey%6 src_grupo_id, "
        "case when s_suppkey is not null then 'alugado' else 'disponivel' end status from part "
        "left join supplier on s_suppkey = p_partkey and s_suppkey%3=0")
_mapped(3, _more_of_g3, "veiculo", "src_id:i placa:s tipo_mecanizacao:s ar_condicionado:b status:s src_grupo_id:i src_empresa_id:i nome_empresa:s",
        "select p_partkey src_id, p_name placa, p_type tipo_mecanizacao, p_size%3=1 ar_condicionado, p_type status, p_partkey%6 src_grupo_id, "
        "p_partkey%8 src_empresa_id, r_name nome_empresa from part join region on r_regionkey = p_partkey%8")
_mapped(4, _more_of_g4, "veiculo", "src_id:i placa:s chassi:s modelo:s marca:s tipo_mecanizacao:s status:s src_grupo_id:i",
        "select p_partkey src_id, p_name placa, p_brand chassi, p_name modelo, p_brand marca, p_type tipo_mecanizacao, p_type status, "
        "p_partkey%6 src_grupo_id from part")
_mapped(1, g1_source, "patio", "src_id:i nome:s cidade:s",
        "select n_nationkey src_id, n_name nome, cast(n_regionkey as varchar) cidade from nation")
_mapped(3, _more_of_g3, "patio", "src_id:i nome:s cidade:s capacidade:i src_empresa_id:i nome_empresa:s",
        "select n_nationkey src_id, n_name nome, n_name cidade, n_nationkey*20 capacidade, n_regionkey*2 src_empresa_id, r_name nome_empresa "
        "from nation join region on r_regionkey = n_regionkey*2")
_mapped(4, _more_of_g4, "patio", "src_id:i nome:s capacidade:i nome_empresa:s",
        "select n_nationkey src_id, n_name nome, n_nationkey*20 capacidade, n_name nome_empresa from nation")
_mapped(1, g1_source, "vaga", "codigo:s src_patio_id:i status:s", "select s_name codigo, s_nationkey src_patio_id, "
        "case when s_suppkey%3=0 then 'ocupada' else 'livre' end status from supplier")
_mapped(2, g2_source, "vaga", "codigo:s src_patio_id:i status:s", "select cast(s_suppkey as varchar) codigo, s_nationkey src_patio_id, "
        "case when s_suppkey%3=0 then 'ocupada' else 'livre' end status from supplier")
_mapped(4, _more_of_g4, "reserva", "src_id:i src_cliente_id:i src_grupo_id:i src_patio_retirada_id:i data_solicitacao:s status:s",
        "select o_orderkey src_id, o_custkey src_cliente_id, o_orderkey%6 src_grupo_id, o_orderkey%25 src_patio_retirada_id, "
        "o_orderdate data_solicitacao, case when o_orderkey%5=0 then 'CANCELADA' when o_orderkey%5<>4 then 'ok' end status from orders "
        f"where o_orderdate >= {sql_mark('reserva', 4)} or o_orderkey%5=0")
_mapped(3, _more_of_g3, "cobranca", "src_id:i src_locacao_id:i valor:d status:s data_pagamento:s",
        "select o_orderkey src_id, o_orderkey src_locacao_id, cast(o_totalprice as decimal(10,2)) valor, "
        "case when o_orderstatus<>'O' then 'pago' else 'pendente' end status, "
        "case when o_orderstatus<>'O' then cast(o_orderdate as date) end data_pagamento from orders")
_mapped(4, _more_of_g4, "cobranca", "src_id:i src_locacao_id:i valor:d",
        "select o_orderkey src_id, o_orderkey src_locacao_id, cast(o_totalprice as decimal(10,2)) valor from orders")


# --- extraction runs ------------------------------------------------------------------------------

def _only_premises(x: Context) -> dict[int, FrameSource]:
    """Three sources: one sound, one with two companies, one that lacks a table."""
    g2, g3 = g2_source(x), _more_of_g3(x)
    two = x.table("region").filter("r_regionkey < 2").select(F.col("r_regionkey").alias("id_empresa"), F.col("r_name").alias("nome_empresa"))
    return {1: g1_source(x), 2: FrameSource({**g2.tables, "empresa": two}),
            3: FrameSource({n: t for n, t in g3.tables.items() if n != "categoria"})}


@dataclass(frozen=True)
class Extracted:
    store: TableStore
    log: DataFrame


def _extracted(x: Context) -> Extracted:
    """All sources twice; the second time source 1 has lost a third of its clients, and source 2 one of its companies."""
    store = TableStore(x.spark, scratch_path(x.spark, "stg"))
    sources = _only_premises(x)
    X.extract_all(store, sources, RUN_TS)
    g1 = sources[1].tables
    fewer = FrameSource({**g1, "cliente": g1["cliente"].filter("id % 3 <> 0")})
    X.extract_all(store, {1: fewer, 2: FrameSource({**sources[2].tables, "empresa": g2_source(x).tables["empresa"]})},
                  RUN_TS + dt.timedelta(hours=2))
    return Extracted(store, X.Log(x.spark, store.root).read())


#: Rows of source 1 in its first run and its second, and of source 2 in its second: the first window is a week.
_G1_ROWS = {"cliente": "customer", "condutor": "customer", "grupo_veiculo": "p_tipos", "veiculo": "(from part where p_partkey%8 < 5)",
            "patio": "nation", "vaga": "supplier",
            "reserva": "(from orders where o_orderdate >= {m}::date or o_orderkey%4=0)",
            "locacao": "(from orders where o_orderdate >= {m} or o_orderkey%3=0)",
            "cobranca": "(from orders where o_orderkey%2=0 or cast(o_orderdate as date) >= {m}::date)",
            "movimentacao_patio": "(from events where ts >= {m})"}
_G2_ROWS = {"cliente": "(from customer join nation on n_nationkey = c_nationkey)", "condutor": "(from customer where c_custkey%4<>0)",
            "grupo_veiculo": "p_tipos", "veiculo": "part", "patio": "nation", "vaga": "supplier",
            "reserva": "(from orders where o_orderdate >= {m}::date or o_orderkey%4=1)",
            "locacao": f"(from orders left join ({G2_SQL['dev']}) d on d.id_locacao = o_orderkey "
                       "where o_orderdate >= {m} or d.id_locacao is null)",
            "cobranca": "orders"}


def _log_sql(source: int, rows: dict[str, str], hours: int, mark_: str) -> list[str]:
    when = f"timestamp '{O.RUN_TS}' + interval {hours} hour"
    return [f"select {source} grupo_fonte, '{t}' tabela_stg, {when} dt_extracao, (select count(*) from {f.format(m=mark_)}) qtd, 'OK' status, "
            "null::varchar motivo" for t, f in rows.items()]


_FIRST = f"(timestamp '{O.RUN_TS}' - interval 7 day)"
_SECOND_MARK = f"(timestamp '{O.RUN_TS}' - interval 1 hour)"
_SECOND_FIRST = f"(timestamp '{O.RUN_TS}' + interval 2 hour - interval 7 day)"
_LATER = {**_G1_ROWS, "cliente": "(from customer where c_custkey%3<>0)"}


def _failed_sql(source: int, motive: str) -> str:
    return (f"select {source} grupo_fonte, 'GRUPO_{source}' tabela_stg, timestamp '{O.RUN_TS}' dt_extracao, 0 qtd, 'ERR' status, "
            f"'{motive}' motivo")


plain("extraction_log", "grupo_fonte:i tabela_stg:s dt_extracao:s qtd:i status:s motivo:s",
      ua([*_log_sql(1, _G1_ROWS, 0, _FIRST), *_log_sql(1, _LATER, 2, _SECOND_MARK), *_log_sql(2, _G2_ROWS, 2, _SECOND_FIRST),
          _failed_sql(2, "source 2 holds 2 companies"), _failed_sql(3, "table categoria not found")]),
      lambda x: _extracted(x).log.select(
          "grupo_fonte", "tabela_stg", "dt_extracao", F.col("qtd_registros").alias("qtd"), "status",
          F.nullif(F.regexp_extract("observacao", "source 2 holds 2 companies|table categoria not found", 0), F.lit("")).alias("motivo")))
plain("staging_refresh", "tabela:s grupo_fonte:i dt_extracao:s qtd:i",
      ua(f"select '{t}' tabela, {g} grupo_fonte, timestamp '{O.RUN_TS}' + interval 2 hour dt_extracao, count(*) qtd "
         f"from {f.format(m=m)} having count(*) > 0" for g, rows, m in ((1, _LATER, _SECOND_MARK), (2, _G2_ROWS, _SECOND_FIRST))
         for t, f in rows.items()),
      lambda x: Q.stack(rows.groupBy("grupo_fonte", "dt_extracao").agg(F.count("*").alias("qtd"))
                        .select(F.lit(t).alias("tabela"), "grupo_fonte", "dt_extracao", "qtd")
                        for store in [_extracted(x).store] for t in store.tables() for rows in [store.read(t)]))
plain("literal_rows", "tabela:s total:i esperado:i ok:b",
      "select * from (values ('region', (select count(*) from region), 5, (select count(*) from region) = 5), "
      "('nation', (select count(*) from nation), 24, (select count(*) from nation) = 24)) v(tabela, total, esperado, ok)",
      lambda x: Q.expected_counts({n: x.table(n) for n in ("region", "nation")},
                                  x.spark.createDataFrame([("region", 5), ("nation", 24)], "tabela string, esperado bigint")))

# --- keys and upserts -----------------------------------------------------------------------------

plain("assign_keys", "reserva_nk:s sk:i",
      "select reserva_nk, row_number() over (order by grupo_fonte, src_id) sk from k_reserva",
      lambda x: K.assign_keys(x.conf["conf_reserva"].select("reserva_nk", "grupo_fonte", "src_id"),
                              ["grupo_fonte", "src_id"], "sk"))


def _old_clients(x: Context) -> DataFrame:
    """An earlier version: two thirds of the clients, under other names, with keys 10, 20, ..."""
    return x.conf["conf_cliente"].filter("src_id % 3 <> 0").select(
        "cliente_nk", F.concat(F.lit("antigo "), "nome").alias("nome"), "cidade",
        ((F.col("src_id") + 1) * 10).alias("sk"))


@query("upsert_scd1", "cliente_nk:s nome:s cidade:s sk_mantida:i nova:b",
       """select coalesce(n.cliente_nk, o.cliente_nk) cliente_nk, coalesce(n.nome, 'antigo ' || o.nome) nome,
       coalesce(n.cidade, o.cidade) cidade, (o.src_id + 1) * 10 sk_mantida, o.src_id is null nova
       from k_cliente n
       full join (select * from k_cliente where src_id%3<>0) o on o.cliente_nk = n.cliente_nk""")
def upsert_scd1(x: Context) -> DataFrame:
    old = _old_clients(x)
    fresh = x.conf["conf_cliente"].select("cliente_nk", "nome", "cidade")
    top = old.agg(F.max("sk")).first()[0]
    keyed = fresh.join(M.keys_for_unseen(fresh, old, "cliente_nk", "sk"), "cliente_nk")
    merged = M.merge_type1(keyed, old, "cliente_nk", keep_key="sk")
    new = F.col("sk") > top
    return merged.select("cliente_nk", "nome", "cidade", F.when(~new, F.col("sk")).alias("sk_mantida"),
                         new.alias("nova"))


@query("upsert_keep_null", "empresa_nk:s nome:s cnpj:s",
       """select empresa_nk, nome_empresa nome,
       case when src_empresa_id%2=0 then 'novo' else 'cnpj ' || nome_empresa end cnpj from k_empresa""")
def upsert_keep_null(x: Context) -> DataFrame:
    firms = x.conf["conf_empresa"].select(
        "empresa_nk", F.col("nome_empresa").alias("nome"), "src_empresa_id")
    old = firms.select("empresa_nk", "nome", F.concat(F.lit("cnpj "), "nome").alias("cnpj"))
    new = firms.select("empresa_nk", "nome",
                       F.when(F.col("src_empresa_id") % 2 == 0, "novo").alias("cnpj"))
    return M.merge_type1(new, old, "empresa_nk", retain=["cnpj"])


def _published(x: Context) -> dict[str, DataFrame]:
    """Conform, gate, assign keys, upsert and publish the whole warehouse, then read it back."""
    cfg = refresh.Config(scratch_path(x.spark, "dw"), AS_OF, RUN_TS, quarantine=True)
    return refresh.warehouse(refresh.run_load(x.spark, cfg, _stored(x, cfg)))


def _stored(x: Context, cfg: refresh.Config) -> dict[str, DataFrame]:
    """The conformed tables, published."""
    run = cfg.store(x.spark, "conf").begin()
    conf = store_conformed(x.with_stored_lines.staging, run.write, AS_OF)
    run.commit()
    discard(x.with_stored_lines._lines)
    return conf


@query("warehouse_load", "fato:s nk:s cliente:s veiculo:s patio:s sk_tempo:i qtd:i valor:d",
       "select 'fato_locacao' fato, locacao_id nk, sk_cliente cliente, sk_veiculo veiculo, sk_patio_retirada patio, "
       "sk_tempo_retirada_realizada sk_tempo, 1 qtd, valor_cobranca valor from f_locacao union all "
       "select 'fato_reserva', reserva_id, sk_cliente, null, sk_patio_retirada, sk_tempo_inicio, 1, null from f_reserva "
       "union all select 'fato_veiculo_no_patio', movimentacao_patio_id, null, sk_veiculo, sk_patio_origem, "
       "sk_tempo_movimentacao, 1, null from f_mov")
def warehouse_load(x: Context) -> DataFrame:
    """The stored facts with their surrogate keys traced back to natural keys."""
    dw = _published(x)

    def named(rows: DataFrame, dim: str, sk: str, nk: str, by: str, out: str) -> DataFrame:
        side = dw[dim].select(F.col(sk).alias(by), F.col(nk).alias(out))
        return rows.join(side, by)

    none = F.lit(None).cast("string")
    loc = named(dw["fato_locacao"], "dim_cliente", "sk_cliente", "cliente_id", "sk_cliente", "cliente")
    loc = named(loc, "dim_veiculo", "sk_veiculo", "veiculo_id", "sk_veiculo", "veiculo")
    loc = named(loc, "dim_patio", "sk_patio", "patio_id", "sk_patio_retirada", "patio")
    res = named(dw["fato_reserva"], "dim_cliente", "sk_cliente", "cliente_id", "sk_cliente", "cliente")
    res = named(res, "dim_patio", "sk_patio", "patio_id", "sk_patio_retirada", "patio")
    mov = named(dw["fato_veiculo_no_patio"], "dim_veiculo", "sk_veiculo", "veiculo_id", "sk_veiculo",
                "veiculo")
    mov = named(mov, "dim_patio", "sk_patio", "patio_id", "sk_patio_origem", "patio")
    no_value = F.lit(None).cast("decimal(12,2)").alias("valor")
    return (loc.select(F.lit("fato_locacao").alias("fato"), F.col("locacao_id").alias("nk"), "cliente",
                       "veiculo", "patio", F.col("sk_tempo_retirada_realizada").alias("sk_tempo"),
                       F.col("qtd_locacoes").alias("qtd"), F.col("valor_cobranca").alias("valor"))
            .union(res.select(F.lit("fato_reserva"), "reserva_id", "cliente", none, "patio",
                              "sk_tempo_inicio", "qtd_reservas", no_value))
            .union(mov.select(F.lit("fato_veiculo_no_patio"), "movimentacao_patio_id", none, "veiculo",
                              "patio", "sk_tempo_movimentacao", "qtd_movimentacoes", no_value)))


def _older(conf: LazyTables) -> dict[str, DataFrame]:
    """An earlier delivery: some rentals, bookings and moves are missing, some had other dates, some other measures."""
    def moved(rows: DataFrame, date: str, key: str, other: dict[str, Column]) -> DataFrame:
        was = {c: F.when(F.col("src_id") % 10 == 7, e).otherwise(F.col(c)) for c, e in other.items()}
        return (rows.filter("src_id % 10 <> 3").withColumn(date, F.when(F.col("src_id") % 10 == 5, F.date_add(date, -40)).otherwise(F.col(date)))
                .withColumns(was))

    return {**{n: conf[n] for n in conf},
            "conf_locacao": moved(conf["conf_locacao"], "data_retirada", "locacao_nk", {"km_rodado": F.col("km_rodado") + 1}),
            "conf_reserva": moved(conf["conf_reserva"], "data_inicio", "reserva_nk", {"status": F.lit("espera")}),
            "conf_movimentacao_patio": moved(conf["conf_movimentacao_patio"], "data_movimentacao", "movimentacao_patio_nk",
                                             {"motivo": F.lit("antes")})}


def _loaded_twice(x: Context) -> tuple[refresh.TableStore, dict[str, DataFrame]]:
    """The warehouse after a second load over an older one, and the older facts."""
    cfg = refresh.Config(scratch_path(x.spark, "dw"), AS_OF, RUN_TS, quarantine=True, maintain_views=True)
    conf = _stored(x, cfg)
    # The older dates lie in the same calendar.
    before = refresh.warehouse(refresh.run_load(x.spark, cfg, _older(LazyTables({n: (lambda t, d=d: d) for n, d in conf.items()}))))
    return refresh.run_load(x.spark, cfg, conf), before


_AFTER = ua(f"select '{f}' fato, {nk} nk, {sk} sk_tempo, {m} medida, {src} % 10 <> 3 conhecida from {c}" for f, nk, sk, m, src, c in (
    ("fato_locacao", "locacao_id", "sk_tempo_retirada_realizada", "cast(km_rodado as varchar)", "cast(split_part(locacao_id, '-', 2) as bigint)",
     "f_locacao"),
    ("fato_reserva", "reserva_id", "sk_tempo_inicio", "status_reserva", "cast(split_part(reserva_id, '-', 2) as bigint)", "f_reserva"),
    ("fato_veiculo_no_patio", "movimentacao_patio_id", "sk_tempo_movimentacao", "motivo",
     "cast(split_part(movimentacao_patio_id, '-', 2) as bigint)", "f_mov")))


@query("second_load", "fato:s nk:s sk_tempo:i medida:s conhecida:b", _AFTER)
def second_load(x: Context) -> DataFrame:
    """Facts after a delivery of changed, moved, new and unchanged rows; conhecida: the row kept the key it had before."""
    store, before = _loaded_twice(x)
    dw = refresh.warehouse(store)
    measure = {"fato_locacao": ("sk_tempo_retirada_realizada", F.col("km_rodado").cast("string")),
               "fato_reserva": ("sk_tempo_inicio", F.col("status_reserva")),
               "fato_veiculo_no_patio": ("sk_tempo_movimentacao", F.col("motivo"))}

    def one(name: str) -> DataFrame:
        spec, (date, value) = star.FACTS[name], measure[name]
        had = before[name].select(F.col(spec.nk).alias("_nk"), F.col(spec.sk).alias("_sk"))
        rows = dw[name].join(had, F.col(spec.nk) == F.col("_nk"), "left")
        return rows.select(F.lit(name).alias("fato"), F.col(spec.nk).alias("nk"), F.col(date).alias("sk_tempo"), value.alias("medida"),
                           F.coalesce(F.col("_sk") == F.col(spec.sk), F.lit(False)).alias("conhecida"))

    return Q.stack(one(n) for n in star.FACTS)


@query("maintained_views", "visao:s chave:s n:i m:i", ua([
    "select 'vw_reservas_por_status' visao, status_reserva chave, total_reservas n, 0 m from v_status",
    "select 'vw_locacoes_por_mes', coalesce(ano * 100 + mes, 0)::varchar, total_locacoes, centavos from v_mes",
    "select 'vw_ocupacao_por_grupo_veiculo', grupo || '/' || categoria, total_locacoes, km_total_rodado from v_ocupacao",
    "select 'vw_movimentacao_entre_patios', patio_origem || '/' || patio_destino, total_movimentacoes, 0 from v_mov",
    f"select 'vw_matriz_transicao_patios', origem || '/' || destino, total_movimentacoes, centesimos from v_matriz",
    "select 'vw_clientes_mais_frequentes', cliente || '/' || tipo || '/' || coalesce(cidade, ''), sum(total_reservas) * 1000000 + "
    "sum(total_locacoes), sum(centavos) from v_clientes group by 2",
    "select 'r1_monthly_revenue', coalesce(ano * 100 + mes, 0)::varchar, total_locacoes, centavos from v_mes"]))
def maintained_views(x: Context) -> DataFrame:
    """The additive views from their maintained parts, after the second load."""
    v = maintained.current(_loaded_twice(x)[0])
    month = F.coalesce(F.col("ano") * 100 + F.col("mes"), F.lit(0)).cast("string")

    def cents(c: str) -> Column:
        return (F.col(c) * 100).cast("bigint")

    def shape(name: str, key: Column, n: Column, m: Column) -> DataFrame:
        return v[name].select(F.lit(name).alias("visao"), key.alias("chave"), n.alias("n"), m.alias("m"))

    none = F.lit(0).cast("bigint")
    clients = v["vw_clientes_mais_frequentes"].groupBy(F.concat_ws("/", "cliente", "tipo", F.coalesce("cidade", F.lit(""))).alias("chave")).agg(
        (F.sum("total_reservas") * 1000000 + F.sum("total_locacoes")).alias("n"), (F.sum("valor_total_cobrado") * 100).cast("bigint").alias("m"))
    return Q.stack([
        shape("vw_reservas_por_status", F.col("status_reserva"), F.col("total_reservas"), none),
        shape("vw_locacoes_por_mes", month, F.col("total_locacoes"), cents("valor_total_cobrado")),
        shape("vw_ocupacao_por_grupo_veiculo", F.concat_ws("/", "grupo", "categoria"), F.col("total_locacoes"), F.col("km_total_rodado")),
        shape("vw_movimentacao_entre_patios", F.concat_ws("/", "patio_origem", "patio_destino"), F.col("total_movimentacoes"), none),
        shape("vw_matriz_transicao_patios", F.concat_ws("/", "origem", "destino"), F.col("total_movimentacoes"),
              cents("percentual_transicao_origem")),
        clients.select(F.lit("vw_clientes_mais_frequentes").alias("visao"), "chave", "n", "m"),
        shape("r1_monthly_revenue", month, F.col("total_locacoes"), cents("receita_total"))])


@query("guarded_rebuild", "passo:s tabelas:i linhas:i", ua([
    "select 'antes' passo, 2 tabelas, (select count(*) from k_cliente) + (select count(*) from k_patio) linhas",
    "select 'recusado', 2, (select count(*) from k_cliente) + (select count(*) from k_patio)", "select 'depois', 0, 0"]))
def guarded_rebuild(x: Context) -> DataFrame:
    """A published tier before, after a rebuild without confirmation, and after one with it."""
    store = TableStore(x.spark, scratch_path(x.spark, "dw"))
    run = store.begin()
    for name in ("conf_cliente", "conf_patio"):
        run.write(name, x.conf[name])
    run.commit()

    def state(step: str) -> DataFrame:
        names = store.tables()
        names = [n for n in names if store.get(n) is not None]
        held = Q.volumes({n: store.read(n) for n in names}, by=None) if names else x.spark.createDataFrame([], "tabela string, qtd bigint")
        return held.agg(F.count("*").alias("tabelas"), F.coalesce(F.sum("qtd"), F.lit(0)).alias("linhas")).select(
            F.lit(step).alias("passo"), "tabelas", "linhas")

    steps = [state("antes")]
    try:
        refresh.rebuild(store)
    except PermissionError:
        steps.append(state("recusado"))
    refresh.rebuild(store, confirm=True)
    return Q.stack([*steps, state("depois")])


plain("calendar", "sk_tempo:i data:s ano:i mes:i nome_mes:s trimestre:i dia:i dia_semana:i nome_dia_semana:s "
      "flag_fim_de_semana:b", "select * from d_tempo", lambda x: star.dim_tempo(x.conf))
plain("dim_veiculo", "veiculo_id:s placa:s marca:s modelo:s status:s sk_grupo_veiculo:s sk_empresa:s",
      "select veiculo_nk veiculo_id, placa, marca, modelo, status, grupo_veiculo_nk sk_grupo_veiculo, "
      "empresa_nk sk_empresa from d_veiculo", lambda x: x.dw["dim_veiculo"])


def _gate(name: str, cte: str, reasons: list[str], rows: Callable[[Context], DataFrame]) -> None:
    parts = [f"select '{r}' motivo, count(*) filter (where {r}) qtd from {cte}" for r in reasons]
    parts.append(f"select 'orfaos', count(*) filter (where {' or '.join(reasons)}) from {cte}")
    plain(name, "motivo:s qtd:i", " union all ".join(parts), lambda x: star.gate_counts(rows(x)))


plain("gate_counts_veiculo", "motivo:s qtd:i",
      "select 'orfaos' motivo, (select count(*) from k_veiculo) - (select count(*) from d_veiculo) qtd",
      lambda x: star.gate_counts(star.dim_veiculo_candidates(x.conf, x.dw)))
_NO_DAY = "dayofyear({}) % 97 = 13"  # days that the calendar of the gates lacks


def _torn(x: Context) -> star.Calendar:
    """The calendar without some days inside its bounds."""
    return star.calendar_of(x.days.filter(F.dayofyear("data") % 97 != 13))


def _absent(*dates: str) -> str:
    return "(" + " or ".join(f"coalesce({_NO_DAY.format(d)}, false)" for d in dates) + ")"


_gate("gate_counts_reserva", f"(select * replace (sem_tempo or {_absent('d_inicio', 'd_fim')} as sem_tempo) from c_reserva)",
      ["sem_cliente", "sem_grupo", "sem_patio", "sem_tempo"], lambda x: star.reserva_candidates(x.conf, x.dw, _torn(x)))
_gate("gate_counts_locacao", f"(select *, {_absent('ret_prev', 'ret', 'dev_prev', 'dev')} sem_tempo from c_locacao)",
      ["sem_cliente", "sem_condutor", "sem_veiculo", "sem_patio", "sem_tempo"],
      lambda x: star.locacao_candidates(x.conf, x.dw, _torn(x)))
_gate("gate_counts_movimentacao", f"(select * replace (sem_tempo or {_absent('data_movimentacao')} as sem_tempo) from c_mov)",
      ["sem_veiculo", "sem_patio", "sem_tempo"], lambda x: star.movimentacao_candidates(x.conf, x.dw, _torn(x)))
plain("calendar_gaps", "data:s", "select data from d_tempo where dayofyear(data) % 97 = 13 and data between "
      "(select min(data) from d_tempo where dayofyear(data) % 97 <> 13) and (select max(data) from d_tempo where dayofyear(data) % 97 <> 13)",
      lambda x: star.calendar_gaps(x.days.filter(F.dayofyear("data") % 97 != 13)))

plain("fato_reserva", "reserva_id:s sk_cliente:s sk_grupo_veiculo:s sk_patio_retirada:s sk_patio_devolucao:s "
      "sk_tempo_inicio:i sk_tempo_fim:i status_reserva:s qtd_reservas:i dias_reservados:i flag_cancelada:b "
      "flag_confirmada:b flag_espera:b", "select * from f_reserva", lambda x: x.dw["fato_reserva"])
plain("fato_locacao", "locacao_id:s reserva_id:s sk_cliente:s sk_condutor:s sk_veiculo:s sk_grupo_veiculo:s "
      "sk_empresa:s sk_patio_retirada:s sk_patio_devolucao:s sk_tempo_retirada_prevista:i "
      "sk_tempo_retirada_realizada:i sk_tempo_devolucao_prevista:i sk_tempo_devolucao_realizada:i km_entrega:i "
      "km_devolucao:i km_rodado:i dias_previstos:i dias_realizados:i atraso_devolucao_dias:i qtd_locacoes:i "
      "valor_cobranca:d valor_multa_atraso:d flag_multa_estimada:b status_cobranca:s",
      "select * from f_locacao", lambda x: x.with_stored_lines.dw_of_whole_rentals["fato_locacao"])
plain("fato_movimentacao", "movimentacao_patio_id:s sk_veiculo:s sk_patio_origem:s sk_patio_destino:s "
      "sk_tempo_movimentacao:i motivo:s qtd_movimentacoes:i", "select * from f_mov",
      lambda x: x.dw["fato_veiculo_no_patio"])

# --- views ----------------------------------------------------------------------------------------

def _view(name: str, columns: str, sql: str) -> None:
    plain(name, columns, sql, lambda x: views.VIEWS[name](x.dw))


_view("vw_reservas_por_status", "status_reserva:s total_reservas:i percentual_status:d",
      "select * from v_status")
_view("vw_locacoes_por_mes", "ano:i mes:i nome_mes:s total_locacoes:i km_medio_rodado:d valor_total_cobrado:d",
      "select *, km_centesimos / 100.0 km_medio_rodado, centavos / 100.0 valor_total_cobrado from v_mes")
_view("vw_ocupacao_por_grupo_veiculo", "grupo:s categoria:s total_locacoes:i dias_realizados:i km_total_rodado:i",
      "select * from v_ocupacao")
_view("vw_movimentacao_entre_patios", "patio_origem:s patio_destino:s total_movimentacoes:i",
      "select * from v_mov")
_view("vw_matriz_transicao_patios", "origem:s destino:s total_movimentacoes:i percentual_transicao_origem:d",
      "select *, centesimos / 100.0 percentual_transicao_origem from v_matriz")
_view("vw_clientes_mais_frequentes", "cliente:s tipo:s cidade:s total_reservas:i total_locacoes:i "
      "valor_total_cobrado:d", "select *, centavos / 100.0 valor_total_cobrado from v_clientes")
_view("vw_atrasos_devolucao", "locacao_id:s cliente:s veiculo:s patio_devolucao:s data_prevista:s "
      "data_realizada:s atraso_em_dias:i", "select * from v_atrasos")
_VIEW_CTES = {"vw_reservas_por_status": "v_status", "vw_locacoes_por_mes": "v_mes", "vw_ocupacao_por_grupo_veiculo": "v_ocupacao",
              "vw_movimentacao_entre_patios": "v_mov", "vw_matriz_transicao_patios": "v_matriz",
              "vw_clientes_mais_frequentes": "v_clientes", "vw_atrasos_devolucao": "v_atrasos"}


@query("registered_views", "view_name:s linhas:i", " union all ".join(
    f"select '{v}' view_name, count(*) linhas from {c}" for v, c in _VIEW_CTES.items()))
def registered_views(x: Context) -> DataFrame:
    """The views as Spark SQL finds them by name."""
    views.register(x.spark, x.dw, x.dw_for_views)
    return x.spark.sql(" UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS linhas FROM {v}" for v in _VIEW_CTES))


plain("vw_ocupacao_por_chave", "grupo_id:s grupo:s categoria:s total_locacoes:i",
      "select g.grupo_veiculo_nk grupo_id, g.nome grupo, g.categoria, count(*) total_locacoes from f_locacao f "
      "join k_grupo g on g.grupo_veiculo_nk = f.sk_grupo_veiculo group by 1, 2, 3",
      lambda x: views.ocupacao_por_grupo_veiculo(x.dw, by_key=True))
plain("vw_movimentacao_por_chave", "origem_id:s destino_id:s patio_origem:s patio_destino:s total_movimentacoes:i",
      "select sk_patio_origem origem_id, sk_patio_destino destino_id, po.nome patio_origem, pd.nome patio_destino, "
      "count(*) total_movimentacoes from f_mov join k_patio po on po.patio_nk = sk_patio_origem "
      "join k_patio pd on pd.patio_nk = sk_patio_destino group by 1, 2, 3, 4",
      lambda x: views.movimentacao_entre_patios(x.dw, by_key=True))

# --- reports --------------------------------------------------------------------------------------

def _report(name: str, columns: str, sql: str) -> None:
    plain(name, columns, sql, lambda x: reports.REPORTS[name](x.dw))


_H = O.half_up
_report("r1_monthly_revenue", "ano:i mes:i nome_mes:s total_locacoes:i receita_total:d media_movel_3m:d "
        "variacao_mes_anterior:d km_medio_por_locacao:d",
        f"select ano, mes, nome_mes, total_locacoes, centavos / 100.0 receita_total, "
        f"{_H('sum(centavos) over w3', 'count(*) over w3')} / 100.0 media_movel_3m, "
        "(centavos - lag(centavos) over w) / 100.0 variacao_mes_anterior, "
        f"{_H('km_centesimos', '10')} / 10.0 km_medio_por_locacao from v_mes "
        "window w as (order by ano nulls last, mes nulls last), "
        "w3 as (order by ano nulls last, mes nulls last rows between 2 preceding and current row)")
_report("r2_top_clients", "nome_cliente:s total_reservas:i total_locacoes:i receita_total:d ticket_medio:d",
        f"select cliente nome_cliente, total_reservas, total_locacoes, centavos / 100.0 receita_total, "
        f"{_H('centavos', 'total_locacoes')} / 100.0 ticket_medio from v_clientes where total_locacoes > 0 "
        "order by centavos desc, cliente_nk limit 10")
_report("r3_cancellation_rate", "grupo_veiculo:s total_reservas:i canceladas:i pct_cancelamento:d",
        f"select *, {_H('1000*canceladas', 'total_reservas')} / 10.0 pct_cancelamento from ("
        "select g.nome grupo_veiculo, count(*) total_reservas, count(*) filter (where flag_cancelada) canceladas "
        "from f_reserva f join k_grupo g on g.grupo_veiculo_nk = f.sk_grupo_veiculo group by 1) where total_reservas >= 5")
_report("r4_yard_use", "patio:s cidade:s capacidade_vagas:i retiradas:i devolucoes:i movimento_total:i giro_por_vaga:d",
        f"select *, {_H('100*movimento_total', 'capacidade_vagas')} / 100.0 giro_por_vaga from ("
        "select *, retiradas + devolucoes movimento_total from ("
        "select p.nome patio, p.cidade, nullif(p.capacidade, 0) capacidade_vagas, "
        "count(*) filter (where f.sk_patio_retirada = p.patio_nk) retiradas, "
        "count(*) filter (where f.sk_patio_devolucao = p.patio_nk) devolucoes from k_patio p "
        "left join f_locacao f on p.patio_nk = f.sk_patio_retirada or p.patio_nk = f.sk_patio_devolucao "
        "group by p.patio_nk, 1, 2, 3))")
_report("r5_late_returns", "nome_cliente:s veiculo:s patio_devolucao:s data_prevista:s data_realizada:s atraso_em_dias:i",
        "select *, cliente nome_cliente from v_atrasos order by atraso_em_dias desc, locacao_id limit 20")
_report("r6_flow_matrix", "origem:s destino:s total_movimentacoes:i pct_do_total_de_saidas:d",
        f"select *, {_H('centesimos', '10')} / 10.0 pct_do_total_de_saidas from v_matriz")
_report("r7_never_rented", "placa:s marca:s modelo:s status:s grupo_veiculo:s empresa:s",
        "select placa, marca, modelo, status, grupo grupo_veiculo, empresa from d_veiculo "
        "where veiculo_nk not in (select sk_veiculo from f_locacao)")
_report("r8_weekday", "nome_dia_semana:s dia_semana:i total_reservas:i qtd_total:i",
        f"select {O.DIAS}[isodow(d_inicio)] nome_dia_semana, isodow(d_inicio) dia_semana, count(*) total_reservas, "
        "sum(qtd_reservas) qtd_total from f_reserva group by 1, 2")

# --- data quality ---------------------------------------------------------------------------------

S_NAMES = {"cliente": "s_cliente", "condutor": "s_condutor", "grupo_veiculo": "s_grupo", "veiculo": "s_veiculo",
           "patio": "s_patio", "vaga": "s_vaga", "reserva": "s_reserva", "locacao": "s_locacao",
           "cobranca": "s_cobranca", "movimentacao_patio": "s_mov"}
K_NAMES = {"conf_cliente": "k_cliente", "conf_condutor": "k_condutor", "conf_grupo_veiculo": "k_grupo",
           "conf_empresa": "k_empresa", "conf_patio": "k_patio", "conf_veiculo": "k_veiculo",
           "conf_tempo": "k_tempo", "conf_reserva": "k_reserva", "conf_locacao": "k_locacao",
           "conf_cobranca": "k_cobranca", "conf_movimentacao_patio": "k_mov"}
F_NAMES = {"dim_veiculo": "d_veiculo", "dim_cliente": "k_cliente", "dim_condutor": "k_condutor",
           "dim_grupo_veiculo": "k_grupo", "dim_empresa": "k_empresa", "dim_patio": "k_patio",
           "fato_reserva": "f_reserva", "fato_locacao": "f_locacao", "fato_veiculo_no_patio": "f_mov"}


plain("q01_volumes", "tabela:s grupo_fonte:i qtd:i",
      ua(f"select '{n}' tabela, grupo_fonte, count(*) qtd from {s} group by 2" for n, s in S_NAMES.items()),
      lambda x: Q.volumes(x.staging))
plain("q01_conformed_volumes", "tabela:s qtd:i",
      ua(f"select '{n}' tabela, count(*) qtd from {s}" for n, s in K_NAMES.items()),
      lambda x: Q.volumes(x.conf, by=None))
plain("q01_conformed_by_source", "tabela:s grupo_fonte:i qtd:i",
      ua(f"select '{n}' tabela, grupo_fonte, count(*) qtd from {K_NAMES[n]} group by 2" for n in (
          "conf_cliente", "conf_condutor", "conf_grupo_veiculo", "conf_empresa", "conf_patio", "conf_veiculo", "conf_reserva",
          "conf_locacao", "conf_movimentacao_patio")),
      lambda x: Q.volumes({n: x.conf[n] for n in Q.CONFORMED_BY_SOURCE}))
plain("q02_conformed_nulls", "tabela:s tipo:s nulos:i", ua([
    "select 'conf_cliente' tabela, 'nk_nulo' tipo, count(*) filter (where cliente_nk is null) nulos from k_cliente",
    "select 'conf_condutor', 'nk_nulo', count(*) filter (where condutor_nk is null or cliente_nk is null) from k_condutor",
    "select 'conf_condutor', 'fk_nula', count(*) filter (where src_cliente_id is null) from k_condutor",
    "select 'conf_veiculo', 'nk_nulo', count(*) filter (where veiculo_nk is null) from k_veiculo",
    "select 'conf_veiculo', 'fk_nula', count(*) filter (where v.grupo_veiculo_nk is null or g.grupo_veiculo_nk is null) "
    "from k_veiculo v left join k_grupo g on g.grupo_veiculo_nk = v.grupo_veiculo_nk",
    "select 'conf_reserva', 'nk_nulo', count(*) filter (where reserva_nk is null) from k_reserva",
    "select 'conf_reserva', 'fk_nula', count(*) filter (where c.cliente_nk is null or g.grupo_veiculo_nk is null or p.patio_nk is null "
    "or r.d_reserva is null or r.d_inicio is null) from k_reserva r left join k_cliente c on c.cliente_nk = r.cliente_nk "
    "left join k_grupo g on g.grupo_veiculo_nk = r.grupo_veiculo_nk left join k_patio p on p.patio_nk = r.patio_retirada_nk",
    "select 'conf_locacao', 'nk_nulo', count(*) filter (where locacao_nk is null) from k_locacao",
    "select 'conf_locacao', 'fk_nula', count(*) filter (where c.cliente_nk is null or d.condutor_nk is null or v.veiculo_nk is null "
    "or p.patio_nk is null or l.registro is null) from k_locacao l left join k_cliente c on c.cliente_nk = l.cliente_nk "
    "left join k_condutor d on d.condutor_nk = l.condutor_nk left join k_veiculo v on v.veiculo_nk = l.veiculo_nk "
    "left join k_patio p on p.patio_nk = l.patio_retirada_nk"]),
      lambda x: Q.conformed_nulls(x.conf))
plain("q02_dw_nulls", "tabela:s coluna:s nulos:i",
      ua(f"select '{t}' tabela, '{c}' coluna, count(*) filter (where {e} is null or trim(cast({e} as varchar)) = '') nulos from {f}"
         for t, f, cols in (
             ("dim_cliente", "k_cliente", {"cliente_id": "cliente_nk", "nome": "nome", "tipo": "tipo"}),
             ("dim_veiculo", "d_veiculo", {"veiculo_id": "veiculo_nk", "placa": "placa", "status": "status",
                                           "sk_grupo_veiculo": "grupo_veiculo_nk", "sk_empresa": "empresa_nk"}),
             ("fato_locacao", "f_locacao", {c: c for c in ("sk_cliente", "sk_condutor", "sk_veiculo", "sk_grupo_veiculo", "sk_empresa",
                                                           "sk_patio_retirada")}),
             ("fato_reserva", "f_reserva", {c: c for c in ("sk_cliente", "sk_grupo_veiculo", "sk_patio_retirada", "sk_tempo_inicio")}))
         for c, e in cols.items()),
      lambda x: Q.null_audit(x.dw_on_dims, Q.REQUIRED_DW, by=None))
plain("q04_dw_duplicates", "tabela:s chaves:i linhas:i",
      ua(f"select '{t}' tabela, count(*) chaves, coalesce(sum(n), 0) linhas from (select count(*) n from {f} group by {k} having count(*) > 1)"
         for t, f, k in (("dim_cliente", "k_cliente", "cliente_nk"), ("dim_condutor", "k_condutor", "condutor_nk"),
                         ("dim_grupo_veiculo", "k_grupo", "grupo_veiculo_nk"), ("dim_empresa", "k_empresa", "empresa_nk"),
                         ("dim_patio", "k_patio", "patio_nk"), ("dim_veiculo", "d_veiculo", "veiculo_nk"),
                         ("fato_reserva", "f_reserva", "reserva_id"), ("fato_locacao", "f_locacao", "locacao_id"),
                         ("fato_veiculo_no_patio", "f_mov", "movimentacao_patio_id"), ("dim_tempo", "d_tempo", "data"))),
      lambda x: Q.duplicates_summary(x.dw_on_dims, Q.UNIQUE_DW))
plain("q02_nulls", "tabela:s grupo_fonte:i coluna:s nulos:i",
      ua(f"select '{t}' tabela, grupo_fonte, '{c}' coluna, count(*) filter (where {c} is null or "
         f"trim(cast({c} as varchar)) = '') nulos from {S_NAMES[t]} group by 2"
         for t, cols in O.MANDATORY.items() for c in cols),
      lambda x: Q.null_audit(x.staging, Q.REQUIRED_STAGING))
_Q3 = ("cliente", "veiculo", "condutor", "reserva", "locacao", "cobranca", "movimentacao_patio")
plain("q03_staging_duplicates", "tabela:s chaves:i linhas:i",
      ua(f"select '{t}' tabela, count(*) chaves, coalesce(sum(n), 0) linhas from (select count(*) n from {S_NAMES[t]} "
         "group by grupo_fonte, src_id having count(*) > 1)" for t in _Q3),
      lambda x: Q.duplicates_summary(x.staging, {t: ("grupo_fonte", "src_id") for t in _Q3}))
plain("q04_conformed_duplicates", "tabela:s chaves:i linhas:i",
      ua(f"select '{t}' tabela, count(*) chaves, coalesce(sum(n), 0) linhas from (select count(*) n from {K_NAMES[t]} "
         f"group by {k} having count(*) > 1)" for t, k in Q.UNIQUE_CONFORMED.items()),
      lambda x: Q.duplicates_summary(x.conf, Q.UNIQUE_CONFORMED))
plain("q05_impossible_dates", "grupo_fonte:i src_id:i data_devolucao_prevista:s data_retirada_realizada:s "
      "data_devolucao_realizada:s",
      "select * from s_locacao where data_devolucao_prevista < data_retirada_prevista "
      "or data_devolucao_realizada < data_retirada_realizada",
      lambda x: Q.impossible_dates(x.staging["locacao"]))
plain("q06_inverted_odometer", "grupo_fonte:i src_id:i km_entrega:i km_devolucao:i km_rodado_calculado:i",
      "select *, km_devolucao - km_entrega km_rodado_calculado from s_locacao where km_devolucao < km_entrega",
      lambda x: Q.inverted_odometer(x.staging["locacao"]))
plain("q07_missing_references", "grupo_fonte:i sem_veiculo:i sem_condutor:i sem_cliente:i",
      "select * from (select grupo_fonte, count(*) - count(src_veiculo_id) sem_veiculo, "
      "count(*) - count(src_condutor_id) sem_condutor, count(*) - count(src_cliente_id) sem_cliente "
      "from s_locacao group by 1) where sem_veiculo + sem_condutor + sem_cliente > 0",
      lambda x: Q.missing_references(x.staging["locacao"]))
plain("q08_latest_log", "grupo_fonte:i tabela_stg:s dt_extracao:s qtd_na_extracao:i status:s",
      "select *, qtd_registros qtd_na_extracao from p_log "
      "qualify dt_extracao = max(dt_extracao) over (partition by grupo_fonte, tabela_stg)",
      lambda x: Q.latest_log(x.extraction_log))
_PAIRS = {"cliente": "cliente", "condutor": "condutor", "grupo_veiculo": "grupo_veiculo", "patio": "patio",
          "veiculo": "veiculo", "reserva": "reserva", "locacao": "locacao",
          "movimentacao_patio": "movimentacao_patio"}
plain("q09_staging_vs_conformed", "entidade:s qtd_staging:i qtd_transform:i",
      ua(f"select '{e}' entidade, (select count(*) from {S_NAMES[e]}) qtd_staging, "
         f"(select count(*) from {K_NAMES['conf_' + e]}) qtd_transform" for e in _PAIRS)
      + " union all select 'empresa', (select count(distinct grupo_fonte || '-' || coalesce(cast(src_empresa_id as varchar), nome_empresa)) "
        "from s_patio), (select count(*) from k_empresa)",
      lambda x: Q.staged_and_conformed(x.staging, x.conf, list(_PAIRS)))
plain("distinct_counts", "expressao:s qtd:i",
      "select 'veiculos' expressao, count(distinct l_partkey) qtd from lineitem union all select 'fornecedores', count(distinct l_suppkey) "
      "from lineitem union all select 'pedidos', count(distinct l_orderkey) from lineitem union all "
      "select 'dias', count(distinct cast(l_shipdate as date)) from lineitem union all "
      "select 'estados', count(distinct l_returnflag || '-' || l_linestatus) from lineitem",
      lambda x: distinct_counts(x.table("lineitem"), {
          "veiculos": F.col("l_partkey"), "fornecedores": F.col("l_suppkey"), "pedidos": F.col("l_orderkey"),
          "dias": F.col("l_shipdate").cast("date"), "estados": F.concat("l_returnflag", F.lit("-"), "l_linestatus")}))
_DW_PAIRS = {"clientes": ("conf_cliente", "dim_cliente"), "condutores": ("conf_condutor", "dim_condutor"),
             "grupos_veiculo": ("conf_grupo_veiculo", "dim_grupo_veiculo"),
             "empresas": ("conf_empresa", "dim_empresa"), "patios": ("conf_patio", "dim_patio"),
             "veiculos": ("conf_veiculo", "dim_veiculo"), "reservas": ("conf_reserva", "fato_reserva"),
             "locacoes": ("conf_locacao", "fato_locacao"),
             "movimentacoes": ("conf_movimentacao_patio", "fato_veiculo_no_patio")}
plain("q09_conformed_vs_dw", "entidade:s qtd_transform:i qtd_dw:i",
      ua(f"select '{e}' entidade, (select count(*) from {K_NAMES[a]}) qtd_transform, "
         f"(select count(*) from {F_NAMES[b]}) qtd_dw" for e, (a, b) in _DW_PAIRS.items()),
      lambda x: Q.reconcile({e: (x.conf[a], x.dw[b]) for e, (a, b) in _DW_PAIRS.items()},
                            "qtd_transform", "qtd_dw"))
plain("q10_log_vs_staging", "grupo_fonte:i tabela_stg:s qtd_registrada_no_log:i qtd_atual_staging:i",
      "select l.grupo_fonte, l.tabela_stg, l.qtd_registros qtd_registrada_no_log, coalesce(n, 0) qtd_atual_staging "
      "from p_log l left join (" + ua(
          f"select '{n}' t, grupo_fonte, count(*) n from {s} group by 2" for n, s in S_NAMES.items())
      + ") s on s.t = l.tabela_stg and s.grupo_fonte = l.grupo_fonte",
      lambda x: Q.log_against_staging(x.extraction_log, x.staging))


def _dangling(child: str, column: str, parent: str, key: str) -> str:
    return (f"(select count(*) from {child} a where a.{column} is not null and not exists "
            f"(select 1 from {parent} b where b.{key} = a.{column}))")


plain("q11_unresolved", "tabela:s referencia:s nulos:i orfaos:i",
      ua(f"select '{t}' tabela, '{c}' referencia, (select count(*) from {K_NAMES[t]} where {c} is null) nulos, "
         f"{_dangling(K_NAMES[t], c, K_NAMES[d], k)} orfaos"
         for t in ("conf_reserva", "conf_locacao", "conf_movimentacao_patio")
         for c, d, k, _ in CONF_REFERENCES[t]),
      lambda x: Q.unresolved_dimensions(x.conf))
plain("q12_orphan_keys", "tabela:s chave:s orfaos:i",
      ua(f"select '{t}' tabela, '{c}' chave, " + _dangling(child, column, parent, key) + " orfaos"
         for t, c, child, column, parent, key in O.STAR_LINKS),
      lambda x: Q.orphan_keys(x.dw_on_dims))


def _rules_sql(table: str, cte: str, checks: dict[str, str]) -> str:
    return ua(f"select '{table}' tabela, '{r}' regra, count(*) filter (where {w}) qtd from {cte}"
              for r, w in checks.items())


plain("q13_conformed_measures", "tabela:s regra:s qtd:i", ua([
    _rules_sql("conf_reserva", "k_reserva", {
        "data_base_nula": "d_inicio is null", "periodo_invertido": "d_fim < d_inicio",
        "antecedencia_negativa": "antecedencia_dias < 0", "duracao_negativa": "duracao_prevista_dias < 0"}),
    _rules_sql("conf_locacao", "k_locacao", {
        "data_base_nula": "ret_prev is null and ret is null", "periodo_invertido": "dev < ret",
        "periodo_previsto_invertido": "dev_prev < ret_prev",
        **{f"{m}_negativo": f"{m} < 0" for m in ("km_rodado", "valor_cobrado", "dias_realizados",
                                                "atraso_devolucao_dias", "valor_multa_atraso")}}),
    _rules_sql("conf_movimentacao_patio", "k_mov", {"data_base_nula": "data_movimentacao is null"}),
    _rules_sql("conf_cobranca", "k_cobranca", {"valor_negativo": "valor_cobranca < 0"})]),
      lambda x: Q.conformed_measures(x.conf))
plain("q13_fact_measures", "tabela:s regra:s qtd:i", ua([
    _rules_sql("fato_reserva", "f_reserva", {"qtd_invalida": "qtd_reservas <> 1",
                                            "dias_invalidos": "dias_reservados <= 0", "dias_negativos": "dias_reservados < 0"}),
    _rules_sql("fato_locacao", "f_locacao", {
        "qtd_invalida": "qtd_locacoes <> 1",
        **{f"{m}_negativo": f"{m} < 0" for m in ("km_rodado", "dias_previstos", "dias_realizados",
                                                "atraso_devolucao_dias", "valor_cobranca", "valor_multa_atraso")},
        "atraso_incoerente": "atraso_devolucao_dias <> greatest(date_diff('day', dev_prev, dev), 0)"}),
    _rules_sql("fato_veiculo_no_patio", "f_mov", {"qtd_invalida": "qtd_movimentacoes <> 1"})]),
      lambda x: Q.fact_measures(x.dw_on_dims))
plain("q13_seeded_violations", "tabela:s regra:s qtd:i", ua([
    _rules_sql("fato_reserva", "(select * replace (if(hash7 = 0, -1, dias_reservados) as dias_reservados, if(hash7 = 1, 2, 1) as qtd_reservas) "
               "from (select *, sk_tempo_inicio % 7 hash7 from f_reserva))",
               {"qtd_invalida": "qtd_reservas <> 1", "dias_invalidos": "dias_reservados <= 0", "dias_negativos": "dias_reservados < 0"}),
    _rules_sql("fato_locacao", "(select * replace (if(hash7 = 0, -1, atraso_devolucao_dias) as atraso_devolucao_dias, "
               "if(hash7 = 1, -km_rodado, km_rodado) as km_rodado) from (select *, coalesce(sk_tempo_retirada_realizada, 0) % 7 hash7 "
               "from f_locacao))", {
                   "qtd_invalida": "qtd_locacoes <> 1",
                   **{f"{m}_negativo": f"{m} < 0" for m in ("km_rodado", "dias_previstos", "dias_realizados",
                                                           "atraso_devolucao_dias", "valor_cobranca", "valor_multa_atraso")},
                   "atraso_incoerente": "dev is not null and dev_prev is not null and atraso_devolucao_dias <> greatest(date_diff('day', dev_prev, dev), 0)"}),
    _rules_sql("fato_veiculo_no_patio", "f_mov", {"qtd_invalida": "qtd_movimentacoes <> 1"})]),
      lambda x: Q.fact_measures(_seeded(x)))


def _seeded(x: Context) -> dict[str, DataFrame]:
    """Facts with wrong measures on some days of the week of the calendar, for checks that a clean load never trips."""
    day = F.coalesce("sk_tempo_inicio", F.lit(0)) % 7
    out = F.coalesce("sk_tempo_retirada_realizada", F.lit(0)) % 7
    return {
        "fato_reserva": x.dw["fato_reserva"].withColumns({
            "dias_reservados": F.when(day == 0, -1).otherwise(F.col("dias_reservados")), "qtd_reservas": F.when(day == 1, 2).otherwise(1)}),
        "fato_locacao": x.dw["fato_locacao"].withColumns({
            "atraso_devolucao_dias": F.when(out == 0, -1).otherwise(F.col("atraso_devolucao_dias")),
            "km_rodado": F.when(out == 1, -F.col("km_rodado")).otherwise(F.col("km_rodado"))}),
        "fato_veiculo_no_patio": x.dw["fato_veiculo_no_patio"],
    }


plain("q14_date_key_coverage", "origem:s linhas:i qtd_chaves_sem_dim_tempo:i",
      ua(f"select '{f}.{r}' origem, count({r}) linhas, count({r}) filter (where {r} not in "
         f"(select sk_tempo from d_tempo)) qtd_chaves_sem_dim_tempo from {F_NAMES[f]} having count({r}) > 0"
         for f, roles in Q.TIME_KEYS for r in roles),
      lambda x: Q.date_key_coverage(star.natural_warehouse(x.conf)))
plain("q15_additive", "entidade:s qtd_transform:i soma_qtd_dw:i",
      ua(f"select '{e}' entidade, (select count(*) from {a}) qtd_transform, (select count(*) from {b}) soma_qtd_dw"
         for e, a, b in (("reservas", "k_reserva", "f_reserva"), ("locacoes", "k_locacao", "f_locacao"),
                         ("movimentacoes", "k_mov", "f_mov"))),
      lambda x: Q.additive_reconciliation(x.conf, x.dw))
plain("q16_view_vs_fact", "validacao:s total_view:i total_fato:i",
      ua(f"select '{v}' validacao, (select sum({m}) from {c}) total_view, (select count(*) from {f}) total_fato"
         for v, m, c, f in (
             ("vw_reservas_por_status", "total_reservas", "v_status", "f_reserva"),
             ("vw_locacoes_por_mes", "total_locacoes", "v_mes", "f_locacao"),
             ("vw_ocupacao_por_grupo_veiculo", "total_locacoes", "v_ocupacao", "f_locacao"),
             ("vw_movimentacao_entre_patios", "total_movimentacoes", "v_mov", "f_mov"),
             ("vw_matriz_transicao_patios", "total_movimentacoes", "v_matriz", "f_mov"),
             ("vw_clientes_mais_frequentes_reservas", "total_reservas", "v_clientes", "f_reserva"),
             ("vw_clientes_mais_frequentes_locacoes", "total_locacoes", "v_clientes", "f_locacao"),
             ("vw_atrasos_devolucao", "1", "v_atrasos", "(from f_locacao where atraso_devolucao_dias > 0)"))),
      lambda x: Q.view_reconciliation(x.dw_for_views))
plain("q17_view_counts", "view_name:s qtd:i",
      ua(f"select '{v}' view_name, count(*) qtd from {c}" for v, c in (
          ("vw_reservas_por_status", "v_status"), ("vw_locacoes_por_mes", "v_mes"),
          ("vw_ocupacao_por_grupo_veiculo", "v_ocupacao"), ("vw_movimentacao_entre_patios", "v_mov"),
          ("vw_matriz_transicao_patios", "v_matriz"), ("vw_clientes_mais_frequentes", "v_clientes"),
          ("vw_atrasos_devolucao", "v_atrasos"))),
      lambda x: Q.view_row_counts(x.dw_for_views))
plain("q18_billing_stats", "qtd_locacoes_com_cobranca:i qtd_cobrancas_totais:i valor_total:d",
      "select count(*) qtd_locacoes_com_cobranca, sum(qtd_cobrancas) qtd_cobrancas_totais, "
      "sum(valor_cobranca) valor_total from k_cobranca", lambda x: Q.billing_stats(x.conf["conf_cobranca"]))
plain("q18_orphan_billing", "locacao_nk:s grupo_fonte:i qtd_cobrancas:i valor_cobranca:d",
      "select * from k_cobranca where locacao_nk not in (select locacao_nk from k_locacao)",
      lambda x: Q.orphan_billing(x.conf["conf_cobranca"], x.conf["conf_locacao"]))
plain("q19_domains", "campo:s valor:s qtd:i",
      ua(f"select '{t}.{c}' campo, {c} valor, count(*) qtd from {K_NAMES[t]} group by 2"
         for t, c in Q.CATEGORICALS), lambda x: Q.observed_domains(x.conf))
plain("q20_domain_gate", "campo:s linhas:i fora_do_dominio:i",
      ua(f"select '{f}' campo, count(*) linhas, count(*) filter (where {c} not in ({labels})) fora_do_dominio from {t}"
         for f, t, c, labels in O.LABELLED), lambda x: Q.domain_violations(x.dw_on_dims))
plain("q20_seeded_violations", "campo:s linhas:i fora_do_dominio:i",
      ua(f"select '{f}' campo, count(*) linhas, count(*) filter (where v not in ({labels})) fora_do_dominio from "
         f"(select if(length({c}) = 4, 'errado', {c}) v from {t})" for f, t, c, labels in (
             (f, t, c, labels) if c != "tipo" else (f, t, "if(length(cidade) = 4, 'erro', tipo)", labels) for f, t, c, labels in O.LABELLED)),
      lambda x: Q.domain_violations(_mislabelled(x)))


def _mislabelled(x: Context) -> dict[str, DataFrame]:
    """The star with labels of four letters replaced by one that no domain has."""
    def wrong(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.withColumns({c: F.when(F.length(c) == 4, "errado").otherwise(F.col(c)) for c in columns})

    clients = x.dw["dim_cliente"].withColumn("tipo", F.when(F.length("cidade") == 4, "errado").otherwise(F.col("tipo")))
    return {"dim_cliente": clients, "dim_veiculo": wrong(x.dw["dim_veiculo"], "tipo_mecanizacao", "status"),
            "fato_reserva": wrong(x.dw["fato_reserva"], "status_reserva"), "fato_locacao": wrong(x.dw["fato_locacao"], "status_cobranca")}


plain("q21_imputation", "tabela:s imputados:i total:i",
      "select 'conf_cliente' tabela, count(*) filter (where flag_nome_imputado) imputados, count(*) total from k_cliente "
      "union all select 'conf_veiculo', count(*) filter (where flag_placa_imputada), count(*) from k_veiculo",
      lambda x: Q.imputation_audit(x.conf))


@query("q22_non_empty", "tabela:s qtd:i",
       "select 'dim_cliente' tabela, count(*) qtd from k_cliente union all select 'dim_veiculo', count(*) from d_veiculo "
       "union all select 'fato_locacao', count(*) from f_locacao")
def q22(x: Context) -> DataFrame:
    names = ("dim_cliente", "dim_veiculo", "fato_locacao")
    dw = x.dw_to_count
    Q.require_rows(dw, names)
    return Q.volumes({n: dw[n] for n in names}, by=None)


plain("q23_calendar_continuity", "dias:i intervalo:i",
      "select count(*) dias, date_diff('day', min(data), max(data)) + 1 intervalo from d_tempo",
      lambda x: Q.calendar_continuity(star.dim_tempo(x.conf)))


@query("q24_expected_counts", "tabela:s total:i esperado:i ok:b",
       "select 'condutor' tabela, (select count(*) from o_condutor) total, (select count(*) from customer) esperado, true ok "
       "union all select 'locacao', (select count(*) from o_locacao), (select count(*) from lineitem), true "
       "union all select 'foto', (select count(*) from o_foto), (select count(*) from events), "
       "(select count(*) from o_foto) = (select count(*) from events)")
def q24(x: Context) -> DataFrame:
    expected = Q.volumes({"condutor": x.table("customer"), "locacao": x.table("lineitem"),
                          "foto": x.table("events")}, by=None)
    return Q.expected_counts({n: x.oltp[n] for n in ("condutor", "locacao", "foto")},
                             expected.select("tabela", F.col("qtd").alias("esperado")))


# --- operational integrity ------------------------------------------------------------------------

def _audit_sql(checks: dict[tuple[str, str], str]) -> str:
    return ua(f"select '{t}' tabela, '{r}' regra, count(*) filter (where {w}) violacoes from o_{t}"
              for (t, r), w in checks.items())


plain("i1_domains", "tabela:s regra:s violacoes:i",
      _audit_sql({(t, f"{c}_fora_do_dominio"): f"{c} not in ({', '.join(repr(v) for v in vals)})"
                  for (t, c), vals in I.DOMAINS.items()}),
      lambda x: I.audit(x.oltp, I.domain_rules()))
plain("i2_temporal", "tabela:s regra:s violacoes:i", _audit_sql({
    ("reserva", "fim_antes_do_inicio"): "data_fim < data_inicio",
    ("locacao", "devolucao_prevista_antes_da_retirada"): "data_devolucao_prevista < data_retirada_prevista",
    ("locacao", "devolucao_sem_retirada_ou_anterior"):
        "data_devolucao_realizada is not null and coalesce(data_devolucao_realizada < data_retirada_realizada, true)"}),
      lambda x: I.audit(x.oltp, I.temporal_rules()))
plain("i3_odometer", "tabela:s regra:s violacoes:i", _audit_sql({
    ("locacao", "retirada_sem_km"): "data_retirada_realizada is not null and coalesce(km_entrega, -1) < 0",
    ("locacao", "devolucao_sem_km"): "data_devolucao_realizada is not null and coalesce(km_devolucao, -1) < 0"}),
      lambda x: I.audit(x.oltp, I.odometer_rules()))
plain("i4_values", "tabela:s regra:s violacoes:i", _audit_sql({
    ("cobranca", "valor_negativo"): "valor < 0", ("seguro", "valor_negativo"): "valor < 0",
    ("movimentacao_patio", "origem_igual_destino"): "origem_patio_id = destino_patio_id"}),
      lambda x: I.audit(x.oltp, I.value_rules()))
plain("i5_uniqueness", "tabela:s coluna:s chaves:i linhas:i",
      ua(f"select '{t}' tabela, '{c}' coluna, count(*) chaves, coalesce(sum(n), 0) linhas from (select count(*) n from o_{t} "
         f"where {c} is not null group by {c} having count(*) > 1)" for t, cs in I.UNIQUE.items() for c in cs),
      lambda x: I.uniqueness(x.oltp))
plain("i6_foreign_keys", "tabela:s coluna:s pai:s orfaos:i",
      ua(f"select '{child}' tabela, '{column}' coluna, '{parent}' pai, {_dangling('o_' + child, column, 'o_' + parent, 'id')} orfaos"
         for child, column, parent, _ in O.FOREIGN),
      lambda x: I.foreign_keys(x.oltp))


def _impact_sql(table: str, where: str) -> str:
    return ua(f"select '{child}' tabela, '{column}' coluna, '{action}' acao, (select count(*) from o_{child} "
              f"where {column} in (select id from o_{table} where {where})) linhas"
              for child, column, parent, action in O.FOREIGN if parent == table)


plain("i7_delete_vehicle", "tabela:s coluna:s acao:s linhas:i", _impact_sql("veiculo", "status = 'vendido'"),
      lambda x: I.delete_impact(x.oltp, "veiculo", x.oltp["veiculo"].filter("status = 'vendido'")))
plain("i7_delete_rental", "tabela:s coluna:s acao:s linhas:i", _impact_sql("locacao", "km_entrega is null"),
      lambda x: I.delete_impact(x.oltp, "locacao", x.oltp["locacao"].filter("km_entrega IS NULL")))

plain("p1_reservations_per_yard", "patio_retirada:s total_reservas:i",
      "select p.nome patio_retirada, count(*) total_reservas from o_reserva r join o_patio p on p.id = r.patio_retirada_id group by 1",
      lambda x: P.reservations_per_yard(x.oltp))
plain("p2_vehicles_per_company_group", "empresa:s grupo:s total_veiculos:i",
      "select e.nome empresa, g.nome grupo, count(*) total_veiculos from o_veiculo v join o_empresa_locadora e on e.id = v.empresa_id "
      "join o_grupo_veiculo g on g.id = v.grupo_id group by 1, 2",
      lambda x: P.vehicles_per_company_and_group(x.oltp))
plain("p3_rental_details", "locacao_id:i cliente:s condutor:s placa:s patio_retirada:s patio_devolucao:s",
      "select l.id locacao_id, c.nome cliente, d.nome condutor, v.placa, pr.nome patio_retirada, pd.nome patio_devolucao "
      "from o_locacao l join o_reserva r on r.id = l.reserva_id join o_cliente c on c.id = r.cliente_id "
      "join o_condutor d on d.id = l.condutor_id join o_veiculo v on v.id = l.veiculo_id "
      "join o_patio pr on pr.id = l.patio_retirada_id join o_patio pd on pd.id = l.patio_devolucao_id",
      lambda x: P.rental_details(x.oltp))
plain("p4_yard_moves", "id:i veiculo_id:i patio_origem:s patio_destino:s data_movimentacao:s motivo:s",
      "select m.id, veiculo_id, a.nome patio_origem, b.nome patio_destino, data_movimentacao, motivo from o_movimentacao_patio m "
      "join o_patio a on a.id = origem_patio_id join o_patio b on b.id = destino_patio_id",
      lambda x: P.yard_moves(x.oltp))
plain("p5_billing_per_rental", "locacao_id:i valor:d status:s",
      "select locacao_id, valor, status from o_cobranca where locacao_id is not null",
      lambda x: P.billing_per_rental(x.oltp))
plain("p6_scenarios", "cenario:s total:i",
      "select 'locacoes_ativas' cenario, count(*) total from o_locacao where data_devolucao_realizada is null union all "
      "select 'locacoes_encerradas', count(*) from o_locacao where data_devolucao_realizada is not null union all "
      "select 'locacoes_com_atraso', count(*) from o_locacao where data_devolucao_realizada > data_devolucao_prevista union all "
      "select 'veiculos_em_manutencao', count(*) from o_veiculo where status = 'manutencao' union all "
      "select 'cobranca_' || status, count(*) from o_cobranca group by 1",
      lambda x: P.scenario_counts(x.oltp))
plain("p7_clients_without_reservation", "id:i nome:s",
      "select id, nome from o_cliente c where not exists (select 1 from o_reserva r where r.cliente_id = c.id)",
      lambda x: P.clients_without_reservation(x.oltp))

# --- telemetry ------------------------------------------------------------------------------------

def _session(x: Context) -> SparkSession:
    """A session for streams, with few state partitions for a local run."""
    session = x.spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(x.spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", CLUSTER_SETTINGS["spark.sql.streaming.stateStore.providerClass"])
    return session


def _stream(x: Context) -> DataFrame:
    """The events file as a stream."""
    return jobs.file_stream(_session(x), f"{x.dir}/events.parquet", x.table("events").schema)


def _delay(x: Context) -> str:
    """The stored events are a backlog: no row of it may count as late."""
    return T.backlog_delay(x.tel)


def _appended(x: Context, stream: DataFrame) -> DataFrame:
    out, checkpoint = scratch_path(x.spark, "stream"), scratch_path(x.spark, "checkpoint")
    jobs.finish(jobs.append_table(stream, out, checkpoint))
    return x.spark.read.schema(stream.schema).parquet(out)


LIVE_FILES = 3


def _arrivals(x: Context, rows: DataFrame, feed: str) -> None:
    """Add events to a feed as files in order of arrival: up to ten minutes after the event, one file after the other."""
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(590_000_000))
    jvm, folder = x.spark._jvm, x.spark._jvm.org.apache.hadoop.fs.Path(feed)
    fs = folder.getFileSystem(x.spark._jsc.hadoopConfiguration())
    known = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
    rows.repartitionByRange(LIVE_FILES, arrival).write.mode("append").parquet(feed)
    fresh = sorted(s.getPath().toString() for s in fs.listStatus(folder)
                   if s.getPath().getName().startswith("part-") and s.getPath().getName() not in known)
    now = jvm.java.lang.System.currentTimeMillis()
    for k, path in enumerate(fresh):  # a stream takes files by age
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(path), now + k, -1)


def _closing(x: Context) -> DataFrame:
    """An event of no vehicle a day after all others: with it the watermark passes them."""
    events = x.table("events")
    last = events.agg(F.max("ts").alias("ts"))
    return last.select(*[(F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts") if f.name == "ts" else
                         F.lit(-1 if f.name in ("event_id", "user_id") else None).cast(f.dataType).alias(f.name)
                         for f in events.schema.fields]).filter("ts is not null")


def _handed_over(x: Context, overlap: str = "INTERVAL 0 SECONDS", closing: bool = False) -> HandOver:
    """A feed whose older half is a backlog in any order and whose newer half arrives after the cut.

    What happened less than ``overlap`` before the cut arrives once more after it. ``closing``: an event that ends the feed.
    """
    events, feed = x.table("events"), scratch_path(x.spark, "feed")
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.agg((F.min(ts) + F.max(ts)) / 2).first()[0]
    old = events.filter(ts < F.lit(int(middle or 0)))
    old.repartition(8, F.xxhash64("event_id")).write.parquet(feed)
    over = HandOver(x.spark, feed, events.schema, scratch_path(x.spark, "handover"))
    over.history_files()
    again = F.timestamp_micros(F.lit(int(middle or 0))) - F.expr(overlap)
    _arrivals(x, events.filter(F.col("ts").cast("timestamp") >= again), feed)
    if closing:
        _arrivals(x, _closing(x), feed)
    return over


def _summed(x: Context, name: str, by: list[str], parts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Parts of the history, and of the feed with ten minutes of watermark, added up."""
    over = _handed_over(x)
    over.keep_history(name, lambda rows: parts(T.telemetry(rows)))
    jobs.finish(over.follow(name, lambda rows: parts(T.telemetry(rows).withWatermark("ts", T.WATERMARK)), _session(x), 1))
    return over.parts(name, by)


_MEAN = f"{_H('sum(speed*100)::bigint', 'count(*)')} / 100.0"
_SECOND = (f"select time_bucket(interval 1 second, ts) segundo, vehicle, count(*) mensagens, {_MEAN} velocidade_media, "
           "max(speed) velocidade_max, count(*) filter (where critical) criticas from p_tel group by 1, 2")
_SECOND_COLS = "segundo:s vehicle:i mensagens:i velocidade_media:d velocidade_max:d criticas:i"
plain("z_per_second", _SECOND_COLS, _SECOND,
      lambda x: _summed(x, "segundo", ["vehicle"], lambda rows: parts.parts_of(rows, "1 second")).select(
          F.col("inicio").alias("segundo"), "vehicle", "mensagens", parts.mean_speed(), "velocidade_max", "criticas"))
plain("z_per_second_batch", _SECOND_COLS, _SECOND, lambda x: T.per_second(x.tel))


def _traffic(x: Context, length: str, slide: str | None = None) -> DataFrame:
    summed = _summed(x, "trafego", ["event_type"], lambda rows: parts.parts_of(rows, length, slide, ["event_type"]))
    return summed.select("inicio", (F.col("inicio") + F.expr(f"INTERVAL {length}")).alias("fim"), "event_type", "mensagens",
                         parts.mean_speed(), "lentas")


_WINDOW_COLS = "inicio:s fim:s event_type:s mensagens:i velocidade_media:d lentas:i"
plain("z_tumbling", _WINDOW_COLS,
      f"select time_bucket(interval 1 hour, ts) inicio, time_bucket(interval 1 hour, ts) + interval 1 hour fim, event_type, "
      f"count(*) mensagens, {_MEAN} velocidade_media, count(*) filter (where speed < 10) lentas from p_tel group by 1, 2, 3",
      lambda x: _traffic(x, "1 hour"))
plain("z_sliding", _WINDOW_COLS,
      "select inicio, inicio + interval 6 hour fim, event_type, count(*) mensagens, "
      f"{_MEAN} velocidade_media, count(*) filter (where speed < 10) lentas from (select *, "
      "time_bucket(interval 3 hour, ts) - to_hours(3 * k) inicio from p_tel cross join (select unnest([0, 1]) k)) group by 1, 2, 3",
      lambda x: _traffic(x, "6 hours", "3 hours"))
_TRIPS = ("select vehicle, min(ts) inicio, max(ts) fim, count(*) mensagens, max(speed) velocidade_max from ("
          "select *, sum(novo) over (partition by vehicle order by ts, event_id) viagem from (select *, case when "
          "ts >= lag(ts) over (partition by vehicle order by ts, event_id) + interval 3 hour then 1 else 0 end novo "
          "from p_tel)) group by vehicle, viagem")
_TRIP_COLS = "vehicle:i inicio:s fim:s mensagens:i velocidade_max:d"
plain("z_session", _TRIP_COLS, _TRIPS, lambda x: T.trips(x.tel, "3 hours"))


@query("z_session_stream", _TRIP_COLS, _TRIPS)
def z_session_stream(x: Context) -> DataFrame:
    """Trips from micro-batches, complete without waiting for a watermark."""
    out = scratch_path(x.spark, "stream")
    jobs.finish(jobs.trip_table(T.telemetry(_stream(x)), out, scratch_path(x.spark, "checkpoint"), "3 hours"))
    return jobs.finished_trips(x.spark, out, "3 hours")


@query("z_latest", "vehicle:i event_id:i event_type:s speed:d ts:s",
       "select vehicle, event_id, event_type, speed, ts from p_tel "
       "qualify row_number() over (partition by vehicle order by ts desc, event_id desc) = 1")
def z_latest(x: Context) -> DataFrame:
    store = TableStore(x.spark, scratch_path(x.spark, "frota"))
    jobs.finish(jobs.keep_latest_status(T.telemetry(_stream(x)), store,
                                        scratch_path(x.spark, "checkpoint")))
    return store.read("status_frota").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _routed(x: Context, table: str) -> DataFrame:
    """One reading of the events into two tables."""
    store = TableStore(x.spark, scratch_path(x.spark, "rotas"))
    jobs.finish(jobs.route(T.telemetry(_stream(x)), store, scratch_path(x.spark, "checkpoint"),
                           {"alertas": T.critical, "rotina": T.routine}))
    return store.read(table)


plain("z_alerts", "event_id:i vehicle:i ts:s speed:d", "select event_id, vehicle, ts, speed from p_tel where critical",
      lambda x: _routed(x, "alertas").withColumn("ts", F.col("ts").cast("timestamp_ntz")))
plain("z_routine", "event_type:s n:i", "select event_type, count(*) n from p_tel where not critical group by 1",
      lambda x: _routed(x, "rotina").groupBy("event_type").agg(F.count("*").alias("n")))


@query("z_dedup", "event_id:i vehicle:i speed:d", "select event_id, vehicle, speed from p_tel")
def z_dedup(x: Context) -> DataFrame:
    """A feed that delivers everything twice, and what happened in the hour before the cut once more after it."""
    def twice(rows: DataFrame) -> DataFrame:
        return T.telemetry(rows).withColumn("copia", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copia")

    over = _handed_over(x, "INTERVAL 1 HOUR")
    past = over.keep_history("eventos", lambda rows: T.without_replays(twice(rows)))
    stream = over.live(_session(x), 1)
    jobs.finish(over.append("eventos", lambda rows: T.without_replays(twice(rows)), stream.sparkSession, 1))
    live = over.live_rows("eventos", past.schema).join(past.select("event_id"), "event_id", "left_anti").select(past.columns)
    return past.unionByName(live).filter("event_id >= 0")


_CLIP = ("select event_id, vehicle, ts from p_tel e where exists (select 1 from p_tel c where c.critical and "
         "c.vehicle = e.vehicle and e.ts between c.ts - interval {i} and c.ts + interval {i})")
plain("z_clip_join", "event_id:i vehicle:i ts:s", _CLIP.format(i="2 hour"),
      lambda x: T.clip_context(x.tel, 7200).withColumn("ts", F.col("ts").cast("timestamp_ntz")))
plain("z_clip_5min", "event_id:i vehicle:i ts:s", _CLIP.format(i="5 minute"),
      lambda x: T.clip_context(x.tel).withColumn("ts", F.col("ts").cast("timestamp_ntz")))


@query("z_clip_stream", "event_id:i vehicle:i ts:s", _CLIP.format(i="5 minute"))
def z_clip_stream(x: Context) -> DataFrame:
    raw = _stream(x)
    both = T.clip_context_stream(T.telemetry(raw), T.critical(T.telemetry(raw)), delay=_delay(x))
    return _appended(x, both).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


plain("z_downsample", "vehicle:i periodo:s mensagens:i velocidade_media:d velocidade_min:d velocidade_max:d criticas:i",
      f"select vehicle, date_trunc('hour', ts) periodo, count(*) mensagens, {_MEAN} velocidade_media, min(speed) velocidade_min, "
      "max(speed) velocidade_max, count(*) filter (where critical) criticas from p_tel group by 1, 2",
      lambda x: T.downsample(x.tel, "hour"))
plain("z_usage", "vehicle:i dia:s mensagens:i segundos_uso:i km:d",
      "select vehicle, cast(ts as date) dia, count(*) mensagens, sum(usado) // 1000000 segundos_uso, "
      "cast(((2 * sum(cast(v * 100 as hugeint) * usado) + 3600000000) // 7200000000) as double) / 100.0 km from ("
      "select *, case when d <= 21600000000 then d else 0 end usado from (select *, "
      "coalesce(lag(speed) over w, 0) v, coalesce(epoch_us(ts) - epoch_us(lag(ts) over w), 0) d from p_tel "
      "window w as (partition by vehicle order by ts, event_id))) group by 1, 2",
      lambda x: T.daily_usage(x.tel, 21600))
plain("z_order", "event_id:i vehicle:i seq:i",
      "select event_id, vehicle, row_number() over (partition by vehicle order by ts, event_id) seq from p_tel",
      lambda x: with_sequence(x.tel, "vehicle", "ts", "event_id"))


@query("z_order_stream", "event_id:i vehicle:i seq:i",
       "select event_id, vehicle, row_number() over (partition by vehicle order by ts, event_id) seq from p_tel")
def z_order_stream(x: Context) -> DataFrame:
    """The backlog numbered by the batch function; the stream goes on from each vehicle's last number."""
    over = _handed_over(x, closing=True)
    past = over.keep_history("ordem", lambda rows: with_sequence(T.telemetry(rows), "vehicle", "ts", "event_id"))
    path = scratch_path(x.spark, "begun")
    past.groupBy("vehicle").agg(F.max("seq").alias("base"), F.max(F.unix_micros("ts")).alias("until")).write.parquet(path)
    session = _session(x)
    begun = session.read.parquet(path)
    jobs.finish(over.append("ordem", lambda rows: in_order(T.telemetry(rows), 600, begun), session, 1))
    live = x.spark.read.schema("vehicle bigint, event_id bigint, micros bigint, seq bigint, late boolean").parquet(f"{over.root}/live/ordem")
    return past.select("event_id", "vehicle", "seq").unionByName(live.select("event_id", "vehicle", "seq"))


@query("z_trips_open", _TRIP_COLS, _TRIPS)
def z_trips_open(x: Context) -> DataFrame:
    """Trips that the stream has closed, and those still open in its state."""
    feed, out, checkpoint = (scratch_path(x.spark, n) for n in ("feed", "stream", "checkpoint"))
    _arrivals(x, x.table("events"), feed)
    stream = T.trips(T.telemetry(jobs.file_stream(_session(x), feed, x.table("events").schema, 1)), "3 hours")
    jobs.finish(jobs.append_table(stream, out, checkpoint))
    return x.spark.read.schema(stream.schema).parquet(out).unionByName(jobs.open_trips(x.spark, checkpoint, "3 hours"))


@query("z_hourly", "hora:s vehicle:i minutos:i segundos:i mensagens:i velocidade_media:d velocidade_max:d",
       "select time_bucket(interval 1 hour, ts) hora, vehicle, count(distinct time_bucket(interval 1 minute, ts)) minutos, "
       f"count(distinct time_bucket(interval 1 second, ts)) segundos, count(*) mensagens, {_MEAN} velocidade_media, "
       "max(speed) velocidade_max from p_tel group by 1, 2")
def z_hourly(x: Context) -> DataFrame:
    """Windows over windows over windows in one streaming query."""
    feed, out, checkpoint = (scratch_path(x.spark, n) for n in ("feed", "stream", "checkpoint"))
    _arrivals(x, x.table("events"), feed)
    _arrivals(x, _closing(x), feed)
    stream = T.hourly_activity(T.telemetry(jobs.file_stream(_session(x), feed, x.table("events").schema, 1)))
    jobs.finish(jobs.append_table(stream, out, checkpoint))
    return x.spark.read.schema(stream.schema).parquet(out)


_RUNG = ("select '{n}' faixa, time_bucket(interval '{i}', ts) inicio, vehicle, count(*) mensagens, " + _MEAN + " velocidade_media, "
         "min(speed) velocidade_min, max(speed) velocidade_max, count(*) filter (where critical) criticas from p_tel group by 2, 3")


@query("z_tiers", "faixa:s inicio:s vehicle:i mensagens:i velocidade_media:d velocidade_min:d velocidade_max:d criticas:i",
       ua(_RUNG.format(n=n, i=i) for n, i in (("segundo", "1 second"), ("minuto", "1 minute"), ("hora", "1 hour"), ("dia", "1 day"))))
def z_tiers(x: Context) -> DataFrame:
    """All rungs after raw days have expired, a late delivery into them, and that delivery once more."""
    tiers = Tiers(TableStore(x.spark, scratch_path(x.spark, "faixas")))
    late = F.pmod(F.xxhash64("event_id"), F.lit(20)) == 0
    tiers.deliver("1", x.tel.filter(~late))
    tiers.expire({"bruto": dt.date(2024, 1, 20)})
    for _ in range(2):
        tiers.deliver("2", x.tel.filter(late))
    return Q.stack(tiers.read(rung).select(
        F.lit(rung).alias("faixa"), "inicio", "vehicle", "mensagens", parts.mean_speed(), "velocidade_min", "velocidade_max", "criticas")
        for rung in RUNGS)


plain("z_rental_usage", "locacao_nk:s leituras:i segundos:i km:d pct_rapidas:d",
      "select nk locacao_nk, count(*) leituras, sum(usado) // 1000000 segundos, "
      "cast(((2 * sum(cast(v * 100 as hugeint) * usado) + 3600000000) // 7200000000) as double) / 100.0 km, "
      f"{_H('10000 * count(*) filter (where speed > 40)', 'count(*)')} / 100.0 pct_rapidas from ("
      "select *, case when antes = nk and d <= 43200000000 then d else 0 end usado from (select *, coalesce(lag(speed) over w, 0) v, "
      "lag(nk) over w antes, epoch_us(ts) - epoch_us(lag(ts) over w) d from (select t.*, "
      "case when r.fim is null or t.ts < r.fim then r.locacao_nk end nk from p_tel t asof left join (select * from p_ar "
      "qualify row_number() over (partition by vehicle, inicio order by locacao_nk desc) = 1) r "
      "on t.vehicle = r.vehicle and t.ts >= r.inicio) window w as (partition by vehicle order by ts, event_id))) "
      "where nk is not null group by 1",
      lambda x: T.rental_usage(x.tel, x.rentals_on_air, 43200, 40))


def _open(x: Context) -> DataFrame:
    return T.open_rentals(x.conf["conf_locacao"], x.conf["conf_veiculo"], x.conf["conf_grupo_veiculo"])


_BILLING = f"""select e.event_id, r.locacao_nk, r.veiculo_nk, cast(e.ts as date) devolucao,
  {O.incl('r.ret', 'cast(e.ts as date)')} dias_realizados, {O.late('cast(e.ts as date)', 'r.dev_prev')} atraso_devolucao_dias,
  cast(floor(e.speed) as int) km_rodado,
  coalesce(nullif(r.valor_atraso, 0), {O.late('cast(e.ts as date)', 'r.dev_prev')} * coalesce(r.diaria, 0)) valor_multa_atraso
  from p_tel e join (select l.* from k_locacao l where ret is not null and dev is null
    qualify row_number() over (partition by veiculo_nk order by ret desc, locacao_nk) = 1) r
  on r.veiculo_nk = '1-' || cast(e.vehicle as varchar) where e.event_type = 'purchase'"""


@query("z_billing", "event_id:i locacao_nk:s veiculo_nk:s devolucao:s dias_realizados:i atraso_devolucao_dias:i "
       "km_rodado:i valor_multa_atraso:d", _BILLING)
def z_billing(x: Context) -> DataFrame:
    """Return events streamed against the latest open rental of each vehicle.

    The static side is written first: a stream re-reads it every batch, so it must not be a plan.
    """
    path = scratch_path(x.spark, "abertas")
    _open(x).write.parquet(path)
    raw = _stream(x)
    rentals = raw.sparkSession.read.parquet(path)
    returns = T.telemetry(raw).filter("event_type = 'purchase'")
    return _appended(x, T.bill_returns(returns, rentals))


plain("z_mask", "cliente_nk:s nome:s telefone:s",
      "select sha256('sal' || cliente_nk) cliente_nk, regexp_replace(regexp_replace(regexp_replace(nome, '[A-Z]', 'X', 'g'), "
      "'[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') nome, regexp_replace(telefone, '[0-9]', 'n', 'g') telefone from k_cliente",
      lambda x: T.mask_personal(x.conf["conf_cliente"], ["cliente_nk"], ["nome", "telefone"], "sal"))
