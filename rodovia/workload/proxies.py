"""The benchmark tables read as rental data: staging tables of four sources and an operational schema.

Deliberate dirt (blank names, odd statuses, inverted dates and odometers, orphans, duplicates) comes
from arithmetic on the keys, so every rule and audit has something to find at every scale.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rodovia.plans.lazy import LazyTables
from rodovia.schemas import STAGING, to_schema


def c(name: str) -> Column:
    return F.col(name)


def txt(x: Column | str) -> Column:
    return (c(x) if isinstance(x, str) else x).cast("string")


def money(x: Column | str, precision: int = 10) -> Column:
    return (c(x) if isinstance(x, str) else x).cast(f"decimal({precision},2)")


def days_after(ts: Column, n: Column, hours: int = 0) -> Column:
    return ts + F.make_dt_interval(n.cast("int"), F.lit(hours), F.lit(0), F.lit(0))


def four_sources(df: DataFrame) -> DataFrame:
    """A copy of reference data for each source."""
    return df.withColumn("g", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)])))


LOADED = "TIMESTAMP_NTZ'2024-01-01' AS dt_extracao"


class Inputs:
    """Lazy frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def categories(self) -> DataFrame:
        """Vehicle categories with a number and a mean price; one row per category."""
        totals = self.table("part").groupBy("p_type").agg(
            F.sum(money("p_retailprice", 12)).alias("tot"), F.count("*").alias("n"))
        number = F.row_number().over(Window.orderBy("p_type"))
        return totals.select("p_type", number.cast("bigint").alias("tid"),
                             money(c("tot") / c("n").cast("decimal(20,0)")).alias("diaria"))

    @cached_property
    def staging(self) -> LazyTables:
        build = {
            "cliente": self._cliente, "condutor": self._condutor, "grupo_veiculo": self._grupo,
            "veiculo": self._veiculo, "patio": self._patio, "vaga": self._vaga,
            "reserva": self._reserva, "locacao": self._locacao, "cobranca": self._cobranca,
            "movimentacao_patio": self._mov,
        }
        return LazyTables({name: lambda t, name=name, f=f: to_schema(f(), STAGING[name])
                           for name, f in build.items()})

    def _cliente(self) -> DataFrame:
        return (self.table("customer").join(self.table("nation"), c("n_nationkey") == c("c_nationkey"))
                .selectExpr(
            "c_custkey AS src_id",
            "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '  ' "
            "ELSE c_name END AS nome",
            "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN ' pj ' ELSE 'pf' END AS tipo",
            "n_name AS cidade",
            "CASE c_custkey % 5 WHEN 0 THEN ' rj ' WHEN 1 THEN '' ELSE 'SP' END AS uf",
            "CASE WHEN c_custkey % 7 <> 0 THEN c_name || '@Mail.COM' END AS email",
            "CASE WHEN c_custkey % 11 = 0 THEN '--' "
            "ELSE '+55 (21) ' || CAST(c_custkey + 100000 AS STRING) END AS telefone",
            "c_custkey % 4 + 1 AS grupo_fonte", LOADED))

    def _condutor(self) -> DataFrame:
        return self.table("customer").filter("c_custkey % 101 <> 0").selectExpr(
            "c_custkey AS src_id", "c_custkey AS src_cliente_id",
            "CASE WHEN c_custkey % 13 <> 0 THEN 'Condutor ' || CAST(c_custkey AS STRING) END AS nome",
            "'CNH ' || CAST(c_custkey + 1000 AS STRING) || '-' || CAST(c_custkey % 10 AS STRING) AS cnh",
            "date_add(DATE'2025-01-01', CAST(c_custkey % 1000 AS INT)) AS validade",
            "CASE c_custkey % 3 WHEN 0 THEN ' b ' WHEN 1 THEN '' ELSE 'ad' END AS categoria",
            "c_custkey % 4 + 1 AS grupo_fonte", LOADED)

    def _grupo(self) -> DataFrame:
        return four_sources(self.categories).selectExpr(
            "tid AS src_id", "CASE WHEN tid = 6 THEN ' ' ELSE p_type END AS nome",
            "CASE WHEN tid % 2 = 1 THEN 'Linha ' || p_type END AS categoria", "diaria",
            "g AS grupo_fonte", LOADED)

    def _veiculo(self) -> DataFrame:
        rows = self.table("part").join(self.categories.select("p_type", "tid"), "p_type")
        return four_sources(rows).selectExpr(
            "p_partkey AS src_id",
            "CASE WHEN p_partkey % 13 <> 0 THEN substring(p_brand, 1, 5) || '-' "
            "|| CAST(p_partkey AS STRING) END AS placa",
            "CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE 'CH' || CAST(p_partkey AS STRING) END AS chassi",
            "CASE WHEN p_partkey % 37 <> 0 THEN p_name END AS modelo", "p_brand AS marca",
            "CASE WHEN g = 1 THEN split_part(p_name, ' ', 1) END AS cor",
            "CASE WHEN p_size % 3 = 0 THEN 'Cambio Automatico' ELSE 'cvt?' END AS tipo_mecanizacao",
            "CASE WHEN p_size % 5 <> 0 THEN p_size % 2 = 0 END AS ar_condicionado",
            "p_size % 10 = 1 AS adaptado_cadeirante",
            "CASE p_size % 7 WHEN 0 THEN 'Locado' WHEN 1 THEN 'EM MANUTENCAO' WHEN 2 THEN 'Indisponivel' "
            "WHEN 3 THEN 'available' WHEN 4 THEN 'status_zoado' WHEN 6 THEN 'disponivel' END AS status",
            "CASE WHEN p_partkey % 499 <> 0 THEN tid END AS src_grupo_id",
            "CASE WHEN g <> 4 AND NOT (g = 3 AND p_partkey % 50 = 0) THEN p_partkey % 10 END "
            "AS src_empresa_id",
            "CASE WHEN g = 4 THEN NULL WHEN g = 3 AND p_partkey % 50 = 0 THEN ' Frota & Cia ' "
            "WHEN p_partkey % 10 = 7 THEN '  ' ELSE 'Empresa ' || CAST(p_partkey % 10 AS STRING) END "
            "AS nome_empresa",
            "g AS grupo_fonte", LOADED)

    def _patio(self) -> DataFrame:
        rows = self.table("nation").join(self.table("region"), c("r_regionkey") == c("n_regionkey"))
        return four_sources(rows).selectExpr(
            "n_nationkey AS src_id", "CASE WHEN n_nationkey = 0 THEN ' ' ELSE n_name END AS nome",
            "r_name AS cidade",
            "CASE WHEN n_nationkey % 6 <> 0 THEN n_nationkey % 6 * 20 END AS capacidade",
            "CASE WHEN g IN (2, 3) THEN n_nationkey % 3 END AS src_empresa_id",
            "CASE WHEN g = 4 THEN 'Dona ' || r_name "
            "WHEN g = 3 THEN 'Empresa ' || CAST(n_nationkey % 3 AS STRING) END AS nome_empresa",
            "g AS grupo_fonte", LOADED)

    def _vaga(self) -> DataFrame:
        return four_sources(self.table("supplier")).filter("g <= 2").selectExpr(
            "s_name AS codigo", "s_nationkey AS src_patio_id",
            "CASE WHEN s_suppkey % 3 = 0 THEN 'ocupada' ELSE 'livre' END AS status",
            "g AS grupo_fonte", LOADED)

    def _reserva(self) -> DataFrame:
        rows = self.table("orders").selectExpr(
            "*", "CASE WHEN o_custkey > 0 AND o_custkey % 31 = 0 THEN o_custkey + 1 ELSE o_custkey END "
            "AS ck").selectExpr("*", "ck % 4 + 1 AS g")
        return rows.selectExpr(
            "o_orderkey AS src_id", "ck AS src_cliente_id",
            "CASE WHEN o_orderkey % 97 = 0 THEN 99 ELSE o_orderkey % 6 + 1 END AS src_grupo_id",
            "o_orderkey % 25 AS src_patio_retirada_id",
            "CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey * 7 + 3) % 25 END AS src_patio_devolucao_id",
            "CASE WHEN g = 4 THEN o_orderdate - INTERVAL 3 DAYS END AS data_solicitacao",
            "CASE WHEN g IN (2, 3) AND o_orderkey % 13 <> 0 "
            "THEN o_orderdate - make_dt_interval(CAST(o_orderkey % 30 AS INT)) END AS data_reserva",
            "CASE WHEN o_orderkey % 307 <> 0 THEN o_orderdate END AS data_inicio",
            "CASE WHEN o_orderkey % 23 <> 0 "
            "THEN o_orderdate + make_dt_interval(CAST(o_orderkey % 15 - 2 AS INT)) END AS data_fim",
            "CASE WHEN o_orderstatus = 'F' THEN 'CONFIRMADO' "
            "WHEN o_orderstatus = 'P' AND o_orderpriority LIKE '1%' THEN 'em espera' "
            "WHEN o_orderstatus = 'P' THEN 'Ativa' WHEN o_orderpriority LIKE '5%' THEN 'estado_invalido' "
            "WHEN o_orderpriority NOT LIKE '4%' THEN 'Cancelled' END AS status",
            "CASE WHEN g = 2 THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS preco_final",
            "CASE WHEN g = 3 THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS preco_previsto",
            "g AS grupo_fonte", "TIMESTAMP_NTZ'2002-01-01' AS dt_extracao")

    @cached_property
    def _lines(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return (self.table("lineitem").join(orders, c("o_orderkey") == c("l_orderkey")).selectExpr(
            "*", "o_custkey % 4 + 1 AS g", "l_orderkey * 10 + l_linenumber AS lid",
            "NOT (l_linestatus = 'O' AND l_returnflag = 'N') AND l_orderkey % 41 <> 0 AS voltou",
            "CAST(l_extendedprice AS DECIMAL(10,2)) AS preco"))

    def _locacao(self) -> DataFrame:
        return self._lines.selectExpr(
            "lid AS src_id", "CASE WHEN voltou THEN l_suppkey END AS src_devolucao_id",
            "CASE WHEN l_linenumber = 1 AND l_orderkey % 5 <> 0 THEN l_orderkey END AS src_reserva_id",
            "CASE WHEN l_partkey > 0 AND l_partkey % 29 = 0 THEN l_partkey - 1 ELSE l_partkey END "
            "AS src_veiculo_id",
            "o_custkey AS src_condutor_id",
            "CASE WHEN l_orderkey % 401 <> 0 THEN o_custkey END AS src_cliente_id",
            "l_orderkey % 25 AS src_patio_retirada_id",
            "CASE WHEN voltou THEN l_suppkey % 25 END AS src_patio_devolucao_id",
            "CASE WHEN l_orderkey % 83 <> 0 THEN o_orderdate END AS data_retirada_prevista",
            "CASE WHEN l_orderkey % 41 <> 0 AND l_orderkey % 83 <> 0 "
            "THEN o_orderdate + make_dt_interval(l_linenumber % 3, 9) END AS data_retirada_realizada",
            "o_orderdate + INTERVAL 7 DAYS AS data_devolucao_prevista",
            "CASE WHEN voltou THEN o_orderdate + make_dt_interval(CAST(l_quantity AS INT) % 15, 18) END "
            "AS data_devolucao_realizada",
            "l_partkey * 10 AS km_entrega",
            "CASE WHEN voltou THEN CAST(l_partkey * 10 + l_quantity * 20 - 100 AS INT) END AS km_devolucao",
            "l_suppkey % 9 AS gasolina_entrega",
            "CASE WHEN voltou THEN l_partkey % 9 END AS gasolina_devolucao",
            "CASE WHEN l_returnflag = 'R' THEN CAST(l_discount * 1000 AS DECIMAL(10,2)) END AS valor_atraso",
            "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_tax * 100 AS DECIMAL(10,2)) END AS valor_reparos",
            "CASE WHEN g = 2 AND l_linenumber <> 5 THEN preco WHEN g = 2 THEN 0 END AS preco_final",
            "CASE WHEN g = 3 OR l_linenumber = 5 THEN preco END AS valor_total",
            "CASE WHEN g = 4 THEN preco END AS valor_final",
            "CASE WHEN l_orderkey % 29 = 0 THEN 'Cancelada pelo cliente' "
            "WHEN l_orderkey % 41 = 0 AND l_linenumber % 2 = 0 THEN ' Pre-Reservada ' END AS status",
            "'ok' AS estado_entrega",
            "CASE WHEN l_linenumber % 4 <> 0 THEN o_orderdate + INTERVAL 8 HOURS END AS created_at",
            "g AS grupo_fonte", "l_shipdate AS dt_extracao")

    def _cobranca(self) -> DataFrame:
        return self._lines.selectExpr(
            "lid AS src_id",
            "CASE WHEN l_orderkey % 211 = 0 THEN l_orderkey * 10 + 8 ELSE lid END AS src_locacao_id",
            "CASE WHEN NOT (l_linenumber = 6 AND l_suppkey % 5 = 0) THEN preco END AS valor",
            "CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'PAGO' WHEN 'AO' THEN 'quitado' "
            "WHEN 'RF' THEN 'Pago' WHEN 'RO' THEN 'cancelada' WHEN 'NF' THEN 'em atraso' "
            "ELSE 'pendente' END AS status",
            "CAST(l_shipdate AS DATE) AS data_pagamento", "g AS grupo_fonte",
            "l_shipdate AS dt_extracao")

    def _mov(self) -> DataFrame:
        return (self.table("events").filter("user_id % 25 <> (event_id * 7 + 3) % 25")
                .selectExpr("event_id AS src_id",
                            "CASE WHEN event_id % 997 <> 0 THEN user_id END AS src_veiculo_id",
                            "user_id % 25 AS src_origem_id", "(event_id * 7 + 3) % 25 AS src_destino_id",
                            "ts AS data_movimentacao",
                            "CASE WHEN event_id % 3 = 0 THEN '  ' ELSE event_type END AS motivo",
                            "user_id % 4 + 1 AS grupo_fonte",
                            "TIMESTAMP_NTZ'2024-02-01' AS dt_extracao"))

    @cached_property
    def oltp(self) -> LazyTables:
        """An operational schema of 17 tables with violations of every rule."""
        k, s, p, size, nation = (c("c_custkey"), c("s_suppkey"), c("p_partkey"), c("p_size"),
                                 c("n_nationkey"))

        def one_before(key: Column, n: int, rest: int, step: int = 1) -> Column:
            """The key as text, with every n-th key repeating an earlier one."""
            return txt(F.when(key % n == rest, key - step).otherwise(key))

        return LazyTables({
            "empresa_locadora": lambda t: self.table("supplier").select(
                s.alias("id"), c("s_name").alias("nome"),
                F.concat(F.lit("CNPJ-"), one_before(s, 10, 9)).alias("cnpj")),
            "cliente": lambda t: self.table("customer").select(
                k.alias("id"), c("c_name").alias("nome"),
                F.when(c("c_mktsegment") == "BUILDING", "PJ")
                .when(c("c_mktsegment") == "MACHINERY", "XX").otherwise("PF").alias("tipo")),
            "condutor": lambda t: self.table("customer").select(
                k.alias("id"), F.when(k % 50 == 49, -k).otherwise(k).alias("cliente_id"),
                F.concat(F.lit("Condutor "), txt(k)).alias("nome"),
                F.concat(F.lit("CNH-"), one_before(k, 40, 39, 39)).alias("cnh")),
            "grupo_veiculo": lambda t: self.table("region").select(
                c("r_regionkey").alias("id"), c("r_name").alias("nome")),
            "veiculo": lambda t: self.table("part").select(
                p.alias("id"),
                F.when(p % 60 != 59, F.concat(F.lit("P"), one_before(p, 30, 28))).alias("placa"),
                F.concat(F.lit("C"), one_before(p, 45, 44)).alias("chassi"),
                F.when(size % 3 == 0, "automatico").when(size % 3 == 1, "manual").otherwise("cvt")
                .alias("tipo_mecanizacao"),
                F.when(size % 7 == 0, "manutencao").when(size % 7 == 1, "alugado")
                .when(size % 7 == 2, "vendido").otherwise("disponivel").alias("status"),
                (size % 6).alias("grupo_id"), (p % 11).alias("empresa_id")),
            "acessorio": lambda t: self.table("region").select(
                c("r_regionkey").alias("id"),
                F.when(c("r_regionkey") >= 3, "GPS").otherwise(c("r_name")).alias("nome")),
            "veiculo_acessorio": lambda t: self.table("lineitem").select(
                c("l_partkey").alias("veiculo_id"), c("l_linenumber").alias("acessorio_id")).distinct(),
            "patio": lambda t: self.table("nation").select(nation.alias("id"),
                                                           c("n_name").alias("nome")),
            "vaga": lambda t: self.table("supplier").select(
                c("s_name").alias("codigo"),
                (c("s_nationkey") + F.when(s % 33 == 0, 50).otherwise(0)).alias("patio_id"),
                F.when(s % 3 == 0, "ocupada").when(s % 20 == 1, "quebrada").otherwise("livre")
                .alias("status")),
            "reserva": lambda t: self._reserva().select(
                c("src_id").alias("id"), c("src_cliente_id").alias("cliente_id"),
                (c("src_grupo_id") - 1).alias("grupo_id"),
                c("src_patio_retirada_id").alias("patio_retirada_id"),
                c("src_patio_devolucao_id").alias("patio_devolucao_id"), "data_inicio", "data_fim",
                F.when(c("src_id") % 5 == 0, "cancelada").when(c("src_id") % 5 == 1, "espera")
                .when(c("src_id") % 5 == 2, "confirmada").otherwise(F.lower("status"))
                .alias("status")),
            "locacao": lambda t: self._locacao().select(
                c("src_id").alias("id"),
                F.when(c("src_id") % 10 <= 2, F.floor(c("src_id") / 10)).alias("reserva_id"),
                c("src_veiculo_id").alias("veiculo_id"), c("src_condutor_id").alias("condutor_id"),
                c("src_patio_retirada_id").alias("patio_retirada_id"),
                c("src_patio_devolucao_id").alias("patio_devolucao_id"), "data_retirada_prevista",
                "data_retirada_realizada",
                F.when(c("src_id") % 53 == 0, days_after(c("data_devolucao_prevista"), F.lit(-9)))
                .otherwise(c("data_devolucao_prevista")).alias("data_devolucao_prevista"),
                "data_devolucao_realizada",
                F.when(c("src_id") % 59 != 0, c("km_entrega") - 100).alias("km_entrega"),
                "km_devolucao", "estado_entrega",
                F.lit(None).cast("string").alias("estado_devolucao"), "created_at"),
            "cobranca": lambda t: self.table("lineitem").select(
                (c("l_orderkey") * 10 + c("l_linenumber")).alias("id"),
                F.when(c("l_linenumber") < 3, c("l_orderkey") * 10 + 1).alias("locacao_id"),
                (money("l_extendedprice", 12) - 2000).alias("valor"),
                F.when(c("l_returnflag") == "A", "pago").when(c("l_returnflag") == "R", "cancelado")
                .when(c("l_linestatus") == "O", "pendente").otherwise("estornado").alias("status"),
                c("l_shipdate").cast("date").alias("data_pagamento")),
            "seguro": lambda t: self.table("nation").select(
                nation.alias("id"), c("n_name").alias("tipo"), money(nation * 10 - 20).alias("valor")),
            "locacao_seguro": lambda t: self.table("lineitem").select(
                (c("l_orderkey") * 10 + c("l_linenumber")).alias("locacao_id"),
                (c("l_suppkey") % 30).alias("seguro_id")),
            "foto": lambda t: self.table("events").select(c("event_id").alias("id"),
                                                      c("user_id").alias("veiculo_id")),
            "manutencao": lambda t: self.table("events").select(
                c("event_id").alias("id"), (c("user_id") * 20).alias("veiculo_id")),
            "movimentacao_patio": lambda t: self.table("events").select(
                c("event_id").alias("id"), c("user_id").alias("veiculo_id"),
                (c("user_id") % 25).alias("origem_patio_id"),
                ((c("event_id") * 7 + 3) % 25).alias("destino_patio_id"),
                c("ts").alias("data_movimentacao"), c("event_type").alias("motivo")),
        })

    @cached_property
    def extraction_log(self) -> DataFrame:
        """A log with one row per source, table and order status: 'F' loads succeeded."""
        rows = self._reserva_dates()
        names = F.explode(F.array(*[F.lit(n) for n in ("reserva", "locacao", "cobranca",
                                                       "movimentacao_patio")])).alias("tabela_stg")
        return rows.select("grupo_fonte", names, "dt_extracao", "qtd_registros", "status",
                           F.lit(None).cast("string").alias("observacao"))

    def _reserva_dates(self) -> DataFrame:
        ok = F.when(c("o_orderstatus") == "F", "OK").otherwise("ERR")
        return (self.table("orders").groupBy((c("o_custkey") % 4 + 1).cast("smallint")
                                             .alias("grupo_fonte"), ok.alias("status"))
                .agg((F.min("o_orderdate") + F.expr("INTERVAL 1500 DAYS")).alias("dt_extracao"),
                     F.count("*").alias("qtd_registros")))

    @cached_property
    def rentals_on_air(self) -> DataFrame:
        """Rentals of the vehicles that send telemetry, in its month: (vehicle, locacao_nk, inicio, fim)."""
        vehicles = self.table("events").agg(F.max("user_id") + 1).first()[0]
        return self.table("lineitem").selectExpr(
            f"l_partkey % {vehicles} AS vehicle", "CAST(l_orderkey * 10 + l_linenumber AS STRING) AS locacao_nk",
            "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, CAST((l_orderkey * 7 + l_linenumber * 131) % 41760 AS INT)) AS inicio",
            "CAST(l_quantity AS INT) AS horas", "l_linenumber").selectExpr(
            "vehicle", "locacao_nk", "inicio", "CASE WHEN l_linenumber <> 6 THEN inicio + make_dt_interval(0, horas) END AS fim")
