"""What plans leave out: joins nobody asks for, second reads of a table, columns that a check does not read."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, RUN_TS
from rodovia.operators.store import TableStore
from rodovia.plans import refresh, star, views
from rodovia.plans.conform import conformed, resolve, store_conformed
from rodovia.plans.star import DIMENSIONS, FACTS
from rodovia.schemas import STAGING, to_schema
from rodovia.session import _scratch_root, discard, scratch_path
from rodovia.workload.catalog import QUERIES, Context

KEYS = ("src_id", "src_cliente_id", "src_condutor_id", "src_veiculo_id", "src_grupo_id", "src_patio_retirada_id",
        "src_patio_devolucao_id", "src_origem_id", "src_destino_id", "src_locacao_id")
MORE = {"grupo_veiculo": "50 * (id + 1) AS diaria", "veiculo": "'X' AS placa", "locacao": (
    "TIMESTAMP_NTZ'2020-01-01' AS data_retirada_prevista, TIMESTAMP_NTZ'2024-03-01' AS data_retirada_realizada, "
    "TIMESTAMP_NTZ'2024-03-03' AS data_devolucao_prevista, TIMESTAMP_NTZ'2024-03-05' AS data_devolucao_realizada")}


@pytest.fixture(scope="module")
def staged(spark):
    """Two rows of source 1 in every staging table, each of them twice; the second rental without an id."""
    def table(name):
        columns = [f"id AS {k}" if (k, name) != ("src_id", "locacao") else "nullif(id, 1) AS src_id"
                   for k in KEYS if f"{k} " in STAGING[name]]
        rows = spark.range(2).union(spark.range(2)) if name == "locacao" else spark.range(2)
        extra = [MORE[name]] if name in MORE and "," not in MORE[name] else MORE.get(name, "1 AS grupo_fonte").split(", ")
        extra = [e for e in extra if not e.endswith("grupo_fonte")]
        return to_schema(rows.selectExpr(*columns, "id % 1 + 1 AS grupo_fonte", "TIMESTAMP_NTZ'2024-01-01' AS dt_extracao", *extra), STAGING[name])

    return {name: table(name) for name in STAGING}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rentals_meet_vehicles_for_the_late_fee_only(staged):
    rentals = conformed(staged, AS_OF)["conf_locacao"]
    assert "Join" not in plan(rentals.select("locacao_nk", "km_rodado"))
    assert {(r[0], r[1]) for r in rentals.select("locacao_nk", "valor_multa_atraso").collect()} == {
        ("1-0", Decimal("100.00")), (None, Decimal("200.00"))}
    assert rentals.count() == 2


def test_a_marker_costs_one_join(staged):
    rows = resolve(conformed(staged, AS_OF), "conf_locacao")
    assert plan(rows.select("locacao_nk", "sk_cliente")).count("Join LeftOuter") == 1
    assert rows.filter("sk_cliente = cliente_nk AND sk_veiculo = veiculo_nk AND sk_reserva IS NULL").count() == 2


def context(spark, staged):
    x = Context(spark, "/nowhere")
    x.__dict__["staging"] = staged
    return x


def test_the_calendar_reads_rentals_once(spark, staged):
    x = context(spark, staged)
    # Bookings and moves are one range each, rentals two.
    assert plan(x.days).count("Range (") == 4
    assert x.days.agg({"data": "min"}).first()[0] == dt.date(2020, 1, 1)


def test_facts_are_written_for_views_only_with_the_columns_they_read(spark, staged):
    x, written = context(spark, staged), {}

    def record(name, rows):
        written[name] = rows.columns
        return rows

    x._written = record
    assert x.dw_on_dims["fato_locacao"].columns != []
    assert set(written) <= set(DIMENSIONS)
    for build in views.VIEWS.values():
        assert build(x.dw_for_views).columns
    assert {n: tuple(c) for n, c in written.items() if n in FACTS} == views.FACT_COLUMNS


def test_stored_tables_are_packed(spark, tmp_path):
    run = TableStore(spark, str(tmp_path)).begin()
    run.write("t", spark.range(5))
    run.write_partitions("f", spark.range(5).selectExpr("id", "id % 2 AS m"), "m", set())
    files = [p.name for p in tmp_path.rglob("part-*")]
    assert files and all(".zstd." in f for f in files)


def test_rentals_stay_in_place_for_clients_and_drivers(spark, staged):
    """References to clients and drivers are checked by the values that nobody has, not by moving rentals to each dimension."""
    some = {**staged, "cliente": staged["cliente"].filter("src_id = 0"), "condutor": staged["condutor"].filter("src_id = 1")}
    extra = some["locacao"].limit(1).withColumns({"src_id": F.lit(9).cast("bigint"), "src_cliente_id": F.lit(None).cast("bigint")})
    some["locacao"] = some["locacao"].unionByName(extra)
    x = context(spark, some)
    rows = star.locacao_candidates(x.conf, x.dw)
    assert plan(rows.select("sk_cliente", "sk_condutor")).count("Relation [_nk#") == 2  # the stored values, no clients, no drivers
    stored = {n: x.conf[n] for n in x.conf}, {n: x.dw[n] for n in DIMENSIONS}  # without what the plans tell of themselves
    expected = star.locacao_candidates(*stored)
    assert rows.columns == expected.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))
    assert {(r.motivo, r.qtd) for r in star.gate_counts(rows).collect()} == {(r.motivo, r.qtd) for r in star.gate_counts(expected).collect()}
    assert rows.filter("_sem_cliente").count() == 2 and rows.filter("_sem_condutor").count() == 2


def test_the_late_fee_shares_the_move_to_vehicles(spark, staged):
    x = context(spark, staged)
    text = plan(x.dw["fato_locacao"].select("valor_multa_atraso"))
    assert not [line for line in text.splitlines() if "Join" in line and "src_veiculo_id#" in line]
    assert text.count("(veiculo_nk#") == 2  # the rate and the dimension, by one key


def test_a_calendar_is_computed_once_for_its_bounds_and_gaps(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(1)
            yield batch

    days = spark.range(9).filter("id <> 4").selectExpr("date_add(DATE'2024-01-01', CAST(id AS INT)) AS data").coalesce(1).mapInArrow(counted, "data date")
    assert star.calendar_of(days) == star.Calendar(dt.date(2024, 1, 1), dt.date(2024, 1, 9), (dt.date(2024, 1, 5),))
    assert reads.value == 1


def test_tables_that_are_counted_twice_are_written_once(spark, staged):
    x, written = context(spark, staged), []
    keep = x._written
    x._written = lambda name, rows: written.append((name, tuple(rows.columns))) or keep(name, rows)
    assert {(r.tabela, r.qtd) for r in QUERIES["q22_non_empty"].build(x).collect()} == {
        ("dim_cliente", 2), ("dim_veiculo", 2), ("fato_locacao", x.dw["fato_locacao"].count())}
    assert written.count(("fato_locacao", ("locacao_id",))) == 1


def moves(df, column):
    """What the rows are dealt by in each exchange that carries ``column``; nothing is broadcast."""
    spark, found = df.sparkSession, []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if node.nodeName() == "Exchange" and f"{column}#" in node.output().toString():
            found.append(node.outputPartitioning().toString())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    try:
        walk(df.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return found


def kept_by(spark, folder, plans):
    def keep(name, rows):
        plans[name] = rows
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")
    return keep


def test_stored_rentals_move_once_for_their_references(spark, staged, tmp_path):
    some = {**staged, "cliente": staged["cliente"].filter("src_id = 0")}
    plans = {}
    conf = store_conformed(some, kept_by(spark, tmp_path, plans), AS_OF)
    assert not [by for by in moves(plans["conf_locacao"], "km_entrega") if "veiculo" in by]
    text = plan(plans["conf_locacao"])
    sorts = [line.split("windowspecdefinition", 1)[1] for line in text.splitlines() if "windowspecdefinition(_linha#" in line]
    assert len(sorts) == 2 and all("src_id#" in w for w in sorts)  # nothing is cut from one of them only: one shuffle
    expected = conformed(some, AS_OF)["conf_locacao"]
    assert plans["conf_locacao"].columns == expected.columns
    assert sorted(map(str, plans["conf_locacao"].collect())) == sorted(map(str, expected.collect()))
    assert {(r[0], r[1]) for r in conf["conf_locacao"].select("locacao_nk", "valor_multa_atraso").collect()} == {
        ("1-0", Decimal("100.00")), (None, Decimal("200.00"))}  # the rental without an id has its rate, too
    # A row that repeats a key with another client, as no de-duplication has seen these, finds its own client.
    twice = conf["conf_locacao"].union(conf["conf_locacao"].withColumns({"cliente_nk": F.lit("1-1"), "km_rodado": F.lit(5)}))
    dims = {n: star.natural_warehouse(conf)[n] for n in DIMENSIONS}
    rows = star.locacao_candidates({**conf, "conf_locacao": twice}, dims)
    assert sum("_linha" in by for by in moves(rows, "km_entrega")) == 1
    assert [by for by in moves(rows, "km_entrega") if "_linha" not in by and "patio" not in by] == []
    assert sorted((str(r.locacao_id), str(r.sk_cliente), r.sk_veiculo) for r in rows.collect()) == [
        ("1-0", "1-0", "1-0"), ("1-0", "None", "1-0"), ("None", "None", "1-1"), ("None", "None", "1-1")]


def found_in(rows, column):
    return sorted((str(r.locacao_nk), str(r[column])) for r in rows.select("locacao_nk", column).collect())


def test_markers_leave_rentals_in_place(spark, staged):
    """Rentals move for their de-duplication only, however many values a dimension lacks, and find what joins with the dimensions find."""
    some = {**staged, "cliente": staged["cliente"].filter("src_id = 0"), "condutor": staged["condutor"].filter("src_id = 1"),
            "reserva": staged["reserva"].limit(0)}
    null_source = staged["locacao"].limit(1).withColumns({"src_id": F.lit(9).cast("bigint"), "grupo_fonte": F.lit(None).cast("smallint")})
    some["locacao"] = some["locacao"].withColumn("src_reserva_id", F.col("src_cliente_id")).unionByName(null_source)
    conf = conformed(some, AS_OF)
    expected = resolve({n: conf[n] for n in conf}, "conf_locacao")  # without what the plans tell of themselves
    rows = resolve(conf, "conf_locacao")
    want = sorted(map(str, expected.collect()))
    assert rows.columns == expected.columns and sorted(map(str, rows.collect())) == want
    assert found_in(rows, "sk_cliente") == [("1-0", "1-0"), ("None", "None"), ("None", "None")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # now all that is absent is too much
    try:
        rows = resolve(conf, "conf_locacao")
        assert sorted(map(str, rows.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [by for by in moves(expected, "estado_entrega") if "_linha" not in by and "src_id" not in by] != []
    # The rows with one row of limit() in them come from a single partition.
    assert {by.split("#")[0] for by in moves(rows, "estado_entrega")} - {"SinglePartition"} == {"hashpartitioning(_linha"}


def test_whole_rentals_leave_vehicles_in_place(spark, staged):
    some = {**staged, "veiculo": staged["veiculo"].filter("src_id = 0")}
    null_source = staged["cobranca"].limit(1).withColumn("grupo_fonte", F.lit(None).cast("smallint"))
    some["cobranca"] = some["cobranca"].unionByName(null_source)
    rentals = some["locacao"].limit(1)
    some["locacao"] = some["locacao"].unionByName(rentals.withColumn("grupo_fonte", F.lit(None).cast("smallint")))
    x = context(spark, some)
    for rows, expected in ((x.dw_of_whole_rentals["fato_locacao"], x.dw["fato_locacao"]), (
            star.rental_candidates(x.conf, x.dw_of_whole_rentals), star.rental_candidates(x.conf, x.dw))):
        assert rows.columns == expected.columns
        assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))
    rows = star.rental_candidates(x.conf, x.dw_of_whole_rentals)
    assert not [by for by in moves(rows, "km_entrega") if "veiculo" in by]
    assert [by for by in moves(star.rental_candidates(x.conf, x.dw), "km_entrega") if "veiculo" in by]


def test_a_load_leaves_no_working_tables(spark, staged, tmp_path):
    rentals = staged["locacao"].filter("src_id IS NOT NULL")
    cfg = refresh.Config(str(tmp_path / "dw"), AS_OF, RUN_TS, quarantine=True)
    conf = store_conformed({**staged, "locacao": rentals}, kept_by(spark, tmp_path, {}), AS_OF)
    scratch = Path(_scratch_root(spark))
    had = set(scratch.glob("keys-*"))
    store = refresh.run_load(spark, cfg, conf)
    assert store.read("fato_locacao").count() == 1
    assert any(tmp_path.glob("dw/dw/fato_locacao/*")) and not any(tmp_path.glob("dw/dw/_candidatos_*/*"))
    left = {p for p in set(scratch.glob("keys-*")) - had}
    assert not [p for p in left if "locacao_id" in spark.read.parquet(str(p)).columns]


def test_a_digest_tells_null_from_text_and_one_column_from_another(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("null", "a"), ("", "a"), ("a", "a"), (None, "a")], "x string, y string")
    found = rows.select(refresh._digest(["x", "y"], rows).alias("d")).collect()
    assert len({bytes(r.d) for r in found}) == 5 and found[0].d == found[-1].d


def test_discard_deletes_files_of_the_shared_folder_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    discard(spark.read.parquet(str(tmp_path / "own")))
    discard(spark.read.parquet(path))
    assert any((tmp_path / "own").glob("part-*")) and not Path(path).exists()


def test_a_second_load_writes_and_moves_only_what_is_not_stored(spark, staged, tmp_path):
    rentals = staged["locacao"].filter("src_id IS NOT NULL")
    stray = rentals.limit(1).withColumns({"src_id": F.lit(9).cast("bigint"), "src_veiculo_id": F.lit(77).cast("bigint")})
    some = {**staged, "locacao": rentals.unionByName(rentals.withColumn("src_id", F.lit(5).cast("bigint"))).unionByName(stray)}
    cfg = refresh.Config(str(tmp_path / "dw"), AS_OF, RUN_TS, quarantine=True)
    conf = store_conformed(some, kept_by(spark, tmp_path, {}), AS_OF)
    store = refresh.run_load(spark, cfg, conf)
    before = {r.locacao_id: r.sk_fato_locacao for r in store.read("fato_locacao").collect()}
    assert set(before) == {"1-0", "1-5"}
    run = store.begin()
    dims = {n: run.read(n) for n in ("dim_tempo", *DIMENSIONS)}
    other = F.when(F.col("src_id") == 5, 7).otherwise(F.col("km_rodado")).cast("int")
    more = conf["conf_locacao"].filter("src_id = 5").withColumns({"src_id": F.lit(6).cast("bigint"), "locacao_nk": F.lit("1-6")})
    again = {**conf, "conf_locacao": conf["conf_locacao"].withColumn("km_rodado", other).unionByName(more)}
    refresh.load_facts(run, again, dims, quarantine=True)
    assert run.rows["_candidatos_fato_locacao"] == 3  # the changed, the new and the stray one, not the one that is as before
    rows = {r.locacao_id: r for r in run.read("fato_locacao").collect()}
    assert {k: r.sk_fato_locacao for k, r in rows.items()} == {**before, "1-6": max(before.values()) + 1}
    assert rows["1-5"].km_rodado == 7 and rows["1-0"].km_rodado != 7
    assert [r.locacao_id for r in run.read("quarentena_fato_locacao").collect()] == ["1-9"]
    assert run.read("quarentena_fato_locacao").columns == store.read("quarentena_fato_locacao").columns
