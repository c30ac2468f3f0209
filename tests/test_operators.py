"""Keys, merges, publication and time slices against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rodovia.functions import calendar as C
from rodovia.operators.dedup import latest_per_key
from rodovia.operators.keys import assign_keys
from rodovia.operators.merge import keys_for_unseen, merge_type1
from rodovia.operators.store import TableStore
from rodovia.operators.timeslice import with_previous, with_sequence


def test_keys_are_dense_ordered_and_unique(spark):
    df = spark.range(0, 997, numPartitions=7).select((F.col("id") * 7919 % 997).alias("id"))
    rows = assign_keys(df, ["id"], "sk", start=40).orderBy("id").collect()
    assert [r.sk for r in rows] == list(range(41, 41 + 997))


def test_keys_of_nothing(spark):
    assert assign_keys(spark.range(0), ["id"], "sk").collect() == []


def test_latest_breaks_ties_the_same_way(spark):
    rows = [(1, dt.datetime(2026, 1, 2), "b"), (1, dt.datetime(2026, 1, 2), "a"), (1, dt.datetime(2026, 1, 1), "z"),
            (2, None, "n")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, dt_extracao timestamp_ntz, v string").repartition(3)
        assert sorted((r.k, r.v) for r in latest_per_key(df, ["k"]).collect()) == [(1, "a"), (2, "n")]


def test_latest_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("dt_extracao"))
    plan = latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_merge_and_keys(spark):
    old = spark.createDataFrame([("a", 10, "x", "c1"), ("b", 20, "y", "c2")], "nk string, sk long, v string, cnpj string")
    new = spark.createDataFrame([("b", "Y", None), ("c", None, "c3"), ("d", "w", None)], "nk string, v string, cnpj string")
    keyed = new.join(keys_for_unseen(new, old, "nk", "sk"), "nk")
    out = merge_type1(keyed, old, "nk", retain=["cnpj"], keep_key="sk")
    assert sorted((r.nk, r.sk, r.v, r.cnpj) for r in out.collect()) == [
        ("a", 10, "x", "c1"), ("b", 20, "Y", "c2"), ("c", 21, None, "c3"), ("d", 22, "w", None)]


def test_store_publishes_all_or_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    run = store.begin()
    run.write("t", spark.range(3))
    assert store.get("t") is None and run.rows["t"] == 3
    run.commit()
    assert store.read("t").count() == 3
    a, b = store.begin(), store.begin()
    a.write("t", spark.range(5))
    b.write("t", spark.range(7))
    a.commit()
    with pytest.raises(RuntimeError, match="another run"):
        b.commit()
    assert store.read("t").count() == 5
    # A table can be rebuilt from itself: the old folder stays until nobody points at it.
    run = store.begin()
    run.write("t", run.read("t").union(run.read("t")))
    run.commit()
    assert store.read("t").count() == 10
    with pytest.raises(KeyError):
        store.read("u")


def test_partition_replacement(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    run = store.begin()
    run.write_partitions("f", spark.range(10).withColumn("m", F.col("id") % 3), "m", set())
    run.commit()
    before = store.current()[1]["f"]
    run = store.begin()
    run.write_partitions("f", spark.createDataFrame([(99, 1)], "id long, m long"), "m", {"1", "2"})
    run.commit()
    after = store.current()[1]["f"]
    assert after["0"] == before["0"] and set(after) == {"0", "1"}
    assert sorted(r.id for r in store.read("f").collect()) == [0, 3, 6, 9, 99]


def events(spark, n=600):
    """One vehicle owns a third of the rows; ties in time and gaps over many slices occur."""
    rnd = random.Random(5)
    base = dt.datetime(2026, 1, 1)
    rows = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 9), base + dt.timedelta(seconds=rnd.randrange(0, 200_000, 50)),
             rnd.randrange(100)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "event_id long, vehicle long, ts timestamp, v int").repartition(5)


@pytest.mark.parametrize("width", [60, 3600, 100_000])
def test_time_slices_match_brute_force(spark, width):
    rows, df = events(spark)
    by = {}
    for e, k, ts, v in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by.setdefault(k, []).append((e, ts, v))
    want_prev = {seq[i][0]: (seq[i - 1][2] if i else None) for seq in by.values() for i in range(len(seq))}
    want_seq = {seq[i][0]: i + 1 for seq in by.values() for i in range(len(seq))}
    prev = with_previous(df, "vehicle", "ts", "event_id", ["v"], seconds=width)
    assert {r.event_id: r.prev_v for r in prev.collect()} == want_prev
    seq = with_sequence(df, "vehicle", "ts", "event_id", seconds=width)
    assert {r.event_id: r.seq for r in seq.collect()} == want_seq


def test_calendar(spark):
    days = C.continuous_days(spark.sql("SELECT DATE'2024-02-27' dt_min, DATE'2024-03-03' dt_max"))
    rows = C.calendar_attributes(days).orderBy("data").collect()
    assert [r.sk_tempo for r in rows] == [20240227, 20240228, 20240229, 20240301, 20240302, 20240303]
    last = rows[-1]
    assert (last.nome_mes, last.nome_dia_semana, last.dia_semana, last.flag_fim_de_semana, last.trimestre) == (
        "Março", "Domingo", 7, True, 1)
    empty = spark.sql("SELECT CAST(NULL AS DATE) dt_min, CAST(NULL AS DATE) dt_max")
    assert C.continuous_days(empty).count() == 0


def test_distinct_counts_in_one_pass(spark):
    from rodovia.operators.distinct import distinct_counts

    rows = [(i % 3, i % 7, "hot" if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, a int, b string").repartition(5)
    asked = {"a": F.col("a"), "b": F.col("b"), "ab": F.concat_ws("-", "a", "b"), "none": F.lit(None).cast("string")}
    assert {r["expressao"]: r["qtd"] for r in distinct_counts(df, asked).collect()} == {
        "a": 7, "b": 1, "ab": len({(a, b) for _, a, b in rows}), "none": 0}
    by = {(r["g"], r["expressao"]): r["qtd"] for r in distinct_counts(df, asked, ["g"]).collect()}
    assert by[0, "a"] == 7 and by[0, "b"] == 0 and by[1, "b"] == 1 and len(by) == 12
    assert {r["qtd"] for r in distinct_counts(df.limit(0), asked).collect()} == {0}
    plan = distinct_counts(df, asked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2  # the rows once, and the names


def test_calendar_gaps_and_gate(spark):
    import datetime as dt

    from rodovia.plans import star

    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    torn = [d for i, d in enumerate(days) if i not in (4, 5, 6, 11)]
    frame = spark.createDataFrame([(d,) for d in torn], "data date")
    calendar = star.calendar_of(frame)
    assert calendar == star.Calendar(days[0], days[-1], (days[4], days[5], days[6], days[11]))
    assert star.calendar_of(frame.limit(0)) is None and star.calendar_of(spark.createDataFrame([(d,) for d in days], "data date")).missing == ()
    probe = spark.createDataFrame([(d,) for d in [*days, days[0] - dt.timedelta(days=1), days[-1] + dt.timedelta(days=1), None]], "d date")
    bad = {r["d"] for r in probe.filter(star._outside(calendar, "d")).collect()}
    assert bad == {days[4], days[5], days[6], days[11], days[0] - dt.timedelta(days=1), days[-1] + dt.timedelta(days=1)}


def test_references_of_several_tables_in_one_pass(spark):
    from rodovia.plans.quality import reference_audit

    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, nk string")
    child = spark.createDataFrame([(1, "a"), (1, "x"), (9, None), (None, "b"), (9, "x")], "p int, q string")
    got = reference_audit({"child": child, "parent": parent, "empty": child.limit(0)},
                          [("child", "p", "parent", "id"), ("child", "q", "parent", "nk"), ("empty", "p", "parent", "id")])
    assert sorted(tuple(r) for r in got.collect()) == [("child", "p", "parent", 1, 2), ("child", "q", "parent", 1, 2),
                                                       ("empty", "p", "parent", 0, 0)]


def test_scratch_is_cleared_at_the_end(spark, tmp_path, monkeypatch):
    from rodovia import session

    monkeypatch.setattr(session, "shared_root", lambda spark: f"file://{tmp_path}")
    spark.range(3).write.parquet(session.scratch_path(spark, "rows"))
    (tmp_path / "other").mkdir()
    assert session.clear_scratch(spark) and not session.clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
