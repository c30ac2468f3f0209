"""Hand-over from backlog to feed, order per vehicle, routes, tiers, trips in progress, rentals on the air."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rodovia.operators.store import Publication, TableStore
from rodovia.operators.timeslice import with_latest, with_sequence
from rodovia.streaming import jobs, parts, telemetry as T
from rodovia.streaming.handover import HandOver
from rodovia.streaming.ordered import in_order
from rodovia.streaming.tiers import RUNGS, Tiers

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def events(n, seed=1, start=0, vehicles=5, step=40):
    """(id, time, vehicle, type, value), one every ``step`` seconds or so; some share their second."""
    rng = random.Random(seed)
    return [(start + i, T0 + dt.timedelta(seconds=(start + i) * step + rng.randrange(step)), rng.randrange(vehicles),
             rng.choice(["view", "error", "click"]), float(rng.randrange(100))) for i in range(n)]


def put(spark, path, rows, files=1):
    """Files one after the other: a stream takes them by age."""
    size = -(-len(rows) // files)
    for k in range(files):
        spark.createDataFrame(rows[k * size:(k + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def shuffled(rng, batch):
    """Up to some minutes out of order."""
    return sorted(batch, key=lambda e: e[1] + dt.timedelta(seconds=rng.randrange(500)))


@pytest.mark.parametrize("files", [1, 1000])
def test_history_and_feed_add_up(spark, tmp_path, files):
    feed, rng = str(tmp_path / "feed"), random.Random(3)
    past, live = events(300), shuffled(rng, events(300, 2, 300))
    put(spark, feed, rng.sample(past, 300), 4)
    over = HandOver(spark, feed, spark.createDataFrame([], SCHEMA).schema, str(tmp_path / "root"))
    assert len(over.history_files()) == 4
    put(spark, feed, live, 5)
    assert len(over.history_files()) == 4 and over.history().count() == 300

    def build(df):
        return parts.parts_of(df, "1 hour", by=["event_type"])

    over.keep_history("hora", lambda df: build(T.telemetry(df)))
    query = over.follow("hora", lambda df: build(T.telemetry(df).withWatermark("ts", "10 minutes")), files_per_batch=files)
    jobs.finish(query)
    everything = T.telemetry(spark.createDataFrame(past + live, SCHEMA))
    assert rows(over.parts("hora", ["event_type"])) == rows(build(everything))
    if files == 1:  # the hours of the backlog are not in the state
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 9
    # Later files join in without another look at the history.
    more = events(60, 4, 600)
    put(spark, feed, more)
    jobs.finish(over.follow("hora", lambda df: build(T.telemetry(df).withWatermark("ts", "10 minutes"))))
    assert rows(over.parts("hora", ["event_type"])) == rows(build(T.telemetry(spark.createDataFrame(past + live + more, SCHEMA))))


@pytest.mark.parametrize("files", [1, 1000])
def test_order_of_a_feed_with_late_rows(spark, tmp_path, files):
    feed, rng = str(tmp_path / "feed"), random.Random(5)
    live = shuffled(rng, events(200))
    put(spark, feed, live, 4)
    late = [(9000 + k, T0 + dt.timedelta(seconds=k), k, "view", 1.0) for k in range(3)]
    put(spark, feed, [(-1, T0 + dt.timedelta(days=2), -1, "view", 0.0)])
    put(spark, feed, late + [(9100, None, 1, "view", 1.0), (9101, T0, None, "view", 1.0)])
    put(spark, feed, [(-2, T0 + dt.timedelta(days=4), -1, "view", 0.0)])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = in_order(T.telemetry(jobs.file_stream(spark, feed, schema, files)), 600)
    query = jobs.append_table(stream, str(tmp_path / "out"), str(tmp_path / "c"))
    jobs.finish(query)
    got = spark.read.parquet(str(tmp_path / "out"))
    if files == 1:
        assert {r["event_id"] for r in got.filter("late").collect()} == {9000, 9001, 9002}
    expected = live if files == 1 else live + late  # all in one batch: nothing is late
    want = with_sequence(T.telemetry(spark.createDataFrame(expected, SCHEMA)), "vehicle", "ts", "event_id").select("event_id", "vehicle", "seq")
    assert rows(got.filter("not late and vehicle >= 0").select("event_id", "vehicle", "seq")) == rows(want)
    # What came out of one vehicle came out in order.
    for v in range(5):
        mine = [r["micros"] for r in got.filter((F.col("vehicle") == v) & ~F.col("late")).orderBy("seq").collect()]
        assert mine == sorted(mine)


def test_order_goes_on_from_a_history(spark, tmp_path):
    feed = str(tmp_path / "feed")
    begun = spark.createDataFrame([(0, 10, int((T0 + dt.timedelta(hours=1)).replace(tzinfo=dt.timezone.utc).timestamp()) * 10 ** 6)],
                                  "vehicle bigint, base bigint, until bigint")
    put(spark, feed, [(1, T0, 0, "view", 1.0), (2, T0 + dt.timedelta(hours=2), 0, "view", 1.0), (3, T0, 1, "view", 1.0)])
    put(spark, feed, [(-1, T0 + dt.timedelta(days=2), -1, "view", 0.0)])
    stream = in_order(T.telemetry(jobs.file_stream(spark, feed, spark.createDataFrame([], SCHEMA).schema, 1)), 600, begun)
    jobs.finish(jobs.append_table(stream, str(tmp_path / "out"), str(tmp_path / "c")))
    got = {r["event_id"]: (r["seq"], r["late"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (None, True), 2: (11, False), 3: (1, False)}


def test_routes_commit_together(spark, tmp_path, monkeypatch):
    """A batch that breaks off between two tables, and a replay of all batches."""
    feed = str(tmp_path / "feed")
    given = events(120)
    put(spark, feed, given, 4)
    schema, store = spark.createDataFrame([], SCHEMA).schema, TableStore(spark, str(tmp_path / "store"))
    routes = {"alertas": T.critical, "rotina": T.routine}
    write, calls = Publication.write, []

    def breaking(self, name, df, partition=""):
        calls.append(name)
        if name == "rotina" and calls.count("rotina") == 3:
            raise OSError("killed")
        return write(self, name, df, partition)

    def run(checkpoint):
        jobs.finish(jobs.route(T.telemetry(jobs.file_stream(spark, feed, schema, 1)), store, str(tmp_path / checkpoint), routes, gather=3))

    monkeypatch.setattr(Publication, "write", breaking)
    with pytest.raises(Exception, match="killed"):
        run("c")
    monkeypatch.setattr(Publication, "write", write)
    # The broken batch left nothing, in neither table.
    assert sum(store.read(t).count() for t in routes) == 60
    for checkpoint in ("c", "c", "again"):
        run(checkpoint)
        everything = T.telemetry(spark.createDataFrame(given, SCHEMA))
        for table, build in routes.items():
            assert rows(store.read(table)) == rows(build(everything))
    assert len(store.current()[1]["rotina"]) < 4  # small batches were gathered


def test_fleet_buckets_that_are_rewritten(spark, tmp_path):
    feed, store = str(tmp_path / "feed"), TableStore(spark, str(tmp_path / "frota"))
    first = events(200, vehicles=40)
    put(spark, feed, first)
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(checkpoint):
        before = store.current()[1].get("status_frota", {})
        jobs.finish(jobs.keep_latest_status(T.telemetry(jobs.file_stream(spark, feed, schema, 1)), store, str(tmp_path / checkpoint), buckets=16))
        now = store.current()[1]["status_frota"]
        return sum(before.get(k) != v for k, v in now.items())

    assert run("c") > 8
    one = [(1000, T0 + dt.timedelta(days=9), 7, "view", 1.0), (1001, T0 - dt.timedelta(days=9), 8, "view", 1.0)]
    put(spark, feed, one)
    assert run("c") == 1  # vehicle 8 has nothing newer
    assert rows(store.read("status_frota")) == rows(T.latest_status(T.telemetry(spark.createDataFrame(first + one, SCHEMA))))
    assert run("again") == 0  # a replay rewrites nothing


def test_tiers_take_late_deliveries(spark, tmp_path):
    tiers = Tiers(TableStore(spark, str(tmp_path / "faixas")))
    given = T.telemetry(spark.createDataFrame(events(400, step=1200), SCHEMA))
    late = F.col("event_id") % 9 == 0

    def check(expected):
        for rung, length in RUNGS.items():
            assert rows(tiers.read(rung)) == rows(parts.parts_of(expected, length).select(tiers.read(rung).columns)), rung

    assert tiers.deliver("a", given.filter(~late))
    check(given.filter(~late))
    before = tiers.store.current()[1]
    gone = tiers.expire({"bruto": dt.date(2024, 1, 4), "segundo": dt.date(2023, 1, 1)})
    assert gone["bruto"] and gone["segundo"] == [] and tiers.read("bruto", {"2024-01-02"}) is None
    assert tiers.deliver("b", given.filter(late & (F.col("ts") < F.lit(T0 + dt.timedelta(days=2)))))
    after = tiers.store.current()[1]
    assert {k for k in after["hora"] if after["hora"][k] != before["hora"][k]} == {"2024-01-01", "2024-01-02"}
    assert not tiers.deliver("b", given) and tiers.deliver("c", given.filter(late & (F.col("ts") >= F.lit(T0 + dt.timedelta(days=2)))))
    check(given)
    assert tiers.read("dia", {"2024-01-03"}).count() == 5
    assert tiers.read("bruto").filter(F.col("ts") >= F.lit(dt.datetime(2024, 1, 4))).count() == given.filter("ts >= '2024-01-04'").count()


def test_trips_in_progress_come_from_the_state(spark, tmp_path):
    feed = str(tmp_path / "feed")
    given = events(150, step=300)
    put(spark, feed, given, 3)
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = T.trips(T.telemetry(jobs.file_stream(spark, feed, schema, 1)), "40 minutes")
    jobs.finish(jobs.append_table(stream, str(tmp_path / "out"), str(tmp_path / "c")))
    done, open_ = spark.read.parquet(str(tmp_path / "out")), jobs.open_trips(spark, str(tmp_path / "c"), "40 minutes")
    assert 0 < open_.count() <= 10 and done.count()
    assert rows(done.unionByName(open_)) == rows(T.trips(T.telemetry(spark.createDataFrame(given, SCHEMA)), "40 minutes"))


def test_windows_over_windows(spark, tmp_path):
    feed = str(tmp_path / "feed")
    given = events(300, step=7)
    put(spark, feed, given, 3)
    put(spark, feed, [(-1, T0 + dt.timedelta(days=2), -1, "view", 0.0)])
    schema = spark.createDataFrame([], SCHEMA).schema
    jobs.finish(jobs.append_table(T.hourly_activity(T.telemetry(jobs.file_stream(spark, feed, schema, 1))), str(tmp_path / "out"), str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got) == rows(T.hourly_activity(T.telemetry(spark.createDataFrame(given, SCHEMA)))) and got.count() == 5
    assert got.agg(F.sum("segundos")).first()[0] == len({(e[2], e[1].replace(microsecond=0)) for e in given})


def test_latest_event_of_each_row(spark):
    """Across slices, at the same moment, before the first event, and for keys without any."""
    rng = random.Random(2)
    marks = [(rng.randrange(3), T0 + dt.timedelta(minutes=rng.randrange(6000)), f"n{i}") for i in range(60)]
    marks += [(0, marks[0][1], "zz"), (0, None, "no"), (None, T0, "no")]
    points = [(i, rng.randrange(4), T0 + dt.timedelta(minutes=rng.randrange(7000) - 300)) for i in range(300)] + [(900, 0, marks[0][1]), (901, None, T0)]
    got = with_latest(spark.createDataFrame(points, "id int, k int, ts timestamp_ntz"),
                      spark.createDataFrame(marks, "k int, at timestamp_ntz, nk string"), "k", "ts", "at", "m")

    def latest(k, ts):
        return max(((a, n) for key, a, n in marks if key == k and a is not None and a <= ts), default=(None, None))[1] if k is not None else None

    assert sorted((r["id"], r["m"]["nk"] if r["m"] else None) for r in got.collect()) == sorted((i, latest(k, ts)) for i, k, ts in points)


def test_usage_is_charged_to_the_open_rental(spark):
    hour = lambda h: T0 + dt.timedelta(hours=h)
    points = [(i, hour(h), v, "view", s) for i, (h, v, s) in enumerate([
        (0, 1, 10.0), (1, 1, 20.0), (1.05, 1, 90.0), (1.1, 1, 30.0), (2, 1, 50.0), (2.05, 1, 50.0), (3, 2, 60.0)])]
    rentals = [(1, "a", hour(1), hour(2)), (1, "b", hour(2), None), (1, "old", hour(-500), hour(900)), (3, "c", hour(0), None)]
    got = T.rental_usage(T.telemetry(spark.createDataFrame(points, SCHEMA)), spark.createDataFrame(
        rentals, "vehicle bigint, locacao_nk string, inicio timestamp_ntz, fim timestamp_ntz"))
    assert sorted((r[0], r[1], r[2], float(r[3]), float(r[4])) for r in got.collect()) == [
        ("a", 3, 360, 5.5, 33.33), ("b", 2, 180, 2.5, 0.0), ("old", 1, 0, 0.0, 0.0)]
