"""Streams against the batch function over the same rows; retention; replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rodovia.operators.store import TableStore
from rodovia.streaming import jobs, telemetry as T

EVENTS = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.read.parquet(f"{EVENTS}/events.parquet")


@pytest.fixture(scope="module")
def feed(spark, raw, tmp_path_factory):
    """The events as several files, so that a stream takes more than one micro-batch."""
    path = str(tmp_path_factory.mktemp("feed") / "in")
    for week in range(5):  # one file after the other: a stream takes files by age
        low = dt.datetime(2024, 1, 1) + dt.timedelta(weeks=week)
        part = raw.filter((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(low + dt.timedelta(weeks=1))))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, raw, feed):
    return T.telemetry(jobs.file_stream(spark, feed, raw.schema, files_per_batch=1))


def rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_windows_in_update_mode(spark, raw, feed, tmp_path):
    out = str(tmp_path / "out")
    jobs.finish(jobs.update_table(T.windows(stream(spark, raw, feed), "1 day", delay="40 days"), out, str(tmp_path / "c")))
    assert spark.read.parquet(out).select("batch").distinct().count() > 1
    final = jobs.current(spark, out, ["inicio", "event_type"])
    assert rows(final) == rows(T.windows(T.telemetry(raw), "1 day"))


@pytest.fixture(scope="module")
def shuffled_feed(raw, tmp_path_factory):
    """Four files, the newest quarter first: most rows are older than what a stream has seen."""
    path = str(tmp_path_factory.mktemp("feed") / "in")
    bounds = raw.agg(F.min("ts"), F.max("ts")).first()
    quarter = (bounds[1] - bounds[0]) / 4
    for k in (3, 1, 2, 0):
        low, high = bounds[0] + k * quarter, bounds[0] + (k + 1) * quarter
        part = raw.filter((F.col("ts") >= F.lit(low)) & (F.lit(k == 3) | (F.col("ts") < F.lit(high))))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("files", [1, 1000])
def test_results_do_not_depend_on_micro_batches(spark, raw, shuffled_feed, tmp_path, files):
    t = T.telemetry(raw)
    delay = T.backlog_delay(t)

    def feed():
        return T.telemetry(jobs.file_stream(spark, shuffled_feed, raw.schema, files_per_batch=files))

    def updated(name, stream, keys):
        jobs.finish(jobs.update_table(stream, str(tmp_path / name), str(tmp_path / f"{name}-c")))
        return rows(jobs.current(spark, str(tmp_path / name), keys))

    def appended(name, stream):
        jobs.finish(jobs.append_table(stream, str(tmp_path / name), str(tmp_path / f"{name}-c")))
        return rows(spark.read.parquet(str(tmp_path / name)))

    assert updated("second", T.per_second(feed(), delay), ["segundo", "vehicle"]) == rows(T.per_second(t))
    assert updated("tumbling", T.windows(feed(), "1 hour", delay=delay), ["inicio", "event_type"]) == rows(T.windows(t, "1 hour"))
    assert updated("sliding", T.windows(feed(), "6 hours", "3 hours", delay=delay), ["inicio", "event_type"]) == rows(
        T.windows(t, "6 hours", "3 hours"))
    assert appended("dedup", T.without_replays(feed(), delay)) == rows(t)
    assert appended("clip", T.clip_context_stream(feed(), T.critical(feed()), delay=delay)) == rows(T.clip_context(t))
    jobs.finish(jobs.trip_table(feed(), str(tmp_path / "trips"), str(tmp_path / "trips-c"), "3 hours"))
    assert rows(jobs.finished_trips(spark, str(tmp_path / "trips"), "3 hours")) == rows(T.trips(t, "3 hours"))


def test_streams_read_files_and_folders_and_refuse_nothing(spark, raw, feed, tmp_path):
    for k, path in enumerate((f"{EVENTS}/events.parquet", feed)):
        out = str(tmp_path / f"out{k}")
        jobs.finish(jobs.append_table(jobs.file_stream(spark, path, raw.schema), out, str(tmp_path / f"c{k}")))
        assert spark.read.parquet(out).count() == raw.count()
    (tmp_path / "none").mkdir()
    for path in (tmp_path / "none", tmp_path / "missing"):
        with pytest.raises(FileNotFoundError):
            jobs.file_stream(spark, str(path), raw.schema)


def test_append_mode_closes_all_but_the_last_windows(spark, raw, feed, tmp_path):
    out = str(tmp_path / "out")
    jobs.finish(jobs.append_table(T.per_second(stream(spark, raw, feed), delay="40 days"), out, str(tmp_path / "c")))
    assert spark.read.parquet(out).count() == 0  # nothing is final under a watermark longer than the data
    out = str(tmp_path / "out2")
    ordered = T.per_second(stream(spark, raw, feed), delay="10 minutes")
    jobs.finish(jobs.append_table(ordered, out, str(tmp_path / "c2")))
    done, batch = set(rows(spark.read.parquet(out))), set(rows(T.per_second(T.telemetry(raw))))
    assert done <= batch and 0 < len(batch - done) < 20


def test_trips(spark, raw):
    gap = dt.timedelta(hours=3)
    by = {}
    for r in T.telemetry(raw).select("vehicle", "ts").collect():
        by.setdefault(r.vehicle, []).append(r.ts)
    want = 0
    for stamps in by.values():
        stamps.sort()
        want += 1 + sum(b - a >= gap for a, b in zip(stamps, stamps[1:]))
    assert T.trips(T.telemetry(raw), "3 hours").count() == want


def test_latest_status_survives_a_replay(spark, raw, feed, tmp_path):
    store = TableStore(spark, str(tmp_path / "frota"))
    for checkpoint in ("a", "b"):  # a second run with a new checkpoint replays everything
        jobs.finish(jobs.keep_latest_status(stream(spark, raw, feed), store, str(tmp_path / checkpoint)))
        assert rows(store.read("status_frota")) == rows(T.latest_status(T.telemetry(raw)))


def test_replays_are_dropped(spark, raw, feed, tmp_path):
    twice = stream(spark, raw, feed).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    out = str(tmp_path / "out")
    jobs.finish(jobs.append_table(T.without_replays(twice), out, str(tmp_path / "c")))
    assert spark.read.parquet(out).count() == raw.count()
    assert T.without_replays(T.telemetry(raw.union(raw))).count() == raw.count()


@pytest.mark.parametrize("seconds", [300, 7200])
def test_clip_context_matches_brute_force(raw, seconds):
    rows_ = [(r.event_id, r.vehicle, r.ts, r.critical) for r in T.telemetry(raw).collect()]
    alarms = {}
    for _, v, ts, critical in rows_:
        if critical:
            alarms.setdefault(v, []).append(ts)
    want = {e for e, v, ts, _ in rows_ if any(abs((ts - a).total_seconds()) <= seconds for a in alarms.get(v, []))}
    assert {r.event_id for r in T.clip_context(T.telemetry(raw), seconds).collect()} == want


def test_clip_stream(spark, raw, feed, tmp_path):
    out = str(tmp_path / "out")
    both = T.clip_context_stream(stream(spark, raw, feed), T.critical(stream(spark, raw, feed)))
    jobs.finish(jobs.append_table(both, out, str(tmp_path / "c")))
    got = {r.event_id for r in spark.read.parquet(out).collect()}
    assert got == {r.event_id for r in T.clip_context(T.telemetry(raw)).collect()}


def test_routing_splits_everything(raw):
    t = T.telemetry(raw)
    assert T.routine(t).count() + T.critical(t).count() == t.count()


def test_retention(spark, raw, tmp_path):
    path, kept = str(tmp_path / "bruto"), str(tmp_path / "resumo")
    jobs.archive_by_day(T.telemetry(raw), path)
    cut = dt.date(2024, 1, 20)
    before = spark.read.parquet(path).count()
    old = spark.read.parquet(path).filter(F.col("dia") < F.lit(cut)).count()
    dropped = jobs.expire_days(spark, path, cut, lambda df: T.downsample(df, "day").write.parquet(kept))
    assert dropped and all(x < "dia=2024-01-20" for x in dropped)
    assert spark.read.parquet(path).count() == before - old
    assert spark.read.parquet(kept).agg(F.sum("mensagens")).first()[0] == old


def test_masking(spark):
    df = spark.createDataFrame([("123", "Ana B1")], "cnh string, nome string")
    row = T.mask_personal(df, ["cnh"], ["nome"], "s").first()
    assert len(row.cnh) == 64 and row.nome == "Xxx Xn"
