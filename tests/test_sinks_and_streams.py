import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import payments as pay
from riskloom.operators import visits as vis
from riskloom.operators.lateness import late_rows
from riskloom.sinks import files as out
from riskloom.sources import files as src
from riskloom.streaming import queries as streams
from riskloom.streaming.observed import observed, run_until_idle, watched
from riskloom.streaming.sources import file_events, kafka_options
from riskloom.session import new_folder, shared_folder


def write_rows(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{number}")


def upsert(spark, folder, sink):
    sink.start(file_events(spark, f"{folder}/*", sink.schema), streams.ONCE).awaitTermination()


def test_keyed_table_keeps_the_last_write_and_replays(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "k string, v int, at int, note string"
    sink = streams.KeyedSink(str(tmp_path), "t", spark.createDataFrame([], schema).schema, ("k",), ("at",))
    assert sink.read(spark).collect() == []
    write_rows(spark, folder, 0, [("a", 9, 1, "x"), ("a", 2, 5, None), ("b", 5, 1, "y"), (None, 1, 1, "null key")], schema)
    for _ in range(2):
        upsert(spark, folder, sink)
    assert {r.k: (r.v, r.note) for r in sink.read(spark).collect()} == {"a": (2, None), "b": (5, "y"), None: (1, "null key")}
    # A later batch wins even with a smaller order.
    write_rows(spark, folder, 1, [("a", 0, 0, "late"), ("c", 9, 1, "")], schema)
    for _ in range(2):
        upsert(spark, folder, sink)
    rows = sink.read(spark).collect()
    assert {r.k: r.v for r in rows} == {"a": 0, "b": 5, "c": 9, None: 1} and len(rows) == 4


def test_reading_a_keyed_table_does_not_grow_with_its_batches(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "k int, v int"
    sink = streams.KeyedSink(str(tmp_path), "t", spark.createDataFrame([], schema).schema, ("k",))
    for number in range(20):
        write_rows(spark, folder, number, [(k, 100 * number + k) for k in range(number % 5, 10)], schema)
    stream = file_events(spark, f"{folder}/*", sink.schema, max_files=1)
    sink.start(stream, streams.ONCE).awaitTermination()
    rows = sink.read(spark)
    # One task per partition of the state; no file of a batch is listed or opened.
    state = spark.read.format("state-metadata").load(sink.checkpoint).first()
    assert state.maxBatchId == 19 and rows.rdd.getNumPartitions() == state.numPartitions
    assert rows.inputFiles() == [] and "FileScan" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.v for r in rows.collect()} == {k: max(100 * n + k for n in range(20) if k >= n % 5) for k in range(10)}


def test_bot_traffic_is_read_newest_first(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), streams.bot_sink(str(tmp_path))
    rows = [(f"u{i % 3}", "ip", i, f"2026-01-01T00:00:{i:02}", None) for i in (5, 1, 9, 3, 7, 0, 2, 4, 6, 8)]
    write_rows(spark, folder, 0, rows, sink.schema)
    upsert(spark, folder, sink)
    read = {}
    for r in sink.read(spark).collect():
        read.setdefault(r.user_id, []).append(r.timestamp)
    assert len(read) == 3 and all(times == sorted(times, reverse=True) for times in read.values())


def test_alerts_keep_the_newest_event(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), streams.alert_sink(str(tmp_path))
    schema = schemas.PAYMENT.simpleString()[7:-1].replace(":", " ") + ", event_time timestamp"
    early, late = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    rows = [("t", "u", amount, "EUR", "ES", "VISA", False, at) for amount, at in ((9000.0, early), (1.0, late))]
    write_rows(spark, folder, 0, rows, schema)
    stream = file_events(spark, f"{folder}/*", schema)
    sink.start(pay.alerts(stream), streams.ONCE).awaitTermination()
    assert [r.amount for r in sink.read(spark).collect()] == [1.0]


def test_csv_export_and_missing_export(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("ES", 3), ("FR", 1)], schemas.COUNTRY_SUMMARY)
    out.export_csv(df, path)
    assert sum(1 for f in (tmp_path / "csv").glob("*.csv") for _ in f.open()) > len(df.collect())
    back = src.read_csv_or_empty(spark, path, schemas.COUNTRY_SUMMARY)
    assert sorted(map(tuple, back.collect())) == [("ES", 3), ("FR", 1)]
    missing = src.read_csv_or_empty(spark, str(tmp_path / "no"), schemas.COUNTRY_SUMMARY)
    assert missing.columns == back.columns and missing.isEmpty()


def test_partition_append_is_idempotent_and_projects_can_be_purged(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "project_id string, n int")
    out.append_partition(rows, path, "project_id")
    out.append_partition(rows.filter("project_id = 'a'"), path, "project_id")
    assert spark.read.parquet(path).count() == 3
    assert out.purge_project(spark, path, "a") is True
    assert out.purge_project(spark, path, "a") is False
    assert [r.n for r in spark.read.parquet(path).collect()] == [3]


def test_overwritten_table(spark):
    out.overwrite_table(spark.range(5), "historial_prueba")
    out.overwrite_table(spark.range(3), "historial_prueba")
    assert spark.table("historial_prueba").count() == 3
    spark.sql("DROP TABLE historial_prueba")


def test_kafka_options():
    got = kafka_options("broker:9092", "datos_pagos", max_offsets=10)
    assert got == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "datos_pagos",
        "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10",
    }


def test_shared_folder_is_the_configured_one(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
    try:
        spark.conf.set("spark.checkpoint.dir", "/tmp/some-folder/")
        assert shared_folder(spark) == "/tmp/some-folder"
    except Exception as error:  # the setting may be fixed at start
        assert "CANNOT_MODIFY" in str(error)
    finally:
        try:
            spark.conf.unset("spark.checkpoint.dir")
        except Exception:
            pass


START = dt.datetime(2026, 1, 1)


def visit_rows(minutes, user="u"):
    return [
        {"timestamp": (START + dt.timedelta(minutes=m)).isoformat(), "user_id": f"{user}{i}",
         "ip": f"1.1.1.{i % 3}", "session_duration": 1, "pages_visited": i, "is_bot": i % 2 == 0,
         "flag_ataque": False}
        for i, m in enumerate(minutes)
    ]


def write_json(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def test_streams_equal_batch_and_replay_adds_nothing(spark, tmp_path):
    paid, seen, root = tmp_path / "paid", tmp_path / "seen", str(tmp_path / "root")
    write_json(paid, "1.json", [
        {"tx_id": f"t{i}", "user_id": "u", "amount": 500.0 * i, "currency": "EUR",
         "card_country": "RU" if i % 2 else "ES", "method": "VISA", "flag_ataque": False}
        for i in range(6)
    ] + [{"user_id": "no id"}])
    write_json(seen, "1.json", visit_rows([0, 0.5, 1, 2, 2.2, 9]))
    listed = spark.createDataFrame([("1.1.1.1", "ALTO")], schemas.BLACKLIST)

    def run():
        payments = file_events(spark, str(paid), schemas.PAYMENT, "json")
        visits = file_events(spark, str(seen), schemas.VISIT, "json")
        started = streams.start_all(
            payments, visits, listed, root, trigger=streams.ONCE, window_trigger=streams.ONCE
        )
        for query in started:
            query.awaitTermination()

    def tables():
        found = []
        for sink in (streams.alert_sink(root), streams.bot_sink(root), streams.window_sink(root)):
            found.append(sorted(map(str, sink.read(spark).collect())))
        return found

    run()
    got = tables()
    batch_paid = src.read_payments_json(spark, str(paid))
    batch_seen = spark.read.schema(schemas.VISIT).json(str(seen))
    closed = vis.window_metrics(batch_seen).filter(F.col("window_end") <= START + dt.timedelta(minutes=8))
    assert got[0] == sorted(map(str, pay.alerts(batch_paid).collect())) and len(got[0]) == 6
    assert got[1] == sorted(map(str, vis.bot_traffic(batch_seen, listed).collect()))
    assert got[2] == sorted(map(str, closed.collect())) and len(got[2]) == 3
    run()
    assert tables() == got
    write_json(seen, "2.json", visit_rows([0, 30], "late"))
    run()
    after = tables()[2]
    assert set(got[2]) < set(after) and len(after) == 4


def test_duplicates_are_dropped_within_the_watermark(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "root")
    rows = [{"k": f"k{i % 4}", "ts": "2026-01-01T00:00:00"} for i in range(12)]
    write_json(source, "1.json", rows)
    stream = file_events(spark, str(source), "k string, ts timestamp", "json")
    once = streams.deduplicated(stream, "k", "ts")
    streams.append_files(once, root, "once", streams.ONCE).awaitTermination()
    assert spark.read.parquet(f"{root}/once").count() == 4


def test_a_late_copy_does_not_hide_one_on_time(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "root")

    def run(name, rows):
        write_json(source, name, [{"k": k, "ts": f"2026-01-01T{t}"} for k, t in rows])
        stream = file_events(spark, str(source), "k string, ts timestamp", "json")
        once = streams.deduplicated(stream, "k", "ts")
        streams.append_files(once, root, "late", streams.ONCE).awaitTermination()

    run("1.json", [("a", "10:00:00")])
    run("2.json", [("z", "09:00:00"), ("z", "10:00:30")])
    assert {r.k for r in spark.read.parquet(f"{root}/late").collect()} == {"a", "z"}


@pytest.mark.parametrize("mode", ["archive", "delete"])
def test_landing_files_are_removed_after_the_commit(spark, tmp_path, mode):
    source, root = tmp_path / "in", str(tmp_path / "root")

    def run():
        stream = file_events(
            spark, str(source), "k string", "json", clean_source=mode,
            archive_dir=str(tmp_path / "archive") if mode == "archive" else None,
        )
        streams.append_files(stream, root, "landed", streams.ONCE).awaitTermination()

    for number in range(3):
        write_json(source, f"{number}.json", [{"k": str(number)}])
        run()
    assert spark.read.parquet(f"{root}/landed").count() == 3
    assert len(list(source.glob("*.json"))) < 3


def test_empty_landing_folder_starts_no_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = file_events(spark, str(tmp_path / "in"), "k string", "json")
    query = streams.append_files(stream, str(tmp_path / "root"), "none", streams.ONCE)
    query.awaitTermination()
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    source = tmp_path / "seen"
    sink = streams.window_sink(str(tmp_path / "root"))

    def run():
        visits = file_events(spark, str(source), schemas.VISIT, "json")
        query = sink.start(vis.window_metrics(visits), streams.ONCE)
        query.awaitTermination()
        return sum(
            state["numRowsDroppedByWatermark"]
            for progress in query.recentProgress
            for state in progress["stateOperators"]
        )

    write_json(source, "1.json", visit_rows([0, 1, 30]))
    assert run() == 0
    write_json(source, "2.json", visit_rows([2, 2, 29.5, 40], "late"))
    # Both rows of minute 2 fall into one partial count before the state is reached.
    assert run() >= 1
    starts = {(r.window_start - START).total_seconds() / 60 for r in sink.read(spark).collect()}
    assert starts == {0, 1, 29, 30}


def test_single_late_rows_are_counted_as_the_batch_report_counts_them(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "root")
    batches = [["10:00:00", "11:00:00"], ["10:30:00", "10:59:30", "12:00:00"], ["11:00:00", "11:58:00", "12:30:00"], ["12:00:00"]]
    rows = []
    with watched(spark) as totals:
        for number, times in enumerate(batches):
            own = [{"k": f"{number}{i}", "ts": f"2026-01-01T{t}"} for i, t in enumerate(times)]
            write_json(source, f"{number}.json", own)
            rows += [(number, dt.datetime.fromisoformat(r["ts"])) for r in own]
            stream = observed(file_events(spark, str(source), "k string, ts timestamp", "json"), "odd", F.col("k").endswith("1"))
            streams.append_files(streams.deduplicated(stream, "k", "ts"), root, "late", streams.ONCE).awaitTermination()
        deadline = time.monotonic() + 20
        while totals.of("late")["n_in"] < len(rows) and time.monotonic() < deadline:
            time.sleep(0.2)
    report = late_rows(spark.createDataFrame(rows, "batch bigint, ts timestamp"), "batch", "ts", "1 minute")
    n_late = report.agg(F.sum("n_late")).first()[0]
    assert totals.of("late") == {"n_in": len(rows), "n_dropped": n_late, "n_rejected": 3} and n_late == 4
    assert spark.read.parquet(f"{root}/late").count() == len(rows) - n_late


def test_a_failing_stream_ends_the_run(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "root")
    write_json(source, "1.json", [{"k": "a"}])
    stream = file_events(spark, str(source), "k string", "json")
    broken = stream.withColumn("k", F.raise_error(F.lit("on purpose")).cast("string"))
    often = {"processingTime": "1 second"}
    started = [streams.append_files(stream, root, "good", often), streams.append_files(broken, root, "bad", often)]
    with pytest.raises(Exception, match="on purpose"):
        run_until_idle(spark, started)
    assert not any(query.isActive for query in started)
