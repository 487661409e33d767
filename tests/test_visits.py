import datetime as dt

from riskloom import schemas
from riskloom.operators import visits as vis
from riskloom.operators.lateness import late_rows


def visit(ip, user="u", pages=1, bot=False, ts="2026-01-01T00:00:01"):
    return (ts, user, ip, 10, pages, bot, False)


def frame(spark, *rows):
    return spark.createDataFrame(rows, schemas.VISIT)


def test_bots_and_blacklisted_addresses(spark):
    rows = frame(
        spark,
        visit("1.1.1.1", "bot", bot=True),
        visit("2.2.2.2", "listed"),
        visit("3.3.3.3", "plain"),
        visit("3.3.3.3", "unknown", bot=None),
        visit("2.2.2.2", "listed, unknown", bot=None),
        visit(None, "bot without address", bot=True),
    )
    listed = spark.createDataFrame(
        [("2.2.2.2", "B"), ("2.2.2.2", "A"), ("9.9.9.9", "C")], schemas.BLACKLIST
    )
    got = {(r.user_id, r.riesgo_historico) for r in vis.bot_traffic(rows, listed).collect()}
    assert got == {
        ("bot", None), ("listed", "A"), ("listed, unknown", "A"), ("bot without address", None),
    }
    assert vis.bot_traffic(rows, listed).count() == 4


def test_empty_blacklist(spark):
    rows = frame(spark, visit("1.1.1.1", bot=True), visit("2.2.2.2"))
    empty = spark.createDataFrame([], schemas.BLACKLIST)
    assert vis.bot_traffic(rows, empty).count() == 1


def test_scraper_rollup_counts_only_known_users(spark):
    rows = frame(spark, visit("a", None, 5), visit("a", "u", 2), visit("b", "u", None))
    got = {r.ip: tuple(r)[1:] for r in vis.scraper_rollup(rows).collect()}
    assert got == {"a": (7, 1, 20), "b": (None, 1, 10)}
    assert [r.ip for r in vis.top_scrapers(rows, 1).collect()] == ["a"]


def test_top_scrapers_breaks_ties_by_address(spark):
    rows = frame(spark, *[visit(f"ip{i}", pages=3) for i in range(5)])
    assert [r.ip for r in vis.top_scrapers(rows, 2).collect()] == ["ip0", "ip1"]


def test_windows(spark):
    rows = frame(
        spark,
        visit("a", pages=1, ts="2026-01-01T00:00:00"),
        visit("a", pages=4, ts="2026-01-01T00:00:59.999999"),
        visit("a", pages=9, ts="2026-01-01T00:01:00"),
        visit("a", pages=9, ts="junk"),
    )
    got = vis.window_metrics(rows).orderBy("window_start").collect()
    assert [(r.total_visitas, r.media_paginas) for r in got] == [(2, 2.5), (1, 9.0)]
    assert (got[0].window_end - got[0].window_start) == dt.timedelta(minutes=1)
    series = vis.latest_windows(vis.window_metrics(rows), 1).collect()
    assert [r.total_visitas for r in series] == [1]


def test_late_rows_use_the_earlier_batches_only(spark):
    day = dt.datetime(2026, 1, 1)
    rows = [
        (0, day + dt.timedelta(days=10)), (0, day),
        (1, day + dt.timedelta(days=9)), (1, day + dt.timedelta(days=8)),
        (2500, day + dt.timedelta(days=30)), (2500, day),
        (2501, day + dt.timedelta(days=10)),
    ]
    events = spark.createDataFrame(rows, "batch bigint, ts timestamp")
    for block in (2, 1000):
        got = late_rows(events, "batch", "ts", "1 day", block=block)
        assert {r.batch: (r.n_rows, r.n_late) for r in got.collect()} == {
            0: (2, 0), 1: (2, 1), 2500: (2, 1), 2501: (1, 1),
        }
