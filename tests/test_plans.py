import json

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import graph, retrieval, rings
from riskloom.operators import payments as pay
from riskloom.operators import visits as vis
from riskloom.operators.splits import stratified_split
from riskloom.plans import views
from riskloom.plans.nightly_close import CloseFailed, land_all, landings, nightly_close
from riskloom.sinks import projects
from riskloom.sources.files import has_files, read_csv_or_empty

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return views.payments(spark, FOLDER), views.visits(spark, FOLDER)


def test_blacklist_join_is_broadcast(spark, tables):
    got = plan(vis.bot_traffic(tables[1], views.blacklist(spark, FOLDER)))
    assert "BroadcastHashJoin" in got and "SortMergeJoin" not in got
    assert "BatchEvalPython" not in got and "ArrowEvalPython" not in got


def test_scoring_reads_only_its_columns(tables):
    got = plan(pay.blocked_by_country(pay.alerts(tables[0], views.POLICY)))
    orders = next(line for line in got.splitlines() if "FileScan" in line and "o_orderkey" in line)
    assert "o_orderdate" not in orders and "PushedFilters: [" in orders


def test_status_filter_reaches_the_scan_as_a_plain_filter(tables):
    got = plan(pay.with_status(pay.alerts(tables[0], views.POLICY), "BLOQUEADO"))
    assert "Exchange hashpartitioning" not in got


def test_hub_cut_runs_before_the_shuffle(tables):
    got = plan(graph.hot_nodes(graph.edges(*tables)))
    assert got.count("WindowGroupLimit") == 2
    assert "Join" not in got.split("WindowGroupLimit")[0]


def test_top_lists_need_no_global_sort(tables):
    assert "TakeOrderedAndProject" in plan(vis.top_scrapers(tables[1]))


def test_nearest_has_no_join_of_all_pairs(spark):
    hits = retrieval.nearest(views.questions(spark, FOLDER), views.passages(spark, FOLDER))
    got = plan(hits)
    # Two levels of merging, each cut before and after its shuffle.
    assert "MapInArrow" in got and got.count("WindowGroupLimit") == 4
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert name not in got


def test_no_plan_multiplies_rows(spark, tables):
    members = spark.createDataFrame([("c", "ip", "a")], "component string, tipo string, id string")
    plans = [
        plan(rings.ring_edges(rings.ring_members(members), graph.edges(*tables))),
        plan(stratified_split(views.vectors(spark, FOLDER).select("id", "label"), "id")),
        plan(vis.window_metrics(tables[1])),
    ]
    for got in plans:
        assert "CartesianProduct" not in got and "BroadcastNestedLoopJoin" not in got


def test_nightly_close(spark, tmp_path):
    target = str(tmp_path / "out")
    paid, seen = tmp_path / "pagos", tmp_path / "visitas"
    assert not has_files(spark, str(paid))
    assert nightly_close(spark, str(paid), str(seen), target, "2026-01-01") is None
    paid.mkdir()
    seen.mkdir()
    assert nightly_close(spark, str(paid), str(seen), target, "2026-01-01") is None
    payments = [
        {"tx_id": f"t{i}", "user_id": f"u{i % 4}", "amount": 10.0, "card_country": "ES"}
        for i in range(9)
    ]
    (paid / "a.json").write_text("\n".join(map(json.dumps, [*payments, {"user_id": "x"}])))
    visits = [{"ip": f"1.1.1.{i % 2}", "user_id": f"g{i}", "pages_visited": i} for i in range(6)]
    (seen / "a.txt").write_text("\n".join(f"data: {json.dumps(v)}" for v in visits) + "\njunk\n")
    for _ in range(2):
        counts = nightly_close(spark, str(paid), str(seen), target, "2026-01-01")
        assert counts == {"payments": 10, "visits": 7}
    assert spark.read.parquet(f"{target}/historial_pagos").count() == 9
    summary = read_csv_or_empty(spark, f"{target}/resumen_batch", schemas.COUNTRY_SUMMARY)
    assert [tuple(r) for r in summary.collect()] == [("ES", 9)]
    scrapers = read_csv_or_empty(spark, f"{target}/top_scrapers_batch", schemas.TOP_SCRAPERS)
    assert [r.total_paginas_dia for r in scrapers.collect()] == [9, 6]
    found = read_csv_or_empty(spark, f"{target}/redes_detectadas", schemas.FRAUD_RINGS)
    assert sorted(r.num_entidades for r in found.collect()) == [4, 4, 5]
    nodes = read_csv_or_empty(spark, f"{target}/nodos_calientes", schemas.HOT_NODES)
    assert nodes.filter("tipo = 'PAIS'").first().degree == 9


def lines_of(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(rows) + "\n")


def test_each_row_counts_on_the_day_it_came(spark, tmp_path):
    paid, seen = tmp_path / "pagos", tmp_path / "visitas"
    folders = landings(str(paid), str(seen), str(tmp_path / "out"))
    for day in (1, 2, 3):
        if day < 3:
            lines_of(paid, f"{day}.json", [json.dumps({"tx_id": f"t{day}{i}", "amount": i}) for i in range(4)] + ["", "#broken"])
            lines_of(seen, f"{day}.txt", [f"data: {json.dumps({'ip': f'1.1.1.{day}'})}", '{"user_id": "no ip"}'])
        assert land_all(spark, folders, f"2026-01-0{day}") == {}
    for landing, kept in zip(folders, (4, 1)):
        days = {r.batch_date: r["count"] for r in landing.accepted(spark).groupBy("batch_date").count().collect()}
        assert days == {"2026-01-01": kept, "2026-01-02": kept}
        assert landing.accepted(spark).select(landing.key).distinct().count() == 2 * kept
        refused = {(r.batch_date, r.value) for r in landing.rejected(spark).collect()}
        assert len(refused) == 2 and {d for d, _ in refused} == {"2026-01-01", "2026-01-02"}
    assert {r.value for r in folders[0].rejected(spark).collect()} == {"#broken"}


def test_a_batch_run_again_replaces_its_rows_under_any_day(spark, tmp_path):
    landing = landings(str(tmp_path), str(tmp_path), str(tmp_path / "out"))[0]
    lines = spark.createDataFrame([('{"tx_id": "a"}',), ("junk",)], "value string")
    landing._saver("2026-01-01")(lines, 0)
    landing._saver("2026-01-02")(lines, 0)
    assert [r.batch_date for r in landing.accepted(spark).collect()] == ["2026-01-02"]
    assert [r.batch_date for r in landing.rejected(spark).collect()] == ["2026-01-02"]


def test_a_folder_that_fails_does_not_stop_the_other(spark, tmp_path):
    paid, seen, target = tmp_path / "pagos", tmp_path / "visitas", tmp_path / "out"
    lines_of(paid, "1.json", ['{"tx_id": "a"}'])
    lines_of(seen, "1.txt", ['{"ip": "1.1.1.1", "pages_visited": 3, "user_id": "u"}'])
    # The payments' table cannot be written.
    target.mkdir()
    (target / "historial_pagos").write_text("in the way")
    with pytest.raises(CloseFailed) as error:
        nightly_close(spark, str(paid), str(seen), str(target), "2026-01-01")
    assert set(error.value.failures) == {"historial_pagos"}
    assert read_csv_or_empty(spark, f"{target}/top_scrapers_batch", schemas.TOP_SCRAPERS).count() == 1
    (target / "historial_pagos").unlink()
    counts = nightly_close(spark, str(paid), str(seen), str(target), "2026-01-02")
    assert counts == {"payments": 1, "visits": 0}


@pytest.mark.parametrize("mode", ["archive", "delete"])
def test_the_close_clears_what_it_has_landed(spark, tmp_path, mode):
    paid, seen, target = tmp_path / "pagos", tmp_path / "visitas", tmp_path / "out"
    archive = str(tmp_path / "archive") if mode == "archive" else None
    folders = landings(str(paid), str(seen), str(target), mode, archive)
    for day in range(3):
        lines_of(paid, f"{day}.json", [json.dumps({"tx_id": f"t{day}"})])
        assert land_all(spark, folders, f"2026-01-0{day + 1}") == {}
    assert folders[0].accepted(spark).count() == 3 and len(list(paid.glob("*.json"))) < 3


def test_projects_and_turns(spark, tmp_path):
    path, chat = str(tmp_path / "projects"), str(tmp_path / "chat")
    for name in ("uno", "dos"):
        projects.register_projects(spark.createDataFrame([(name,)], "name string"), path)
    rows = spark.read.schema(schemas.PROJECT).parquet(path).collect()
    assert {r.name for r in rows} == {"uno", "dos"} and len({r.id for r in rows}) == 2
    assert all(len(r.id) == 36 and len(r.created_at) == 19 for r in rows)
    turns = spark.createDataFrame(
        [("p", 1, 0, "user", "a"), ("q", 2, 0, "user", "b")],
        "project_id string, conv_id bigint, turn bigint, role string, text string",
    )
    projects.append_turns(turns, chat)
    projects.append_turns(turns.filter(F.col("project_id") == "p"), chat)
    assert projects.read_turns(spark, chat).count() == 2
    assert projects.clear_history(spark, chat, "p") is True
    assert [r.text for r in projects.read_turns(spark, chat).collect()] == ["b"]
