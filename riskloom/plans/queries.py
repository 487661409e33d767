"""The check queries: every operator applied to the whole test tables.

Each takes the session and the table folder and returns a DataFrame; ``plans.oracles`` holds the
SQL that computes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import rasters as ras
from riskloom.functions import text as txt
from riskloom.functions.threat import member_list
from riskloom.operators import chunking, conversations, evaluation, graph, images, rings
from riskloom.operators import payments as pay
from riskloom.operators import retrieval as ret
from riskloom.operators import visits as vis
from riskloom.operators.components import connected_components as components_of
from riskloom.operators.embedding import CountSketch
from riskloom.operators.lateness import late_rows as late_report
from riskloom.operators.neighbours import Hyperplanes, best_ranked, block_join
from riskloom.operators.splits import stratified_split as split_rows
from riskloom.operators.training import candidate_heads, predict, train_heads
from riskloom.plans import views
from riskloom.plans.corpus import build_index, chunks_of
from riskloom.plans.nightly_close import CloseFailed, land_all, landings
from riskloom.session import new_folder
from riskloom.sinks import files as out
from riskloom.sinks import projects
from riskloom.sinks.index import read_index, write_upload
from riskloom.sources import files as src
from riskloom.streaming import queries as streams
from riskloom.streaming.observed import DROPPED, REJECTED, ROWS, run_until_idle, watched
from riskloom.streaming.sources import file_events

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

PROJECT_CREATED = "2026-01-01 00:00:00"
INSTRUCTIONS = "Responde solo con datos del contexto.\n\nContexto:\n"


def register(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    _REGISTRY[query.__name__] = run
    return query


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def joined(values: Column) -> Column:
    """An array of whole numbers as text."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


def milli(values: Column) -> Column:
    """Array of fractions as text, in thousandths."""
    return joined(F.transform(values, lambda v: F.round(v * 1000).cast("bigint")))


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    return pay.alerts(views.payments(spark, folder), views.POLICY)


# ---------------------------------------------------------------- payments


@register
def fraud_score(spark, folder):
    return _alerts(spark, folder)


@register
def fraud_status_counts(spark, folder):
    return pay.status_counts(_alerts(spark, folder))


@register
def alerts_with_status(spark, folder):
    return pay.with_status(_alerts(spark, folder), "SOSPECHOSO")


@register
def country_summary(spark, folder):
    return pay.ranked_country_summary(pay.clean(views.payments(spark, folder)))


@register
def soc_kpis(spark, folder):
    return pay.soc_kpis(_alerts(spark, folder))


@register
def blocked_by_country(spark, folder):
    return pay.blocked_by_country(_alerts(spark, folder))


def _seen(spark, folder):
    """Transactions of finished orders count as shown already."""
    return (
        views.table(spark, folder, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").cast("string").alias("tx_id"))
    )


@register
def new_attacks(spark, folder):
    return pay.new_attacks(_alerts(spark, folder), _seen(spark, folder))


@register
def latest_attacks(spark, folder):
    rows = _alerts(spark, folder)
    fresh = pay.new_attacks(rows, _seen(spark, folder))
    shown = pay.with_status(rows, "BLOQUEADO").join(_seen(spark, folder), "tx_id", "left_semi")
    return pay.latest_attacks(fresh, shown)


# ---------------------------------------------------------------- decoding


def _payment_lines(spark, folder):
    """Payments as JSON text: open orders are damaged, urgent ones have a text as amount."""
    rows = views.payments(spark, folder)
    good = F.to_json(F.struct(*schemas.PAYMENT.names))
    odd = F.to_json(
        F.struct(
            *[F.lit("n/a").alias("amount") if c == "amount" else F.col(c)
              for c in schemas.PAYMENT.names]
        )
    )
    damaged = F.concat(F.lit("#"), good)
    return rows.select(
        F.when(F.col("flag_ataque"), damaged)
        .when(F.col("method") == "1-URGENT", odd)
        .otherwise(good)
        .alias("value")
    )


@register
def decode_events_json(spark, folder):
    decoded = src.decode_json(_payment_lines(spark, folder), schemas.PAYMENT)
    return decoded.withColumn("flag_ataque", F.col("flag_ataque").cast("string"))


@register
def payments_from_json(spark, folder):
    """Payments written as JSON lines and read with the fixed schema; damaged lines are rows of NULLs."""
    path = f"{new_folder(spark, 'json')}/pagos"
    _payment_lines(spark, folder).write.text(path)
    return src.read_payments_json(spark, path).groupBy("card_country", "method").agg(
        F.count(F.lit(1)).alias("n"), F.count("tx_id").alias("n_keys"), F.count("amount").alias("n_amounts"),
        F.round(F.sum("amount"), 2).alias("total"),
    )


@register
def visits_from_text(spark, folder):
    path = f"{new_folder(spark, 'text')}/visitas"
    _visit_lines(spark, folder).write.text(path)
    return src.read_visits_text(spark, path)


@register
def missing_blacklist(spark, folder):
    """Without the file of addresses only visits of bots are kept, none with a risk."""
    absent = src.read_blacklist(spark, f"{new_folder(spark, 'absent')}/blacklist.csv")
    return vis.bot_traffic(views.visits(spark, folder), absent)


@register
def payment_rejects(spark, folder):
    decoded = src.decode_json(_payment_lines(spark, folder), schemas.PAYMENT)
    rejected = pay.rejects(decoded).agg(F.count(F.lit(1)).alias("n"))
    kept = pay.clean(decoded).agg(F.count(F.lit(1)).alias("n"))
    return rejected.select(F.lit("rejected").alias("outcome"), "n").unionByName(
        kept.select(F.lit("kept").alias("outcome"), "n")
    )


def _visit_lines(spark, folder):
    """Visits as JSON text, those of people with the frame prefix."""
    prefix = F.when(F.col("is_bot"), "").otherwise("data: ")
    line = F.concat(prefix, F.to_json(F.struct(*schemas.VISIT.names)))
    return views.visits(spark, folder).select(line.alias("value"))


@register
def strip_frame_prefix(spark, folder):
    return src.decode_json(_visit_lines(spark, folder), schemas.VISIT)


@register
def history_messages(spark, folder):
    """Chat messages through their stored JSON form and back."""
    stored = views.table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.to_json(
            F.struct(
                F.when(F.col("role") == "user", "human").otherwise("ai").alias("type"),
                F.struct(F.col("text").alias("content")).alias("data"),
            )
        ).alias("value"),
    )
    message = F.from_json("value", schemas.MESSAGE)
    return stored.withColumn("m", message).select(
        "conv_id",
        "turn",
        txt.chat_role(F.col("m.type")).alias("role"),
        F.coalesce("m.data.content", F.lit("")).alias("text"),
    )


# ---------------------------------------------------------------- visits


@register
def bot_traffic(spark, folder):
    return vis.bot_traffic(views.visits(spark, folder), views.blacklist(spark, folder))


@register
def scraper_rollup(spark, folder):
    return vis.scraper_rollup(vis.clean(views.visits(spark, folder)))


@register
def top_scrapers(spark, folder):
    return vis.top_scrapers(vis.clean(views.visits(spark, folder)))


def _plain_windows(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "total_visitas",
        F.round("media_paginas", 6).alias("media_paginas"),
    )


@register
def window_metrics(spark, folder):
    return _plain_windows(vis.window_metrics(views.visits(spark, folder)))


@register
def window_series(spark, folder):
    series = vis.latest_windows(vis.window_metrics(views.visits(spark, folder)))
    return series.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register
def late_rows(spark, folder):
    """Orders arrive by key, 1000 to a batch; the event time is the order date."""
    arrivals = views.table(spark, folder, "orders").select(
        F.floor(F.col("o_orderkey") / 1000).alias("batch"), "o_orderdate"
    )
    return late_report(arrivals, "batch", "o_orderdate", "365 days")


# ---------------------------------------------------------------- streaming


def _stream(spark, folder, name):
    """A table as a stream of files; the pattern fits one file as well as a folder of them."""
    schema = views.table(spark, folder, name).schema
    return file_events(spark, f"{folder}/{name}[.]parquet", schema)


@register
def fraud_alerts_stream(spark, folder):
    root = new_folder(spark, "fraud-alerts")
    arriving = views.as_payments(
        _stream(spark, folder, "orders"),
        views.table(spark, folder, "customer"),
        views.table(spark, folder, "nation"),
    )
    sink = streams.alert_sink(root)
    sink.start(pay.alerts(arriving, views.POLICY), streams.ONCE).awaitTermination()
    return sink.read(spark)


@register
def bot_traffic_stream(spark, folder):
    root = new_folder(spark, "bot-traffic")
    arriving = views.as_visits(_stream(spark, folder, "events"))
    sink = streams.bot_sink(root)
    rows = vis.bot_traffic(arriving, views.blacklist(spark, folder))
    sink.start(rows, streams.ONCE).awaitTermination()
    return sink.read(spark)


@register
def window_metrics_stream(spark, folder):
    root = new_folder(spark, "window-metrics")
    arriving = views.as_visits(_stream(spark, folder, "events"))
    sink = streams.window_sink(root)
    sink.start(vis.window_metrics(arriving), streams.ONCE).awaitTermination()
    return _plain_windows(sink.read(spark))


@register
def observed_streams(spark, folder):
    """The three streams side by side on a processing-time trigger; what they read, refused and hold.

    Payments of attackers come without their id.
    """
    root = new_folder(spark, "observed")
    payments = views.as_payments(
        _stream(spark, folder, "orders"),
        views.table(spark, folder, "customer"),
        views.table(spark, folder, "nation"),
    ).withColumn("tx_id", F.when(~F.col("flag_ataque"), F.col("tx_id")))
    visits = views.as_visits(_stream(spark, folder, "events"))
    often = {"processingTime": "1 second"}
    with watched(spark) as totals:
        started = streams.start_all(
            payments, visits, views.blacklist(spark, folder), root, views.POLICY, often, often
        )
        run_until_idle(spark, started)
    parts = []
    for sink in (streams.alert_sink(root), streams.bot_sink(root), streams.window_sink(root)):
        own = totals.of(sink.name)
        parts.append(sink.read(spark).agg(F.count(F.lit(1)).alias("n_held")).select(
            F.lit(sink.name).alias("name"), *[F.lit(own[c]).cast("bigint").alias(c) for c in (ROWS, REJECTED, DROPPED)],
            "n_held",
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def dedup_stream(spark, folder):
    """Every event arrives twice and is kept once."""
    root = new_folder(spark, "dedup")
    arriving = _stream(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"
    )
    twice = arriving.unionByName(arriving)
    once = streams.deduplicated(twice, "event_id", "ts")
    streams.append_files(once, root, "events", streams.ONCE).awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{root}/events").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


@register
def incremental_close(spark, folder):
    """The landing folder is read twice with one checkpoint; the second run finds nothing new."""
    root = new_folder(spark, "close")
    for _ in range(2):
        arriving = _stream(spark, folder, "orders")
        streams.append_files(arriving, root, "orders", streams.ONCE).awaitTermination()
    landed = spark.read.schema(views.table(spark, folder, "orders").schema)
    return landed.parquet(f"{root}/orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("n_keys")
    )


@register
def two_day_close(spark, folder):
    """Two nights over landing folders that keep their files; each row counts on the day it came.

    Payments of even customers and visits of even users come on the first day.
    """
    root = new_folder(spark, "two-days")
    folders = landings(f"{root}/pagos/*", f"{root}/visitas/*", root)
    number = F.regexp_extract("value", r'"user_id":"[UV](\d+)"', 1).cast("bigint") % 2
    for day in (0, 1):
        for name, lines in (("pagos", _payment_lines), ("visitas", _visit_lines)):
            lines(spark, folder).filter(number == day).write.text(f"{root}/{name}/{day}")
        if failures := land_all(spark, folders, f"2026-01-0{day + 1}"):
            raise CloseFailed(failures)
    parts = [
        rows.groupBy("batch_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_distinct"))
        .select(F.lit(name).alias("source"), F.lit(outcome).alias("outcome"), "batch_date", "n", "n_distinct")
        for name, landing in zip(("pagos", "visitas"), folders)
        for outcome, rows, key in (
            ("kept", landing.accepted(spark), landing.key), ("rejected", landing.rejected(spark), "value")
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---------------------------------------------------------------- sinks


@register
def keyed_upsert(spark, folder):
    """Last order per customer: finished orders arrive first, all others in a second batch."""
    root = new_folder(spark, "upsert")
    orders = views.table(spark, folder, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"
    )
    finished = F.col("o_orderstatus") == "F"
    sink = streams.KeyedSink(root, "last_order", orders.schema, ("o_custkey",), ("o_orderdate", "o_orderkey"))
    for number, rows in enumerate([orders.filter(finished), orders.filter(~finished)]):
        rows.write.parquet(f"{root}/arriving/{number}")
        stream = file_events(spark, f"{root}/arriving/*", orders.schema)
        sink.start(stream, streams.ONCE).awaitTermination()
    return sink.read(spark)


@register
def csv_roundtrip(spark, folder):
    path = f"{new_folder(spark, 'export')}/country_summary"
    out.export_csv(pay.ranked_country_summary(views.payments(spark, folder)), path)
    return src.read_csv_or_empty(spark, path, schemas.COUNTRY_SUMMARY)


@register
def history_by_date(spark, folder):
    """Appended history: writing a period again replaces that period only."""
    path = f"{new_folder(spark, 'history')}/payments"
    orders = views.table(spark, folder, "orders").withColumn(
        "batch_year", F.year("o_orderdate")
    )
    out.append_partition(orders, path, "batch_year")
    out.append_partition(orders.filter(F.col("batch_year") >= 1996), path, "batch_year")
    stored = spark.read.schema(orders.schema).parquet(path)
    return stored.groupBy("batch_year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@register
def tenant_purge(spark, folder):
    """Rows per project after one project was removed from the stored table."""
    path = f"{new_folder(spark, 'tenants')}/documents"
    rows = views.documents(spark, folder)
    out.append_partition(rows, path, "project_id")
    existed = out.purge_project(spark, path, "es")
    again = out.purge_project(spark, path, "es")
    left = spark.read.schema(rows.schema).parquet(path).groupBy("project_id")
    return left.agg(F.count(F.lit(1)).alias("n")).select(
        "project_id", "n", F.lit(existed).alias("existed"), F.lit(again).alias("existed_again")
    )


# ---------------------------------------------------------------- graph


def _graph(spark, folder):
    paid, seen = pay.clean(views.payments(spark, folder)), vis.clean(views.visits(spark, folder))
    return graph.vertices(paid, seen), graph.edges(paid, seen)


@register
def graph_vertices(spark, folder):
    return _graph(spark, folder)[0]


@register
def graph_edges(spark, folder):
    return _graph(spark, folder)[1]


@register
def graph_degrees(spark, folder):
    return graph.degrees(_graph(spark, folder)[1])


@register
def hot_nodes(spark, folder):
    return graph.hot_nodes(_graph(spark, folder)[1])


@register
def hot_addresses(spark, folder):
    return graph.of_type(graph.hot_nodes(_graph(spark, folder)[1]), "IP")


def _folded_graph(spark, folder):
    """The vertices and folded edges of :func:`_graph`; payments and visits are read once."""
    paid, seen = pay.clean(views.payments(spark, folder)), vis.clean(views.visits(spark, folder))
    pairs = graph.folded(paid, seen)
    return graph.vertices(*pairs), graph.folded_edges(*pairs)


def _rings(spark, folder):
    vertices, edges = _folded_graph(spark, folder)
    return rings.ring_members(components_of(vertices, edges)), edges


@register
def connected_components(spark, folder):
    return components_of(*_folded_graph(spark, folder))


@register
def fraud_rings(spark, folder):
    return rings.ranked_rings(rings.fraud_rings(_rings(spark, folder)[0]))


@register
def ring_lookup(spark, folder):
    return rings.ring_lookup(_rings(spark, folder)[0], "ip:10.0.1.0")


@register
def ring_members(spark, folder):
    return _rings(spark, folder)[0]


@register
def ring_triage(spark, folder):
    members = _rings(spark, folder)[0]
    severity = rings.ring_severity(members, views.THREATS)
    return rings.triage(members, severity)


@register
def ring_severity(spark, folder):
    return rings.ring_severity(_rings(spark, folder)[0], views.THREATS)


@register
def ring_topology(spark, folder):
    return rings.ring_topology(_rings(spark, folder)[0])


@register
def ring_node_types(spark, folder):
    return rings.ring_node_types(_rings(spark, folder)[0])


@register
def ring_edges(spark, folder):
    return rings.ring_edges(*_rings(spark, folder))


# ---------------------------------------------------------------- text


@register
def supported_documents(spark, folder):
    return src.supported(views.documents(spark, folder)).select("doc_id", "project_id", "source")


@register
def chunks_fixed(spark, folder):
    return chunking.chunk_fixed(views.documents(spark, folder).select("doc_id", "text"))


@register
def chunks_recursive(spark, folder):
    return chunking.chunk_recursive(views.documents(spark, folder).select("doc_id", "text"))


@register
def chunks_rebuilt(spark, folder):
    """What every splitting must hold: length, numbering, and all signs but blanks, once and in order."""
    rows = views.documents(spark, folder).select("doc_id", "text")
    apart = chunking.chunk_recursive(rows, overlap=0)
    plain = lambda text: F.md5(F.regexp_replace(text, r"\s", ""))
    ordered = F.array_sort(F.collect_list(F.struct("chunk_no", "text")))
    return apart.groupBy("doc_id").agg(
        (F.max(F.length("text")) <= 500).alias("short"),
        (F.max("chunk_no") + 1 == F.count_distinct("chunk_no")).alias("numbered"),
        plain(F.concat_ws("", F.transform(ordered, lambda c: c["text"]))).alias("signs"),
    )


@register
def chunk_counts(spark, folder):
    return chunking.chunk_counts(chunking.chunk_fixed(views.documents(spark, folder)))


@register
def text_stats(spark, folder):
    text = F.col("text")
    return views.documents(spark, folder).select(
        "doc_id",
        txt.word_count(text).alias("n_words"),
        F.length(text).alias("n_chars"),
        txt.text_statistics(text).alias("summary"),
    )


@register
def project_registry(spark, folder):
    """One project per language; the id is a digest of the name so that runs agree."""
    names = views.documents(spark, folder).select(F.col("project_id").alias("name")).distinct()
    return names.select(
        F.md5("name").alias("id"), "name", F.lit(PROJECT_CREATED).alias("created_at")
    )


@register
def registered_projects(spark, folder):
    """Languages registered in two goes; every project has an id of its own and a time."""
    path = f"{new_folder(spark, 'registered')}/projects"
    names = views.documents(spark, folder).select(F.col("project_id").alias("name")).distinct()
    for chosen in (F.col("name") < "es", F.col("name") >= "es"):
        projects.register_projects(names.filter(chosen), path)
    stored = spark.read.schema(schemas.PROJECT).parquet(path)
    return stored.groupBy("name").agg(
        F.count_distinct("id").alias("n_ids"), F.max(F.length("id")).alias("id_length"),
        F.every(F.try_to_timestamp("created_at", F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()).alias("timed"),
    )


@register
def exported_members(spark, folder):
    """Exported lists of a country's addresses: read as lists, compared with the listed addresses."""
    visits = views.visits(spark, folder)
    listed = F.array_sort(F.collect_set("ip"))
    groups = visits.groupBy("user_id").agg(F.concat_ws(" , ", listed).alias("miembros"))
    marked = F.array(*[F.lit(f"10.0.{i}.{i}") for i in range(40)])
    names = member_list(F.col("miembros"))
    return groups.select(
        "user_id", F.size(names).alias("n_members"), F.array_max(names).alias("last_member"),
        F.arrays_overlap(names, marked).alias("marked"),
    )


@register
def project_files(spark, folder):
    supported = src.supported(views.documents(spark, folder))
    known = views.documents(spark, folder).select("project_id").distinct()
    without = supported.filter(F.col("project_id") != "es")
    return conversations.project_files(without, known)


@register
def history_window(spark, folder):
    messages = views.table(spark, folder, "conversations")
    return conversations.history_window(messages, limit=200).select(
        "conv_id", "turn", "role", "tokens", "running_tokens", "to_summarise"
    )


@register
def history_append(spark, folder):
    """Chat turns appended in two writes, the second repeating the user turns; one project cleared."""
    path = f"{new_folder(spark, 'chat')}/turns"
    turns = views.table(spark, folder, "conversations").select(
        F.concat(F.lit("p"), F.pmod("conv_id", F.lit(4)).cast("string")).alias("project_id"),
        "conv_id", "turn", "role", "text",
    )
    projects.append_turns(turns, path)
    projects.append_turns(turns.filter(F.col("role") == "user"), path)
    projects.clear_history(spark, path, "p0")
    return projects.read_turns(spark, path).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@register
def hashed_embeddings(spark, folder):
    rows = views.documents(spark, folder).select("doc_id", "text")
    return CountSketch().fit(rows).transform(rows).select(
        "doc_id", F.size("vector").alias("width"), joined(F.transform("vector", lambda v: v.cast("bigint"))).alias("vector")
    )


# ---------------------------------------------------------------- retrieval

# All but corpus_search and index_reupload search the documents that have a stored vector: the
# ``embeddings`` table alone is their corpus, as in their SQL.


def _plain_hits(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "chunk_id", F.round("similarity", 6).alias("similarity"), "rank")


@register
def knn_exact(spark, folder):
    hits = ret.nearest(views.questions(spark, folder), views.passages(spark, folder), vectors=False)
    return _plain_hits(hits)


@register
def knn_filtered(spark, folder):
    """Each question searches only the file its own number lies in."""
    queries = views.questions(spark, folder).withColumn("source_filter", F.col("own_source"))
    hits = ret.nearest(queries, views.passages(spark, folder), vectors=False)
    return _plain_hits(hits)


def _sampled_vectors(spark, folder):
    """Every hundredth stored vector as a query, all of them as rows."""
    rows = views.vectors(spark, folder).select(
        "id", F.lit("all").alias("key"), F.lit(None).cast("string").alias("label"), "vector"
    )
    return rows.filter(F.col("id") % 100 == 0), rows


@register
def knn_all(spark, folder):
    """Every hundredth stored vector against all of them."""
    hits = best_ranked(block_join(*_sampled_vectors(spark, folder), 10), 10)
    return _plain_hits(hits)


@register
def lsh_recall(spark, folder):
    """Whether search by hyperplane signatures finds nine in ten of the rows of ``knn_all``."""
    queries, rows = _sampled_vectors(spark, folder)
    exact = best_ranked(block_join(queries, rows, 10), 10).select("query_id", "chunk_id")
    found = Hyperplanes().nearest(queries, rows, 10).select("query_id", "chunk_id", F.lit(1).alias("hit"))
    return exact.join(found, ["query_id", "chunk_id"], "left").agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count(F.lit(1)).alias("n_wanted"),
        (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("reached"),
    )


def _retrieved(spark, folder):
    return ret.retrieve(views.questions(spark, folder), views.passages(spark, folder))


@register
def mmr(spark, folder):
    return _retrieved(spark, folder).select("query_id", "chunk_id", "rank", "pick")


@register
def context_table(spark, folder):
    return ret.context_table(_retrieved(spark, folder))


@register
def source_footer(spark, folder):
    return ret.source_footer(_retrieved(spark, folder))


@register
def no_index_answers(spark, folder):
    """After the Spanish project was purged its questions get the explicit message."""
    corpus = views.passages(spark, folder).filter(F.col("project_id") != "es")
    queries = views.questions(spark, folder)
    footers = ret.source_footer(ret.retrieve(queries, corpus))
    return ret.answers(queries, corpus, footers)


@register
def prompt_messages(spark, folder):
    questions = views.questions(spark, folder)
    contexts = ret.context_table(_retrieved(spark, folder))
    messages = views.table(spark, folder, "conversations")
    return conversations.prompt_messages(
        questions, messages, contexts, project_files(spark, folder), INSTRUCTIONS, limit=200
    )


@register
def corpus_search(spark, folder):
    """Text to picked chunks: all supported documents and all questions are embedded alike."""
    path = f"{new_folder(spark, 'index')}/chunks"
    index, encoder = build_index(views.documents(spark, folder), path)
    asked = views.asked(spark, folder).withColumnRenamed("question", "text")
    picked = ret.retrieve(encoder.transform(asked), index)
    return picked.select("query_id", "pick", "rank", "chunk_id", "source", F.col("page").cast("string").alias("page"))


@register
def index_reupload(spark, folder):
    """Chunks per source after the text files were uploaded again in larger chunks."""
    path = f"{new_folder(spark, 'index')}/chunks"
    pages = views.documents(spark, folder)
    again = pages.filter(F.col("source").endswith(".txt"))
    columns = ["chunk_id", "project_id", "source", "page", "text"]
    first = chunks_of(pages).select(*columns)
    write_upload(first, path, 0)
    write_upload(chunks_of(again, 1000, 100).select(*columns), path, 1)
    return chunking.chunk_counts(read_index(spark, path, first.schema))


# ---------------------------------------------------------------- rasters and training data


@register
def dataset_profile(spark, folder):
    return images.dataset_profile(views.rasters(spark, folder))


def _labelled(spark, folder):
    return views.rasters(spark, folder).withColumn("label", ras.first_label(F.col("label")))


@register
def class_distribution(spark, folder):
    return images.class_distribution(_labelled(spark, folder))


@register
def class_weights(spark, folder):
    weights = images.class_weights(_labelled(spark, folder))
    return weights.withColumn("weight", F.round("weight", 9))


@register
def first_samples(spark, folder):
    return images.first_samples(_labelled(spark, folder)).select(
        "id", ras.class_name(F.col("label")).alias("class_name"),
        joined(F.col("pixels")).alias("pixels"),
    )


@register
def stratified_split(spark, folder):
    return split_rows(views.vectors(spark, folder).select("id", "label"), "id")


@register
def scaled_rasters(spark, folder):
    return views.rasters(spark, folder).select(
        "id", milli(ras.scale(F.col("pixels"))).alias("scaled_milli")
    )


@register
def centred_rasters(spark, folder):
    """Every value is widened to a pixel of three channels first."""
    rgb = F.flatten(
        F.transform("pixels", lambda p: F.array(p, 255 - p, F.floor(p / 2).cast("int")))
    )
    return views.rasters(spark, folder).select(
        "id", milli(ras.preprocess_pretrained(rgb, 64)).alias("centred_milli")
    )


@register
def flip_horizontal(spark, folder):
    return images.random_flip(_labelled(spark, folder), 8, 8, 1).select(
        "id", joined(F.col("pixels")).alias("pixels")
    )


@register
def shift_nearest(spark, folder):
    moved = images.random_shift(_labelled(spark, folder), 8, 8, 1, factor=0.25)
    return moved.select("id", milli(F.col("pixels")).alias("pixels_milli"))


@register
def upsample(spark, folder):
    return views.rasters(spark, folder).select(
        "id", joined(ras.upsample(F.col("pixels"), 8, 8, 1, 3)).alias("pixels")
    )


# ---------------------------------------------------------------- evaluation


def _predicted(spark, folder):
    return views.rule_predictions(spark, folder).withColumn(
        "prediction", ras.argmax(F.col("probabilities"))
    )


def _long_text(spark, folder):
    return _predicted(spark, folder).filter(F.col("model") == "long text")


@register
def argmax_predictions(spark, folder):
    return _predicted(spark, folder).select("model", "id", "label", "prediction")


@register
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_long_text(spark, folder), [0, 1, 2])


@register
def classification_report(spark, folder):
    report = evaluation.classification_report(_long_text(spark, folder))
    return report.select(
        "class",
        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1_score")],
        "support",
    )


@register
def log_loss(spark, folder):
    return evaluation.test_metrics(_long_text(spark, folder)).select(
        F.round("test_loss", 9).alias("test_loss"),
        F.round("test_accuracy", 9).alias("test_accuracy"),
        "n_rows",
    )


@register
def model_comparison(spark, folder):
    return evaluation.model_comparison(_predicted(spark, folder)).select(
        "modelo",
        F.round("test_loss", 9).alias("test_loss"),
        F.round("test_accuracy", 9).alias("test_accuracy"),
        "n_rows",
    )


@register
def trained_heads(spark, folder):
    """Two heads trained on 80 % of the vectors and compared on the rest."""
    path = f"{new_folder(spark, 'heads')}/split"
    rows = split_rows(views.vectors(spark, folder), "id")
    rows.write.parquet(path)
    parts = spark.read.schema(rows.schema).parquet(path)
    train = parts.filter(F.col("split") == "train")
    validation = parts.filter(F.col("split") == "validation")
    models = train_heads(train, candidate_heads(width=64, classes=10))
    scored = None
    for name, model in models.items():
        rows = predict(model, validation, name)
        scored = rows if scored is None else scored.unionByName(rows)
    # One row per model, so that the window is small; no model is scored twice.
    best = F.first("modelo").over(Window.orderBy("test_loss", "modelo"))
    return evaluation.model_comparison(scored).withColumn("best", best).select(
        "modelo",
        F.round("test_loss", 6).alias("test_loss"),
        F.round("test_accuracy", 6).alias("test_accuracy"),
        "n_rows",
        (F.col("modelo") == F.col("best")).alias("chosen"),
    )
