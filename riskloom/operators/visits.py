"""Web visits: blacklist enrichment, bot traffic, windows and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import lookup_join
from riskloom.schemas import BOT_TRAFFIC, TOP_SCRAPERS


def clean(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("ip").isNotNull())


def rejects(visits: DataFrame) -> DataFrame:
    return visits.filter(F.col("ip").isNull())


def one_row_per_ip(blacklist: DataFrame) -> DataFrame:
    """A repeated address must not multiply visits; the label that sorts first is kept."""
    return blacklist.groupBy("ip").agg(F.min("riesgo_historico").alias("riesgo_historico"))


def enrich(visits: DataFrame, blacklist: DataFrame) -> DataFrame:
    return lookup_join(visits, one_row_per_ip(blacklist), ["ip"], "left")


def bot_traffic(visits: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Declared bots and every visit from a blacklisted address."""
    suspicious = F.col("is_bot") | F.col("riesgo_historico").isNotNull()
    return enrich(visits, blacklist).filter(suspicious).select(*BOT_TRAFFIC.names)


def scraper_rollup(visits: DataFrame) -> DataFrame:
    """Pages, sessions with a user, and seconds per address."""
    return (
        visits.groupBy("ip")
        .agg(
            F.sum("pages_visited").alias("total_paginas_dia"),
            F.count("user_id").alias("total_sesiones_dia"),
            F.sum("session_duration").alias("tiempo_total_segundos"),
        )
        .select(*TOP_SCRAPERS.names)
    )


def top_scrapers(visits: DataFrame, n: int = 10) -> DataFrame:
    return scraper_rollup(visits).orderBy(F.desc_nulls_last("total_paginas_dia"), "ip").limit(n)


def with_event_time(visits: DataFrame) -> DataFrame:
    """Event time from the ISO text; a text that is no time gives NULL."""
    return visits.withColumn("event_time", F.try_to_timestamp("timestamp"))


def window_metrics(
    visits: DataFrame, width: str = "1 minute", delay: str = "1 minute"
) -> DataFrame:
    """Visits and mean pages per tumbling window; the same plan for a table and a stream."""
    return (
        with_event_time(visits)
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", width))
        .agg(
            F.count(F.lit(1)).cast("int").alias("total_visitas"),
            F.avg("pages_visited").alias("media_paginas"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "total_visitas",
            "media_paginas",
        )
    )


def latest_windows(metrics: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` windows in time order, as the load chart needs them."""
    newest = metrics.select("window_start", "total_visitas").orderBy(F.desc("window_start"))
    return newest.limit(n).orderBy("window_start")
