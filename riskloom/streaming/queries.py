"""The streaming queries: scored payments, bot traffic and window metrics as serving tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas
from riskloom.functions.risk import RiskPolicy
from riskloom.operators import payments as pay
from riskloom.operators import visits as vis
from riskloom.sinks.keyed import last_by_key, read_state
from riskloom.streaming.observed import observed

ONCE = {"availableNow": True}
EVERY_10_SECONDS = {"processingTime": "10 seconds"}


@dataclass(frozen=True)
class KeyedSink:
    """A table with one row per key, held as the state of its query under ``root``."""

    root: str
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    sort_by: Sequence = field(default=())

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoints/{self.name}"

    def start(self, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        """Update-mode query; a restart with the same checkpoint adds nothing twice."""
        writer = (
            last_by_key(stream, self.keys, self.order)
            .writeStream.queryName(self.name)
            .outputMode("update")
            .format("noop")
            .option("checkpointLocation", self.checkpoint)
        )
        return (writer.trigger(**trigger) if trigger else writer).start()

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the last committed batch; with ``sort_by``, sorted within each first key."""
        rows = read_state(spark, self.checkpoint, self.schema)
        if self.sort_by:
            rows = rows.repartition(self.keys[0]).sortWithinPartitions(*self.sort_by)
        return rows


@dataclass(frozen=True)
class AppendSink:
    """A table whose stream gives every key once: files, appended exactly once."""

    root: str
    name: str
    schema: T.StructType

    def start(self, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return append_files(stream, self.root, self.name, trigger)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the last committed batch, empty before the first."""
        try:
            return spark.read.schema(self.schema).parquet(f"{self.root}/{self.name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)


def alert_sink(root: str) -> KeyedSink:
    """The last score of a payment; where payments carry an ``event_time``, by that."""
    return KeyedSink(root, "alertas_fraude", schemas.ALERT, ("tx_id",), (pay.EVENT_TIME,))


def bot_sink(root: str) -> KeyedSink:
    newest_first = ("user_id", F.desc("timestamp"))
    return KeyedSink(root, "trafico_bot", schemas.BOT_TRAFFIC, ("user_id", "timestamp"), sort_by=newest_first)


def window_sink(root: str) -> AppendSink:
    """A window is given out once, when the watermark has passed it."""
    return AppendSink(root, "metricas_ventanas", schemas.WINDOW_METRIC)


def append_files(
    stream: DataFrame, root: str, name: str, trigger: dict | None = None
) -> StreamingQuery:
    """Exactly-once append of all rows to Parquet files; used for quarantined rows and landing."""
    writer = (
        stream.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", f"{root}/{name}")
        .option("checkpointLocation", f"{root}/_checkpoints/{name}")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def deduplicated(
    stream: DataFrame, key: str, event_time: str, delay: str = "1 minute"
) -> DataFrame:
    """One row per key; state is dropped once the watermark has passed it.

    Copies are left to the state store: a copy that is late is dropped as a late row and must not
    stand for one that is on time.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def start_all(
    payments: DataFrame,
    visits: DataFrame,
    blacklist: DataFrame,
    root: str,
    policy: RiskPolicy = RiskPolicy(),
    trigger: dict | None = None,
    window_trigger: dict | None = EVERY_10_SECONDS,
) -> list[StreamingQuery]:
    """Start the three queries; ``visits`` feeds two of them. Each tells how many rows lack their key."""
    alerts, bots, windows = alert_sink(root), bot_sink(root), window_sink(root)
    payments = observed(payments, alerts.name, F.col("tx_id").isNull())
    no_address = F.col("ip").isNull()
    return [
        alerts.start(pay.alerts(payments, policy), trigger),
        bots.start(vis.bot_traffic(observed(visits, bots.name, no_address), blacklist), trigger),
        windows.start(vis.window_metrics(observed(visits, windows.name, no_address)), window_trigger),
    ]
