"""The nightly batch: land what has arrived since the last close, export the reports, then the graph reports.

Each landing folder is a stream that is run until it has read what there is. Its checkpoint knows the
files already landed, so a file counts on one day only, whatever stays in the folder. Rows with a key
go to the history, others as they came to the quarantine, both under the number of their batch: a
batch that is run again after a failure replaces what it had written, under whatever day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.operators import graph, rings
from riskloom.operators import payments as pay
from riskloom.operators import visits as vis
from riskloom.operators.components import connected_components
from riskloom.sinks.files import export_csv
from riskloom.sources.files import decode_json
from riskloom.streaming.queries import ONCE
from riskloom.streaming.sources import file_events

PAYMENT_HISTORY = "historial_pagos"
VISIT_HISTORY = "historial_visitas"
_LINE = T.StructType([T.StructField("value", T.StringType())])
_PLACE = [T.StructField("batch_id", T.LongType()), T.StructField("batch_date", T.StringType())]


class CloseFailed(Exception):
    """Some landing folders could not be closed; the others were. ``failures`` has their errors."""

    def __init__(self, failures: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in failures.items()))
        self.failures = failures


@dataclass(frozen=True)
class Landing:
    """A folder of JSON lines, its history and its quarantine under ``target``."""

    name: str
    path: str
    schema: T.StructType
    key: str
    target: str
    clean_source: str | None = None
    archive_dir: str | None = None

    @property
    def history(self) -> str:
        return f"{self.target}/{self.name}"

    @property
    def quarantine(self) -> str:
        return f"{self.target}/cuarentena_{self.name.removeprefix('historial_')}"

    def land(self, spark: SparkSession, batch_date: str) -> None:
        """Read what is new in the folder; a folder that is not there has nothing new."""
        try:
            lines = file_events(
                spark, self.path, _LINE, "text",
                clean_source=self.clean_source, archive_dir=self.archive_dir,
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        writer = lines.writeStream.queryName(f"close-{self.name}").foreachBatch(self._saver(batch_date))
        place = f"{self.target}/_checkpoints/{self.name}"
        writer.option("checkpointLocation", place).trigger(**ONCE).start().awaitTermination()

    def _saver(self, batch_date: str) -> Callable[[DataFrame, int], None]:
        def save(lines: DataFrame, batch_id: int) -> None:
            rows = decode_json(lines.filter(F.trim("value") != ""), self.schema, keep=("value",))
            rows = rows.withColumn("batch_date", F.lit(batch_date)).persist()
            # The quarantine first: a history that is there is whole.
            for path, kept in (
                (self.quarantine, rows.filter(F.col(self.key).isNull()).select("value", "batch_date")),
                (self.history, rows.filter(F.col(self.key).isNotNull()).drop("value")),
            ):
                kept.write.mode("overwrite").partitionBy("batch_date").parquet(f"{path}/batch_id={batch_id}")
            rows.unpersist()

        return save

    def _stored(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        # Folders without a row have no schema of their own.
        whole = T.StructType([*schema.fields, *_PLACE])
        try:
            return spark.read.schema(whole).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], whole)

    def accepted(self, spark: SparkSession) -> DataFrame:
        """All rows of the history with their ``batch_date``."""
        return self._stored(spark, self.history, self.schema)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """All quarantined lines with their ``batch_date``."""
        return self._stored(spark, self.quarantine, _LINE)

    def day(self, spark: SparkSession, batch_date: str) -> tuple[DataFrame, int]:
        """The accepted rows of a day, and how many rows came that day."""
        rows = self.accepted(spark).filter(F.col("batch_date") == batch_date)
        refused = self.rejected(spark).filter(F.col("batch_date") == batch_date)
        return rows.select(*self.schema.names), rows.count() + refused.count()


def landings(
    payments_path: str, visits_path: str, target: str,
    clean_source: str | None = None, archive_dir: str | None = None,
) -> tuple[Landing, Landing]:
    """The two folders of the close. ``clean_source`` archives or deletes files once they are landed."""
    archives = [archive_dir and f"{archive_dir}/{name}" for name in ("pagos", "visitas")]
    return (
        Landing(PAYMENT_HISTORY, payments_path, schemas.PAYMENT, "tx_id", target, clean_source, archives[0]),
        Landing(VISIT_HISTORY, visits_path, schemas.VISIT, "ip", target, clean_source, archives[1]),
    )


def land_all(spark: SparkSession, folders: tuple[Landing, ...], batch_date: str) -> dict[str, Exception]:
    """Land every folder; the errors of those that failed. One folder does not stop another."""
    failures = {}
    for folder in folders:
        try:
            folder.land(spark, batch_date)
        except Exception as error:  # whatever it is, the other folders are landed
            failures[folder.name] = error
    return failures


def nightly_close(
    spark: SparkSession,
    payments_path: str,
    visits_path: str,
    target: str,
    batch_date: str,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> dict[str, int] | None:
    """Run the close of one day; None if no payments have arrived that day.

    Histories and quarantines are kept under ``<target>`` by day, reports as CSV in
    ``<target>/<report>``. A close that is run again adds what has arrived since and makes the
    reports anew. Returns the numbers of rows that came, rejected ones included. If a folder fails,
    the reports of the other are still made and :class:`CloseFailed` is raised.
    """
    folders = landings(payments_path, visits_path, target, clean_source, archive_dir)
    failures = land_all(spark, folders, batch_date)
    # A folder that failed may have left a table that cannot be read.
    days = {f.name: f.day(spark, batch_date) for f in folders if f.name not in failures}
    if PAYMENT_HISTORY in days:
        paid, n_paid = days[PAYMENT_HISTORY]
        if not n_paid and not failures:
            return None
        export_csv(pay.ranked_country_summary(paid), f"{target}/resumen_batch")
    if VISIT_HISTORY in days:
        seen, n_seen = days[VISIT_HISTORY]
        export_csv(vis.top_scrapers(seen), f"{target}/top_scrapers_batch")
    if failures:
        raise CloseFailed(failures)

    vertices, edges = graph.vertices(paid, seen), graph.edges(paid, seen)
    export_csv(graph.hot_nodes(edges), f"{target}/nodos_calientes")
    members = rings.ring_members(connected_components(vertices, edges))
    export_csv(rings.ranked_rings(rings.fraud_rings(members)), f"{target}/redes_detectadas")
    export_csv(members, f"{target}/redes_miembros")
    return {"payments": n_paid, "visits": n_seen}
