"""Payments: cleaning, scoring and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.risk import BLOCKED, RiskPolicy, fraud_score, fraud_status
from riskloom.functions.text import money
from riskloom.operators.keyed import unseen
from riskloom.schemas import ALERT

ALL = "TODOS"
#: Optional column: when a payment happened or arrived.
EVENT_TIME = "event_time"


def clean(payments: DataFrame) -> DataFrame:
    """Amount as a number, rows without a transaction id removed."""
    return payments.withColumn("amount", F.expr("try_cast(amount AS double)")).filter(
        F.col("tx_id").isNotNull()
    )


def rejects(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("tx_id").isNull())


def score(payments: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    return payments.withColumn("score_fraude", fraud_score(policy)).withColumn(
        "status", fraud_status(F.col("score_fraude"), policy)
    )


def alerts(payments: DataFrame, policy: RiskPolicy = RiskPolicy()) -> DataFrame:
    """The serving table: scored payments with the stored columns, and their ``event_time`` if they have one."""
    times = [EVENT_TIME] if EVENT_TIME in payments.columns else []
    return score(clean(payments), policy).select(*ALERT.names, *times)


def with_status(alert_rows: DataFrame, status: str = ALL) -> DataFrame:
    return alert_rows if status == ALL else alert_rows.filter(F.col("status") == status)


def country_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("card_country").agg(F.count(F.lit(1)).alias("total_transacciones"))


def ranked_country_summary(payments: DataFrame) -> DataFrame:
    return country_summary(payments).orderBy(F.desc("total_transacciones"), "card_country")


def status_counts(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.groupBy("score_fraude", "status").agg(F.count(F.lit(1)).alias("n"))


def soc_kpis(alert_rows: DataFrame) -> DataFrame:
    """Analysed and blocked transactions and the amount saved, in one pass."""
    blocked = F.col("status") == BLOCKED
    saved = F.coalesce(F.sum(F.when(blocked, F.col("amount"))), F.lit(0.0))
    return alert_rows.agg(
        F.count(F.lit(1)).alias("analizadas"),
        F.count_if(blocked).alias("bloqueadas"),
        F.round(saved, 2).alias("dinero_salvado"),
    ).withColumn("dinero_salvado_texto", money(F.col("dinero_salvado")))


def blocked_by_country(alert_rows: DataFrame) -> DataFrame:
    return (
        with_status(alert_rows, BLOCKED)
        .groupBy("card_country")
        .agg(F.count(F.lit(1)).alias("bloqueadas"))
    )


def new_attacks(alert_rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Blocked transactions that were not shown before."""
    return unseen(with_status(alert_rows, BLOCKED), seen, "tx_id")


def latest_attacks(fresh: DataFrame, shown: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` rows on display: the new ones first, then those already shown."""
    both = fresh.withColumn("block", F.lit(0)).unionByName(shown.withColumn("block", F.lit(1)))
    return both.orderBy("block", F.desc("amount"), "tx_id").limit(n)
