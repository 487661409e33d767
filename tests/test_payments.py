import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.risk import RiskPolicy
from riskloom.operators import payments as pay


def frame(spark, *rows):
    return spark.createDataFrame(rows, schemas.PAYMENT)


@pytest.mark.parametrize(
    "amount, country, method, expected",
    [
        (1000.0, "ES", "VISA", (0, "OK")),
        (1000.01, "ES", "VISA", (50, "SOSPECHOSO")),
        (10.0, "RU", "VISA", (50, "SOSPECHOSO")),
        (10.0, "ES", "Crypto", (20, "OK")),
        (10.0, "CN", "Crypto", (70, "SOSPECHOSO")),
        (2000.0, "CN", "VISA", (100, "BLOQUEADO")),
        (2000.0, "RU", "Crypto", (120, "BLOQUEADO")),
        (None, None, None, (0, "OK")),
        (2000.0, None, None, (50, "SOSPECHOSO")),
    ],
)
def test_score_and_status(spark, amount, country, method, expected):
    rows = frame(spark, ("t", "u", amount, "EUR", country, method, None))
    got = pay.alerts(rows).select("score_fraude", "status").first()
    assert tuple(got) == expected


def test_policy_parameters(spark):
    rows = frame(spark, ("t", "u", 30.0, "EUR", "XX", "cash", None))
    policy = RiskPolicy(amount_above=20, sanctioned=("XX",), risky_methods=("cash",))
    assert pay.alerts(rows, policy).first()["score_fraude"] == 120


def test_clean_routes_rows_without_id_to_rejects(spark):
    rows = frame(
        spark, ("a", "u", 1.0, "EUR", "ES", "VISA", False), (None, "u", 1.0, "EUR", "ES", "VISA", False)
    )
    assert [r.tx_id for r in pay.clean(rows).collect()] == ["a"]
    assert pay.rejects(rows).count() == 1


def test_amount_given_as_text(spark):
    rows = spark.createDataFrame([("a", "x1"), ("b", "7.5")], "tx_id string, amount string")
    got = {r.tx_id: r.amount for r in pay.clean(rows).collect()}
    assert got == {"a": None, "b": 7.5}


def test_kpis_of_an_empty_table(spark):
    got = pay.soc_kpis(pay.alerts(frame(spark))).first()
    assert tuple(got) == (0, 0, 0.0, "0.00")


def test_new_and_latest_attacks(spark):
    rows = frame(
        spark,
        *[(f"t{i}", "u", 2000.0 + i, "EUR", "RU", "VISA", True) for i in range(12)],
        ("ok", "u", 1.0, "EUR", "ES", "VISA", False),
    )
    alerts = pay.alerts(rows)
    seen = spark.createDataFrame([("t0",), ("t0",), ("t1",)], "tx_id string")
    fresh = pay.new_attacks(alerts, seen)
    assert {r.tx_id for r in fresh.collect()} == {f"t{i}" for i in range(2, 12)}
    shown = pay.with_status(alerts, "BLOQUEADO").join(seen.distinct(), "tx_id", "left_semi")
    few = fresh.filter(F.col("amount") > 2008)
    got = pay.latest_attacks(few, shown).collect()
    assert [r.tx_id for r in got] == ["t11", "t10", "t9", "t1", "t0"]
    assert pay.with_status(alerts).count() == 13
