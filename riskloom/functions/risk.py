"""Rule-based transaction scoring."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status labels stored with every scored transaction.
BLOCKED = "BLOQUEADO"
SUSPICIOUS = "SOSPECHOSO"
ACCEPTED = "OK"


@dataclass(frozen=True)
class RiskPolicy:
    """Rule parameters. The defaults are the fixed values of the scoring contract."""

    amount_above: float = 1000.0
    sanctioned: tuple[str, ...] = ("RU", "CN")
    risky_methods: tuple[str, ...] = ("Crypto",)
    amount_points: int = 50
    country_points: int = 50
    method_points: int = 20
    blocked_from: int = 100
    suspicious_from: int = 50

    def rules(self) -> list[tuple[Column, int]]:
        return [
            (F.col("amount") > self.amount_above, self.amount_points),
            (F.col("card_country").isin(*self.sanctioned), self.country_points),
            (F.col("method").isin(*self.risky_methods), self.method_points),
        ]


def additive_score(rules: Iterable[tuple[Column, int]]) -> Column:
    """Sum the points of the rules that hold; a rule whose predicate is NULL adds nothing."""
    return reduce(add, [F.when(p, points).otherwise(0) for p, points in rules])


def bucket(value: Column, cuts: Sequence[tuple[int, str]], rest: str) -> Column:
    """Label of the first cut that ``value`` reaches; order the cuts from high to low."""
    chain = F
    for lower, label in cuts:
        chain = chain.when(value >= lower, label)
    return chain.otherwise(rest)


def fraud_score(policy: RiskPolicy = RiskPolicy()) -> Column:
    return additive_score(policy.rules()).cast("int")


def fraud_status(score: Column, policy: RiskPolicy = RiskPolicy()) -> Column:
    cuts = [(policy.blocked_from, BLOCKED), (policy.suspicious_from, SUSPICIOUS)]
    return bucket(score, cuts, ACCEPTED)
