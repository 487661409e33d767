"""Node types and threat levels of connected groups."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four severity labels, most severe first.
CRITICAL = "🔴 CRÍTICO: Red Criminal"
ELEVATED = "🟠 ALTO: Botnet / Scraper"
SAFE = "🟢 SEGURO: Geografía Legítima"
INFO = "🟡 INFO: IP Doméstica Compartida"

# Node types as the hub report shows them.
NODE_IP = "IP"
NODE_COUNTRY = "PAIS"
NODE_USER = "USUARIO"


@dataclass(frozen=True)
class ThreatPolicy:
    """Markers are matched as substrings, safe members by equality, all in upper case."""

    critical_marks: tuple[str, ...] = ("FRAUD_", "222.15.")
    elevated_marks: tuple[str, ...] = ("GUEST_",)
    safe_members: tuple[str, ...] = ("ES", "FR", "IT", "DE", "US", "UK", "CN", "RU")


def contains_any(text: Column, marks: tuple[str, ...]) -> Column:
    return reduce(or_, [text.contains(mark) for mark in marks])


def level(critical: Column, elevated: Column, safe: Column) -> Column:
    """The severity ladder; the first condition that holds decides."""
    return F.when(critical, CRITICAL).when(elevated, ELEVATED).when(safe, SAFE).otherwise(INFO)


def member_list(text: Column) -> Column:
    """``"a, b"`` as an array of trimmed names."""
    return F.transform(F.split(text, ","), lambda name: F.trim(name))


def threat_level(members_text: Column, policy: ThreatPolicy = ThreatPolicy()) -> Column:
    """Severity of a ring exported as comma-separated text."""
    upper = F.upper(members_text)
    safe = F.arrays_overlap(member_list(upper), F.array(*map(F.lit, policy.safe_members)))
    return level(
        contains_any(upper, policy.critical_marks),
        contains_any(upper, policy.elevated_marks),
        safe,
    )


def is_dangerous(severity: Column, include_safe: bool = False) -> Column:
    """The list view keeps critical and elevated rings; the forensic view also keeps safe ones."""
    kept = (CRITICAL, ELEVATED, SAFE) if include_safe else (CRITICAL, ELEVATED)
    return severity.isin(*kept)


def node_type(node: Column) -> Column:
    """Type of a bare identifier: a dot means IP, two upper-case characters a country."""
    two_upper = (F.length(node) == 2) & (F.upper(node) == node) & (F.lower(node) != node)
    return F.when(node.contains("."), NODE_IP).when(two_upper, NODE_COUNTRY).otherwise(NODE_USER)
