"""URL filter by a sort-merge range join.

A rule ``host/path`` fits its host, all subdomains, and every path that starts with its own. In the
canonical key, the host's labels from the top down and then the path, that is a prefix, and so an
interval of sorted keys. A page's key is formed for each of its parent domains that some rule may
name. Rules and keys are cut into the same ranges, a rule going to every range it reaches into, and
each range is swept in order with a stack of the rules that contain the current key; they are
nested, so the top one is the longest.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.folders import staged
from riskloom.operators.joins import lookup_join

#: Judged addresses that are broadcast; more are joined by a shuffle without the most frequent of them.
LOOKUP_BYTES = 16 << 20
#: Keys looked at to choose the ranges, for each range.
KEYS_PER_RANGE = 20
MOST_RANGES = 2000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = "\U0010ffff"


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path`` of ``url``; both are empty without ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), _UPPER, _LOWER),
        "path": F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1),
    })


def canonical_key(host: str, path: str) -> str:
    return ".".join(reversed(host.split("."))) + "/" + path


def page_keys(host: str, path: str, most_labels: int) -> list[str]:
    """The keys of a page under each of its parent domains of at most ``most_labels`` labels."""
    labels = host.rsplit(".", most_labels)
    known = labels[1:] if len(labels) > most_labels else labels
    return [canonical_key(".".join(known[i:]), path) for i in range(len(known))] if host else []


def _keys(batches, most_labels: int, bounds: list[str]):
    for batch in batches:
        rows = []
        for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for key in page_keys(host, path, most_labels):
                rows.append((bisect.bisect_right(bounds, key), key, 1, host, path, None))
        yield _table(rows)


def _rule_keys(batches, bounds: list[str]):
    for batch in batches:
        rows = []
        for rule in batch.column(0).to_pylist():
            host, slash, path = rule.partition("/")
            key = canonical_key(host, slash + path)
            first, last = bisect.bisect_right(bounds, key), bisect.bisect_right(bounds, key + _LAST)
            rows += [(at, key, 0, None, None, rule) for at in range(first, last + 1)]
        yield _table(rows)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
    names = ["span", "key", "kind", "host", "path", "rule"]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


_SCHEMA = "span int, key string, kind int, host string, path string, rule string"


def _sweep(batches):
    """Pages of a sorted run with the longest rule that contains each key."""
    stack: list[tuple[str, str]] = []
    at = None
    for batch in batches:
        rows = []
        for span, key, kind, host, path, rule in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if span != at:
                stack, at = [], span
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, rule))
            elif stack:
                rows.append((host, path, stack[-1][1]))
        columns = zip(*rows) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "path", "rule"])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages`` (url and other columns).

    ``rules`` has rule (``host/path``) and verdict. Of the rules that fit a page the longest wins,
    counted in characters; among equally long ones the greater string, and of a rule given twice
    the greater verdict. A page that no rule fits, or whose url is null or has no ``://``, gets a
    null rule and the default verdict. Rules that are null or have no host fit nothing. Columns of
    ``pages`` with these names are replaced; repeated rows stay.
    """
    spark = pages.sparkSession
    pages = with_host_and_path(pages.drop("host", "path", "rule", "verdict"))
    known = (
        rules.filter("rule IS NOT NULL AND rule NOT LIKE '/%' AND rule <> ''")
        .groupBy("rule").agg(F.max("verdict").alias("verdict"))
    )
    host_labels = F.size(F.split(F.regexp_extract("rule", r"\A([^/]*)", 1), r"\."))
    most_labels = known.agg(F.coalesce(F.max(host_labels), F.lit(0))).first()[0]
    distinct = pages.select("host", "path").filter("host <> ''").distinct()
    n_ranges = min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sample = (
        distinct.mapInArrow(lambda x: _keys(x, most_labels, []), _SCHEMA)
        .select("key").distinct()
        .orderBy(F.xxhash64("key")).limit(KEYS_PER_RANGE * n_ranges)
        .collect()
    )
    ordered = sorted(row.key for row in sample)
    bounds = ordered[KEYS_PER_RANGE::KEYS_PER_RANGE]

    keys = distinct.mapInArrow(lambda x: _keys(x, most_labels, bounds), _SCHEMA)
    intervals = known.select("rule").mapInArrow(lambda x: _rule_keys(x, bounds), _SCHEMA)
    hits = (
        keys.unionByName(intervals)
        .repartition(n_ranges, "span")
        .sortWithinPartitions("span", "key", "kind")
        .mapInArrow(_sweep, "host string, path string, rule string")
    )
    best = (
        hits.groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"))
    )
    judged = staged(best.join(known, "rule"), "url-verdicts")
    # Only pages with a host can have a rule; a host that very many share stays spread.
    ruled = lookup_join(pages.filter("host <> ''"), judged, ["host", "path"], "left", LOOKUP_BYTES)
    free = pages.filter("host = ''").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    return ruled.select(*free.columns).unionByName(free).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
