"""URL rules by host and path, matched in one sorted sweep of reversed hosts.

A host's labels, reversed and each closed by a separator, make every rule's host a
prefix, and so an interval, of the keys of its subdomains. Intervals nest. Sorted by key,
a rule's start pushes it on the stack of active rules and its end pops it; a host sees
the stack of the event before it. The sweep runs over distinct hosts, dealt by their
first two labels and a hashed part, with those labels' rules; rules of one label are
below every stack of that label. Among the active rules of a host a page's longest one
whose path its own starts with decides.

Everything is DataFrame functions. Null urls and those without ``://`` have an empty host
and path, which no rule fits. Repeated pages get a row each. Of rules with equal host and
path the least action counts ("allow" before "block"); of fitting rules of equal length
the one with the longer host. Rules with a null or an empty host fit nothing. Empty tables
of pages or rules are fine. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts before all that hosts are made of, as _LAST sorts after it.
_CLOSE, _LAST = "\u0001", "\U0010ffff"
#: Parts of one domain's hosts, so that no domain fills a task.
SALTS = 16


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(action, host, path) rows."""
    rows = [
        F.struct(
            F.lit(action).alias("action"), F.lit(host).alias("host"), F.lit(path).alias("path")
        )
        for action, host, path in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to ``/``, ``?`` or ``#``, and from there to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def reversed_key(host: Column) -> Column:
    """``a.example.net`` as net, example, a, each closed by a separator."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), _CLOSE), F.lit(_CLOSE))


def _first_labels(key: Column, n: int) -> Column:
    return F.concat(F.substring_index(key, _CLOSE, n), F.lit(_CLOSE))


def judge_urls(
    pages: DataFrame, rules: DataFrame, *, otherwise: str = "allow", salts: int = SALTS
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    stacks = host_stacks(parsed.select("host").distinct(), rules, salts)
    fitting = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        parsed.join(stacks, "host", "left")
        .withColumn("best", F.array_max(fitting))
        .select(
            "page_id",
            "host",
            "path",
            F.concat(F.col("best.rule_host"), F.col("best.path")).alias("rule"),
            F.coalesce(F.col("best.action"), F.lit(otherwise)).alias("verdict"),
        )
    )


def host_stacks(hosts: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """(host, stack): the rules whose host's interval holds the host's key, if any."""
    stacks = _rule_stacks(rules)
    swept = hosts.where("host <> ''").withColumn("key", reversed_key(F.col("host")))
    points = swept.select(
        "host",
        "key",
        _first_labels(F.col("key"), 2).alias("domain"),
        F.pmod(F.xxhash64("host"), F.lit(salts)).alias("salt"),
        F.lit(1).alias("turn"),
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    events = _events(stacks).select(
        F.lit(None).cast("string").alias("host"),
        "key",
        _first_labels(F.col("key"), 2).alias("domain"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
        "turn",
        "stack",
    )
    active = (
        points.unionByName(events)
        .selectExpr(
            "host",
            "key",
            "last(stack, true) over (partition by domain, salt order by key, turn "
            "rows between unbounded preceding and current row) as stack",
        )
        .where("host is not null")
    )
    label = stacks.where(_labels("key") == 1).select(
        F.col("key").alias("label"), F.col("stack").alias("below")
    )
    return (
        active.withColumn("label", _first_labels(F.col("key"), 1))
        .join(label, "label", "left")
        .select("host", F.coalesce("stack", "below").alias("stack"))
        .where("stack is not null")
    )


def _labels(key: str) -> Column:
    return F.size(F.split(key, _CLOSE)) - 1


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): each distinct rule host with its own rules and all its ancestors'."""
    entry = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        F.col("host").alias("rule_host"),
        "path",
        "action",
    )
    own = (
        rules.where("host <> '' and path is not null and action is not null")
        .withColumn("host", F.translate("host", _UPPER, _LOWER))
        .groupBy("host", "path")
        .agg(F.min("action").alias("action"))
        .select(reversed_key(F.col("host")).alias("key"), entry.alias("entry"))
    )
    keys = own.select("key").distinct()
    prefixes = F.expr(
        f"transform(sequence(1, size(split(key, '{_CLOSE}')) - 1), "
        f"n -> concat(substring_index(key, '{_CLOSE}', n), '{_CLOSE}'))"
    )
    above = keys.select("key", F.explode(prefixes).alias("prefix"))
    return (
        above.join(own.withColumnRenamed("key", "prefix"), "prefix")
        .groupBy("key")
        .agg(F.collect_list("entry").alias("stack"))
    )


def _events(stacks: DataFrame) -> DataFrame:
    """(key, turn, stack): a push at an interval's start, a pop to what was below at its end.

    Ends come before the points of their key and starts too; only rules of two labels or
    more have events.
    """
    inner = stacks.where(_labels("key") > 1)
    n = F.length("key")
    rest = F.filter("stack", lambda r: F.length(r["rule_host"]) + 1 < n)
    push = inner.select("key", F.lit(0).alias("turn"), "stack")
    pop = inner.select(
        F.concat("key", F.lit(_LAST)).alias("key"), F.lit(0).alias("turn"), rest.alias("stack")
    )
    return push.unionAll(pop)


#: The query's rules: fixed values.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

ORACLE = """
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parsed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(action, rule_host, rule_path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best AS (
  SELECT page_id, host, path,
    (SELECT arg_max(struct_pack(rule := rule_host || rule_path, action := action), length(rule_host || rule_path))
     FROM rules
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS b
  FROM parsed)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.action, 'allow') AS verdict FROM best
"""
