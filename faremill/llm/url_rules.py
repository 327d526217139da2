"""URL rules by a sort-merge range join, in DataFrame functions only.

A host is written backwards by its labels (``www.example.com`` becomes ``com.example.www.``),
so a host and its subdomains are an interval of a sorted axis, and so are the paths that start
with a rule's path below one host. Intervals of prefixes are nested or disjoint. A sweep over
the sorted keys therefore keeps a stack: one open rule for each depth of nesting, and at a
point those are active that are a prefix of the point.

The axis is cut into ranges that are swept in parallel; the stack at a range's start is the
stack at the end of the one before it, a small table of one row per range. Two sweeps find
the answer: over distinct hosts, then over distinct paths below the active rules' hosts.
Repeated hosts and urls are reduced before anything is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremill.llm.common import stored

ALLOW = "allow"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Fixed values: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    if not rules:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    quoted = [", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in r)
              for r in rules]
    values = ", ".join(f"({r})" for r in quoted)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "."), F.lit("."))


def below(host: str, path: str) -> Column:
    """The key of a path below a host; a host holds no slash."""
    return F.concat(F.col(host), F.lit("/"), F.col(path))


def _levels(opens: DataFrame) -> DataFrame:
    """Each key with its depth of nesting: how many others are a prefix of it."""
    shorter = opens.select(
        F.col("key").alias("_of"),
        F.explode(
            F.transform(F.sequence(F.lit(0), F.length("key")), lambda n: F.left("key", n))
        ).alias("key"),
    )
    return (
        shorter.join(opens, "key").groupBy("_of").agg((F.count(F.lit(1)) - 1).alias("level"))
    ).withColumnRenamed("_of", "key")


def sweep(points: DataFrame, opens: DataFrame) -> DataFrame:
    """For distinct ``key`` of points the ``active`` ones of ``opens`` (distinct ``key``),
    outermost first: those that are a prefix of the point. Points without any are left out.
    """
    levels = stored(_levels(opens), "url-rules")
    deepest = levels.agg(F.max("level")).first()[0]
    if deepest is None:
        return points.select("key", F.array().cast("array<string>").alias("active")).limit(0)
    depth = range(deepest + 1)
    events = points.select("key", F.lit(None).cast("long").alias("level")).unionByName(
        levels.select("key", "level")
    )
    blocks = stored(
        events.repartitionByRange("key").withColumn("block", F.spark_partition_id()),
        "url-sweep",
    )

    def opened(d: int) -> Column:
        return F.max(F.when(F.col("level") == d, F.col("key")))

    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.groupBy("block")
        .agg(*[opened(d).alias(f"s{d}") for d in depth])
        .select("block", *[F.max(f"s{d}").over(before).alias(f"s{d}") for d in depth])
    )
    # keys ascend, so the last key opened at a depth is the largest so far
    so_far = Window.partitionBy("block").orderBy("key", F.col("level").asc_nulls_last())
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = blocks.withColumns({f"o{d}": opened(d).over(so_far) for d in depth})
    stack = F.array(*[F.coalesce(f"o{d}", f"s{d}") for d in depth])
    return (
        swept.filter("level IS NULL")
        .join(carried, "block")
        .select("key", F.filter(stack, lambda r: F.startswith(F.col("key"), r)).alias("active"))
        .filter(F.size("active") > 0)
    )


def judge_urls(
    df: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per input row: the key, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains
    if the url's path starts with the rule's; the longest (host and path together, then host)
    wins. Without one ``rule`` is NULL and ``verdict`` the default. A NULL url, or one without
    ``://``, has an empty host and path. Rules with a NULL part are left out; of equal rules
    with two verdicts the one later in the alphabet (block) holds. Rows that repeat stay;
    an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    rows = df.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    clean = (
        rules.dropna(subset=["host", "path", "verdict"])
        .select(F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("_host", reversed_host(F.col("host")))
        .withColumn("_below", below("_host", "path"))
    )
    targets = rows.select("host", "path").distinct().withColumn(
        "_host", reversed_host(F.col("host"))
    )
    hosts = targets.select(F.col("_host").alias("key")).distinct()
    over = sweep(hosts, clean.select(F.col("_host").alias("key")).distinct())
    probes = (
        targets.join(over, F.col("_host") == F.col("key"))
        .select("host", "path", F.explode("active").alias("_at"))
        .withColumn("_below", below("_at", "path"))
    )
    points = probes.select(F.col("_below").alias("key")).distinct()
    longest = sweep(points, clean.select(F.col("_below").alias("key"))).select(
        F.col("key").alias("_below"), F.try_element_at("active", F.lit(-1)).alias("_rule")
    )
    named = clean.select(
        F.col("_below").alias("_rule"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("_h"),
        "verdict",
    )
    order = F.struct(F.length("rule").alias("a"), F.col("_h").alias("b"))
    best = (
        probes.join(longest, "_below")
        .join(named, "_rule")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), order).alias("_best"))
    )
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
