"""Connected components of links, by smallest neighbours and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``label`` (the smallest id of its component) for every id in a link.

    Each round hooks an id to the smallest label around it and then jumps to its label's
    label, so chains shorten by halves. A round is written to the shared folder. Joins on a
    popular label have one row per label on the other side, so their hot partitions split.
    """
    both = links.select(F.col(a).alias("id"), F.col(b).alias("to"))
    edges = stored(
        both.unionByName(both.select(F.col("to").alias("id"), F.col("id").alias("to"))).distinct(),
        "edges",
    )
    labels = edges.groupBy("id").agg(F.min("to").alias("to"))
    labels = stored(labels.select("id", F.least("id", "to").alias("label")), "labels")
    round_ = 0
    while True:
        round_ += 1
        around = edges.join(
            labels.select(F.col("id").alias("to"), F.col("label").alias("near")), "to"
        )
        around = around.groupBy("id").agg(F.min("near").alias("near"))
        hooked = labels.join(around, "id").select(
            "id", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        far = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        jumped = hooked.join(far, "label").select(
            "id", "was", F.least("label", "far").alias("label")
        )
        step = stored(jumped, f"labels-{round_}")
        labels = step.select("id", "label")
        if not step.filter(F.col("label") != F.col("was")).limit(1).count():
            return labels


def joined(labels: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``labels`` after more links, whose ids may be new.

    The ends are replaced by their labels first: what is joined already is left out, and of
    many links between two components one remains.
    """
    of = labels.select(F.col("id").alias("_of"), F.col("label").alias("_label"))
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    for end in ("a", "b"):
        named = ends.join(of, F.col(end) == F.col("_of"), "left")
        ends = named.withColumn(end, F.coalesce("_label", end)).drop("_of", "_label")
    between = ends.filter("a <> b")
    between = between.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    above = components(stored(between.distinct(), "label-links"))
    moved = labels.join(
        above.select(F.col("id").alias("label"), F.col("label").alias("_to")), "label", "left"
    ).select("id", F.coalesce("_to", "label").alias("label"))
    new = above.join(labels.select("id"), "id", "left_anti")
    return stored(moved.unionByName(new.select("id", "label")), "labels-joined")
