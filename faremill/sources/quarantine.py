"""Readers that go on past bad input: good rows in one frame, the rest with a reason in another.

Nothing is lost between the two: every data line of a CSV file, and every page and every record
of a readable page, is in exactly one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.sources.files import infer_from_sample

BAD = "_bad"
REASON = "reason"


def _ddl(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def split_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files that fit ``schema``, and the other lines as ``file``, ``line``, ``reason``.

    The reason names the columns whose text is not of their type, or tells that the number of
    fields is another. All files have the first one's header line; one with another header has
    it among the bad lines. Blank lines are no data. A record ends with its line.
    """
    schema = _ddl(schema)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = lines.filter(F.trim("value") != "")
    if header:
        first = spark.read.text(path).head()
        lines = lines.filter(F.col("value") != F.lit(first[0] if first else ""))
    # every column is parsed, whichever a reader wants: else a bad one could pass unseen
    marked = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = lines.withColumn("_row", F.from_csv("value", _fields(marked), options))
    good = parsed.filter(F.col(f"_row.{BAD}").isNull())
    bad = parsed.filter(F.col(f"_row.{BAD}").isNotNull())
    return (
        good.select(*[F.col(f"_row.{f.name}") for f in schema.fields]),
        bad.select("file", F.col("value").alias("line"), _csv_reason("value", schema).alias(REASON)),
    )


def _fields(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _csv_reason(line: str, schema: T.StructType) -> Column:
    """Columns whose text cannot be cast; the text is split by the reader's own rules."""
    width = len(schema.fields)
    # one column more than there should be tells a longer line
    texts = ", ".join(f"c{i} string" for i in range(width + 1))
    split = F.from_csv(F.col(line), texts, {"mode": "PERMISSIVE"})
    wrong = [
        F.when(
            split[f"c{i}"].isNotNull() & split[f"c{i}"].try_cast(f.dataType).isNull(),
            F.lit(f.name),
        )
        for i, f in enumerate(schema.fields)
    ]
    names = F.array_compact(F.array(*wrong))
    return (
        F.when(split[f"c{width}"].isNotNull(), F.lit("other number of fields"))
        .when(F.size(names) > 0, F.concat(F.lit("not of its type: "), F.concat_ws(", ", names)))
        .otherwise(F.lit("other number of fields"))
    )


def split_sampled(
    spark: SparkSession, path: str, rows: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """``split_csv`` with the types of the first ``rows`` lines."""
    return split_csv(spark, path, infer_from_sample(spark, path, rows))


def split_pages(
    pages: DataFrame, selector: str, record: T.StructType | str, body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """Records of landed pages that fit, and the pages and records that do not.

    Records keep the page's other columns. The rest has these columns too, and ``place`` (of the
    record in its page, from 0; NULL for a whole page), ``text`` and ``reason``.
    """
    record = _ddl(record)
    beside = [c for c in pages.columns if c != body]
    texts = T.ArrayType(T.StringType())
    if selector == "$":
        found = F.from_json(body, texts)
    else:
        found = F.from_json(body, T.StructType([T.StructField(selector, texts)]))[selector]
    # only a body that is a document to its end counts as read
    readable = F.try_parse_json(body).isNotNull()
    read = pages.select(*beside, body, readable.alias("_read"), found.alias("_texts"))
    whole = F.col("_read") & F.col("_texts").isNotNull()
    bad_pages = read.filter(~whole).select(
        *beside,
        F.lit(None).cast("int").alias("place"),
        F.col(body).alias("text"),
        F.when(F.col("_read"), F.lit(f"no list at {selector}"))
        .otherwise(F.lit("no JSON document"))
        .alias(REASON),
    )
    each = read.filter(whole).select(*beside, F.posexplode("_texts").alias("place", "text"))
    marked = T.StructType([*record.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json("text", marked, {"columnNameOfCorruptRecord": BAD})
    each = each.select(*beside, "place", "text", parsed.alias("_row"))
    fits = F.col("_row").isNotNull() & F.col(f"_row.{BAD}").isNull()
    good = each.filter(fits).select(*beside, *[F.col(f"_row.{f.name}") for f in record.fields])
    bad = each.filter(~fits).select(*beside, "place", "text", F.lit("record does not fit").alias(REASON))
    return good, bad_pages.unionByName(bad)


def set_aside(good: DataFrame, bad: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Store the bad rows at ``path`` and return the good ones; the counts of both by reason."""
    bad.write.mode("overwrite").parquet(path)
    counts = good.sparkSession.read.parquet(path).groupBy(REASON).count().collect()
    return good, {r[REASON]: r["count"] for r in counts}
