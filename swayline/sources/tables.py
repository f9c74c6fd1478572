"""Input schemas, readers and sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from swayline.functions.columns import zoned_timestamp

APP_USAGE = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# The visit time stays text: its day/month order differs between splits.
WEB_VISITS = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

CLAIMS = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("icd_code", T.StringType()),
    T.StructField("diagnosis_date", T.DateType()),
])

CHURN_LABELS = T.StructType([
    T.StructField("member_id", T.LongType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("churn", T.IntegerType()),
    T.StructField("outreach", T.IntegerType()),
])

SCHEMAS = {"app_usage": APP_USAGE, "web_visits": WEB_VISITS, "claims": CLAIMS, "churn_labels": CHURN_LABELS}


@dataclass(frozen=True)
class MemberTables:
    """The four inputs of one split."""

    app_usage: DataFrame
    web_visits: DataFrame
    claims: DataFrame
    churn_labels: DataFrame


MULTI_LINE = ("web_visits",)  # titles and descriptions may hold line breaks; such a file is one task's


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Header CSV with a declared schema; columns are found by name, others are left out. Times with a zone suffix are turned to UTC.
    A missing column or a malformed value stops the job."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    there = reader.csv(path).columns
    if missing := [f.name for f in schema if f.name not in there]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    as_text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType) for f in schema])
    known = {f.name: f for f in as_text}
    rows = (reader.schema(T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in there])).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))
    return rows.select(*[zoned_timestamp(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in schema])


def read_split(spark: SparkSession, folder: str, prefix: str = "") -> MemberTables:
    """All four tables of a split, ``<folder>/<prefix><table>.csv``."""
    return MemberTables(**{
        name: read_csv(spark, f"{folder}/{prefix}{name}.csv", schema, name in MULTI_LINE) for name, schema in SCHEMAS.items()
    })


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Ranked list, comparison report and trial log all leave through here, one file per task."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    writer.format(fmt).save(path)
    return path
