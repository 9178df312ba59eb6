"""Readers and writers for landed feeds: columnar JSON, CSV, points, records."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tideline import settings as S


def columnar_schema(block: str, measures: list[str]) -> T.StructType:
    inner = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))]
                         + [T.StructField(m, T.ArrayType(T.DoubleType())) for m in measures])
    return T.StructType([T.StructField("zone", T.StringType()), T.StructField(block, inner),
                         T.StructField("_bad", T.StringType())])


def read_documents(spark: SparkSession, path: str, block: str, measures: list[str],
                   whole_file: bool = False) -> DataFrame:
    """Landed responses; the zone is a folder (zone=...) or a field."""
    return (spark.read.schema(columnar_schema(block, measures))
            .option("multiLine", whole_file).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_bad").json(path))


def unpack(docs: DataFrame, block: str, measures: list[str]) -> DataFrame:
    """Parallel arrays to rows: one row per time stamp."""
    arrays = F.arrays_zip(F.col(f"{block}.time").alias("time"),
                          *[F.col(f"{block}.{m}").alias(m) for m in measures])
    rows = docs.select("zone", F.explode(arrays).alias("_r"))
    return rows.select("zone", F.to_timestamp_ntz(F.col("_r.time")).alias("time"),
                       *[F.col(f"_r.{m}").alias(m) for m in measures])


def weather(docs: DataFrame, measures=None, strict: bool = True) -> DataFrame:
    """Hourly rows. A document without its block is an error, or skipped if not strict."""
    measures = measures or S.MEASURES
    if strict:
        docs = docs.withColumn("hourly", F.when(
            F.col("hourly").isNull(),
            F.raise_error(F.concat(F.lit("malformed response for "),
                                   F.coalesce(F.col("zone"), F.lit("unknown zone"))))
            .cast(docs.schema["hourly"].dataType)).otherwise(F.col("hourly")))
    else:
        docs = docs.filter(F.col("hourly").isNotNull())
    return unpack(docs, "hourly", measures)


def forecast(docs: DataFrame, days: int = S.LIVE_DAYS, measures=None) -> DataFrame:
    """Hourly forecast of all zones that answered, cut at ``days`` after their first hour.

    A zone without a usable document is left out; if none is usable that is an error.
    """
    usable = docs.filter(F.col("hourly").isNotNull())
    if usable.isEmpty():
        raise RuntimeError("no forecast feed could be read")
    rows = weather(usable, measures, strict=False)
    first = rows.groupBy("zone").agg(F.min("time").alias("_first"))
    return (rows.join(first, "zone")
            .filter(F.col("time") < F.col("_first") + F.make_dt_interval(F.lit(days)))
            .drop("_first"))


def bad_documents(docs: DataFrame, block: str) -> DataFrame:
    """Count of unusable documents per zone."""
    return (docs.filter(F.col(block).isNull()).groupBy("zone")
            .agg(F.count(F.lit(1)).alias("bad_documents")))


def discharge(docs: DataFrame) -> DataFrame:
    """Daily discharge rows; a document without its block gives no rows."""
    return unpack(docs.filter(F.col("daily").isNotNull()), "daily", [S.DISCHARGE])


def write_documents(rows: DataFrame, path: str, block: str, measures: list[str],
                    per: str = "day") -> None:
    """Land rows as columnar JSON, one document per zone and ``per``."""
    stamped = rows.withColumn("_per", F.date_trunc(per, "time")).withColumn(
        "time", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"))
    entry = F.sort_array(F.collect_list(F.struct("time", *measures)))
    docs = stamped.groupBy("zone", "_per").agg(entry.alias("_e"))
    packed = F.struct(*[F.col(f"_e.{c}").alias(c) for c in ["time", *measures]])
    (docs.select("zone", packed.alias(block)).write.partitionBy("zone")
     .option("ignoreNullFields", False).json(path))


def read_csv(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(glob)


def write_csv(df: DataFrame, path: str, by: list[str] = ()) -> None:
    writer = df.write.option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def points(spark: SparkSession, path: str) -> DataFrame:
    """A landed array of [lon, lat, elevation, zone index] arrays, one per line or file."""
    docs = spark.read.schema("points array<array<double>>").json(path)
    names = ["lon", "lat", "elevation"]
    p = docs.select(F.explode("points").alias("p"))
    return p.select(*[F.col("p")[i].alias(n) for i, n in enumerate(names)],
                    F.col("p")[3].cast("int").alias("zone_idx"))


def records(predictions: DataFrame) -> DataFrame:
    """Forecast records: fixed columns, ISO time, no nulls, level as text."""
    from tideline.functions.columns import iso_time
    x = predictions
    if S.DISCHARGE not in x.columns:
        x = x.withColumn(S.DISCHARGE, F.lit(0.0))
    x = x.withColumn("time", iso_time("time_6h")).withColumn("risk_level", F.col("risk_level").cast("string"))
    x = x.withColumn("flood_pred", F.col("flood_pred").cast("int"))
    numbers = [c for c in S.RECORD_COLUMNS if c not in ("zone", "time", "risk_level")]
    return x.select(*S.RECORD_COLUMNS).na.fill(0, numbers).na.fill("0", ["zone", "time", "risk_level"])


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))
