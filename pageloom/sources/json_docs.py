"""JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom import schemas


def read_ads_files(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Records of ``{"ads": [record, ...]}`` objects, one object per line, or with ``multi_line`` one
    per file, which a single task must read. An object that is malformed anywhere gives a row with
    its text in ``_corrupt_record`` besides the records that could be read."""
    schema = T.StructType([*schemas.fields(schemas.ADS_FILE), T.StructField("_corrupt_record", T.StringType())])
    docs = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    records = (docs.select(F.explode_outer("ads").alias("ad"), "_corrupt_record")
               .filter(F.col("ad").isNotNull() | F.col("_corrupt_record").isNotNull())
               .select("ad.*", "_corrupt_record"))
    return records.withColumn("Time", F.col("Time").try_cast("timestamp"))


def read_records(spark: SparkSession, path: str, ddl: str = schemas.LISTING_AD) -> DataFrame:
    """One object per line. A line that is no JSON keeps its text in ``_corrupt_record``."""
    schema = T.StructType([*schemas.fields(ddl), T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
