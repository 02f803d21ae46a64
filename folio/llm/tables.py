"""Reading the driver's tables, and names for helper columns."""

from itertools import count

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A name like that which no column of df has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return next(n for i in count() if (n := f"_{name}{i}".lower()) not in taken)
