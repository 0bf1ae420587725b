"""Reading the given tables, and intermediate tables in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardflow.plans.workspace import new_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and there when an executor is lost."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that are dropped when the block ends. What leaves the block must
    not read them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(new_dir(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
