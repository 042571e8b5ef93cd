"""Relational source and target over JDBC (the reference's database backend).

Reads are partitioned on a numeric column when bounds are given, so a large
table is fetched by many tasks in parallel; writes append in batches.  The
default backend of this package is parquet or catalog tables; JDBC is for
exchanging star tables with an existing i2b2 database.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class DbConfig:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None

    def options(self) -> dict[str, str]:
        o = {"url": self.url}
        if self.user is not None:
            o["user"] = self.user
        if self.password is not None:
            o["password"] = self.password
        if self.driver is not None:
            o["driver"] = self.driver
        return o


def read_table(spark: SparkSession, db: DbConfig, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
               fetch_size: int = 10000) -> DataFrame:
    r = spark.read.format("jdbc").options(**db.options()).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    if partition_column is not None and lower is not None and upper is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    return r.load()


def write_table(df: DataFrame, db: DbConfig, table: str, mode: str = "append",
                batch_size: int = 10000, num_partitions: int | None = None) -> None:
    w = df if num_partitions is None else df.coalesce(num_partitions)
    (w.write.format("jdbc").options(**db.options()).option("dbtable", table)
     .option("batchsize", str(batch_size)).mode(mode).save())
