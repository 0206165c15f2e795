"""Putting tables of one kind together, and keeping keyed tables."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType
from pyspark.sql.window import Window


def union_promoted(*frames: DataFrame) -> DataFrame:
    """All rows by column name: missing columns are null and untyped ones take the other's type.

    Columns of two different types are an error; Spark alone would widen them or fail at run time.
    """
    kinds: dict[str, object] = {}
    for df in frames:
        for f in df.schema:
            if isinstance(kinds.get(f.name, NullType()), NullType):
                kinds[f.name] = f.dataType
            elif not isinstance(f.dataType, NullType) and f.dataType != kinds[f.name]:
                raise TypeError(f"column {f.name} is {kinds[f.name].simpleString()} and {f.dataType.simpleString()}")
    cast = [df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in df.columns]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; order must be total for a stable result. Spark cuts groups before the shuffle."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__number", number).where("__number = 1").drop("__number")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows of source in place of those of the same key. source has one row a key."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def with_columns_of(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with the columns (name -> type) that it lacks, null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def batches(df: DataFrame, order: list[Column], size: int, within: list[str] | None = None) -> DataFrame:
    """df with batch: rows in order, so many to a batch. within numbers each group on its own."""
    number = F.row_number().over(Window.partitionBy(*(within or [])).orderBy(*order))
    return df.withColumn("batch", F.floor((number - 1) / size))


class VersionedTable:
    """A table as one folder a version below a path, the newest complete one being current: readers see old or new."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        jvm = self._spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self._path)
        fs = top.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        names = [s.getPath() for s in fs.listStatus(top)]
        done = [p.getName() for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n[1:]) for n in done if n[:1] == "v" and n[1:].isdigit())

    def read(self, schema: str | StructType) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(f"{self._path}/v{versions[-1]}")

    def publish(self, df: DataFrame) -> None:
        """Writes the next version; it counts once its marker file is there."""
        df.write.parquet(f"{self._path}/v{(self._versions() or [0])[-1] + 1}")


class BucketedTable:
    """A keyed table whose versions (see VersionedTable) are bucketed and sorted by the key.

    What is compared with it by the key needs no shuffle of this side. A version's folder names its number of buckets
    (v3b64), so that the number may change between versions; the session's catalog gets a table a version, with that folder
    as its location.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int) -> None:
        self._spark, self._path, self._key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _versions(self) -> list[tuple[int, int]]:
        jvm = self._spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self._path)
        fs = top.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        done = [x.getPath().getName() for x in fs.listStatus(top) if fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))]
        return sorted((int(m[1]), int(m[2])) for m in (re.fullmatch(r"v(\d+)b(\d+)", n) for n in done) if m)

    def _named(self, version: int, buckets: int) -> tuple[str, str]:
        digest = hashlib.sha256(self._path.encode()).hexdigest()[:16]
        return f"shelfwise_{digest}_v{version}b{buckets}", f"{self._path}/v{version}b{buckets}"

    def read(self, schema: str) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self._spark.createDataFrame([], schema)
        name, folder = self._named(*versions[-1])
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromDDL(schema))
        self._spark.sql(
            f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({ddl}) USING parquet CLUSTERED BY (`{self._key}`) SORTED BY (`{self._key}`) INTO {versions[-1][1]} BUCKETS LOCATION '{folder}'",
            args={"t": name},
        )
        return self._spark.table(name)

    def dealt(self, df: DataFrame) -> DataFrame:
        """df dealt out as the table is: it then meets the table, and becomes its next version, without another shuffle."""
        return df.repartition(self.buckets, self._key)

    def publish(self, df: DataFrame) -> None:
        """Writes the next version, of rows as dealt() gives them; it counts once its marker file is there."""
        name, folder = self._named((self._versions() or [(0, 0)])[-1][0] + 1, self.buckets)
        self._spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
        df.write.bucketBy(self.buckets, self._key).sortBy(self._key).option("path", folder).mode("overwrite").saveAsTable(name)
