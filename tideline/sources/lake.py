"""Layered parquet tables under one shared root: bronze, silver, gold."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.utils import AnalysisException


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _fs(self, where: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(where)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, layer: str, name: str) -> bool:
        self._settle(layer, name)
        fs, p = self._fs(self.path(layer, name) + "/_SUCCESS")
        return fs.exists(p)

    def _aside(self, layer: str, name: str, mark: str) -> str:
        """A hidden folder beside a table, on the same file system."""
        return self.path(layer, f".{mark}-{name}")

    def _settle(self, layer: str, name: str) -> None:
        """Put the old table back if a switch was cut short between its two renames."""
        fs, old = self._fs(self._aside(layer, name, "old"))
        if fs.exists(old):
            _, now = self._fs(self.path(layer, name))
            if fs.exists(now):
                fs.delete(old, True)
            else:
                fs.rename(old, now)

    def tables(self, layer: str) -> list[str]:
        fs, p = self._fs(f"{self.root}/{layer}")
        if not fs.exists(p):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith("."))

    def replace(self, df: DataFrame, layer: str, name: str, by: list[str] = ()) -> DataFrame:
        """Create or replace a table; ``by`` are its partition columns.

        The rows are written beside the table, which is switched only when the write has ended: a failed job leaves the
        old rows. The switch is two renames, quick where a rename is one step (local, HDFS); a process lost between them
        leaves the old table aside, and the next use puts it back. One writer a table at a time. On an object store use
        ``add_catalog_table``.
        """
        self._settle(layer, name)
        new = self._aside(layer, name, f"new-{uuid.uuid4().hex[:12]}")
        writer = df.write.mode("overwrite")
        try:
            (writer.partitionBy(*by) if by else writer).parquet(new)
        except BaseException:
            fs, p = self._fs(new)
            fs.delete(p, True)
            raise
        fs, fresh = self._fs(new)
        _, now = self._fs(self.path(layer, name))
        _, old = self._fs(self._aside(layer, name, "old"))
        if fs.exists(now) and not fs.rename(now, old):
            raise OSError(f"{now} could not be set aside")
        if not fs.rename(fresh, now):
            self._settle(layer, name)
            raise OSError(f"{fresh} could not be put in place")
        fs.delete(old, True)
        self.spark.catalog.refreshByPath(self.path(layer, name))
        return self.read(layer, name)

    def append(self, df: DataFrame, layer: str, name: str, by: list[str] = ()) -> None:
        writer = df.write.mode("append")
        (writer.partitionBy(*by) if by else writer).parquet(self.path(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        """The stored table; a clear error when it was never written."""
        self._settle(layer, name)
        try:
            return self.spark.read.parquet(self.path(layer, name))
        except AnalysisException as exc:
            raise LookupError(f"{layer}.{name} has not been written yet") from exc

    def insert_absent(self, batch: DataFrame, layer: str, name: str, keys: list[str],
                      by: list[str] = (), dedupe: bool = False) -> DataFrame:
        """Append rows whose key is not stored yet; a stored row never changes."""
        if dedupe:
            batch = one_per_key(batch, keys)
        if self.exists(layer, name):
            batch = absent(batch, self.read(layer, name), keys)
        self.append(batch, layer, name, by)
        return self.read(layer, name)

    def purge(self, layer: str, enabled: bool = False) -> bool:
        """Drop a whole layer; does nothing unless asked to."""
        if not enabled:
            return False
        fs, p = self._fs(f"{self.root}/{layer}")
        return fs.delete(p, True)


def absent(batch: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key ``stored`` lacks.

    Only the key columns of the stored table are read, and only inside the time
    span of the batch, which prunes files and partitions of a long history.
    """
    time = next((k for k in keys if k.startswith("time")), None)
    have = stored.select(*keys)
    if time:
        span = batch.agg(F.min(time).alias("a"), F.max(time).alias("z"))
        have = have.filter((F.col(time) >= span.select("a").scalar())
                           & (F.col(time) <= span.select("z").scalar()))
    return batch.join(have, keys, "left_anti")


def one_per_key(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key that is least by its other columns in their order (nulls first), whatever the partitioning."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest or any(isinstance(batch.schema[c].dataType, (MapType, VariantType)) for c in rest):
        return batch.dropDuplicates(keys)
    return (batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(*batch.columns))


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], mode: str = "first_wins",
           dedupe: bool = False) -> DataFrame:
    """Stored rows plus the new ones. ``latest_wins`` lets the batch replace a stored row."""
    if mode == "first_wins":
        new = one_per_key(batch, keys) if dedupe else batch
        return stored.unionByName(absent(new, stored, keys))
    if mode == "latest_wins":
        new = one_per_key(batch, keys) if dedupe else batch
        return stored.join(new.select(*keys), keys, "left_anti").unionByName(new)
    raise ValueError(f"unknown mode {mode}")


def add_catalog_table(df: DataFrame, name: str, by: list[str] = ()) -> None:
    """Create or replace ``name`` in the catalog: a view over a new folder, switched in one step by the catalog.

    A failed write leaves the view on the old folder, and readers that have begun go on with it. Old folders lie beside
    the new one under the database's location; the cluster's clean-up may take all but the view's own.
    """
    spark = df.sparkSession
    *database, table = name.split(".")
    where = spark.catalog.getDatabase(database[0] if database else spark.catalog.currentDatabase()).locationUri
    path = f"{where.rstrip('/')}/{table}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`")


def catalog_has(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def catalog_tables(spark: SparkSession, layer: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(layer)) if spark.catalog.databaseExists(
        layer) else []


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def require_column(df: DataFrame, column: str) -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"column '{column}' is missing")
    return df
