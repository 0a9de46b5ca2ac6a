"""Sinks (B1-B7): idempotent Parquet writes.

Plain Parquet has no MERGE or DELETE, so "replace a day" is a dynamic
partition overwrite (atomic per job) and "insert if absent" is a left anti
join against the keys already stored, written to a staging folder first
(a table cannot be read and overwritten by the same plan).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.reshape import set_difference
from ..session import scratch_path


class Written:
    """Rows that a write wrote, in all and by day, observed inside the write itself (no second pass counts them).

    The metrics sit right below the writer, where every partition reports once, whatever is retried before it.
    """

    def __init__(self, days: list[dt.date] = ()):
        self.days, self.seen = list(days), Observation()

    def on(self, df: DataFrame, date_col: str | None = None) -> DataFrame:
        # a plain count of a day's rows: count_if took about twice the time on every row
        by_day = [F.count(F.when(F.col(date_col) == F.lit(d), F.lit(1))).alias(f"d{i}") for i, d in enumerate(self.days)] if date_col else []
        return df.observe(self.seen, F.count(F.lit(1)).alias("n"), *by_day)

    def total(self) -> int:
        return self.seen.get["n"]

    def by_day(self) -> dict[dt.date, int]:
        got = self.seen.get
        return {d: got[f"d{i}"] for i, d in enumerate(self.days)}


def replace_days(df: DataFrame, path: str, date_col: str = "date", full: bool = False, order: tuple = (), written: Written | None = None) -> None:
    """B1: write ``df`` partitioned by day; only the days present in ``df`` are replaced.

    ``full=True`` replaces the whole feed (static overwrite). Rows are
    clustered by day with a REBALANCE hint, so each day becomes a few files
    rather than one per task, and AQE splits a day that holds a large share
    of the rows across several writers instead of one.
    """
    df = rebalance(df, date_col).sortWithinPartitions(date_col, *order)
    w = ((written.on(df, date_col) if written else df)
         .write.mode("overwrite").option("partitionOverwriteMode", "static" if full else "dynamic"))
    w.partitionBy(date_col).parquet(path)


def replace_months(df: DataFrame, path: str, date_col: str = "date", full: bool = False, order: tuple = (), staged: bool = False) -> None:
    """B1 for batch loads: every month that ``df`` holds is replaced as a whole.

    A day that has left the source leaves the feed too: the rows are staged (``staged``: they are read from a stage already), the stored days of
    their months that they no longer hold are dropped (the day folders, one per day), and the others are overwritten.
    """
    spark = df.sparkSession
    new = df if staged else stage(spark, df, "months")
    if not full and path_exists(spark, path):
        days = new.select(F.col(date_col).cast("date").alias("d")).distinct()
        stored = (spark.read.parquet(path).select(F.col(date_col).cast("date").alias("d")).distinct()
                  .withColumn("m", F.trunc("d", "month")))
        gone = stored.join(days.select(F.trunc("d", "month").alias("m")).distinct(), "m", "left_semi").join(days, "d", "left_anti")
        for r in gone.collect():                        # bounded by the days of the months read
            delete_path(spark, f"{path}/{date_col}={r.d.isoformat()}")
    replace_days(new, path, date_col, full, order)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` under a declared schema: columns by name in its order, absent ones NULL, only safe casts.

    A NULL in a column that is declared NOT NULL fails the write and names the column.
    """
    have = {c.lower() for c in df.columns}
    absent = [f.name for f in schema.fields if not f.nullable and f.name.lower() not in have]
    if absent:
        raise ValueError(f"columns declared NOT NULL are missing: {', '.join(absent)}")
    df = df.to(T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]))
    return df.withColumns({f.name: F.coalesce(F.col(f.name), F.raise_error(F.lit(f"NULL in {f.name}, which is declared NOT NULL")).cast(f.dataType))
                           for f in schema.fields if not f.nullable})


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder or file is there; any other trouble with the store is an error."""
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"cannot delete {path}")


def rebalance(df: DataFrame, *cols: str) -> DataFrame:
    """Cluster by ``cols`` for a partitioned write; AQE splits skewed and merges small partitions."""
    return df.hint("rebalance", *cols)


def rewrite_layer(df: DataFrame, path: str, part_col: str = "month") -> None:
    """B2: full rewrite of a layer partitioned by ``part_col`` (booking snapshot)."""
    (rebalance(df, part_col).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(part_col).parquet(path))


def export_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    """Delimited UTF-8 export (one folder of part files)."""
    df.write.mode("overwrite").option("sep", sep).option("header", header).option("encoding", "UTF-8").csv(path)


def read_delimited(spark: SparkSession, path: str, schema, sep: str = ";") -> DataFrame:
    """What ``export_delimited`` wrote, with its types; a malformed line fails."""
    return spark.read.schema(schema).option("sep", sep).option("header", True).option("mode", "FAILFAST").csv(path)


def rows_to_insert(new: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """B4 plan: new rows, one per key (Q11), whose key is not stored yet (type-0 dimension)."""
    from ..operators.aggregates import keep_first
    others = [c for c in new.columns if c != key]
    dedup = keep_first(new, [key], others, others) if others else new.select(key).distinct()
    dedup = dedup.select(*new.columns)
    return dedup if existing is None else set_difference(dedup, existing, [key])


def upsert_dim(spark: SparkSession, new: DataFrame, path: str, key: str) -> int:
    """Insert-if-absent into the dimension stored at ``path``; returns rows added.

    The rows to add are staged in the shared folder first so the plan that
    reads the stored keys never writes to the same folder.
    """
    existing = spark.read.parquet(path) if path_exists(spark, path) else None
    add = rows_to_insert(new, existing, key)
    stage, written = scratch_path(spark, "stage-dim"), Written()
    written.on(add).write.mode("overwrite").parquet(stage)
    n = written.total()
    if n:
        spark.read.parquet(stage).write.mode("append").parquet(path)
    return n


def replace_fact_days(df: DataFrame, path: str, part_col: str = "partition_date", written: Written | None = None) -> None:
    """Replace the days present in ``df``; other days stay.

    Empty input is a no-op by construction: dynamic overwrite only replaces
    partitions that receive rows (no separate emptiness job, which would
    compute the plan twice).
    """
    replace_days(df, path, part_col, written=written)


def replaced_view(existing: DataFrame, batch: DataFrame, part_col: str = "partition_date") -> DataFrame:
    """B5 as a plan: the table after replacing ``batch``'s days in ``existing``."""
    days = batch.select(part_col).distinct()
    return existing.join(days, part_col, "left_anti").unionByName(batch)


def create_tables(spark: SparkSession, root: str, catalogue: dict) -> None:
    """Create empty tables from the schema catalogue (``name -> (schema, partition col)``)."""
    for name, (schema, part) in catalogue.items():
        w = spark.createDataFrame([], schema).write.mode("ignore")
        (w.partitionBy(part) if part else w).parquet(f"{root}/{name}")


def column_comment(table: str, column: str) -> str:
    """Column description derived from the key catalogue."""
    from .. import schemas
    if schemas.PRIMARY_KEYS.get(table) == column:
        return "surrogate key: md5 of the natural key text"
    for fact, col, dim, key in schemas.FOREIGN_KEYS:
        if fact == table and col == column:
            return f"references {dim}.{key} (not enforced; see the fk_orphans check)"
    if column == "partition_date":
        return "day partition (replaced as a whole on reload)"
    return ""


def gold_ddl(root: str, database: str = "gold") -> list[str]:
    """CREATE TABLE statements of the gold model: Parquet at ``root/<name>``, facts partitioned by day, NOT NULL columns and descriptions.

    Spark's own catalog takes NOT NULL for Parquet tables but keeps their columns nullable, so the names are a table
    property too (``not_null``), and ``conform`` holds them in every write.
    """
    from .. import schemas
    out = []
    for name, (schema, part) in schemas.catalogue().items():
        cols = []
        for f in schema.fields:
            comment = column_comment(name, f.name).replace("'", "")
            cols.append(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") + (f" COMMENT '{comment}'" if comment else ""))
        out.append(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(cols)}) USING parquet "
                   + (f"PARTITIONED BY ({part}) " if part else "")
                   + f"LOCATION '{root}/{name}' COMMENT '{'fact' if part else 'dimension'} table of the gold model' "
                   + f"TBLPROPERTIES ('not_null' = '{','.join(schemas.not_null_columns(name))}')")
    return out


def create_catalog_tables(spark: SparkSession, root: str, database: str = "gold") -> list[str]:
    """Register every gold table in the session catalog (``gold_ddl``). Existing tables are kept."""
    from .. import schemas
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for ddl in gold_ddl(root, database):
        spark.sql(ddl)
    return [f"{database}.{name}" for name in schemas.GOLD]


def drop_catalog_tables(spark: SparkSession, database: str = "gold") -> None:
    """Drop every gold table from the catalog (the kill script); files of external tables stay."""
    from .. import schemas
    for name in schemas.GOLD:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a written table in the shared folder: one computation, then a plain scan.

    (An eager ``Dataset.checkpoint`` computes the plan twice: once to count,
    once to write the checkpoint.) Survives executor loss like any table.
    """
    path = scratch_path(spark, f"stage-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def store_bucketed(df: DataFrame, keys: list[str], path: str, table: str | None = None, buckets: int | None = None) -> DataFrame:
    """Store ``df`` in buckets of ``keys``, one sorted file each, and read it as the catalog table ``table``.

    Aggregates by the keys and joins on them then find their rows together: no exchange. ``buckets`` should fit the
    table (default: the session's shuffle partitions); tables that are joined need the same number. Without ``table`` the
    name is one of its own.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = table or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name))
    return spark.table(name)


def with_load_version(df: DataFrame, version: int) -> DataFrame:
    return df.withColumn("load_version", F.lit(version))
