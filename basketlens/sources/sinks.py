"""Writing tables.

No retry loops or sleeps. Parquet has no snapshots, so new content is written
beside the old and swapped in when it is whole: a plan may read the table that
it replaces, and a write that fails half-way leaves that table as it was.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import MONEY_SUM
from ..session import a_data_file, delete_path, scratch_path, swap_in


def overwrite_table(df: DataFrame, target: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                    as_table: bool = False) -> None:
    """Overwrite a path (default) or a catalog table with ``df``, which
    may read the target. The new content is written beside the old one and
    takes its place once it is whole: if the write fails, the target is as it
    was."""
    spark = df.sparkSession
    new = f"{target}_new_{uuid.uuid4().hex}" if as_table else f"{target.rstrip('/')}.new-{uuid.uuid4().hex}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        if as_table:
            w.saveAsTable(new)
        else:
            w.save(new)
    except BaseException:
        if as_table:
            drop_table(spark, new)
        else:
            delete_path(spark, new)
        raise
    if as_table:
        swap_table(spark, new, target)
    else:
        swap_in(spark, new, target)


def swap_table(spark: SparkSession, new: str, target: str) -> None:
    """Give catalog table ``new`` the name ``target``; the table that had it is
    renamed first and dropped last."""
    old = None
    if table_exists(spark, target):
        old = f"{target}_old_{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {target}")
    except BaseException:
        if old:
            spark.sql(f"ALTER TABLE {old} RENAME TO {target}")
        raise
    if old:
        drop_table(spark, old)
    spark.catalog.refreshTable(target)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """A40, SQL form: ``INSERT OVERWRITE`` an existing catalog table, keeping
    its definition; columns are matched by position, as in SQL. The cached
    metadata is refreshed afterwards."""
    df.write.insertInto(table, overwrite=True)
    df.sparkSession.catalog.refreshTable(table)


#: rows of one stored file of the base at most
FILE_ROWS = 4_000_000


def write_base(base: DataFrame, path: str, partition_by: str | None = "month") -> None:
    """A1: store the normalised base table partitioned by a coarse period.

    ``partition_by`` is ``'month'`` (default), ``'date'`` or None (the flat
    layout); ``'month'`` adds a
    ``month`` column (first day of the month) as the directory key and keeps
    ``date`` as data, so a year of data is 12 directories, not 365, and a
    date-range filter prunes with ``month`` between the truncated bounds.
    User or company partitioning (millions of tiny files) is not offered.
    Rows are rebalanced, not repartitioned, by the directory key: small
    months share a task, a large one is split over as many tasks and files
    as its size asks for.
    """
    if partition_by not in ("month", "date", None):
        raise ValueError("partition_by must be 'month', 'date' or None")
    if partition_by == "month":
        base = base.withColumn("month", F.trunc("date", "MM"))
    keys = [partition_by] if partition_by else []
    w = base.hint("rebalance", *keys).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
    (w.partitionBy(*keys) if keys else w).parquet(path)


def read_base(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by ``write_base`` back: the normalised columns
    and, stored by month, the directory key ``month``, which joins and
    filters prune with. Outputs of whole rows leave it out."""
    df = spark.read.parquet(path)
    if "month" in df.columns:  # inferred from the directory names
        df = df.withColumn("month", F.col("month").cast("date"))
    return df


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, sort_by: Sequence[str]) -> None:
    """Store ``df`` in ``buckets`` files by the hash of ``key``, each sorted by
    ``sort_by``. Aggregates, windows and joins by ``key`` (and any further
    columns) then run without an exchange; see ``read_bucketed``.

    All rows of a key share a file, so store totals whose rows per key are
    bounded (per day or month and company), not transactions.
    """
    name = f"write_{uuid.uuid4().hex}"
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key)
     .sortBy(*sort_by).option("path", new).saveAsTable(name))
    drop_table(df.sparkSession, name)  # external: the files stay
    swap_in(df.sparkSession, new, path)


def read_bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int,
                  sort_by: Sequence[str]) -> DataFrame:
    """A table of ``columns`` (DDL) that ``write_bucketed`` stored. Only a
    catalog table tells the planner of its buckets, so the files are declared
    as an external one."""
    name = "bucketed_" + hashlib.sha1(path.encode()).hexdigest()[:16]
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # of an earlier content of the path
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) "
              f"SORTED BY ({', '.join(sort_by)}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def layout_parity(flat: DataFrame, partitioned: DataFrame) -> DataFrame:
    """A2: the per-(date, user) sums of both layouts side by side, from one
    aggregate over their union: ``date, unique_mem_id, transactions_flat,
    transactions_partitioned, amount_flat, amount_partitioned, agree``."""
    def side(df: DataFrame, of_flat: bool) -> DataFrame:
        return df.select("date", "unique_mem_id", "transactions", "amount", F.lit(of_flat).alias("of_flat"))

    def of(c: str, flat_side: bool):
        mine = F.col("of_flat") if flat_side else ~F.col("of_flat")
        return F.coalesce(F.sum(F.when(mine, F.col(c))), F.lit(0))

    sums = side(flat, True).unionByName(side(partitioned, False)).groupBy("date", "unique_mem_id").agg(
        of("transactions", True).cast("long").alias("transactions_flat"),
        of("transactions", False).cast("long").alias("transactions_partitioned"),
        of("amount", True).cast(MONEY_SUM).alias("amount_flat"),
        of("amount", False).cast(MONEY_SUM).alias("amount_partitioned"))
    return sums.withColumn("agree", (F.col("transactions_flat") == F.col("transactions_partitioned"))
                           & (F.col("amount_flat") == F.col("amount_partitioned")))


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` under the shared folder and return a DataFrame
    reading it back, cutting the lineage (and any dependency on the source
    files) before the source is overwritten."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_path(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the folder ``target`` with ``df``, which may read it."""
    overwrite_table(df, target, partition_by)


def _leaf_folders(spark: SparkSession, path: str, depth: int) -> dict[str, dict[str, str]]:
    """The partition folders ``depth`` levels below ``path``: relative name and values."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    level = [("", root, {})] if fs.exists(root) else []
    for _ in range(depth):
        level = [(f"{name}/{s.getPath().getName()}".lstrip("/"), s.getPath(),
                  values | {k: unescape(v) for k, v in [s.getPath().getName().split("=", 1)]})
                 for name, p, values in level for s in fs.listStatus(p)
                 if s.isDirectory() and "=" in s.getPath().getName()]
    return {name: values for name, _, values in level}


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       stale: Callable[[dict[str, str]], bool]) -> list[str]:
    """Replace the partitions of a stored table that ``stale`` picks (by their
    values, as strings) with ``df``, which holds rows of such partitions only;
    other folders are not touched. Stale partitions without new rows go. All
    new rows are written aside first, then folder by folder swapped in.
    Returns the names of the folders replaced or removed."""
    spark = df.sparkSession
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*partition_by).parquet(new)
        made, had = (_leaf_folders(spark, p, len(partition_by)) for p in (new, path))
        for name in made:
            swap_in(spark, f"{new}/{name}", f"{path}/{name}")
    finally:
        delete_path(spark, new)
    gone = [name for name, values in had.items() if name not in made and stale(values)]
    for name in gone:
        delete_path(spark, f"{path}/{name}")
    return sorted([*made, *gone])


def stored_schema(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    """The schema of a stored table and its partition columns, which are
    strings, as they are in the names of its folders: reading them by guess
    would turn a client '007' into the number 7."""
    whole = spark.read.parquet(path).schema
    file = a_data_file(spark, path)
    data = set(spark.read.parquet(file).columns) if file else set(whole.names)
    folders = [f.name for f in whole if f.name not in data]
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in folders else f for f in whole]), folders


def edit_path(spark: SparkSession, target: str, edit: Callable[[DataFrame], DataFrame],
              partition_by: Sequence[str] | None = None, schema: T.StructType | None = None) -> None:
    """Change a stored table in place: ``edit`` gets the table and returns
    its new content (for instance one of the operations of
    ``operators.admin``), which replaces it once it is written. Partition
    columns are strings unless ``schema`` says otherwise; the table stays
    partitioned as it is unless ``partition_by`` does."""
    found, folders = stored_schema(spark, target)
    table = spark.read.schema(schema or found).parquet(target)
    overwrite_table(edit(table), target, folders if partition_by is None else partition_by)


def replace_table(spark: SparkSession, target: str, source: str) -> None:
    """Overwrite catalog table ``target`` with table ``source``, then drop ``source``."""
    overwrite_table(spark.table(source), target, as_table=True)
    drop_table(spark, source)


def remove_client_partitions(spark: SparkSession, path: str, clients: Iterable[str]) -> list[str]:
    """A38 for outputs written ``partitionBy('client')``: delete exactly the
    ``client=<name>`` directories (exact name, so 'Gap' never removes
    'Gapless'). Returns the removed directories."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(hconf)
    removed = []
    for c in sorted(set(clients)):
        # partition directory names are escaped the same way Spark writes them
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(c)
        p = jvm.org.apache.hadoop.fs.Path(root, f"client={name}")
        if fs.exists(p):
            fs.delete(p, True)
            removed.append(str(p))
    return removed


def table_exists(spark: SparkSession, name: str) -> bool:
    """A42."""
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a catalog table (and its files, for a managed table)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def jdbc_export(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                connections: int = 8) -> None:
    """Overwrite-load a metric table into a relational database over
    JDBC, with ``connections`` parallel connections at most. Credentials come
    from the caller's properties / Spark config."""
    (df.write.option("numPartitions", connections)
     .jdbc(url=url, table=table, mode="overwrite", properties=properties or {}))
