"""Layer tables as Parquet files, and the mart writers."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from cargolake.operators.dedup import latest_by_key, upsert
from cargolake.schemas import STAR, Schema, conform, ddl, empty
from cargolake.sources.versions import (
    KEEP, WHOLE, current, expire, new_version, publish, publish_folders, resolved_parts, store_of,
)

# Fixed value: rows per insert statement of a mart load over JDBC.
INSERT_BATCH = 1000
SCHEMA_PART = "schema"  # the part without rows that every table in parts has


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table, or the files of a plain folder.

    What is read stays the same version until its files expire, whatever is
    published meanwhile.
    """
    folders = resolved_parts(spark, path)
    return spark.read.parquet(folders[WHOLE]) if WHOLE in folders else _parts(spark, folders, folders)


def _parts(spark: SparkSession, folders: Mapping[str, str], names: Collection[str]) -> DataFrame:
    schema = spark.read.parquet(folders[SCHEMA_PART]).schema  # of one small file, whatever the number of parts
    return spark.read.schema(schema).parquet(*(folders[n] for n in sorted({SCHEMA_PART, *names}) if n in folders))


def read_parts(spark: SparkSession, path: str, names: Collection[str]) -> DataFrame:
    """Some parts of a table that was published in parts; no file of another part is opened."""
    return _parts(spark, resolved_parts(spark, path), names)


def part_names(spark: SparkSession, path: str) -> set[str]:
    """The parts of a table that have rows, or had some; none if it was never published in parts."""
    return set(resolved_parts(spark, path)) - {WHOLE, SCHEMA_PART}


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when it was never written."""
    try:
        return read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """The table in the given schema; an empty one when it was never written."""
    df = read_optional(spark, path)
    return empty(spark, schema) if df is None else conform(df, schema)


def laid_out(df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrameWriter:
    """A writer of ``df`` in the layout of a table.

    Before a partitioned write the rows are rebalanced by the partition
    columns: a small day ends up in one file, a day that holds a third of the
    rows is split over tasks, and no task opens a file for every day.
    ``sort_by`` orders the rows inside each file, which moves nothing between
    tasks: row groups then span few keys, so a key look-up skips the others
    and an aggregate by that key is nearly complete before its shuffle.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df.write.partitionBy(*partition_by) if partition_by else df.write


def publish_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), keep: timedelta = KEEP
) -> None:
    """Full refresh. The rows are written as a new version, which one small file makes the current one.

    So a run that fails, or dies at any point, leaves the old table as it was,
    ``df`` may read it, and jobs that read the old version go on doing so for
    ``keep``. No data is renamed. Read such a table with ``read_table``.
    """
    spark, version = df.sparkSession, new_version(path)
    try:
        laid_out(df, partition_by, sort_by).parquet(version)
    except Exception:
        discard(spark, version)
        raise
    publish(spark, path, version)
    expire(spark, path, keep)


def publish_parts(
    df: DataFrame, path: str, part: Column, touched: Collection[str] | None = None, sort_by: Sequence[str] = (), keep: timedelta = KEEP
) -> None:
    """Replace the parts ``touched`` of a table by the rows of ``df``; without ``touched`` the whole table.

    ``part`` names the part of a row; ``df`` holds the rows of the touched parts
    and no others, and may read the table. Parts that are not touched keep their
    files. All parts change at once, by one small file that lists a folder per
    part, so there should be thousands of parts and not millions.
    """
    spark, version = df.sparkSession, new_version(path)
    before = current(spark, path)
    if touched is not None and (before is None or SCHEMA_PART not in before.parts):
        raise ValueError(f"{path} was not published in parts")
    try:
        laid_out(df.withColumn("part", part.cast("string")), ["part"], sort_by).parquet(version)
        if touched is None:
            df.limit(0).write.parquet(f"{version}/{SCHEMA_PART}")
    except Exception:
        discard(spark, version)
        raise
    prefix = "part="
    written = {n.removeprefix(prefix): f"{version}/{n}" for n in names_in(spark, version) if n.startswith(prefix)}
    if touched is None:
        publish_folders(spark, path, {SCHEMA_PART: f"{version}/{SCHEMA_PART}", **written})
    else:
        if set(written) - set(touched):
            discard(spark, version)
            raise ValueError(f"rows of other parts than the touched ones: {sorted(set(written) - set(touched))[:5]}")
        rest = {n: f for n, f in resolved_parts(spark, path).items() if n not in set(touched)}
        publish_folders(spark, path, rest | written, after=before.number)
    expire(spark, path, keep)


def bucket_name(keys: Sequence[str], buckets: int) -> Column:
    """The part of a row by its keys: equal keys, NULLs included, share it; the number of buckets is in the name."""
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    return F.concat(F.lit(f"{buckets}-"), F.lpad(number.cast("string"), len(str(buckets)), "0"))


def publish_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Publish a table in buckets of its keys, for ``upsert_table``; some 256 MB a bucket are a good size."""
    publish_parts(df, path, bucket_name(keys, buckets), sort_by=keys)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> set[str]:
    """Take the rows of ``source`` into a keyed table, in place of rows with the same keys; returns the buckets written.

    ``source`` must hold at most one row per key (see ``latest_by_key``) and the
    columns of the table; it is read twice, so it is best a written table. Only
    buckets that a source row falls in are read, joined and written.
    """
    if SCHEMA_PART not in resolved_parts(spark, path):
        raise ValueError(f"{path} has no buckets; publish it with publish_keyed")
    buckets = {int(n.split("-")[0]) for n in part_names(spark, path)} or {1}
    name = bucket_name(keys, buckets.pop())
    rows = source.select(read_parts(spark, path, []).columns)
    touched = {r[0] for r in rows.select(name.alias("n")).distinct().collect()}  # a row per bucket
    if touched:
        publish_parts(upsert(read_parts(spark, path, touched), rows, keys), path, name, touched, sort_by=keys)
    return touched


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> None:
    """Full refresh of a plain folder, for readers that take its files as they are.

    The rows are written beside the folder, which is exchanged once they are
    all there, by two renames; a run that fails before leaves the old folder as
    it was. Where a rename copies (object stores) use ``publish_table``.
    """
    staged = beside(path, "new")
    try:
        laid_out(df, partition_by, sort_by).parquet(staged)
    except Exception:
        discard(df.sparkSession, staged)
        raise
    exchange(df.sparkSession, staged, path)


def beside(path: str, word: str) -> str:
    """A new name in the folder of ``path`` that readers of the folder pass over."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}-{word}-{uuid.uuid4().hex}"


def names_in(spark: SparkSession, path: str) -> list[str]:
    store, at = store_of(spark, path)
    return [status.getPath().getName() for status in store.listStatus(at)]


def exists(spark: SparkSession, path: str) -> bool:
    store, at = store_of(spark, path)
    return store.exists(at)


def discard(spark: SparkSession, path: str) -> None:
    store, at = store_of(spark, path)
    store.delete(at, True)


def exchange(spark: SparkSession, staged: str, path: str) -> None:
    """Put the written folder ``staged`` in the place of ``path``; the old one goes only when the new one stands."""
    store, target = store_of(spark, path)
    new, old = store_of(spark, staged)[1], store_of(spark, beside(path, "old"))[1]
    there = store.exists(target)
    if there and not store.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not store.rename(new, target):
        if there:
            store.rename(old, target)
        raise OSError(f"cannot move {staged} to {path}")
    if there:
        store.delete(old, True)
    spark.catalog.refreshByPath(path)


def declare_marts(spark: SparkSession, gold: str) -> list[str]:
    """Create the star tables that do not exist yet, empty; returns their names."""
    created = []
    for name, schema in STAR.items():
        if read_optional(spark, f"{gold}/{name}") is None:
            publish_table(empty(spark, schema), f"{gold}/{name}")
            created.append(name)
    return created


def publish_dimension(df: DataFrame, name: str, gold: str) -> None:
    """Replace a dimension by the latest version of each of its keys."""
    schema = STAR[name]
    df = conform(df, schema)
    if "etl_updated_at" in schema:
        df = latest_by_key(df, [next(iter(schema))], "etl_updated_at")
    publish_table(df, f"{gold}/{name}")


def publish_fact(
    df: DataFrame, gold: str, source: DataFrame, skip_if_empty: bool = True, sorted_layout: bool = False,
    part: Column | None = None, touched: Collection[str] | None = None,
) -> bool:
    """Replace the fact; an empty run leaves the old one.

    ``source`` is the sales table the fact has a row for each row of, so
    looking for its first row tells whether the fact is empty without
    computing the fact. ``sorted_layout`` range-partitions the rows by
    (time_id, order_key), which lets readers of a period skip files but costs
    one more shuffle of the fact; a day that holds most orders still spreads
    over many files. With ``part`` the fact is published in parts, of which
    ``touched`` (all, if not given) are replaced.
    """
    if skip_if_empty and source.isEmpty():
        return False
    fact, path = conform(df, STAR["fact_orders"]), f"{gold}/fact_orders"
    if part is not None:
        publish_parts(fact, path, part, touched, sort_by=("time_id", "order_key") if sorted_layout else ())
        return True
    if sorted_layout:
        key = ("time_id", "order_key")
        fact = fact.repartitionByRange(*key).sortWithinPartitions(*key)
    publish_table(fact, path)
    return True


def connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A connection of the driver, by the same JDBC driver the tasks use."""
    jvm, given = spark._jvm, spark._jvm.java.util.Properties()
    for name, value in properties.items():
        given.setProperty(name, str(value))
    if "driver" in properties:  # a driver that came with --jars
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, given)


def in_transaction(spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str]) -> None:
    """Run statements in a database so that all take effect or none."""
    opened = connection(spark, url, properties)
    try:
        opened.setAutoCommit(False)
        statement = opened.createStatement()
        try:
            for sql in statements:
                statement.executeUpdate(sql)
            opened.commit()
        except Exception:
            opened.rollback()
            raise
        finally:
            statement.close()
    finally:
        opened.close()


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict, rows_per_writer: int = 500_000) -> None:
    """Replace the rows of a mart table by those of ``df``, all at once.

    The rows are loaded into a table beside it, with batched inserts from tasks
    of ``rows_per_writer`` rows, and dealt anew before, so the job ahead keeps
    its own parallelism. When all are there the database takes them over in one
    transaction: readers see the old mart or the new one, and a load that
    breaks off, or dies, leaves the old one. The mart keeps its keys, grants
    and indexes; it is created if it is missing. ``df`` is best a written
    table, since it is counted.
    """
    staged = f"{table}_new"
    df.limit(0).write.mode("append").jdbc(url, table, properties=properties)
    (
        df.repartition(max(1, -(-df.count() // rows_per_writer)))
        .write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", INSERT_BATCH)
        .jdbc(url, staged, properties=properties)
    )
    columns = ", ".join(df.columns)
    in_transaction(df.sparkSession, url, properties, [
        f"DELETE FROM {table}",
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staged}",
        f"DELETE FROM {staged}",
    ])


def table_declared(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def declare_table(spark: SparkSession, name: str, schema: Schema) -> bool:
    """Create a catalog table unless it exists; tells whether it was created."""
    if table_declared(spark, name):
        return False
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING parquet")
    return True
