"""Session settings and the one configuration object the layer runs take."""

from __future__ import annotations

import math
import tempfile
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

# The calendar every warehouse is loaded with.
CALENDAR_START = date(2024, 1, 1)
CALENDAR_END = date(2029, 12, 31)

# The operational tables that are ingested.
OPERATIONAL_TABLES = (
    "customers", "drivers", "products", "purchase_headers",
    "purchase_items", "sale_headers", "sale_items", "stock_balances",
    "stock_movements", "suppliers", "vehicles", "warehouses",
)


@dataclass(frozen=True)
class WarehouseConfig:
    """Where the layers live and which instant a run stands for.

    ``run_ts`` and ``as_of`` replace every "now" and "today", so that a run
    can be repeated and gives the same rows.
    """

    root: str
    run_ts: datetime
    as_of: date
    calendar_start: date = CALENDAR_START
    calendar_end: date = CALENDAR_END
    jdbc_url: str | None = None
    jdbc_properties: dict = field(default_factory=dict, repr=False)  # credentials: never printed
    jdbc_rows: int = 500_000  # rows a task reads from, or inserts into, a database
    mart_url: str | None = None  # database the marts are also loaded into
    mart_properties: dict = field(default_factory=dict, repr=False)
    mart_schema: str = "gold"
    incremental_logs: bool = False  # take only log files no earlier run has taken
    incremental_fact: bool = False  # join and write only months of the fact whose inputs changed

    def raw(self, kind: str) -> str:
        return f"{self.root}/raw/{kind}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for a job that moves about its whole input once.

    Some 256 MB each, so that a task sorts and aggregates in memory at any
    size; adaptive execution merges what turns out smaller.
    """
    return max(1, math.ceil(input_bytes / (256 << 20)))


def size_shuffle(spark: SparkSession, folder: str) -> int:
    """Raise the session's shuffle partitions to what the files below ``folder`` need; returns the number set."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    size = store.getContentSummary(path).getLength() if store.exists(path) else 0
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shuffle_partitions(size))
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


def build_session(
    app: str = "cargolake", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs are written for.

    UTC keeps timestamps comparable; AQE coalesces small partitions, splits
    skewed join partitions and turns a join into a broadcast only after it
    has seen the real size of the small side. ``input_bytes``, the size of the
    largest table, sets the number of shuffle partitions; the layer runs raise
    it to what their own input needs.
    """
    if input_bytes is not None:
        conf.setdefault("spark.sql.shuffle.partitions", str(max(200, shuffle_partitions(input_bytes))))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="cargolake-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` at a reliable checkpoint, which survives the loss of any executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = checkpoint_folder(df.sparkSession)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
