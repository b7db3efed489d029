"""Telemetry logs: ``dt=<day>/delivery_<sale>_<plate>_<start>.jsonl``, one point per line."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolake.functions.text import decoded_file_name, key_from_file_name
from cargolake.plans.entities import BRONZE_FIELDS, lift_fields
from cargolake.schemas import TELEMETRY, TELEMETRY_BRONZE, conform, ddl, empty, stamp

CORRUPT = "_corrupt_record"


def _leaves(text: str, kinds: Mapping[str, str]) -> str:
    """A type with its leaf types exchanged."""
    return re.sub("|".join(rf"\b{k}\b" for k in kinds), lambda m: kinds[m.group()], text)


# A number may come quoted or be no number at all. So leaves are read as text,
# then as wide numbers, then narrowed; what cannot be read becomes NULL and the
# rest of the point stays.
AS_TEXT = dict.fromkeys(("bigint", "int", "double", "boolean"), "string")
AS_WIDE = {"bigint": "decimal(20,3)", "int": "double"}
POINT_TEXT = {c: _leaves(kind, AS_TEXT) for c, kind in TELEMETRY.items()}
POINT_WIDE = {c: _leaves(kind, AS_WIDE) for c, kind in TELEMETRY.items()}
POINT = f"{ddl(POINT_TEXT)}, `{CORRUPT}` string"
LINES = "value string, dt string"
OPTIONS = {"pathGlobFilter": "*.jsonl"}


def parsed(lines: DataFrame) -> DataFrame:
    """Lines (value, dt, file_name) as points of text, with the fields that have no column as ``other_fields``."""
    lines = lines.where(F.trim("value") != "")
    point = F.from_json("value", POINT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~k.isin(*TELEMETRY))
    rows = lines.select("dt", "file_name", point.alias("p"), fields.alias("f"))
    others = F.when(F.size("f") > 0, F.to_json("f"))
    return rows.select("dt", "file_name", "p.*", others.alias("other_fields"))


def with_lineage(points: DataFrame, run_ts: datetime) -> DataFrame:
    """File name, day of the folder, order key out of the file name, load time."""
    name = decoded_file_name(F.col("file_name"))
    return points.withColumns(
        {
            "source_file": name,
            "log_date": F.col("dt").cast("string"),
            "load_timestamp": stamp(run_ts),
            "order_key": key_from_file_name(name),
        }
    )


def _broken() -> Column:
    """A line that is no JSON object. A line with one odd field keeps its other fields."""
    nothing = [F.col(c).isNull() for c in TELEMETRY]
    return F.col(CORRUPT).isNotNull() & reduce(and_, nothing)


def to_bronze(points: DataFrame, run_ts: datetime) -> DataFrame:
    """Readable points with lineage and the lifted nested fields."""
    kept = with_lineage(points, run_ts).where(~_broken()).withColumns(
        {c: F.col(c).try_cast(POINT_WIDE[c]).try_cast(kind) for c, kind in TELEMETRY.items()}
    )
    return conform(lift_fields(kept, BRONZE_FIELDS), TELEMETRY_BRONZE)


def to_rejected(points: DataFrame, run_ts: datetime) -> DataFrame:
    """The lines that are no points, with their file."""
    bad = with_lineage(points, run_ts).where(_broken())
    return bad.select("source_file", "log_date", F.col(CORRUPT).alias("line"))


def broken_count() -> Column:
    """For an observation of ``parsed`` lines: how many are no points."""
    return F.count_if(_broken())


def scan_lines(spark: SparkSession, base: str) -> DataFrame | None:
    """All lines below the day folders, or None without such folders.

    Only the day folders are matched here; Spark lists the many files in them
    in parallel.
    """
    try:
        lines = spark.read.schema(LINES).options(**OPTIONS).option("basePath", base).text(f"{base}/dt=*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return lines.select("value", "dt", "_metadata.file_name")


def read_telemetry(spark: SparkSession, base: str, run_ts: datetime) -> DataFrame:
    """All points below ``base``. Blank lines do not count; broken lines are left out one by one."""
    lines = scan_lines(spark, base)
    return empty(spark, TELEMETRY_BRONZE) if lines is None else to_bronze(parsed(lines), run_ts)


def broken_lines(spark: SparkSession, base: str, run_ts: datetime) -> DataFrame:
    """The lines ``read_telemetry`` leaves out, with their file."""
    lines = scan_lines(spark, base)
    if lines is None:
        return spark.createDataFrame([], "source_file string, log_date string, line string")
    return to_rejected(parsed(lines), run_ts)
