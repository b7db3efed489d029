"""Tables published in parts, and the upsert that rewrites only what changes."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cargolake.operators.dedup import latest_by_key
from cargolake.sources import tables, versions
from tests.conftest import rows

SCHEMA = "id long, kind string, value int, version int"


def made(ids, seed=0, version=1):
    rng = random.Random(seed)
    return [(i, rng.choice("xyz"), rng.randrange(1000), version) for i in ids]


def files(path):
    """Every data file below a table with its bytes."""
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*.parquet")}


def test_only_touched_parts_are_written(spark, tmp_path):
    path = tmp_path / "t"
    day = F.concat(F.lit("day-"), F.col("id") % 4)
    tables.publish_parts(spark.createDataFrame(made(range(40)), SCHEMA), str(path), day)
    before, folders = files(path), versions.resolved_parts(spark, str(path))
    assert tables.part_names(spark, str(path)) == {f"day-{i}" for i in range(4)}
    changed = made([1, 5, 41], 9)
    tables.publish_parts(spark.createDataFrame(changed, SCHEMA), str(path), day, touched=["day-1"])
    after, now = files(path), versions.resolved_parts(spark, str(path))
    assert {k: v for k, v in after.items() if k in before} == before          # byte for byte
    assert {n for n in now if now[n] != folders[n]} == {"day-1"}
    want = [r for r in made(range(40)) if r[0] % 4 != 1] + changed
    assert rows(tables.read_table(spark, str(path))) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(tables.read_parts(spark, str(path), ["day-1", "none"]), "id") == [(1,), (41,), (5,)]


def test_a_part_may_lose_all_rows_and_come_back(spark, tmp_path):
    path = str(tmp_path / "t")
    part = F.col("kind")
    tables.publish_parts(spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 1)], SCHEMA), path, part)
    tables.publish_parts(spark.createDataFrame([], SCHEMA), path, part, touched=["a"])
    assert rows(tables.read_table(spark, path), "id") == [(2,)] and tables.part_names(spark, path) == {"b"}
    tables.publish_parts(spark.createDataFrame([], SCHEMA), path, part, touched=["b"])
    assert tables.read_table(spark, path).count() == 0 and tables.read_table(spark, path).columns == ["id", "kind", "value", "version"]
    tables.publish_parts(spark.createDataFrame([(3, "a", 1, 1)], SCHEMA), path, part, touched=["a", "b"])
    assert rows(tables.read_table(spark, path), "id") == [(3,)]


def test_rows_of_other_parts_and_plain_tables_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_table(spark.createDataFrame(made(range(3)), SCHEMA), path)
    with pytest.raises(ValueError, match="not published in parts"):
        tables.publish_parts(spark.createDataFrame([], SCHEMA), path, F.col("kind"), touched=["a"])
    tables.publish_parts(spark.createDataFrame([(1, "a", 1, 1)], SCHEMA), path, F.col("kind"))
    with pytest.raises(ValueError, match="other parts"):
        tables.publish_parts(spark.createDataFrame([(1, "b", 1, 1)], SCHEMA), path, F.col("kind"), touched=["a"])
    assert rows(tables.read_table(spark, path), "kind") == [("a",)]
    with pytest.raises(ValueError, match="in parts"):
        versions.resolved(spark, path)


def test_a_writer_that_was_overtaken_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.publish_parts(spark.createDataFrame([(1, "a", 1, 1)], SCHEMA), path, F.col("kind"))
    real = tables.publish_folders

    def late(*args, **options):
        monkeypatch.setattr(tables, "publish_folders", real)
        tables.publish_parts(spark.createDataFrame([(2, "b", 1, 1)], SCHEMA), path, F.col("kind"), touched=["b"])
        return real(*args, **options)

    monkeypatch.setattr(tables, "publish_folders", late)
    with pytest.raises(RuntimeError, match="another writer"):
        tables.publish_parts(spark.createDataFrame([(9, "a", 1, 1)], SCHEMA), path, F.col("kind"), touched=["a"])
    assert rows(tables.read_table(spark, path), "id") == [(1,), (2,)]


def test_replaced_parts_go_by_age(spark, tmp_path):
    path = tmp_path / "t"
    tables.publish_parts(spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 1)], SCHEMA), str(path), F.col("kind"))
    first = next((path / versions.VERSIONS).iterdir())
    tables.publish_parts(spark.createDataFrame([(3, "a", 1, 1)], SCHEMA), str(path), F.col("kind"), touched=["a"])
    assert (first / "part=a").exists()                     # for readers that began before
    assert versions.expire(spark, str(path), timedelta(seconds=-5)) == [f"{first.name}/part=a"]
    assert not (first / "part=a").exists() and (first / "part=b").exists()
    assert rows(tables.read_table(spark, str(path)), "id") == [(2,), (3,)]


def test_upsert_equals_the_whole_upsert_and_leaves_other_buckets(spark, tmp_path):
    path, rng = tmp_path / "t", random.Random(4)
    tables.publish_keyed(spark.createDataFrame(made(range(500)), SCHEMA), str(path), ["id"], 32)
    held = {r[0]: r for r in made(range(500))}
    for version in (2, 3, 4):
        before, folders = files(path), versions.resolved_parts(spark, str(path))
        change = made([*rng.sample(range(500), 3), 500 + version], version, version)
        touched = tables.upsert_table(spark, str(path), spark.createDataFrame(change, SCHEMA), ["id"])
        held |= {r[0]: r for r in change}
        assert rows(tables.read_table(spark, str(path))) == sorted(held.values(), key=lambda t: tuple((x is None, str(x)) for x in t))
        after, now = files(path), versions.resolved_parts(spark, str(path))
        assert 0 < len(touched) <= 4 and {n for n in now if now[n] != folders.get(n)} == touched
        assert {k: v for k, v in after.items() if k in before} == before
    assert tables.upsert_table(spark, str(path), spark.createDataFrame([], SCHEMA), ["id"]) == set()


def test_upsert_reads_only_the_buckets_it_writes(spark, tmp_path):
    path = tmp_path / "t"
    tables.publish_keyed(spark.createDataFrame(made(range(300)), SCHEMA), str(path), ["id"], 16)
    source = spark.createDataFrame([(7, "new", 0, 2)], SCHEMA)
    own = source.select(tables.bucket_name(["id"], 16)).first()[0]
    for file in path.rglob("*.parquet"):
        if f"part={own}/" not in str(file) and "/schema/" not in str(file):
            file.write_bytes(b"whoever reads this file fails")
            (file.parent / f".{file.name}.crc").unlink()
    table = tables.read_parts(spark, str(path), [own])
    assert tables.upsert_table(spark, str(path), source, ["id"]) == {own}
    assert rows(tables.read_parts(spark, str(path), [own]).where("id = 7"), "kind") == [("new",)]
    assert tables.read_parts(spark, str(path), [own]).count() == table.count()


def test_null_and_composite_keys_and_the_latest_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_keyed(spark.createDataFrame([(None, "a", 1, 1), (1, "a", 1, 1), (1, "b", 1, 1)], SCHEMA), path, ["id", "kind"], 4)
    batch = spark.createDataFrame([(1, "b", 7, 2), (1, "b", 8, 3), (2, None, 9, 2)], SCHEMA)
    tables.upsert_table(spark, path, latest_by_key(batch, ["id", "kind"], "version"), ["id", "kind"])
    assert rows(tables.read_table(spark, path), "id", "kind", "value") == [(1, "a", 1), (1, "b", 8), (2, None, 9), (None, "a", 1)]


def test_a_table_without_rows_is_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_keyed(spark.createDataFrame([], SCHEMA), path, ["id"], 8)
    tables.upsert_table(spark, path, spark.createDataFrame(made(range(5)), SCHEMA), ["id"])
    assert tables.read_table(spark, path).count() == 5
