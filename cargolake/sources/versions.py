"""Tables that are replaced without moving data: versions, and a log that names the current one.

A published table is a folder with

    _versions/<time>-<unique>/...     the rows of one version, written where they stay
    _log/<number>                     one small file per publication, which names its folders

The entry with the highest number is the current version. It is put in one
request when all rows are there, so a reader sees the old version or the new
one, and a run that dies at any point leaves at most a version that no entry
names. Nothing is renamed: on an object store a rename is a copy of every byte.
An entry ends with a mark; one that is cut off, as a file system without atomic
puts may leave it, counts as not there. Two writers cannot put the same number:
the later one takes the next, and as each is a full refresh the last one wins.

A table may be published in parts (buckets of a key, months). A publication then
writes only the parts that change; its entry names their new folders and, for
all other parts, the folders they have, so files of those are not touched.

Old versions stay readable for as long as ``expire`` lets them, for jobs that
began to read them; then their files go, and so do the leftovers of runs that
died. The names begin with an underscore, so a reader that does not know the
layout finds an empty table and fails, and never reads two versions as one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import SparkSession

LOG, VERSIONS = "_log", "_versions"
MARK = "published"  # the last line of a whole entry
KEEP = timedelta(days=1)


WHOLE = ""  # the one part of a table without parts


@dataclass(frozen=True)
class Entry:
    """A publication: its number, the folder of each part below ``_versions``, and when it was put (milliseconds)."""

    number: int
    parts: dict[str, str]
    put_at: int

    def versions(self) -> set[str]:
        return {folder.split("/")[0] for folder in self.parts.values()}


def store_of(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, path: str) -> list:
    store, at = store_of(spark, path)
    try:
        return list(store.listStatus(at))
    except Exception as e:  # py4j wraps the exception of the store
        if "FileNotFoundException" in str(e):
            return []
        raise


def content(spark: SparkSession, path: str) -> list[str]:
    """The lines of a small file; none if it was removed meanwhile."""
    store, at = store_of(spark, path)
    try:
        stream = store.open(at)
    except Exception as e:
        if "FileNotFoundException" in str(e):
            return []
        raise
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace").split("\n")
    finally:
        stream.close()


def _entry(spark: SparkSession, path: str, number: int, put_at: int) -> Entry | None:
    lines = content(spark, f"{path}/{LOG}/{number:020d}")
    if len(lines) < 2 or lines[-1] != MARK:
        return None
    named = [line.rpartition("\t") for line in lines[:-1]]
    return Entry(number, {name: folder for name, _, folder in named}, put_at)


def _numbers(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Numbers of all entries, whole or not, with the time of their put, the latest first."""
    found = [(s.getPath().getName(), s.getModificationTime()) for s in _children(spark, f"{path}/{LOG}")]
    return sorted(((int(name), at) for name, at in found if name.isdigit()), reverse=True)


def current(spark: SparkSession, path: str) -> Entry | None:
    """The entry of the version to read, or None if nothing was ever published there."""
    for number, put_at in _numbers(spark, path):
        entry = _entry(spark, path, number, put_at)
        if entry is not None:
            return entry
    return None


def resolved(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of a table without parts: its current version, or the table's own folder if it has none."""
    folders = resolved_parts(spark, path)
    if list(folders) != [WHOLE]:
        raise ValueError(f"{path} is published in parts")
    return folders[WHOLE]


def resolved_parts(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of every part of a table."""
    entry = current(spark, path)
    return {WHOLE: path} if entry is None else {name: f"{path}/{VERSIONS}/{folder}" for name, folder in entry.parts.items()}


def new_version(path: str) -> str:
    """A folder for the rows of the next version; the time in its name tells how old a leftover is."""
    return f"{path}/{VERSIONS}/{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in one request; False if there is one."""
    store, at = store_of(spark, path)
    if store.exists(at):
        return False
    try:
        stream = store.create(at, False)
    except Exception as e:
        if "AlreadyExists" in str(e):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()  # on an object store the file is there from here on, whole
    return True


def put_entry(spark: SparkSession, path: str, number: int, parts: Mapping[str, str]) -> bool:
    """Put the entry that makes the folders the current ones; False if another writer has taken the number."""
    root = f"{path}/{VERSIONS}/"
    lines = [f"{name}\t{folder.removeprefix(root)}" if name else folder.removeprefix(root) for name, folder in parts.items()]
    return put(spark, f"{path}/{LOG}/{number:020d}", "\n".join([*lines, MARK]))


def publish(spark: SparkSession, path: str, folder: str) -> int:
    """Make the written version the current one; returns its number."""
    return publish_folders(spark, path, {WHOLE: folder})


def publish_folders(spark: SparkSession, path: str, parts: Mapping[str, str], after: int | None = None) -> int:
    """Make the folders of all parts the current ones; returns the number of the publication.

    A publication that keeps parts of entry ``after`` must follow it: it is
    refused if another writer has published meanwhile.
    """
    if after is not None:
        if not put_entry(spark, path, after + 1, parts):
            raise RuntimeError(f"{path} was published by another writer")
        return after + 1
    numbers = _numbers(spark, path)
    number = numbers[0][0] + 1 if numbers else 1
    while not put_entry(spark, path, number, parts):
        number += 1
    return number


def expire(spark: SparkSession, path: str, keep: timedelta = KEEP) -> list[str]:
    """Delete what readers no longer need; returns the names of the versions that went.

    A version goes when the entry that followed it is older than ``keep``; a
    version without an entry, which a run is writing or has left behind, when
    it was begun before that. Files and partition folders beside the versions,
    from before the table had any, go like a version before the first entry.
    """
    entries = [e for e in (_entry(spark, path, *n) for n in _numbers(spark, path)) if e is not None]
    if not entries:
        return []
    before = time.time_ns() // 1_000_000 - keep // timedelta(milliseconds=1)
    gone = []
    read = [entries[0], *(old for new, old in zip(entries, entries[1:]) if new.put_at > before)]
    kept, folders = {v for e in read for v in e.versions()}, {f for e in read for f in e.parts.values()}
    named = {v for e in entries for v in e.versions()}
    for status in _children(spark, f"{path}/{VERSIONS}"):
        name = status.getPath().getName()
        if name not in kept and (name in named or int(name.split("-")[0]) <= before):
            store, at = store_of(spark, f"{path}/{VERSIONS}/{name}")
            store.delete(at, True)
            gone.append(name)
        elif name in kept and name not in folders:  # parts of it that later publications replaced
            for part in {f for e in entries for f in e.parts.values() if f.startswith(f"{name}/")} - folders:
                store, at = store_of(spark, f"{path}/{VERSIONS}/{part}")
                if store.delete(at, True):
                    gone.append(part)
    for entry in entries:  # an entry goes after its rows, so a reader that holds it never lacks them for long
        if entry not in read:
            store, at = store_of(spark, f"{path}/{LOG}/{entry.number:020d}")
            store.delete(at, False)
    if entries[-1].put_at <= before:
        for status in _children(spark, path):
            name = status.getPath().getName()
            if name not in (LOG, VERSIONS) and (status.isFile() or "=" in name):
                store, at = store_of(spark, f"{path}/{name}")
                store.delete(at, True)
                gone.append(name)
    return gone
