"""Token ids in files: one compressed wavelet matrix per shard, with the documents' bounds.

A shard holds the ids of consecutive documents (by ascending doc_id) as
zstd-compressed bit-planes. An opened shard answers which token stands where,
how often a token occurs in a range and where, without decoding the rest.

Documents are dealt by ranges of doc_id and written as they come, a shard at a
time, so a task's memory is bounded by ``shard_tokens`` (plus one document).
Files have names of their own per attempt and count only once the manifest
lists them, so a task that is run again leaves no half shard behind.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cargolake.config import checkpoint_folder
from cargolake.llm.base import written
from cargolake.llm.byte_bpe import encoder
from cargolake.llm.wavelet import WaveletMatrix

MAGIC = b"TOKS"
SHARD_TOKENS = 1 << 20
RANGE_DOCS = 5_000  # documents a task writes, in as many shards as they need
MANIFEST = "part int, shard int, path string, n_docs bigint, n_tokens bigint"


class TokenShard:
    """Documents of one file: ids as a wavelet matrix, doc_ids (None for null) and their ends."""

    def __init__(self, matrix: WaveletMatrix, doc_ids: list[int | None], ends: np.ndarray):
        self.matrix, self.doc_ids, self.ends = matrix, doc_ids, ends

    @classmethod
    def of(cls, doc_ids: list[int | None], documents: list[np.ndarray]) -> TokenShard:
        ends = np.cumsum([len(d) for d in documents], dtype=np.int64)
        ids = np.concatenate(documents) if documents else np.empty(0, np.uint16)
        return cls(WaveletMatrix.of(ids, 16), doc_ids, ends)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order."""
        ids, start = self.matrix.values(), 0
        for doc_id, end in zip(self.doc_ids, self.ends):
            yield doc_id, ids[start:end]
            start = end

    def document(self, nth: int) -> np.ndarray:
        """The ids of one document, by access alone."""
        start = self.ends[nth - 1] if nth else 0
        return self.matrix.access(np.arange(start, self.ends[nth]))

    def count(self, token: int) -> int:
        return self.matrix.count(token)

    def occurrences(self, token: int) -> list[tuple[int | None, int]]:
        """(doc_id, place in the document) of every occurrence of a token."""
        at = self.matrix.occurrences(token)
        nth = np.searchsorted(self.ends, at, side="right")
        starts = np.concatenate([[0], self.ends[:-1]])
        return [(self.doc_ids[d], int(p - starts[d])) for d, p in zip(nth, at)]

    def to_bytes(self) -> bytes:
        known = np.array([d is not None for d in self.doc_ids], bool)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        return (
            MAGIC + struct.pack("<Q", len(ids)) + np.packbits(known).tobytes() + ids.tobytes()
            + self.ends.astype("<i8").tobytes() + self.matrix.to_bytes()
        )

    @classmethod
    def from_bytes(cls, raw: bytes) -> TokenShard:
        if raw[:4] != MAGIC:
            raise ValueError("not a token shard")
        n = struct.unpack_from("<Q", raw, 4)[0]
        at = 12 + (n + 7) // 8
        known = np.unpackbits(np.frombuffer(raw[12:at], np.uint8), count=n).astype(bool)
        ids = np.frombuffer(raw, "<i8", n, at)
        ends = np.frombuffer(raw, "<i8", n, at + 8 * n)
        matrix = WaveletMatrix.from_bytes(raw[at + 16 * n :])
        return cls(matrix, [int(d) if k else None for d, k in zip(ids, known)], ends)

    @classmethod
    def open(cls, path: str) -> TokenShard:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_stream(name) as f:
            return cls.from_bytes(f.read())


def as_uri(path: str) -> str:
    return path if ":" in path.split("/")[0] else f"file://{path}"


def write_tokens(
    docs: DataFrame,
    folder: str | None = None,
    end_id: int = 0,
    tokenizer_path: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
    range_docs: int = RANGE_DOCS,
) -> DataFrame:
    """Write the ids of all documents, each closed by ``end_id``, and return the manifest of the files.

    ``folder`` must be shared by driver and executors (by default a new one
    below ``spark.checkpoint.dir``). Null and empty texts are the end id alone;
    a null doc_id comes first; rows with equal ids stand in the order of their
    texts. No documents give no files. Other columns are not read.
    """
    folder = as_uri(folder or f"{checkpoint_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}")
    rows = docs.select("doc_id", "text")
    parts = max(1, -(-docs.count() // range_docs))
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part = encoder(tokenizer_path).encode, TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        end, shard = np.array([end_id], np.uint16), 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            name = f"{part:08d}-{shard:06d}-{uuid.uuid4().hex}.tok"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(f"{base}/{name}") as f:
                f.write(TokenShard.of(doc_ids, held).to_bytes())
            return pd.DataFrame([(part, shard, f"{folder}/{name}", len(held), size)], columns=[c.split()[0] for c in MANIFEST.split(", ")])

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], encode(batch["text"])):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(np.concatenate([ids, end]))
                size += len(ids) + 1
                if size >= shard_tokens:
                    yield flush()
                    doc_ids, held, size, shard = [], [], 0, shard + 1
        if held:
            yield flush()

    return written(dealt.mapInPandas(run, MANIFEST))


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start (all ids before the document) and ``ids`` (32-bit little-endian) of every document, from the files."""
    in_part = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range of documents
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("before_part")
    )
    files = manifest.join(parts, "part").select(
        "path", (F.col("before_part") + F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))).alias("start")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                rows = []
                for doc_id, ids in TokenShard.open(path).documents():
                    rows.append((doc_id, start, ids.astype("<u4").tobytes()))
                    start += len(ids)
                found = pd.DataFrame(rows, columns=["doc_id", "start", "ids"])
                found["doc_id"] = pd.array([r[0] for r in rows], "Int64")
                yield found

    spread = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return files.repartition(spread).mapInPandas(run, "doc_id bigint, start bigint, ids binary")


def token_counts(manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """How often each of the given tokens occurs, by rank in the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                shard = TokenShard.open(path)
                yield pd.DataFrame({"token": tokens, "n": [shard.count(t) for t in tokens]})

    return manifest.select("path").mapInPandas(run, "token int, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
