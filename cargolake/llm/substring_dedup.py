"""Removal of word passages that occur more than once, by FM-indexes over shards of candidate passages.

Every window of ``window`` words has a minimiser, the least hash of its runs of
``GRAM`` words. Equal windows have equal minimisers, so

1. each text is cut into segments of consecutive windows with one minimiser;
2. segments whose minimiser occurs once in the corpus are dropped;
3. the others go to the shard of their minimiser, copies of a segment counted
   before they move;
4. each shard is a compressed FM-index over its segments, and the same segments
   are streamed through it: backward search gives the matching statistics, and
   windows that occur twice or more are reported as intervals.

A minimiser with many different segments would make one shard of them. Its
segments are cut into windows instead: hashes of the windows are counted, only
windows whose hash occurs again move, and each goes to a shard of its own words.
Equal windows still meet, no segment is streamed twice, and the work grows with
the number of windows. A shard holds a share of all words, or the segments of
one minimiser (``BLOCK_SEGMENTS`` rows at most).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from cargolake.llm.base import byte_words, hash_words, window_hashes, written
from cargolake.llm.fm_index import FMIndex

WINDOW = 35
GRAM = 8
RUN = 64  # windows in a segment at most
CHUNK = 1 << 16
SHARD_WORDS = 1 << 20
BLOCK_SEGMENTS = 4096  # segments of one minimiser in a shard at most; those of others are cut into windows
COMBINE = 200_000  # segments whose copies are counted together before they move


def segments(hashed: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, minimiser, and places of the minimiser, of every segment of a text."""
    gram = min(GRAM, window)
    n = len(hashed) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4
    grams, reach = window_hashes(hashed, gram), window - gram + 1
    place = np.concatenate([
        sliding_window_view(grams[i : i + CHUNK + reach - 1], reach).argmin(axis=1) + np.arange(i, min(i + CHUNK, n))
        for i in range(0, n, CHUNK)
    ])
    least = grams[place]
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    stops = np.append(change[1:], n)
    starts = np.concatenate([np.arange(a, b, RUN) for a, b in zip(change, stops)]) if (stops - change).max() > RUN else change
    moves = np.concatenate([[True], place[1:] != place[:-1]])
    moves[starts] = True
    return starts, np.diff(np.append(starts, n)), least[starts].view(np.int64), np.add.reduceat(moves.astype(np.int64), starts)


def text_key(text: Column) -> Column:
    """Equal for equal texts."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def marked(docs: DataFrame, window: int) -> DataFrame:
    """key, first, windows, minimiser and its times of the segments of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, found = [], []
            for key, text in zip(batch["key"], batch["text"]):
                parts = segments(hash_words(byte_words(text)), window)
                keys.extend([key] * len(parts[0]))
                found.append(parts)
            yield pd.DataFrame({
                "key": keys,
                **{c: np.concatenate([f[i] for f in found]) if found else [] for i, c in enumerate(("first", "windows", "minimiser", "times"))},
            })

    return docs.select(text_key(F.col("text")).alias("key"), "text").mapInPandas(
        run, "key binary, first int, windows int, minimiser bigint, times int"
    )


def cut(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The wanted segments of every document, once as places (key, first, segment) and once as words with their copies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, list] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(list(held.values()), columns=["minimiser", "segment", "words", "copies"])
            held.clear()
            return out.assign(key=None, first=None)

        for batch in batches:
            places = []
            for key, text, parts in zip(batch["key"], batch["text"], batch["parts"]):
                words = byte_words(text)
                for part in parts:
                    first, stop = part["first"], part["first"] + part["windows"] + window - 1
                    piece = b" ".join(words[first:stop])
                    name = hashlib.blake2b(piece, digest_size=16).digest()
                    places.append((key, first, name))
                    known = held.setdefault(name, [part["minimiser"], name, piece, 0])
                    known[3] += 1
                if len(held) > COMBINE:
                    yield flush()
            yield pd.DataFrame(places, columns=["key", "first", "segment"]).assign(minimiser=None, words=None, copies=None)
        yield flush()

    texts = docs.select(text_key(F.col("text")).alias("key"), "text")
    return texts.join(wanted, "key").mapInPandas(
        run, "key binary, first int, segment binary, minimiser bigint, words binary, copies bigint"
    )


def window_prints(segments: DataFrame, window: int) -> DataFrame:
    """segment, place, hash (``print``) and copies of every window of the segments."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [window_hashes(hash_words(w.split(b" ")), window).view(np.int64) for w in batch["words"]]
            n = np.array([len(p) for p in prints], np.int64)
            yield pd.DataFrame({
                "segment": batch["segment"].repeat(n).to_numpy(),
                "place": np.concatenate([np.arange(k) for k in n]) if len(n) else [],
                "print": np.concatenate(prints) if prints else [],
                "copies": batch["copies"].repeat(n).to_numpy(),
            })

    return segments.select("segment", "words", "copies").mapInPandas(run, "segment binary, place int, print bigint, copies bigint")


def cut_windows(segments: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """The windows of segments at ``places``, once as places (owner, place, segment) and once as words with their copies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, list] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame(list(held.values()), columns=["segment", "words", "copies"])
            held.clear()
            return out.assign(owner=None, place=None)

        for batch in batches:
            found = []
            for owner, text, copies, at in zip(batch["segment"], batch["words"], batch["copies"], batch["at"]):
                words = text.split(b" ")
                for place in at:
                    piece = b" ".join(words[place : place + window])
                    name = hashlib.blake2b(piece, digest_size=16).digest()
                    found.append((owner, place, name))
                    known = held.setdefault(name, [name, piece, 0])
                    known[2] += copies
                if len(held) > COMBINE:
                    yield flush()
            yield pd.DataFrame(found, columns=["owner", "place", "segment"]).assign(words=None, copies=None)
        yield flush()

    return segments.select("segment", "words", "copies").join(places, "segment").mapInPandas(
        run, "owner binary, place int, segment binary, words binary, copies bigint"
    )


def matched(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """Build the index of one shard and stream its segments: segment and the window runs (flattened) that occur again."""
    rows = rows.groupby("segment", as_index=False, sort=False).agg({"words": "first", "copies": "sum"})
    split = [w.split(b" ") for w in rows["words"]]
    hashed = hash_words([w for words in split for w in words])
    _, codes = np.unique(hashed, return_inverse=True)
    sequences = np.split(codes + 1, np.cumsum([len(w) for w in split])[:-1])
    index = FMIndex(sequences, rows["copies"].to_numpy(), RUN + window)
    found = index.repeats(sequences, np.full(len(sequences), 2), window)
    return pd.DataFrame(
        [(s, [x for run in f for x in run]) for s, f in zip(rows["segment"], found) if f], columns=["segment", "runs"]
    )


def repeated_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key`` of a text and ``runs``, (first, last) window starts whose words occur elsewhere too."""
    marks = written(marked(docs, window))
    # written, so that the join with it can split a minimiser that a third of the segments share
    twice = written(marks.groupBy("minimiser").agg(F.sum("times").alias("n")).where("n > 1").select("minimiser"))
    wanted = marks.join(twice, "minimiser").groupBy("key").agg(F.collect_set(F.struct("first", "windows", "minimiser")).alias("parts"))
    pieces = written(cut(docs, wanted, window))
    words = pieces.where(F.col("words").isNotNull()).select("segment", "minimiser", "words", "copies")

    # rows hold the copies of one task; those of minimisers with many rows are summed before they are judged
    many = written(words.groupBy("minimiser").count().where(F.col("count") > BLOCK_SEGMENTS).select("minimiser"))
    owned = None
    dealt = words.select(F.xxhash64("minimiser").alias("dealt"), "segment", "words", "copies")
    if not many.isEmpty():
        summed = written(words.join(many, "minimiser").groupBy("segment", "minimiser", "words").agg(F.sum("copies").alias("copies")))
        large = written(summed.groupBy("minimiser").count().where(F.col("count") > BLOCK_SEGMENTS).select("minimiser"))
        hot = summed.join(large, "minimiser")
        prints = written(window_prints(hot, window))
        again = written(prints.groupBy("print").agg(F.sum("copies").alias("n")).where("n > 1").select("print"))
        at = prints.join(again, "print").groupBy("segment").agg(F.collect_set("place").alias("at"))
        windows = written(cut_windows(hot, at, window))
        owned = windows.where(F.col("owner").isNotNull()).select("owner", "place", "segment")
        few = words.join(many, "minimiser", "left_anti").unionByName(summed.join(large, "minimiser", "left_anti").select(words.columns))
        dealt = few.select(F.xxhash64("minimiser").alias("dealt"), "segment", "words", "copies").unionByName(
            windows.where(F.col("words").isNotNull()).select(F.xxhash64("segment").alias("dealt"), "segment", "words", "copies")
        )
    volume = dealt.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(1, -(-volume // (6 * SHARD_WORDS)))  # some six bytes a word
    dealt = dealt.withColumn("shard", F.pmod(F.col("dealt"), F.lit(shards))).drop("dealt")
    runs = written(dealt.groupBy("shard").applyInPandas(lambda rows: matched(rows, window), "segment binary, runs array<int>"))
    if owned is not None:
        held = owned.join(runs.select("segment"), "segment").groupBy("owner").agg(F.collect_set("place").alias("at"))
        whole = held.select(F.col("owner").alias("segment"), F.flatten(F.transform("at", lambda p: F.array(p, p))).alias("runs"))
        runs = written(runs.unionByName(whole))
    places = pieces.where(F.col("key").isNotNull()).select("key", "first", "segment")
    hit = places.join(runs, "segment").select("key", F.struct("first", "runs").alias("hit"))
    return hit.groupBy("key").agg(F.collect_set("hit").alias("hits"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with a struct ``repeats``: n_words, n_removed, kept_text and spans (first word, word after the last).

    A word is removed if it lies in a window of ``window`` words that occurs
    again, in the same text or in another row; all occurrences go. Windows are
    judged on the given texts. ``kept_text`` is the kept words joined by one
    blank. Null and empty texts have no words; repeated rows are occurrences of
    each other; an empty table gives an empty table. Columns of ``docs`` keep
    their names, which must not include ``repeats``.
    """
    hits = repeated_runs(docs.select("text"), window)
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_key(F.col("text")).alias("key"))

    @F.pandas_udf("struct<n_words: bigint, n_removed: bigint, kept_text: string, spans: array<int>>")
    def clean(texts: pd.Series, hits: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, hits):
            words = byte_words(text)
            if found is None or not len(found):
                out.append((len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass"), []))
                continue
            edge = np.zeros(len(words) + 1, np.int64)
            for hit in found:
                runs = np.asarray(hit["runs"]).reshape(-1, 2)
                np.add.at(edge, hit["first"] + runs[:, 0], 1)
                np.add.at(edge, hit["first"] + runs[:, 1] + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
            kept = b" ".join([w for w, g in zip(words, gone) if not g]).decode("utf-8", "surrogatepass")
            spans = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            out.append((len(words), int(gone.sum()), kept, spans.tolist()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text", "spans"])

    joined = rows.join(hits, "key", "left")
    return joined.select("row.*", clean(F.col("row.text"), F.col("hits")).alias("repeats"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words as ``text`` and ``n_chars``, if there is such a column, counted anew."""
    # in a struct the columns may have any names
    cleaned = remove_repeats(docs.select(F.struct("*").alias("row"), "text"), window)
    row = F.col("row").withField("text", F.col("repeats.kept_text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("repeats.kept_text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(row.alias("row")).select("row.*")
