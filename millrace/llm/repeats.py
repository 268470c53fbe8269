"""Repeated passages: seeds by winnowing, extension both ways, and removal of all but the first occurrence."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import gram_hashes, texts, word_hashes
from millrace.llm.workspace import Workspace

WINDOW = 20
#: An anchor is a run of so many words. Any two equal windows hold a common one, since of each WINDOW - SEED + 1 runs the smallest hash is taken.
SEED = 8


def anchors(h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the winnowed runs: of the runs in each window the one with the smallest hash, the last of equals."""
    grams = gram_hashes(h, seed)
    span = window - seed + 1
    if len(grams) < span:
        return grams[:0], np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)[:, ::-1]
    at = np.unique(np.arange(len(view)) + span - 1 - view.argmin(1))
    return grams[at], at


def nested(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    offsets = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))


def outlined(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, n_words, same (digest of the word sequence), and the anchors as hashes and places."""
    def run(batches):
        for batch in batches:
            count, same, hashes, places = [], [], [], []
            for text in texts(batch):
                words = text.split()
                found, at = anchors(word_hashes(words), window, seed) if len(words) >= window else anchors(np.empty(0, np.uint64), window, seed)
                count.append(len(words))
                same.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                hashes.append(found), places.append(at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(same, pa.binary()),
                                              nested(hashes, pa.int64()), nested(places, pa.int32())], ["doc_id", "n_words", "same", "hashes", "places"])
    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, same binary, hashes array<bigint>, places array<int>")


def around_seeds(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id with the hashes and starts of all windows that hold a seed: as far as a match of that length can extend to either side."""
    def run(batches):
        for batch in batches:
            hashes, starts = [], []
            for text, places in zip(texts(batch), batch.column("places").to_numpy(zero_copy_only=False)):
                grams = gram_hashes(word_hashes(text.split()), window)
                edges = np.zeros(len(grams) + 1, np.int64)
                places = places[places < len(grams) + window - seed]
                np.add.at(edges, np.maximum(places + seed - window, 0), 1)
                np.add.at(edges, np.minimum(places + 1, len(grams)), -1)
                at = np.flatnonzero(np.cumsum(edges[:-1]))
                hashes.append(grams[at]), starts.append(at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), nested(hashes, pa.int64()), nested(starts, pa.int32())], ["doc_id", "hashes", "places"])
    return docs.select("doc_id", "text", "places").mapInArrow(run, "doc_id bigint, hashes array<bigint>, places array<int>")


def exploded(table: DataFrame) -> DataFrame:
    return table.select("doc_id", F.explode(F.arrays_zip("hashes", "places")).alias("x")).select("doc_id", F.col("x.hashes").alias("h"), F.col("x.places").alias("at"))


def later_windows(plain: DataFrame, work: Workspace, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, places (starts of windows whose words also start earlier), whole (the text is a later copy, so all its windows do).

    Whole copies are set aside first. Anchors that occur once can't lie in a repeat, so only windows around the others are compared: each
    with the first window of the same hash, never with all of them.
    """
    outline = work.cut(outlined(plain, window, seed), "outline")
    long = outline.filter(F.col("n_words") >= window)
    firsts = work.cut(long.groupBy("same").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n"), "firsts")
    copies = work.cut(long.select("doc_id", "same").join(firsts, "same").filter("doc_id > first_id").select("doc_id").distinct(), "copies")
    found = exploded(outline.select("doc_id", "hashes", "places").join(copies, "doc_id", "left_anti"))
    repeated = work.cut(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeated")
    seeds = work.cut(found.join(repeated, "h").groupBy("doc_id").agg(F.collect_list("at").alias("places")), "seeds")
    work.drop(outline, firsts, repeated)
    windows = work.cut(around_seeds(plain.join(seeds.hint("shuffle_hash"), "doc_id"), window, seed), "windows")
    rows = exploded(windows)
    first = work.cut(rows.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at")).alias("first")).filter("n > 1").drop("n"), "first")
    later = rows.join(first, "h").filter(F.struct("doc_id", "at") > F.col("first")).groupBy("doc_id").agg(F.collect_list("at").alias("places"))
    marks = work.cut(later.withColumn("whole", F.lit(False)).union(copies.select("doc_id", F.array().cast("array<int>"), F.lit(True))), "marks")
    work.drop(copies, seeds, windows, first)
    return marks


def without_repeats(docs: DataFrame, work: Workspace, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by spaces), n_repeats, longest_repeat.

    A word goes when a window of ``window`` words that covers it also starts earlier (at a smaller id, or before in the same text); windows
    are judged on the input. n_repeats counts the maximal runs of removed words. Null and empty texts have no words; ids are taken to be
    unique: rows that repeat one share their marks; a null id is never marked nor earlier than another; an empty table gives no rows;
    other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = later_windows(plain.filter("doc_id is not null"), work, window, seed)

    def run(batches):
        for batch in batches:
            rows = []
            for text, places, whole in zip(texts(batch), batch.column("places").to_numpy(zero_copy_only=False), batch.column("whole").to_pylist()):
                words = text.split()
                gone = np.full(len(words), bool(whole))
                if places is not None and len(places):
                    edges = np.zeros(len(words) + 1, np.int64)
                    places = places[places + window <= len(words)]
                    np.add.at(edges, places, 1)
                    np.add.at(edges, places + window, -1)
                    gone |= np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                sizes = turns[1::2] - turns[::2]
                kept = words if not len(sizes) else [words[i] for i in np.flatnonzero(~gone)]
                rows.append((len(words), int(gone.sum()), b" ".join(kept), len(sizes), int(sizes.max(initial=0))))
            n, removed, kept, repeats, longest = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(repeats, pa.int64()), pa.array(longest, pa.int64())], ["doc_id", "n_words", "n_removed", "kept", "n_repeats", "longest_repeat"])
    return plain.join(marks.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "places", "whole").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, n_repeats bigint, longest_repeat bigint")
