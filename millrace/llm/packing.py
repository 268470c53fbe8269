"""Best-fit packing of documents into fixed-size training sequences, under conflicts."""

from __future__ import annotations

import hashlib
from bisect import insort
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import texts
from millrace.llm.workspace import Workspace

CAPACITY = 2048
PER_SOURCE = 2
#: Pieces of one task. Documents are dealt to shards by a hash, so every shard holds the same mix of sources.
SHARD_ROWS = 8192
PIECES = "doc_id bigint, piece int, first_word bigint, n_words bigint, shard bigint, bin bigint, bin_start bigint"


class Bins:
    """Open bins ordered by what is left in them.

    A bin carries bitmaps of the clusters in it and of the sources seen once and ``per_source`` times. A piece goes to the fullest bin
    that has room and no conflict: the search starts at the smallest sufficient residual and goes on to the next larger one.
    """

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.levels: dict[int, list[int]] = defaultdict(list)
        self.occupied = 0  # a bit for each residual that some bin has
        self.left: list[int] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # per bin, bit s of entry k: source s is in the bin more than k times

    def _levels_from(self, need: int) -> Iterator[int]:
        above = self.occupied >> need
        while above:
            step = (above & -above).bit_length() - 1
            need += step
            yield need
            above >>= step + 1
            need += 1

    def _move(self, b: int, size: int) -> None:
        left = self.left[b]
        self.levels[left].remove(b)
        if not self.levels[left]:
            self.occupied &= ~(1 << left)
        self._enter(b, left - size)

    def _enter(self, b: int, left: int) -> None:
        self.left[b] = left
        insort(self.levels[left], b)
        self.occupied |= 1 << left

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """``source`` and ``cluster`` are single-bit masks, 0 for none. The bin and where in it the piece starts."""
        last = self.per_source - 1
        for level in self._levels_from(size):
            for b in self.levels[level]:
                if not self.clusters[b] & cluster and not self.sources[b][last] & source:
                    self._move(b, size)
                    break
            else:
                continue
            break
        else:
            b = len(self.left)
            self.left.append(0)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
            self._enter(b, self.capacity - size)
        self.clusters[b] |= cluster
        for k, seen in enumerate(self.sources[b]):
            if not seen & source:
                self.sources[b][k] = seen | source
                break
        return b, self.capacity - self.left[b] - size


def bits(values: Iterable) -> dict:
    return {v: 1 << i for i, v in enumerate(values)}


def pack(rows: list[tuple], capacity: int, per_source: int) -> Iterator[tuple]:
    """(doc_id, source, cluster, n_words) to (doc_id, piece, first_word, n_words, bin, bin_start), best fit in order of falling size."""
    pieces = []
    for doc_id, source, cluster, n in rows:
        for k, first in enumerate(range(0, max(n, 1), capacity)):
            pieces.append((min(capacity, n - first), doc_id, k, first, source, cluster))
    pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2]))
    sources = bits(sorted({s for _, s, _, _ in rows if s is not None}))
    clusters = bits(sorted(c for c, k in Counter(c for _, _, c, _ in rows if c is not None).items() if k > 1))
    bins = Bins(capacity, per_source)
    for size, doc_id, k, first, source, cluster in pieces:
        b, start = bins.place(size, sources.get(source, 0), clusters.get(cluster, 0)) if size else (None, None)
        yield doc_id, k, first, size, b, start


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, cluster (a digest of the text), n_words."""
    def run(batches):
        for batch in batches:
            body = texts(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"),
                 pa.array([hashlib.blake2b(t, digest_size=16).digest() if t else None for t in body], pa.binary()),
                 pa.array([len(t.split()) for t in body], pa.int64())], ["doc_id", "source", "cluster", "n_words"])
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")]
    return docs.select(columns).mapInArrow(run, "doc_id bigint, source string, cluster binary, n_words bigint")


def best_fit(docs: DataFrame, work: Workspace, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin_id, bin_start.

    Sizes are counted in words. A document longer than ``capacity`` is cut into whole bins and a rest. No bin holds two pieces with the same
    text digest (two copies; rests of one document included) or more than ``per_source`` pieces of one source; a null source or an empty
    text conflicts with nothing. A document without words has one row of 0 words and null bin_id. Ties go to the smaller id and the older
    bin. Rows that repeat an id are packed each; an empty table gives no rows; other columns are not read.
    Each shard is packed alone, so ``shard_rows`` bounds a task; with shards of thousands of pieces the bins left open are few.
    """
    sizes = work.cut(measured(docs), "sizes")
    shards = max(1, -(-sizes.count() // shard_rows))
    dealt = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))

    def run(key, table):
        shard = key[0].as_py()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "source", "cluster", "n_words"))))
        out = list(zip(*pack(rows, capacity, per_source)))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        cols = [pa.array(c, k) for c, k in zip(out, kinds)]
        cols.insert(4, pa.array([shard] * len(cols[0]), pa.int64()))
        return pa.Table.from_arrays(cols, ["doc_id", "piece", "first_word", "n_words", "shard", "bin", "bin_start"])

    packed = dealt.groupBy("shard").applyInArrow(run, PIECES)
    return packed.select("doc_id", "piece", "first_word", "n_words", (F.col("shard") * F.lit(1 << 32) + F.col("bin")).alias("bin_id"), "bin_start")
