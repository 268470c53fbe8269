"""Ranked lexical search: the best documents for each item of a query set, in whole numbers.

A task holds a block of documents as one bitmap for each term. For an item, the bits of its terms at a document are the document's mask;
all documents with one mask share a maximum score. Masks are evaluated from the highest maximum down, and the rest is safely left when
it is below the worst of the best found so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.words import texts

#: Upper-case A-Z to lower case, all other characters below 0x80 that are no letters or digits to a space; bytes of longer characters stay.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
BEST = 10
#: Documents of a block, and postings after which it is closed earlier.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 20
#: Bytes of item texts that are searched for in one pass over the documents.
ITEM_BYTES = 4 << 20
#: Rows of bitmaps spread to one byte a document at once; masks evaluated before the bound is looked at again.
SPREAD, MASKS = 256, 64
#: Parts in which the best of all tasks are first narrowed down.
SALTS = 64

WORDS_OF_ALL, DOCS = -2, -1


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def item_blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items as (id, terms with repeats), in blocks of bounded size; the driver holds one block and a partition of the items."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("bigint").alias("id"), F.col("text").cast("string").cast("binary").alias("text")).toLocalIterator():
        own = bytes(row.text or b"")
        if block and size + len(own) > most:
            yield block
            block, size = [], 0
        block.append((row.id, Counter(terms(own))))
        size += len(own)
    if block:
        yield block


def statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> dict[int, int]:
    """Documents that hold each term of ``vocabulary``, by its number; at DOCS the documents with terms, at WORDS_OF_ALL their terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known, held, n_docs, n_words = shared.value, Counter(), 0, 0
        for batch in batches:
            for text in texts(batch):
                words = terms(text)
                n_docs += bool(words)
                n_words += len(words)
                held.update(known.keys() & set(words))
        numbers = [known[w] for w in held] + [DOCS, WORDS_OF_ALL]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([*held.values(), n_docs, n_words], pa.int64())], ["number", "n"])

    rows = docs.select("text").mapInArrow(run, "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n"))
    return {r.number: r.n for r in rows.collect()}  # one row for each term of the items at most


class Search:
    """The items of a block against blocks of documents, keeping each item's best."""

    def __init__(self, items: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_words: int, best: int):
        self.items = [(np.array(sorted(item), np.int64), np.array([item[t] for t in sorted(item)], np.int64)) for item in items]
        self.weights, self.n_docs, self.n_words, self.best = weights, n_docs, n_words, best
        self.found: list[list[tuple]] = [[] for _ in items]

    def block(self, ids: list[int | None], lengths: list[int], sizes: list[int], term: np.ndarray, tf: np.ndarray) -> None:
        """Documents with their postings (numbers of terms and how often), those of one document side by side."""
        n, at = len(ids), np.concatenate([[0], np.cumsum(sizes)])
        doc = np.repeat(np.arange(n), sizes)
        m = np.array([25 + 75 * length * self.n_docs // self.n_words for length in lengths], np.int64)
        value = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        # a row of bits for each term that the block has, and the most that a document gets from it
        order = np.argsort(term, kind="stable")
        present, first = np.unique(term[order], return_index=True)
        row_of = np.full(len(self.weights), -1)
        row_of[present] = np.arange(len(present))
        bitmaps = np.zeros((len(present), -(-n // 8)), np.uint8)
        np.bitwise_or.at(bitmaps, (row_of[term], doc >> 3), (128 >> (doc & 7)).astype(np.uint8))
        highest = np.maximum.reduceat(value[order], first) if len(first) else np.empty(0, np.int64)
        times = np.zeros(len(self.weights), np.int64)
        for item, (own, repeats) in enumerate(self.items):
            here = row_of[own] >= 0
            rows = row_of[own[here]]
            if not len(rows):
                continue
            times[own] = repeats
            self.search(item, ids, n, at, bitmaps[rows], highest[rows] * repeats[here], lambda some: self.scores(some, at, times[term], value))
            times[own] = 0

    def search(self, item, ids, n, at, bitmaps, highest, scores) -> None:
        bound = np.zeros(n, np.int64)
        for low in range(0, len(bitmaps), SPREAD):
            spread = np.unpackbits(bitmaps[low:low + SPREAD], axis=1, count=n)
            for bits, most in zip(spread, highest[low:low + SPREAD]):
                bound += bits * most
        some = np.flatnonzero(bound >= max(1, self.least(item)))
        if not len(some):
            return
        # the masks of the documents left: their column of bits, packed
        masks = np.concatenate([np.packbits(np.unpackbits(bitmaps[low:low + SPREAD], axis=1, count=n)[:, some], axis=0) for low in range(0, len(bitmaps), SPREAD)])
        order = np.lexsort([*masks, -bound[some]])
        some, masks = some[order], masks[:, order]
        heads = np.flatnonzero(np.append(True, (masks[:, 1:] != masks[:, :-1]).any(0)))
        ends = np.append(heads[1:], len(some))
        for low in range(0, len(heads), MASKS):
            if bound[some[heads[low]]] < self.least(item):
                break
            group = some[heads[low]:ends[min(low + MASKS, len(heads)) - 1]]
            total = scores(group)
            keep = np.flatnonzero(total >= max(1, self.least(item)))
            new = [(-int(total[k]), ids[group[k]] is None, ids[group[k]] or 0) for k in keep]
            self.found[item] = sorted(self.found[item] + new)[:self.best]

    def least(self, item: int) -> int:
        """A document below this score is not among the best."""
        found = self.found[item]
        return -found[-1][0] if len(found) == self.best else 0

    @staticmethod
    def scores(some: np.ndarray, at: np.ndarray, times: np.ndarray, value: np.ndarray) -> np.ndarray:
        sizes = at[some + 1] - at[some]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes) + np.repeat(at[some], sizes)
        return np.diff(np.concatenate([[0], np.cumsum(times[places] * value[places])])[ends])


def best_of_tasks(docs: DataFrame, vocabulary: dict[bytes, int], items: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_words: int, best: int) -> DataFrame:
    """item (its place in ``items``), doc_id, score: the best of each task."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, items, weights))

    def run(batches):
        known, own, weight = shared.value
        search = Search(own, weight, n_docs, n_words, best)
        ids, lengths, sizes, number, often = [], [], [], [], []

        def close():
            if ids:
                search.block(ids, lengths, sizes, np.array(number, np.int64), np.array(often, np.int64))
                for x in (ids, lengths, sizes, number, often):
                    x.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = terms(text)
                counted = Counter(words)
                before = len(number)
                for word in counted.keys() & known.keys():
                    number.append(known[word])
                    often.append(counted[word])
                if len(number) > before:
                    ids.append(doc_id), lengths.append(len(words)), sizes.append(len(number) - before)
                    if len(ids) == BLOCK_DOCS or len(number) >= BLOCK_POSTINGS:
                        close()
        close()
        rows = [(i, None if null else doc_id, -score) for i, found in enumerate(search.found) for score, null, doc_id in found]
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def rank(docs: DataFrame, items: DataFrame, best: int = BEST, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` its ``best`` documents with a score above 0, equal scores by ascending doc_id.

    A null text has no terms, an item without terms or matches no rows. Rows that repeat a doc_id are documents of their own, rows that
    repeat an item_id items of their own; a null doc_id comes after all others of its score. Two passes over the documents for each block
    of items; a task keeps one block of documents. Other columns are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in item_blocks(items, item_bytes):
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for _, counted in block for w in counted))}
        stats = statistics(plain, vocabulary) if vocabulary else {}
        n_docs, n_words = stats.get(DOCS, 0), stats.get(WORDS_OF_ALL, 0)
        if not n_docs:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * stats.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
        numbered = [{vocabulary[w]: n for w, n in counted.items()} for _, counted in block]
        rows = best_of_tasks(plain, vocabulary, numbered, weights, n_docs, n_words, best)
        rows = rows.withColumn("salt", F.spark_partition_id() % SALTS)
        for keys in (("item", "salt"), ("item",)):
            rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= best)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item bigint, item_id bigint")
        out = out.unionByName(rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
