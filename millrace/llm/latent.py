"""Benchmark decontamination by latent semantic retrieval, then checks on the words themselves."""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from millrace.llm.words import texts
from millrace.llm.workspace import Workspace

#: Words are hashed to so many terms; with the rank this bounds everything that is broadcast or brought to the driver.
TERMS, RANK, RESIDUAL, SLICES = 1 << 14, 32, 48, 64
LATENT_WEIGHT = 0.5  # of a term's latent coordinates against those of its residual
PASSAGE = 32  # words of a passage that the decomposition sees
STEP, LENGTHS = 8, (8, 16, 24, 32, 40, 48, 56, 64)  # windows that are searched: starts and words
#: Least cosine of a window with a passage as long as itself; it falls with the square root of the passage's share of the window.
COSINE = 0.2
#: Passages of so many words and fewer meet every window, since one word of eight says little in a cosine; up to LONG the least cosine rises.
SHORT, LONG = 4, 16
#: A window counts as a copy of an item with so much of it in common order, or with less when the answer is there too.
SAME, PARAPHRASE, ANSWER = 0.75, 0.55, 0.8
#: Or with a run of its words, one after the other: half of them, at least RUNS[0] (all of a shorter item) and at most RUNS[1].
RUNS = (13, 32)
#: An item over LENGTHS[-1] words has passages of that length that start so far apart, so any run of RUNS[1] words lies whole in one.
PART_STEP = LENGTHS[-1] - RUNS[1]
#: The least share of a passage in common order with which a window can match in any of these ways.
LEAST_SHARE = 0.5
#: Items whose vectors are broadcast at once; a larger benchmark is searched block by block.
BLOCK_ITEMS = 20_000
PLAIN = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\"'()[]{}<>*_-", bytes(range(97, 123)) + b" " * 19)


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def terms(words: list[bytes]) -> np.ndarray:
    return (np.fromiter(map(crc32, words), np.uint32, len(words)) >> np.uint32(32 - 14)).astype(np.uint16)


def batches_of_words(rows, most: int = 200_000):
    """Groups of row numbers with about ``most`` words."""
    group, held = [], 0
    for i, r in enumerate(rows):
        group.append(i)
        held += len(r)
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def laid_out(docs: list[np.ndarray], length: int, spare: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The terms of texts as rows of ``length``, and the text of each row. Gaps, and ``spare`` rows after each text, hold TERMS."""
    rows = [-(-len(d) // length) + spare for d in docs]
    flat = np.full(sum(rows) * length, TERMS, np.int64)
    at = 0
    for d, n in zip(docs, rows):
        flat[at:at + len(d)] = d
        at += n * length
    return flat.reshape(-1, length), np.repeat(np.arange(len(docs)), rows)


def row_sums(index: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row of ``index`` the sum of the rows of ``table`` that it names; the last row of ``table`` is zero."""
    total, more = table[index[:, 0]], None
    for column in index.T[1:]:
        more = np.take(table, column, 0, more, "clip")
        total += more
    return total


def with_zero(table: np.ndarray) -> np.ndarray:
    return np.concatenate([table, np.zeros((1, *table.shape[1:]), table.dtype)])


class Sums:
    """Sums of equally shaped matrices over all tasks: cut into slices of rows, added in two levels of bounded groups."""

    def __init__(self, partitions: int):
        self.fan = math.isqrt(max(1, partitions)) + 1

    @staticmethod
    def rows(matrix: np.ndarray, task: int, fan: int):
        parts = np.split(matrix.astype(np.float32), SLICES)
        return pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "salt": pa.array([task % fan] * SLICES, pa.int32()),
                                           "sums": pa.array([p.tobytes() for p in parts], pa.binary())})

    @staticmethod
    def added(key, table):
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("sums"))
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    def total(self, parts: DataFrame, columns: int) -> np.ndarray:
        some = parts.groupBy("slice", "salt").applyInArrow(self.added, "slice int, sums binary")
        rows = some.groupBy("slice").applyInArrow(self.added, "slice int, sums binary").collect()
        return np.vstack([np.frombuffer(r.sums, np.float32).reshape(-1, columns) for r in sorted(rows, key=lambda r: r.slice)]).astype(np.float64)


def hashed(docs: DataFrame) -> DataFrame:
    """The terms of each text, two bytes a word."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"terms": pa.array([terms(plain_words(t)).tobytes() for t in texts(batch)], pa.binary())})
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "terms binary")


def inverse_frequency(table: DataFrame) -> np.ndarray:
    """log(documents / documents with the term), smoothed, for each term."""
    def run(batches):
        count, last = np.zeros(TERMS, np.int64), np.zeros(TERMS, np.int64)
        for batch in batches:
            for x in batch.column("terms").to_pylist():
                words = np.frombuffer(x, np.uint16)
                place = np.arange(len(words))
                last[words] = place
                count[words[last[words] == place]] += 1  # each term where it stands last
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen, pa.int32()), "docs": pa.array(count[seen], pa.int64())})
    found = table.mapInArrow(run, "term int, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs")).collect()
    total, docs = table.count(), np.zeros(TERMS)
    docs[[r.term for r in found]] = [r.docs for r in found]
    return np.log((total + 1) / (docs + 1)) + 0.1


def gram(table: DataFrame, weights: np.ndarray, basis: np.ndarray, sums: Sums) -> np.ndarray:
    """AᵀA times ``basis`` (terms x rank), where the rows of A are the weighted terms of every passage, scaled to length one."""
    shared = table.sparkSession.sparkContext.broadcast(
        (with_zero(weights.astype(np.float32)), with_zero((weights[:, None] * basis).astype(np.float32))))
    rank, fan = basis.shape[1], sums.fan

    def run(batches):
        from pyspark import TaskContext

        weight, table = shared.value
        total = np.zeros((rank, TERMS + 1))
        for batch in batches:
            docs = [np.frombuffer(x, np.uint16) for x in batch.column("terms").to_pylist()]
            for group in batches_of_words(docs):
                index, _ = laid_out([docs[i] for i in group], PASSAGE)
                if len(index):
                    squares = row_sums(index, weight ** 2)
                    rows = (row_sums(index, table) / squares[:, None]).T.astype(np.float64)
                    flat = index.ravel()
                    for k in range(rank):
                        total[k] += np.bincount(flat, np.repeat(rows[k], PASSAGE), TERMS + 1)
        yield Sums.rows((total * weight).T[:TERMS], TaskContext.get().partitionId(), fan)
    got = sums.total(table.mapInArrow(run, "slice int, salt int, sums binary"), rank)
    shared.unpersist()
    return got


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


class LatentSpace:
    """Randomised singular value decomposition of the TF-IDF passages of a corpus, in two passes over its terms.

    A term's coordinates along the right singular vectors, each divided by its singular value, are scaled to one length, so that no word
    from an often repeated passage decides alone. A low rank leaves most of a rare word unexplained; that residual is kept by a random
    projection beside the latent coordinates, which brings the cosine of unrelated passages near 0. A passage is the weighted sum.
    """

    def __init__(self, docs: DataFrame, work: Workspace, rank: int = RANK, seed: int = 3):
        table = work.cut(hashed(docs), "terms")
        sums = Sums(table.rdd.getNumPartitions())
        self.weights = inverse_frequency(table)
        start = np.random.default_rng(seed).normal(size=(TERMS, rank))
        basis, _ = np.linalg.qr(gram(table, self.weights, start, sums))
        image = gram(table, self.weights, basis, sums)
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        good = values > 1e-9 * max(values.max(), 1e-300)
        self.singular = np.sqrt(values[good])
        loadings = (basis @ turn[:, good]) / self.singular
        residual = np.random.default_rng(seed + 1).normal(size=(TERMS, RESIDUAL))
        self.map = (self.weights[:, None] * np.hstack([LATENT_WEIGHT * unit_rows(loadings), unit_rows(residual)])).astype(np.float32)
        work.drop(table)


def longest_common(bits: dict[bytes, int], n: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence of an item of ``n`` words (as bits by word) and ``words``."""
    full = (1 << n) - 1
    v = full
    for w in words:
        u = v & bits.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def positions(words: list[bytes]) -> dict[bytes, int]:
    found: dict[bytes, int] = {}
    for i, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << i
    return found


def answer_of(text: bytes) -> list[bytes]:
    """What follows the last 'Answer:' or question mark; without them the last sentence, or the last five words where that is shorter."""
    tail = re.split(rb"(?i)\banswer\s*:|\?", text)
    if len(tail) > 1 and plain_words(tail[-1]):
        return plain_words(tail[-1])
    sentence = plain_words(re.split(rb"[.!]\s", text.rstrip(b" .!\n"))[-1])
    return sentence if len(sentence) >= 5 else plain_words(text)[-5:]


def least_cosine(words: int, length: int) -> float:
    """From which cosine a window of ``length`` words proposes a passage of so many words."""
    return -1.0 if words <= SHORT else COSINE * min(1, words / LONG) * math.sqrt(words / length)


def common_words(near: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """`longest_common` of many rows at once, for passages of ``n`` <= 64 words (of one length, or one for each row): each row has the places in
    its passage of its words, as bits. Words that are not in the passage, and columns of zeros, change nothing."""
    n = np.broadcast_to(np.asarray(n, np.int64), len(near))
    full = np.uint64((1 << 64) - 1) >> (64 - n).astype(np.uint64)
    v = full.copy()
    for u in near.T:
        u = u & v
        v = ((v + u) | (v - u)) & full
    return n - np.bitwise_count(v).astype(np.int64)


def standing(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``index`` in which each term stands, term after term, and where each term's rows begin."""
    flat = index.ravel().astype(np.uint16)
    starts = np.zeros(TERMS + 2, np.int64)
    np.cumsum(np.bincount(flat, minlength=TERMS + 1), out=starts[1:])
    return np.argsort(flat, kind="stable") // index.shape[1], starts


def any_of(held: np.ndarray, width: int) -> np.ndarray:
    """The bits of each ``width`` neighbours together."""
    have = 1
    while 2 * have <= width:
        held = held[:-have] | held[have:]
        have *= 2
    return held[:have - width] | held[width - have:] if have < width else held


def needed_run(n: int) -> int:
    return min(n, max(RUNS[0], min(RUNS[1], -(-n // 2))))


def passages(n: int) -> list[tuple[int, int]]:
    """Start and end of the passages of an item of ``n`` words: whole, or LENGTHS[-1] words each. To those come equal parts side by side, of
    which one has its share when the item has."""
    longest = LENGTHS[-1]
    if n <= longest:
        return [(0, n)]
    cuts = [round(n * k / -(-n // longest)) for k in range(-(-n // longest) + 1)]
    return sorted({*zip(cuts, cuts[1:]), *((min(a, n - longest), min(a, n - longest) + longest) for a in range(0, n - RUNS[1], PART_STEP))})


class Items:
    """Benchmark items: word sequences for the checks and, for each searched length, unit vectors of their passages."""

    def __init__(self, rows: list[tuple[int, bytes]], term_map: np.ndarray):
        self.ids, self.words, self.bits, self.answers, self.runs = [], [], [], [], []
        self.space_map = with_zero(term_map)
        vectors: dict[int, list] = {n: [] for n in LENGTHS}
        for item_id, text in rows:
            words = plain_words(text)
            if not words:
                continue
            self.ids.append(item_id)
            self.words.append(len(words))
            self.bits.append(positions(words))
            answer = answer_of(text)
            self.answers.append((len(answer), positions(answer)))
            size = needed_run(len(words))
            self.runs.append((size, {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}))
            for a, b in passages(len(words)):
                piece = terms(words[a:b])
                v = term_map[piece].sum(0)
                length = next(n for n in LENGTHS if n >= b - a)
                places = positions(piece.tolist())
                vectors[length].append(((len(self.ids) - 1, a, b - a, np.array(list(places)), np.array(list(places.values()), np.uint64)),
                                        v / max(np.linalg.norm(v), 1e-12), least_cosine(b - a, length)))
        self.queries = {n: ([where for where, *_ in vs], np.array([v for _, v, _ in vs], np.float32),
                            np.array([least for *_, least in vs], np.float32)) for n, vs in vectors.items() if vs}

    def search(self, docs: list[np.ndarray]):
        """(document, item, cosine, first word, first word of the item's passage, its length) of windows whose cosine with a passage is high enough and
        which, with their surroundings, hold enough of its terms in common order. Terms are hashed words, so none with enough words is left out.

        ``docs``: terms. All windows of one length meet all passages of that length in one product.
        """
        longest = LENGTHS[-1] // STEP
        index, owner = laid_out(docs, STEP, longest - 1)
        first = np.searchsorted(owner, np.arange(len(docs)))
        blocks = row_sums(index, self.space_map)
        n = len(blocks) - longest + 1
        windows, real = blocks[:n].copy(), index[:n, 0] < TERMS
        gap = np.full((longest, STEP), TERMS, np.int64)
        flat = np.concatenate([gap, index, gap])
        rows, starts = standing(flat)
        starts = starts.tolist()
        at = np.zeros(TERMS + 1, np.uint64)  # of the passage in hand, a bit for each place of a term
        held = np.zeros(len(flat), np.uint64)  # and for each place of the terms that stand in a block
        limit, hit = np.empty(n, np.float32), np.empty(n, bool)
        near, left, waiting = [], [], 0

        def enough():
            """Of the windows that wait, those with enough of their passage in common order."""
            lengths = np.repeat([where[2] for where, *_ in left], [len(w) for _, w, _ in left])
            widest = max(x.shape[1] for x in near)
            padded = np.zeros((waiting, widest), np.uint64)
            low = 0
            for x in near:
                padded[low:low + len(x), :x.shape[1]] = x
                low += len(x)
            good = (common_words(padded, lengths) >= np.ceil(LEAST_SHARE * lengths)).tolist()
            low = 0
            for (item, offset, m, *_), some, cosines in left:
                for w, cosine, fits in zip(some.tolist(), cosines.tolist(), good[low:low + len(some)]):
                    if fits:
                        yield int(owner[w]), item, cosine, (w - int(first[owner[w]])) * STEP, offset, m
                low += len(some)

        for span in range(1, longest + 1):
            if span > 1:
                windows += blocks[span - 1:span - 1 + n]
            where, queries, least = self.queries.get(span * STEP, (None, None, None))
            if where is None:
                continue
            norms = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            norms = np.maximum(norms, 1e-12)
            for low in range(0, len(queries), 1024):
                cosines = queries[low:low + 1024] @ windows.T
                for q, row in enumerate(cosines, low):
                    np.greater_equal(row, np.multiply(norms, least[q], out=limit), out=hit)
                    hit &= real
                    if not hit.any():
                        continue
                    _, _, m, piece, places = where[q]
                    need = math.ceil(LEAST_SHARE * m)
                    before, after = -(-(m // 4 + STEP) // STEP), -(-(m + m // 4 + STEP) // STEP)  # in blocks
                    held[:] = 0
                    for term, bits in zip(piece.tolist(), places):
                        if starts[term] < starts[term + 1]:
                            held[rows[starts[term]:starts[term + 1]]] |= bits
                    hit &= np.bitwise_count(any_of(held[len(gap) - before:n + len(gap) + after - 1], before + after)) >= need  # in any order
                    good = np.flatnonzero(hit)
                    if not len(good):
                        continue
                    at[piece] = places
                    for some in np.array_split(good, len(good) // 20_000 + 1):
                        near.append(at[flat[some[:, None] + np.arange(len(gap) - before, len(gap) + after)]].reshape(len(some), -1))
                        left.append((where[q], some, row[some] / norms[some]))
                        waiting += len(some)
                        if waiting >= 20_000:
                            yield from enough()
                            near, left, waiting = [], [], 0
                    at[piece] = 0
        if waiting:
            yield from enough()

    def quoted(self, i: int, offset: int, m: int, words: list[bytes], start: int) -> bool:
        """Whether the words around a window hold a needed run of the item, or the passage at ``offset`` of a long item in common order."""
        near = words[max(0, start - m // 4 - 2 * STEP):start + m + m // 4 + 2 * STEP]
        size, runs = self.runs[i]
        if any(tuple(near[k:k + size]) in runs for k in range(len(near) - size + 1)):
            return True
        if m < LENGTHS[-1] or self.words[i] == m:
            return False
        full = (1 << m) - 1
        part = {w: x >> offset & full for w, x in self.bits[i].items()}
        return longest_common(part, m, near) >= SAME * m

    def matches(self, words: list[list[bytes]]) -> list[dict[int, tuple]]:
        """For each text, by item_id: (share of the item in common order, share of the answer, cosine, first word of the window)."""
        found: list[dict[int, tuple]] = [{} for _ in words]
        for d, i, cosine, start, offset, m in self.search([terms(w) for w in words]):
            n = self.words[i]
            low = max(0, start - offset - n // 4 - STEP)
            region = words[d][low:max(0, start - offset + n + n // 4 + 2 * STEP)]
            share = longest_common(self.bits[i], n, region) / n
            size, bits = self.answers[i]
            answer = longest_common(bits, size, region) / size
            if share >= SAME or (share >= PARAPHRASE and answer >= ANSWER) or self.quoted(i, offset, m, words[d], start):
                if share > found[d].get(self.ids[i], (-1,))[0]:
                    found[d][self.ids[i]] = (share, answer, cosine, start)
        return found


def found_in(body: list[bytes], items: Items) -> list[dict[int, tuple]]:
    """The matches of each text."""
    words = [plain_words(t) for t in body]
    return [m for group in batches_of_words(words) for m in items.matches([words[i] for i in group])]


def item_blocks(benchmark: DataFrame, space: LatentSpace, block: int):
    """The benchmark, ``block`` items at a time, as what `Items` is made of."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = max(1, -(-rows.count() // block))
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        yield [(r.item_id, r.text.encode()) for r in part], space.map


def contaminated(docs: DataFrame, benchmark: DataFrame, work: Workspace, block: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and benchmark item found in it, whole or in part: doc_id, item_id, lcs (of the whole item), answer, cosine,
    first_word (of the best window).

    Every window of every whole text meets every item. Null and empty texts and items without words match nothing; items that repeat an id
    count as one; rows that repeat a doc_id give a row each; either table empty: no rows; other columns are not read.
    """
    space = LatentSpace(docs, work)
    parts = None
    for items in item_blocks(benchmark, space, block):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            known = Items(*shared.value)
            for batch in batches:
                rows = [(d, i, *m) for d, found in zip(batch.column("doc_id").to_pylist(), found_in(texts(batch), known)) for i, m in sorted(found.items(), key=lambda x: (x[0] is None, x[0] or 0))]
                cols = list(zip(*rows)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "lcs", "answer", "cosine", "first_word"])
        got = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            run, "doc_id bigint, item_id bigint, lcs double, answer double, cosine double, first_word bigint")
        parts = got if parts is None else parts.union(got)
    return parts


def decontaminate(docs: DataFrame, benchmark: DataFrame, work: Workspace, block: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark item is found."""
    space, left = LatentSpace(docs, work), docs
    mark = "_clean"
    while mark in docs.columns:
        mark += "_"
    for items in item_blocks(benchmark, space, block):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            known = Items(*shared.value)
            for batch in batches:
                clean = [not found for found in found_in(texts(batch), known)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(clean, pa.bool_())], [*batch.schema.names, mark])
        left = left.mapInArrow(run, StructType([*docs.schema.fields, StructField(mark, BooleanType())])).filter(mark).drop(mark)
    return left
