"""Which tokens of two tokenizers stand for the same text: a byte-level BPE (A) and a sentencepiece model (B).

Each tokenizer's own spans give coarse cuts. Where a token shares a character with its neighbour, or is a single byte of one, the bytes
that it decodes to give its end. Neither tokenizer merges across a space that follows a word, so texts are cut there, and the units are
coded once for each chunk of documents. Counts over the corpus meet the chunks by the pairs of ids that a chunk has, not by document.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import texts
from millrace.llm.workspace import Workspace

#: Bytes of text whose units share one dictionary, and so bound a task; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Units that go to the tokenizers at once.
AT_ONCE = 10_000
#: A space and what follows, up to the next space that stands after something else than white space and isn't the last character.
UNIT = re.compile(r" (?:[^ ]+|(?<=\s) | \Z)*")
#: Characters of neighbouring units that are coded as one text, which gives the same tokens and costs fewer calls.
JOINED = 4096
#: Rows of a batch whose texts are Python objects at the same time, and units of documents whose pairs are counted at once.
ROWS, COUNTED = 256, 1 << 18
SPACE = "▁"  # how the sentencepiece model writes a space

DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
CHUNK = f"chunk bigint, docs array<struct<{DOC}>>, packed array<binary>, codes array<bigint>, held array<bigint>"
OUT = f"{DOC}, n_best bigint, count_sum bigint"


def read_models(a_path: str, b_path: str) -> tuple[str, bytes]:
    """The two model files, which the driver sends to the tasks; a few megabytes at most."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 is itself, the rest follows from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed differences, one plane of bytes after the other."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    return zstandard.compress(np.ascontiguousarray(steps.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw) or b"", np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of stretches of whole numbers, given where each begins and the last ends."""
    return np.diff(offsets(values)[at])


def stretches(sizes: np.ndarray, most: int):
    """Neighbouring rows of at most ``most`` together, or one larger row."""
    low = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and total + size > most:
            yield low, i
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


class Units:
    """What alignment knows of a list of units: sizes by unit, the groups as text, and the linked pairs of ids (codes) with how often."""

    def __init__(self, good, n_a, n_b, n_groups, n_links, shown, pair_unit, pair_code, pair_times):
        self.good, self.n_a, self.n_b, self.n_groups, self.n_links, self.shown = good, n_a, n_b, n_groups, n_links, shown
        self.pair_unit, self.pair_code, self.pair_times = pair_unit, pair_code, pair_times


class Aligner:
    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters, names = byte_letters(), self.a.get_vocab()
        own = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in names.items()}
        self.a_bytes = [own.get(i, b"") for i in range(max(own, default=-1) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_single = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_bytes = [bytes([int(p[3:5], 16)]) if one else p.replace(SPACE, " ").encode() for p, one in zip(pieces, self.b_single)]
        for token in itertools.chain(self.a_bytes, self.b_bytes):
            if re.search(r"\S ", token.decode("utf-8", "replace")):
                raise ValueError("a token holds a space after something else: texts can't be cut into units")
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        table = lambda n, mark: np.array([f"{i}{mark}" for i in range(n)], object)
        self.a_shown, self.b_shown = ([table(len(x), mark) for mark in marks] for x, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))

    def align(self, units: list[str]) -> Units:
        """Every unit begins with a space, which B would add to the rest of it."""
        n = len(units)
        begin = offsets(np.fromiter((len(u.encode()) for u in units), np.int64, n))  # of each unit, in bytes of all of them
        parts, low, chars = [], 0, 0
        for i, unit in enumerate(units):
            chars += len(unit)
            if chars >= JOINED or unit[-1].isspace() or i == n - 1:
                parts.append((low, i + 1))
                low, chars = i + 1, 0
        tokens_a, tokens_b, bad = self.tokens(units, parts, begin)
        alone = [(i, i + 1) for low, high in bad for i in range(low, high)]
        more_a, more_b, bad = self.tokens(units, alone, begin)
        good = np.ones(n, bool)
        good[[low for low, _ in bad]] = False
        (a, a_end), (b, b_end) = (np.concatenate([x, y], 1) for x, y in ((tokens_a, more_a), (tokens_b, more_b)))
        order_a, order_b = np.argsort(a_end), np.argsort(b_end)
        a, a_end, b, b_end = a[order_a], a_end[order_a], b[order_b], b_end[order_b]
        a_unit, b_unit = (np.searchsorted(begin[1:], x) for x in (a_end, b_end))
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        counts = [np.bincount(x, minlength=n) for x in (a_unit, b_unit)]
        return self.linked(n, good, *counts, a, b, a_unit, np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end), len(cuts))

    def tokens(self, units: list[str], parts: list[tuple[int, int]], begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """Ids and ends of the A and the B tokens of stretches of units; the stretches that a tokenizer changes, without tokens."""
        n, whole = len(parts), ["".join(units[low:high]) for low, high in parts]
        raw = [w.encode() for w in whole]
        size, start = np.fromiter(map(len, raw), np.int64, n), begin[[low for low, _ in parts]] if n else np.empty(0, np.int64)
        coded = self.a.encode_batch(whole, add_special_tokens=False)
        lists = [c.ids for c in coded]
        n_a = np.fromiter(map(len, lists), np.int64, n)
        a = np.fromiter(itertools.chain.from_iterable(lists), np.int64, n_a.sum())
        spans = np.fromiter(itertools.chain.from_iterable(itertools.chain.from_iterable(c.offsets for c in coded)), np.int64, 2 * len(a)).reshape(-1, 2)
        points = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32)
        at_char = offsets(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))
        first = offsets(np.fromiter(map(len, whole), np.int64, n))[:-1]
        a_part = np.repeat(np.arange(n), n_a)
        a_start, a_end = (at_char[first[a_part] + spans[:, k]] for k in (0, 1))
        shared = np.zeros(len(a), bool)
        shared[:-1] = a_start[1:] < a_end[:-1]
        a_end = start[a_part] + a_end - at_char[first][a_part]
        pieces = [p.pieces for p in self.b.encode([w[1:] for w in whole], return_type="proto", num_threads=1)] if n else []
        pairs = [[(x.id, x.end) for x in p] for p in pieces]
        n_b = np.fromiter(map(len, pairs), np.int64, n)
        b, b_end = np.fromiter(itertools.chain.from_iterable(itertools.chain.from_iterable(pairs)), np.int64, 2 * n_b.sum()).reshape(-1, 2).T
        b_part = np.repeat(np.arange(n), n_b)
        b_end = start[b_part] + 1 + b_end
        good = self.same(raw, a, n_a, self.a_bytes) & self.same(raw, b, n_b, self.b_bytes)
        keep_a, keep_b = good[a_part], good[b_part]
        a_end = self.refined(a_end[keep_a], shared[keep_a], self.a_sizes[a[keep_a]], a_part[keep_a], start, size)
        b_end = self.refined(b_end[keep_b], self.b_single[b[keep_b]], self.b_sizes[b[keep_b]], b_part[keep_b], start, size)
        return np.stack([a[keep_a], a_end]), np.stack([b[keep_b], b_end]), [p for p, ok in zip(parts, good) if not ok]

    @staticmethod
    def same(raw: list[bytes], ids: np.ndarray, counts: np.ndarray, token_bytes: list[bytes]) -> np.ndarray:
        own, ends = [token_bytes[i] for i in ids.tolist()], offsets(counts).tolist()
        return np.fromiter((b"".join(own[low:high]) == r for r, low, high in zip(raw, ends, ends[1:])), bool, len(raw))

    @staticmethod
    def refined(end, unsure, size, part, start, part_size) -> np.ndarray:
        """Ends of tokens: as the tokenizer says, and where it can't tell, the last sure end and the bytes decoded since."""
        if not len(end):
            return end
        last = np.append(part[1:] != part[:-1], True)
        end = np.where(last, start[part] + part_size[part], end)
        sure = last | ~unsure
        total, places = np.cumsum(size), np.arange(len(end))
        before = np.maximum.accumulate(np.where(sure, places, -1))
        first = np.maximum.accumulate(np.where(np.append(True, last[:-1]), places, 0))
        inside = (before >= 0) & (part[before] == part)
        base = np.where(inside, end[before] - total[before], start[part] - (total - size)[first])
        return np.where(sure, end, total + base)

    def linked(self, n, good, n_a, n_b, a, b, a_unit, a_group, b_group, groups) -> Units:
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        group_unit = a_unit[offsets(in_a)[:-1]] if groups else np.empty(0, np.int64)
        # the groups as text: A tokens then B tokens of each, with the mark that follows each token
        shown = np.empty(len(a) + len(b), object)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[:len(g)] for g in (a_group, b_group))
        at_a, at_b = np.arange(len(a)) + offsets(in_b)[a_group], np.arange(len(b)) + offsets(in_a)[b_group + 1]
        shown[at_a] = np.where(last_a, self.a_shown[1][a], self.a_shown[0][a])
        shown[at_b] = np.where(last_b, self.b_shown[1][b], self.b_shown[0][b])
        shown, ends = shown.tolist(), offsets(n_a + n_b).tolist()
        strings = ["".join(shown[low:high]) for low, high in itertools.pairwise(ends)]
        # pairs: distinct ids of a group on either side, with how often each occurs
        (ga, ia, ka), (gb, ib, kb) = (self.folded(g, x) for g, x in ((a_group, a), (b_group, b)))
        many = np.bincount(gb, minlength=groups)
        repeat = many[ga]
        left = np.repeat(np.arange(len(ga)), repeat)
        right = np.arange(len(left)) - np.repeat(offsets(repeat)[:-1], repeat) + offsets(many)[ga][left]
        unit, code, times = group_unit[ga[left]], ia[left] << 32 | ib[right], ka[left] * kb[right]
        order = np.lexsort((code, unit))
        unit, code, times = unit[order], code[order], times[order]
        head = np.flatnonzero(np.append(True, (unit[1:] != unit[:-1]) | (code[1:] != code[:-1]))[:len(unit)])
        times = sums(times, np.append(head, len(times))) if len(head) else times
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, group_unit, in_a * in_b)
        return Units(good, n_a, n_b, np.bincount(group_unit, minlength=n), n_links, strings, unit[head], code[head], times)

    @staticmethod
    def folded(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, times = np.unique(group << 20 | ids, return_counts=True)  # a vocabulary has fewer than 2^20 tokens
        return keys >> 20, keys & ((1 << 20) - 1), times


ALIGNERS: dict[tuple, Aligner] = {}


class Numbers(dict):
    """Numbers for words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Chunk:
    """Documents that share a dictionary of units."""

    def __init__(self):
        self.numbers = Numbers()
        self.ids, self.rows, self.bytes = [], [], 0

    def add(self, doc_id, text: str) -> None:
        found = UNIT.findall(" " + text) if text else []
        own = np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found))
        self.ids.append(doc_id)
        self.rows.append(own)
        self.bytes += len(text)

    def batch(self, aligner: Aligner, number: int) -> pa.RecordBatch:
        units = list(self.numbers)
        parts = [aligner.align(units[low:low + AT_ONCE]) for low in range(0, len(units), AT_ONCE)] or [aligner.align([])]
        good, n_a, n_b, n_groups, n_links, code, times = (np.concatenate([getattr(p, k) for p in parts]) for k in
                                                          ("good", "n_a", "n_b", "n_groups", "n_links", "pair_code", "pair_times"))
        unit = np.concatenate([p.pair_unit + k * AT_ONCE for k, p in enumerate(parts)])
        shown = [s for p in parts for s in p.shown]
        rows = [r if good[r].all() else r[:0] for r in self.rows]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.concatenate([*rows, np.empty(0, np.int64)])
        at = offsets(sizes)
        totals = [sums(x[flat], at) for x in (n_a, n_b, n_groups, n_links)]
        digests = [hashlib.sha256("".join([shown[u] for u in r.tolist()])[:-1].encode()).hexdigest() if len(r) else "" for r in rows]
        # the distinct units of each document, and in how many documents each pair is
        codes, place = np.unique(code, return_inverse=True)
        of_unit, held = np.bincount(unit, minlength=len(units)), np.zeros(len(codes), np.int64)
        pairs_at, used, often, per_doc = offsets(of_unit), [], [], []
        for low, high in stretches(sizes, COUNTED):
            keys, times_used = np.unique(np.repeat(np.arange(high - low), sizes[low:high]) << 32 | flat[at[low]:at[high]], return_counts=True)
            doc, own = keys >> 32, keys & 0xFFFFFFFF
            repeat = of_unit[own]
            where = np.arange(repeat.sum()) + np.repeat(pairs_at[own] - offsets(repeat)[:-1], repeat)
            held += np.bincount(np.unique(np.repeat(doc, repeat) << 32 | place[where]) & 0xFFFFFFFF, minlength=len(codes))
            used.append(own), often.append(times_used), per_doc.append(np.bincount(doc, minlength=high - low))
        used, often, per_doc = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (used, often, per_doc))
        packed = [pack(x) for x in (per_doc, used, often, of_unit, place, times)]
        docs = pa.StructArray.from_arrays([pa.array(self.ids, pa.int64()), *map(pa.array, totals), pa.array(digests, pa.string())], DOC_NAMES)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs), one(packed, pa.binary()),
             one(codes, pa.int64()), one(held, pa.int64())], ["chunk", "docs", "packed", "codes", "held"])


DOC_NAMES = [x.split()[0] for x in DOC.split(", ")]


def chunks(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """One row for each chunk of documents, with what later steps need of it instead of the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(read_models(a_path, b_path))

    def run(batches):
        from pyspark import TaskContext

        if shared.value not in ALIGNERS:
            ALIGNERS[shared.value] = Aligner(*shared.value)
        aligner, number, chunk = ALIGNERS[shared.value], TaskContext.get().partitionId() << 32, Chunk()
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                for doc_id, raw in zip(part.column("doc_id").to_pylist(), texts(part)):
                    if chunk.ids and chunk.bytes + len(raw) > chunk_bytes:
                        yield chunk.batch(aligner, number)
                        number, chunk = number + 1, Chunk()
                    chunk.add(doc_id, raw.decode("utf-8", "replace"))
        if chunk.ids:
            yield chunk.batch(aligner, number)

    return docs.mapInArrow(run, CHUNK)


def finished(key, chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a chunk with their sums over linked pairs, given the count of each of the chunk's pairs."""
    docs = chunk.column("docs").combine_chunks().flatten()
    per_doc, used, often, of_unit, place, times = (unpack(x) for x in chunk.column("packed").to_pylist()[0])
    of_doc, of_pair, columns = offsets(per_doc), offsets(of_unit), []
    for name in ("best", "n"):
        value = np.zeros(counts.num_rows, np.int64)
        value[counts.column("place").to_numpy()] = counts.column(name).cast(pa.int64()).to_numpy()
        columns.append(pa.array(sums(sums(value[place] * times, of_pair)[used] * often, of_doc)))
    return pa.Table.from_arrays([*docs.flatten(), *columns], [*DOC_NAMES, "n_best", "count_sum"])


def align(docs: DataFrame, a_path: str, b_path: str, work: Workspace, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both tokenizers code a space and the text. Offsets at which tokens of both end cut the tokens into groups; every A and B token of a
    group are linked. A pair of ids counts the documents that have it linked: ``count_sum`` adds the counts of a document's links, and
    ``n_best`` is how many of them have the highest count of their A id. A null or empty text, and one that a tokenizer changes, has no
    tokens: zeros, and '' for the digest. Rows that repeat an id count, and are returned, each; other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = work.cut(chunks(plain, a_path, b_path, chunk_bytes), "chunks")
    pairs = table.select("chunk", F.posexplode(F.arrays_zip("codes", "held")).alias("place", "pair")).select("chunk", "place", F.col("pair.codes").alias("code"), F.col("pair.held").alias("held"))
    counts = work.cut(pairs.groupBy("code").agg(F.sum("held").alias("n")), "counts")
    highest = counts.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("n").alias("most"))  # a row for each A id at most: the vocabulary bounds it
    judged = counts.withColumn("a", F.shiftright("code", 32)).join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    values = pairs.drop("held").join(judged, "code").select(F.col("chunk").alias("of"), "place", "n", "best")
    out = table.select("chunk", "docs", "packed").groupBy("chunk").cogroup(values.groupBy("of")).applyInArrow(finished, OUT)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
