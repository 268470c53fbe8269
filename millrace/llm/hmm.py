"""A hidden Markov language model: Baum-Welch counts from all partitions, exact likelihood by the scaled forward recursion."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.words import mixed, texts, word_hashes
from millrace.llm.workspace import Workspace

#: States, and word classes that they emit: hashed buckets, one class of rare words, and the end of the text. These bound the model.
STATES, BUCKETS = 8, 1 << 13
RARE, END, CLASSES = BUCKETS, BUCKETS + 1, BUCKETS + 2
ROUNDS = 4
#: Training cuts token sequences into pieces of this length; scoring never does.
PIECE = 256
ALPHA = 0.1
#: Bytes of text whose tokens share one dictionary, and so bound a task.
CHUNK_BYTES = 48 << 20
SLICES = 16


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def counted(docs: DataFrame) -> DataFrame:
    """h (a word's hash), chunk, n (training tokens), held (a held-out text of the chunk has the word).

    A batch is folded before rows are made. Words go by 64-bit hashes from here on: of 10^8 words about one in a billion shares one.
    """
    def run(batches):
        for batch in batches:
            found: dict[int, tuple[list, list]] = {}
            for text, chunk, held in zip(texts(batch), batch.column("chunk").to_pylist(), batch.column("held_out").to_pylist()):
                found.setdefault(chunk, ([], []))[held].append(word_hashes(tokens(text)).view(np.int64))
            for chunk, (seen, other) in found.items():
                h, n = np.unique(np.concatenate(seen or [NONE]), return_counts=True)
                extra = np.unique(np.concatenate(other or [NONE]))
                also = np.isin(h, extra, assume_unique=True)
                extra = np.setdiff1d(extra, h, assume_unique=True)
                size = len(h) + len(extra)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([h, extra])), pa.array(np.full(size, chunk), pa.int32()),
                     pa.array(np.concatenate([n, np.zeros(len(extra), np.int64)])), pa.array(np.concatenate([also, np.ones(len(extra), bool)]))],
                    ["h", "chunk", "n", "held"])
    return docs.mapInArrow(run, "h bigint, chunk int, n bigint, held boolean")


NONE = np.empty(0, np.int64)


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (mixed(h.view(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def bucket_masses(words: DataFrame) -> np.ndarray:
    """Training tokens of each bucket, from words (h, c) with c > 1."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            total += np.bincount(bucket_of(batch.column("h").to_numpy()), batch.column("c").to_numpy(), BUCKETS).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "c"])
    out = np.zeros(BUCKETS, np.int64)
    for r in words.mapInArrow(run, "bucket int, c bigint").groupBy("bucket").agg(F.sum("c").alias("c")).collect():  # one row for each bucket
        out[r.bucket] = r.c
    return out


class Shared:
    """What scoring needs of the corpus as a whole: N, V, words seen once and twice."""

    def __init__(self, train_tokens: int, distinct: int, once: int, twice: int, texts_: int):
        self.train_tokens, self.distinct, self.texts = train_tokens, distinct, texts_
        self.once = once
        # Good-Turing: of tokens whose word was seen at most once, the share never seen before
        self.unseen = (once + 1) / (once + 2 * twice + 2) if once or twice else 1.0


def encoded(docs: DataFrame, dictionary: DataFrame, shared: Shared, mass: np.ndarray) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, base_score, within (log10 of words given their classes), classes (two bytes a token).

    A word that training has twice or more is in the bucket of its hash, with its share of the bucket's tokens; rarer words are one class.
    Documents and the dictionary meet by chunk, so a task holds one chunk of texts and the words in it. The dictionary leaves out
    words that occur once, in a training text: there a missing word has count 1, in a held-out text 0.
    """
    total = np.log10(shared.train_tokens + ALPHA * (shared.distinct + 1))
    once, never = np.log10(max(1 - shared.unseen, 1e-300) / max(shared.once, 1)), np.log10(shared.unseen)
    ends = shared.texts

    def run(key, table, words):
        h, c = words.column("h").to_numpy(), words.column("c").to_numpy()
        order = np.argsort(h)
        h, c = np.append(h[order], 0), np.append(c[order], 0)  # one more, that no search ends on by accident
        rows = []
        for text, held in zip(texts(table.combine_chunks()), table.column("held_out").to_pylist()):
            own = word_hashes(tokens(text)).view(np.int64)
            at = np.searchsorted(h[:-1], own)
            count = np.where((h[at] == own) & (at < len(h) - 1), c[at], 0 if held else 1)
            bucket = bucket_of(own)
            rare = count < 2
            within = np.where(rare, np.where(count == 1, once, never), np.log10(np.maximum(count, 1) / np.maximum(mass[bucket], 1)))
            base = np.log10(count + ALPHA).sum() + np.log10(ends + ALPHA) - (len(own) + 1) * total
            rows.append((len(own) + 1, int((count > 0).sum()) + int(ends > 0), float(base), float(within.sum()),
                         np.append(np.where(rare, RARE, bucket), END).astype(np.uint16).tobytes()))
        cols = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
        return pa.Table.from_arrays([table.column("doc_id"), table.column("held_out"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "within", "classes"])

    return docs.groupBy("chunk").cogroup(dictionary.groupBy("chunk")).applyInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, within double, classes binary")


class HMM:
    """``start`` (states), ``step`` (state to state), ``emit`` (classes x states); the columns of each are probabilities."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, frequency: np.ndarray, seed: int = 17) -> HMM:
        """States that stay, each with the overall frequencies shaken: what differs between them is for training to find."""
        shaken = frequency[:, None] * np.random.default_rng(seed).gamma(1.0, 1.0, (len(frequency), STATES)) + 1e-9
        step = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), step, shaken / shaken.sum(0))

    @classmethod
    def from_counts(cls, start, step, emit, frequency: np.ndarray) -> HMM:
        """Expected counts to probabilities; each state also sees every class a little, in proportion to its frequency."""
        smooth = lambda x, prior, weight: (x + weight * prior) / (x.sum() + weight)
        return cls(smooth(start, 1 / STATES, 1.0), np.array([smooth(r, 1 / STATES, 1.0) for r in step]),
                   np.stack([smooth(emit[:, k], frequency, 20.0) for k in range(STATES)], 1))

    def log10_likelihood(self, rows: list[np.ndarray]) -> np.ndarray:
        """Of whole sequences side by side, the longest first: after each token the forward values are scaled to sum one."""
        order = np.argsort([-len(r) for r in rows], kind="stable")
        sizes = np.array([len(rows[i]) for i in order])
        at = np.cumsum([0, *sizes[:-1]])
        flat = np.concatenate([rows[i] for i in order]).astype(np.int64)
        total, live = np.zeros(len(rows)), len(rows)
        a = np.tile(self.start, (live, 1))
        for t in range(sizes[0]):
            while sizes[live - 1] <= t:
                live -= 1
            a = (a[:live] @ self.step if t else a) * self.emit[flat[at[:live] + t]]
            scale = a.sum(1)
            a /= scale[:, None]
            total[:live] += np.log10(scale)
        out = np.empty(len(rows))
        out[order] = total
        return out

    def expected(self, pieces: np.ndarray, sizes: np.ndarray, opening: np.ndarray, counts: list[np.ndarray]) -> float:
        """Adds the expected counts of sequences side by side (padded rows, longest first) to ``counts``; the log-likelihood."""
        n, width = pieces.shape
        live = [int(np.searchsorted(-sizes, -t, "left")) for t in range(width)]  # rows longer than t
        emit = self.emit.astype(np.float32)
        step, start = self.step.astype(np.float32), self.start.astype(np.float32)
        seen, alpha, scales = [], [], []
        a = None
        for t in range(width):
            e = emit[pieces[:live[t], t]]
            a = (np.broadcast_to(start, e.shape) if a is None else a[:live[t]] @ step) * e
            scale = a.sum(1, keepdims=True)
            a = a / scale
            seen.append(e), alpha.append(a), scales.append(scale)
        beta = np.ones((live[-1], STATES), np.float32)
        gamma = [None] * width
        for t in range(width - 1, -1, -1):
            if live[t] > len(beta):
                beta = np.concatenate([beta, np.ones((live[t] - len(beta), STATES), np.float32)])
            gamma[t] = alpha[t] * beta
            if t:
                onward = seen[t] * beta / scales[t]
                counts[1] += self.step * (alpha[t - 1][:live[t]].T.astype(np.float64) @ onward)
                beta = onward @ step.T
        counts[0] += gamma[0][opening].sum(0)
        where = np.concatenate([pieces[:k, t] for t, k in enumerate(live)])
        values = np.concatenate(gamma)
        for k in range(STATES):
            counts[2][:, k] += np.bincount(where, values[:, k], CLASSES)
        return float(sum(np.log(s, dtype=np.float64).sum() for s in scales))


def round_of_counts(table: DataFrame, model: HMM, fan: int) -> list[np.ndarray]:
    """Baum-Welch counts of all training documents under ``model``. Each task adds up its own; slices of them are added in two levels."""
    shared = table.sparkSession.sparkContext.broadcast((model.start, model.step, model.emit))

    def run(batches):
        from pyspark import TaskContext

        hmm = HMM(*shared.value)
        counts = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))]
        score = 0.0
        for batch in batches:
            pieces, opens = [], []
            for x in batch.column("classes").to_pylist():
                row = np.frombuffer(x, np.uint16)
                parts = np.split(row, range(PIECE, len(row), PIECE))
                pieces += parts
                opens += [True] + [False] * (len(parts) - 1)
            order = np.argsort([-len(p) for p in pieces], kind="stable")
            for low in range(0, len(order), 512):
                some = order[low:low + 512]
                sizes = np.array([len(pieces[i]) for i in some])
                padded = np.zeros((len(some), sizes[0]), np.int64)
                for r, i in enumerate(some):
                    padded[r, :sizes[r]] = pieces[i]
                score += hmm.expected(padded, sizes, np.array([opens[i] for i in some]), counts)
        whole = np.concatenate([counts[0].ravel(), counts[1].ravel(), counts[2].ravel(), [score]])
        for k, part in enumerate(np.array_split(whole, SLICES)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([TaskContext.get().partitionId() % fan], pa.int32()),
                                              pa.array([part.tobytes()], pa.binary())], ["slice", "salt", "sums"])

    def added(key, table):
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in table.column("sums"))
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    parts = table.select("classes").mapInArrow(run, "slice int, salt int, sums binary")
    rows = parts.groupBy("slice", "salt").applyInArrow(added, "slice int, sums binary").groupBy("slice").applyInArrow(added, "slice int, sums binary").collect()
    shared.unpersist()
    whole = np.concatenate([np.frombuffer(r.sums, np.float64) for r in sorted(rows, key=lambda r: r.slice)]) if rows else np.zeros(STATES * (1 + STATES + CLASSES) + 1)
    a, b = STATES, STATES * (1 + STATES)
    return [whole[:a], whole[a:b].reshape(STATES, STATES), whole[b:-1].reshape(CLASSES, STATES)]


def score(docs: DataFrame, work: Workspace, rounds: int = ROUNDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The probability of a text is that of its classes under the hidden Markov model (exact, over the whole text) times that of each word
    within its class; together they sum to one over the same events as the base score (known words, one unknown word, the end). Null and
    empty texts are the end alone; a null id counts as not held out; rows that repeat an id are scored, and count, each; without training
    rows the model is uniform; an empty table gives no rows; other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    plain = plain.withColumn("held_out", F.coalesce(fold, F.lit(False)))
    size = plain.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("texts")).first()
    chunks = max(1, -(-(size["bytes"] or 0) // chunk_bytes))
    # a rest of each document's hash decides its chunk, so all chunks have the same mix
    plain = plain.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(chunks)).cast("int"))
    # one shuffle gives each word's count and the chunks that need it; a word has one row for each chunk at most
    by_word = Window.partitionBy("h")
    cells = counted(plain).repartition("h").groupBy("h", "chunk").agg(F.sum("n").alias("n"), F.max("held").alias("held"))
    words = work.cut(cells.select("h", "chunk", "held", F.sum("n").over(by_word).alias("c"), (F.col("chunk") == F.min("chunk").over(by_word)).alias("first")), "words")
    each = words.filter("first and c > 0")
    stats = each.agg(F.sum("c"), F.count("*"), *(F.count_if(F.col("c") == x) for x in (1, 2))).first()
    ends = size["texts"]
    shared = Shared((stats[0] or 0) + ends, stats[1] + (ends > 0), stats[2], stats[3], ends)
    mass = bucket_masses(each.filter("c > 1").select("h", "c"))
    frequency = np.zeros(CLASSES)
    frequency[:BUCKETS] = mass
    frequency[RARE], frequency[END] = max(shared.once, 1), max(ends, 1)
    frequency = (frequency + 1e-6) / (frequency + 1e-6).sum()
    dictionary = words.filter("c > 1 or (c = 1 and held)").select("chunk", "h", "c")
    table = work.cut(encoded(plain, dictionary, shared, mass), "encoded")
    work.drop(words)
    model, training = HMM.first(frequency), table.filter("not held_out")
    fan = int(np.sqrt(table.rdd.getNumPartitions())) + 1
    for _ in range(rounds if ends else 0):
        model = HMM.from_counts(*round_of_counts(training, model, fan), frequency)
    final = docs.sparkSession.sparkContext.broadcast((model.start, model.step, model.emit))

    def run(batches):
        hmm = HMM(*final.value)
        for batch in batches:
            if batch.num_rows:
                chain = hmm.log10_likelihood([np.frombuffer(x, np.uint16) for x in batch.column("classes").to_pylist()])
                total = chain + batch.column("within").to_numpy()
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in SCORED[:-1]), pa.array(total)], list(SCORED))

    out = table.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(shared.train_tokens).cast("bigint"))


SCORED = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
