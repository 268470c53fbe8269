"""A convolutional text classifier for toxicity, trained here in numpy."""

from __future__ import annotations

import io
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm.words import texts
from millrace.llm.workspace import Workspace

#: Bound of the training sample: so many labelled rows of each class, chosen by a hash of the id.
SAMPLE_PER_CLASS = 2000
WIDTHS, FILTERS, SIZE, TABLE_BITS = (1, 2, 3), 8, 12, 16
TABLES, STEM = 3, 5
CUT = 0.3
#: A language gets a threshold of its own when its calibration rows hold so many toxic ones; any other language uses CUT.
LEAST_TOXIC = 20
PLAIN = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\"'()[]{}<>*_-", bytes(range(97, 123)) + b" " * 19)
MASK = np.uint64((1 << TABLE_BITS) - 1)


def tokens(text: bytes) -> np.ndarray:
    """A hash for each word of the whole text, lower-cased, without ASCII punctuation, and 16 bits for its first STEM bytes above it.

    An empty text has one token.
    """
    words = text.translate(PLAIN).split() or [b""]
    whole = np.fromiter(map(crc32, words), np.uint64, len(words))
    stems = np.fromiter([crc32(w[:STEM]) for w in words], np.uint64, len(words))
    return whole | (stems << np.uint64(32))


def table_rows(flat: np.ndarray) -> list[np.ndarray]:
    """The row of each token in each of the embedding tables."""
    return [((flat >> np.uint64(k * TABLE_BITS)) & MASK).astype(np.int64) for k in range(TABLES)]


class TextCNN:
    """Hashed word embeddings, filters of several widths, maximum over the positions, one logistic unit.

    A word's embedding is the sum of a row in each of three tables, found by two halves of its hash and by its first bytes: words that share
    a row in one table rarely share the others. Rows that no training word touched are zero, so unknown words add nothing.
    """

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables = rng.normal(0, 0.05, (TABLES, 1 << TABLE_BITS, SIZE)).astype(np.float32)
        self.filters = [rng.normal(0, 0.4, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.full((len(WIDTHS), FILTERS), 0.05, np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(0)
        self.shift = np.float32(0)  # log odds of the corpus less those of the sample

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, *self.filters, self.bias, self.out, np.float32([self.out_bias, self.shift])]

    def dump(self) -> bytes:
        np.savez_compressed(out := io.BytesIO(), *self.parameters())
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> TextCNN:
        model, arrays = cls.__new__(cls), list(np.load(io.BytesIO(data)).values())
        model.tables, model.filters, model.bias, model.out = arrays[0], arrays[1:-3], arrays[-3], arrays[-2]
        model.out_bias, model.shift = arrays[-1]
        # what each filter gives for a word at each of its offsets, so that scoring looks up and adds
        model.effects = [[[np.ascontiguousarray(t @ f[k]) for t in model.tables] for k in range(len(f))] for f in model.filters]
        return model

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """Probabilities of label 1. Documents stand one after the other with blanks between, so no filter sees two of them."""
        gap, longest = np.zeros(len(WIDTHS) - 1, np.uint64), max(WIDTHS)
        flat = np.concatenate([x for d in docs for x in (d, gap)] + [np.zeros(longest, np.uint64)])
        blank = np.concatenate([x for d in docs for x in (np.zeros(len(d), bool), np.ones(len(gap), bool))] + [np.ones(longest, bool)])
        starts = np.cumsum([0] + [len(d) + len(gap) for d in docs])[:-1]
        rows = table_rows(flat)
        n, pooled = len(flat) - longest, []
        for effects, bias in zip(self.effects, self.bias):
            total = np.zeros((n, FILTERS), np.float32)
            for k, pair in enumerate(effects):
                for effect, row in zip(pair, rows):
                    part = effect[row[k:k + n]]
                    part[blank[k:k + n]] = 0
                    total += part
            total[blank[:n]] = -np.inf
            pooled.append(np.maximum(np.maximum.reduceat(total, starts, axis=0) + bias, 0))
        logit = np.hstack(pooled) @ self.out + self.out_bias + self.shift
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, share: float, epochs: int = 8, batch: int = 32, rate: float = 0.05, seed: int = 11):
        """Adagrad on the logistic loss. ``share``: of label 1 among all labelled rows, which the sample doesn't keep."""
        rng, state = np.random.default_rng(seed), [np.full_like(p, 1e-6) for p in self.parameters()]
        labels = labels.astype(np.float32)

        def step(k, where, grad):
            state[k][where] += grad * grad
            return rate * grad / np.sqrt(state[k][where])

        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), batch):
                self._step([docs[i] for i in order[at:at + batch]], labels[order[at:at + batch]], step)
        for table, row in zip(self.tables, table_rows(np.concatenate(docs))):
            seen = np.zeros(1 << TABLE_BITS, bool)
            seen[row] = True
            table[~seen] = 0
        got = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        share = np.clip(share, 1e-3, 1 - 1e-3)
        self.shift = np.float32(np.log(share / (1 - share)) - np.log(got / (1 - got)))
        return self

    def _step(self, docs, labels, step):
        longest = max(WIDTHS)
        gap = np.zeros(longest - 1, np.uint64)
        flat = np.concatenate([x for d in docs for x in (d, gap)] + [gap])
        real = np.concatenate([x for d in docs for x in (np.ones(len(d), bool), np.zeros(len(gap), bool))] + [np.zeros(len(gap), bool)])
        starts = np.cumsum([0] + [len(d) + len(gap) for d in docs])[:-1]
        rows = table_rows(flat)
        vectors = sum(t[r] for t, r in zip(self.tables, rows)) * real[:, None]
        n, best, feats = len(flat) - longest + 1, [], []
        for f, bias in zip(self.filters, self.bias):
            total = sum(vectors[k:k + n] @ f[k] for k in range(len(f)))
            total[~real[:n]] = -np.inf
            top = np.maximum.reduceat(total, starts, axis=0)
            is_top = total == np.repeat(top, np.diff(np.append(starts, n)), axis=0)
            where = np.empty((len(docs), FILTERS), np.int64)
            for j in range(FILTERS):
                hit = np.flatnonzero(is_top[:, j])
                where[:, j] = hit[np.searchsorted(hit, starts)]
            best.append(where)
            feats.append(np.maximum(top + bias, 0))
        pooled = np.hstack(feats)
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -30, 30)))
        off = ((p - labels) / len(docs)).astype(np.float32)
        back = off[:, None] * self.out * (pooled > 0)
        everything, last = slice(None), len(self.filters)
        touched, changes = [], []
        for w, (f, where) in enumerate(zip(self.filters, best)):
            g = back[:, w * FILTERS:(w + 1) * FILTERS]
            grad = np.empty_like(f)
            for k in range(len(f)):
                at = where + k
                grad[k] = np.einsum("df,dfs->sf", g, vectors[at])
                touched.append(at.ravel())
                changes.append((g[:, :, None] * f[k].T[None]).reshape(-1, SIZE))
            f -= step(1 + w, everything, grad + 1e-5 * f)
            self.bias[w] -= step(1 + last, w, g.sum(0))
        self.out -= step(2 + last, everything, pooled.T @ off + 1e-5 * self.out)
        self.out_bias -= step(3 + last, 0, off.sum())
        at, grads = np.concatenate(touched), np.concatenate(changes)
        grads = grads * real[at][:, None]
        for t, row in enumerate(rows):
            hit, index = np.unique(row[at], return_inverse=True)
            total = np.zeros((len(hit), SIZE), np.float32)
            np.add.at(total, index, grads)
            self.tables[t][hit] -= step(0, (t, hit), total)


def marked(labels: DataFrame) -> DataFrame:
    """Labelled ids outside the held-out fold: doc_id, toxic, calibrate. The calibration fold is an eighth of all and not trained on."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    one = labels.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return one.filter(fold % 4 != 2).withColumn("calibrate", fold % 8 == 1)


def train(docs: DataFrame, labels: DataFrame, work: Workspace, per_class: int = SAMPLE_PER_CLASS) -> bytes | None:
    """The model's bytes, from at most ``per_class`` rows of either label, trained in one task. None when a label is missing.

    The sample is chosen among ids; only its texts are read, so no other text is moved.
    """
    rows = work.cut(marked(labels).filter("not calibrate").join(docs.select("doc_id"), "doc_id", "left_semi"), "labelled")
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    share = counts[1] / sum(counts.values())
    pick = lambda label: rows.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)

    def fit(key, table):
        body = [tokens(x or b"") for x in table.column("text").cast(pa.binary()).to_pylist()]
        ids, labels = table.column("doc_id").to_pylist(), table.column("toxic").to_numpy()
        order = sorted(range(len(body)), key=lambda i: (ids[i], len(body[i])))
        model = TextCNN().fit([body[i] for i in order], labels[order], share)
        return pa.table({"model": pa.array([model.dump()], pa.binary())})

    sample = pick(0).union(pick(1)).select("doc_id", "toxic")  # a fixed number of ids, so small enough for every task
    texts_ = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    model = texts_.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fit, "model binary").first().model
    work.drop(rows)
    return model


def with_scores(docs: DataFrame, model: bytes | None, column: str, kept: list[str] | None = None) -> DataFrame:
    """The ``kept`` columns of ``docs`` (all) and the score of its whole text; 0 without a model."""
    shared, kept = docs.sparkSession.sparkContext.broadcast(model), kept or docs.columns

    def run(batches):
        cnn = TextCNN.load(shared.value) if shared.value else None
        for batch in batches:
            body, got = [tokens(t) for t in texts(batch)], np.zeros(batch.num_rows)
            first, held = 0, 0
            for i, d in enumerate(body):  # some hundred thousand words at once
                held += len(d)
                if cnn and (held > 200_000 or i == len(body) - 1):
                    got[first:i + 1] = cnn.scores(body[first:i + 1])
                    first, held = i + 1, 0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(got)], [*kept, column])

    schema = StructType([*(docs.schema[c] for c in kept), StructField(column, DoubleType())])
    return docs.mapInArrow(run, schema)


def thresholds(scored: DataFrame) -> dict[str, float]:
    """Per language the threshold with the best F1 on its calibration rows (middle of the best stretch), from counts by hundredths of the score."""
    bins = scored.groupBy("lang", F.least(F.floor(F.col("score") * 100), F.lit(99)).alias("bin")).agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")).filter("lang is not null").collect()
    found = {}
    for lang in {r.lang for r in bins}:
        bad, n = np.zeros(100), np.zeros(100)
        for r in bins:
            if r.lang == lang:
                bad[r.bin], n[r.bin] = r.bad, r.n
        if bad.sum() >= LEAST_TOXIC:
            hit, called = bad[::-1].cumsum()[::-1][1:], n[::-1].cumsum()[::-1][1:]
            f1 = 2 * hit / (called + bad.sum())
            top = np.flatnonzero(f1 == f1.max())
            found[lang] = float(np.median(top) + 1) / 100
    return found


def cut_of(scored: DataFrame, labels: DataFrame, score: str = "score"):
    """The threshold of each row's language, from the scores of all calibration rows."""
    known = scored.select("doc_id", "lang", F.col(score).alias("score")).join(marked(labels).filter("calibrate"), "doc_id")
    pairs = [F.lit(x) for item in sorted(thresholds(known).items()) for x in item]
    return F.coalesce(F.create_map(*pairs)[F.col("lang")], F.lit(CUT)) if pairs else F.lit(CUT)


def classify(docs: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, threshold (of its language), toxic.

    Null text counts as empty and scores like a text of unknown words; a null language uses the common threshold; labels other than 0 and 1
    are no labels, and of several labels of one id the largest counts. Without rows of both labels every score is 0. Repeated rows are
    scored each; an empty table gives no rows; other columns are not read.
    """
    model = train(docs, labels, work)
    scored = work.cut(with_scores(docs.select("doc_id", "text", "lang"), model, "score", ["doc_id", "lang"]), "scores")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    cut = cut_of(scored, labels)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
                         cut.alias("threshold"), (F.col("score") >= cut).alias("toxic"))


def reject_toxic(docs: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below the threshold of their language."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    scored = work.cut(with_scores(docs, train(docs, labels, work), name), "scored")
    return scored.filter(F.col(name) < cut_of(scored, labels, name)).drop(name)
