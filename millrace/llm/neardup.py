"""Near-duplicates: similarity sketches filled in rounds, banding, exact verification, connected components."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.words import gram_hashes, mixed, texts, word_hashes
from millrace.llm.workspace import Workspace

SHINGLE = 5
PERCENT = 85
COORDINATES = 120
#: How often a pair at exactly the wanted similarity may share no band, or agree in too few coordinates.
NO_BAND, TOO_FEW = 1e-6, 1e-5
#: Members up to which a bucket's pairs are listed, and members of one block of a hot group.
LISTED, BLOCK = 64, 256


def banding(percent: int) -> tuple[int, int]:
    """Bands and coordinates of each: the longest bands (fewest chance meetings) of which pairs at ``percent`` share one but for NO_BAND."""
    s = percent / 100
    for rows in range(8, 0, -1):
        if (1 - s ** rows) ** (COORDINATES // rows) <= NO_BAND:
            return COORDINATES // rows, rows
    return math.ceil(math.log(NO_BAND) / math.log(1 - s)), 1


def least_agreeing(percent: int, size: int) -> int:
    """The most coordinates of ``size`` in which all pairs at ``percent`` agree but for TOO_FEW (binomial)."""
    s, below = percent / 100, 0.0
    for k in range(size + 1):
        below += math.comb(size, k) * s ** k * (1 - s) ** (size - k)
        if below > TOO_FEW:
            return k
    return size


def shingles(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``n`` lower-cased words; of the whole sequence where there are fewer; empty without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(n, len(words))))


def sketch(items: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketching: in round i each item falls into one hashed bin and the bin keeps its smallest hash, earlier rounds first.

    After ``size`` rounds with hashed bins, round ``size + b`` puts every item into bin b, so each coordinate is filled for certain. Most
    sets need about ``size * log(size) / len(items)`` rounds. Two sets agree in a coordinate with a probability equal to their similarity.
    """
    got = np.full(size, np.iinfo(np.uint64).max)
    empty = np.ones(size, bool)
    for i in range(2 * size):
        h = mixed(items + np.uint64((0x9E3779B97F4A7C15 * (i + 1)) % (1 << 64)))
        if i < size:
            bins = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            value = mixed(h) >> np.uint64(8)
            order = np.lexsort((value, bins))
            bins, value = bins[order], value[order]
            first = np.r_[True, bins[1:] != bins[:-1]]
            bins, value = bins[first], value[first]
            new = empty[bins]
            got[bins[new]] = value[new] + np.uint64(i)
            empty[bins] = False
        elif empty[i - size]:
            got[i - size] = mixed(h).min()
            empty[i - size] = False
        if not empty.any():
            break
    return got


def signed(docs: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    """doc_id, n_shingles, same (digest of the set; null for an empty one), bands (a key per band), marks (a byte per coordinate)."""
    def run(batches):
        seeds = mixed(np.arange(1, rows + 1, dtype=np.uint64))
        for batch in batches:
            count, same, keys, marks = [], [], [], []
            for text in texts(batch):
                items = shingles(text, shingle)
                count.append(len(items))
                if not len(items):
                    same.append(None), keys.append(None), marks.append(None)
                    continue
                same.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                coordinates = sketch(items, bands * rows)
                keys.append(mixed((mixed(coordinates.reshape(bands, rows)) * (seeds | np.uint64(1))).sum(1)).view(np.int64))
                marks.append((mixed(coordinates) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(same, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "n_shingles", "same", "bands", "marks"])
    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, same binary, bands array<bigint>, marks binary")


def alike(pairs: DataFrame, sides: DataFrame, percent: int, least: int) -> DataFrame:
    """Pairs (a, b) of ids whose sketches and set sizes allow a link."""
    one = lambda k: sides.select(F.col("id").alias(k), F.col("n_shingles").alias("n" + k), F.col("marks").alias("m" + k))
    both = pairs.join(one("a"), "a").join(one("b"), "b").filter(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in ("ma", "mb"))
                keep = (a == b).sum(1) >= least
                yield batch.select(["a", "b"]).filter(pa.array(keep))
    return both.select("a", "b", "ma", "mb").mapInArrow(run, "a bigint, b bigint")


def linked(pairs: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, judged on the full sets of the whole texts."""
    one = lambda k: docs.select(F.col("doc_id").alias(k), F.col("text").alias("t" + k))

    def run(batches):
        known, held = {}, 0
        for batch in batches:
            keep = []
            for x, y, s, t in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), texts(batch, "ta"), texts(batch, "tb")):
                for key, text in ((x, s), (y, t)):
                    if key not in known:
                        if held > 2_000_000:
                            known, held = {}, 0
                        known[key] = shingles(text, shingle)
                        held += len(known[key])
                keep.append(similar(known[x] if x in known else shingles(s, shingle), known[y], percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return pairs.join(one("a"), "a").join(one("b"), "b").mapInArrow(run, "a bigint, b bigint")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def links_of_blocks(left: list, right: list, marks: dict, body: dict, percent: int, least: int, shingle: int):
    """Links between two blocks of a hot group (or within one), enough to join what is joined at all: a pair whose members hang
    together already is skipped. Sketches choose the pairs, the most alike first; full sets decide."""
    sets, root = {}, {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    def items(x):
        if x not in sets:
            sets[x] = shingles(body[x], shingle)
        return sets[x]

    across = np.array([marks[x] for x in right])
    pairs = []
    for i, x in enumerate(left):
        agree = (across == marks[x]).sum(1)
        pairs += [(-int(agree[j]), x, right[j]) for j in np.flatnonzero(agree >= least) if right[j] != x]
    pairs.sort()
    for _, x, y in pairs:
        p, q = find(x), find(y)
        if p != q and similar(items(x), items(y), percent):
            root[max(p, q)] = min(p, q)
            yield min(x, y), max(x, y)


def links_of_hot_groups(members: DataFrame, sides: DataFrame, bodies: DataFrame, work: Workspace, percent: int, least: int, shingle: int) -> DataFrame:
    """Links among ids that meet in buckets with more than LISTED members. ``members``: band, key, id of those buckets.

    Such buckets overlap, so what hangs together through them is one hot group. It is dealt by hash into blocks, and each pair of blocks
    is one bounded task: texts travel once for each block of the group, and only links that join something come back.
    """
    centre = members.groupBy("band", "key").agg(F.min("id").alias("b"))
    group = components(members.join(work.cut(centre, "centres"), ["band", "key"]).select(F.col("id").alias("a"), "b"), work)
    group = work.cut(group.union(group.select(F.col("label").alias("id"), "label").distinct()), "groups")
    sizes = work.cut(group.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "sizes")
    dealt = group.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    whole = dealt.join(sides, "id").join(bodies.select(F.col("doc_id").alias("id"), "text"), "id")
    spread = whole.select("id", "label", "own", "marks", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keyed = spread.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other")

    def run(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        ids, own = table.column("id").to_pylist(), table.column("own").to_pylist()
        marks = dict(zip(ids, (np.frombuffer(m, np.uint8) for m in table.column("marks").to_pylist())))
        body = dict(zip(ids, texts(table.combine_chunks())))
        left, right = (sorted(i for i, o in zip(ids, own) if o == side) for side in (low, high))
        found = list(zip(*links_of_blocks(left, right, marks, body, percent, least, shingle))) or [[], []]
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return keyed.groupBy("label", "low", "high").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, work: Workspace, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat an id count as one document, whose largest text
    is taken; a null id is linked with nothing and kept, with null component_id. An empty table gives no rows; other columns are not read.

    Texts with equal sets form a class and its smallest id stands for it. Representatives meet in buckets (band and its key). A small
    bucket lists its pairs; larger ones go the way of `links_of_hot_groups`. Either way no link between two classes' components is lost
    but for the chance that sketches miss it (see `banding` and `least_agreeing`), and full sets confirm every link.
    """
    bands, rows = banding(percent)
    plain = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")))
    known = plain.filter("doc_id is not null")
    if repeated_ids(known):
        largest = F.max_by("text", F.struct(F.octet_length("text"), "text")).alias("text")
        once = work.cut(known.groupBy("doc_id").agg(largest), "once")
        found = near_duplicates(once.unionByName(plain.filter("doc_id is null")), work, percent, shingle)
        return known.select("doc_id").join(found, "doc_id").unionByName(found.filter("doc_id is null"))
    sets = work.cut(signed(plain, bands, rows, shingle), "sets")
    filled = sets.filter("same is not null and doc_id is not null")
    classes = work.cut(filled.groupBy("same").agg(F.min("doc_id").alias("id")), "classes")
    heads = filled.join(classes, (filled.same == classes.same) & (filled.doc_id == classes.id), "left_semi")
    heads = work.cut(heads.select(F.col("doc_id").alias("id"), "n_shingles", "bands", "marks"), "heads")
    spread = heads.select("id", F.posexplode("bands").alias("band", "key"))
    shared = spread.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = work.cut(spread.join(work.cut(shared, "shared"), ["band", "key"]), "members")
    sides = work.cut(heads.select("id", "n_shingles", "marks").join(members.select("id").distinct(), "id", "left_semi"), "sides")
    bodies = work.cut(known.join(sides.select(F.col("id").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi"), "bodies")
    least = least_agreeing(percent, bands * rows)
    small, large = members.filter(F.col("n") <= LISTED), work.cut(members.filter(F.col("n") > LISTED).drop("n"), "large")
    met = (small.select("band", "key", F.col("id").alias("a")).join(small.select("band", "key", F.col("id").alias("b")), ["band", "key"])
           .filter("a < b").select("a", "b").distinct())
    links = linked(work.cut(alike(met, sides, percent, least), "pairs"), bodies, percent, shingle)
    if not large.isEmpty():
        links = links.union(links_of_hot_groups(large, sides, bodies, work, percent, least, shingle))
    labels = components(links, work)
    top = work.cut(classes.join(labels, "id", "left").select("same", F.coalesce("label", "id").alias("id")), "top")
    chosen = sets.select("doc_id", "n_shingles", "same").join(top, "same", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id"))
    return chosen.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def repeated_ids(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()


def one_of_each(docs: DataFrame, work: Workspace, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their component."""
    kept = work.cut(near_duplicates(docs, work, **options).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct(), "kept")
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"].cast("bigint").eqNullSafe(kept.kept_id), "left_semi")
