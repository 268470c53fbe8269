"""Byte-level BPE: texts to token ids and back, by recursive DuckDB queries inside the tasks.

A task splits its texts into words, and one recursive query contracts every word that it has not met before: its token-position rows
join the table of merges, and the leftmost pair of the least rank becomes one token, until no row joins. Nothing is shuffled.
"""

from __future__ import annotations

import base64
import re

import duckdb
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import texts

#: Bytes of text, and tokens, that meet DuckDB at once; a longer text is taken alone.
SLICE_BYTES, SLICE_TOKENS = 4 << 20, 1 << 20
#: Words whose tokens a worker remembers, and their bytes; it then begins anew.
REMEMBERED, REMEMBERED_BYTES = 600_000, 32 << 20
#: Longer runs of bytes contract many pairs a round.
LONG_RUN = 256

#: Each round: the pair of the least rank, leftmost first, in every run that has one; a run without is done. Positions are those of all
#: runs together, so one order serves them all.
CONTRACT = """
WITH RECURSIVE step(run, pos, token, done) AS (
    SELECT run, pos, token, false FROM short
    UNION ALL
    (WITH paired AS MATERIALIZED (
        SELECT run, pos, token, ppos, m FROM (
            SELECT run, pos, token, CASE WHEN lead(run) OVER w = run THEN lead(token) OVER w END AS nxt, lag(pos) OVER w AS ppos
            FROM step WHERE NOT done WINDOW w AS (ORDER BY pos))
        LEFT JOIN merges ON (token << 32 | nxt) = pair),
     best AS (SELECT run, min(m << 32 | pos) AS b FROM paired WHERE m IS NOT NULL GROUP BY run)
     SELECT p.run, p.pos, CASE WHEN p.pos = (b.b & 4294967295) THEN b.b >> 32 ELSE p.token END, b.run IS NULL
     FROM paired p LEFT JOIN best b ON p.run = b.run WHERE b.run IS NULL OR p.ppos IS DISTINCT FROM (b.b & 4294967295)))
SELECT pos, token FROM step WHERE done"""

#: The same for long runs, with many pairs a round: those of the least rank from the left, every second one where they overlap, up to
#: the first that makes a pair of a lesser rank with its neighbours. One by one, they would be contracted in this order too.
CONTRACT_LONG = """
WITH RECURSIVE step(run, pos, token, done) AS (
    SELECT run, pos, token, false FROM long
    UNION ALL
    (WITH paired AS MATERIALIZED (
        SELECT run, pos, token, npos, m, ppos, ptoken, token2 FROM (
            SELECT run, pos, token, lead(token) OVER w AS nxt, lead(pos) OVER w AS npos, lag(pos) OVER w AS ppos, lag(token) OVER w AS ptoken,
                   lead(token, 2) OVER w AS token2
            FROM step WHERE NOT done WINDOW w AS (PARTITION BY run ORDER BY pos))
        LEFT JOIN merges ON (token << 32 | nxt) = pair),
     best AS (SELECT run, min(m) AS m FROM paired WHERE m IS NOT NULL GROUP BY run),
     least AS (SELECT p.*, row_number() OVER w AS k, lag(p.npos) OVER w IS DISTINCT FROM p.pos AS head
               FROM paired p JOIN best b ON p.run = b.run AND p.m = b.m WINDOW w AS (PARTITION BY p.run ORDER BY p.pos)),
     apart AS (SELECT * FROM (SELECT *, max(CASE WHEN head THEN k END) OVER (PARTITION BY run ORDER BY pos) AS first FROM least) WHERE (k - first) % 2 = 0),
     joined AS (SELECT *, CASE WHEN lag(npos) OVER (PARTITION BY run ORDER BY pos) = ppos THEN m ELSE ptoken END AS before FROM apart),
     turns AS (SELECT j.run, j.pos, j.npos, j.m, x.m IS NOT NULL OR y.m IS NOT NULL AS turn FROM joined j
               LEFT JOIN merges x ON (j.before << 32 | j.m) = x.pair AND x.m < j.m LEFT JOIN merges y ON (j.m << 32 | j.token2) = y.pair AND y.m < j.m),
     taken AS (SELECT * FROM (SELECT *, count(CASE WHEN turn THEN 1 END) OVER (PARTITION BY run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past FROM turns)
               WHERE past = 0)
     SELECT p.run, p.pos, coalesce(t.m, p.token), b.run IS NULL
     FROM paired p LEFT JOIN best b ON p.run = b.run LEFT JOIN taken t ON p.pos = t.pos LEFT JOIN taken g ON p.pos = g.npos WHERE g.pos IS NULL))
SELECT pos, token FROM step WHERE done"""

DECODED = "SELECT doc, array_to_string(list(v.letters ORDER BY t.place), '') AS letters FROM tokens t JOIN vocabulary v ON t.token = v.token GROUP BY doc"


def read_ranks(path: str) -> bytes:
    """The rank file (base64 of a token and its rank on each line), which the driver sends to the tasks; under a megabyte for 50,000 tokens."""
    with open(path, "rb") as file:
        return file.read()


def unassigned() -> str:
    """Characters that the regex library takes for letters or numbers and tiktoken, of another Unicode version, doesn't."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = set()
    for kind in (r"\p{L}", r"\p{N}"):
        bytes_only = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        out |= set(regex.findall(kind, every)) - set(bytes(bytes_only.encode_ordinary(every)).decode())
    return "".join(sorted(out))


class Numbers(dict):
    """Numbers for words in the order of their first use; ``new`` are those numbered since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Coder:
    """Encodes and decodes texts in one DuckDB connection; ``pattern`` cuts a text into the words that are merged one by one.

    Characters of ``unknown`` count as neither letters, numbers nor white space when a text is cut.
    """

    def __init__(self, ranks: bytes, pattern: str, unknown: str = ""):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        self.pattern = regex.compile(pattern)
        self.hidden = dict.fromkeys(map(ord, unknown), "\uffff")
        self.unknown = frozenset(unknown)
        self.beyond = re.compile(f"[{min(unknown)}-\U0010ffff]") if unknown else None  # a cheap look, which most texts pass
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        left, right, merged = np.array([
            (a, b, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
            if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None] or np.empty((0, 3)), np.int64).T
        self.create("merges", pair=left << 32 | right, m=merged)
        letters = [token.decode("latin-1").replace("\0", "Ā") for token in self.ranks]  # a character for each byte; 0 has a stand-in
        self.create("vocabulary", token=np.array(list(self.ranks.values()), np.int64), letters=letters)
        # two bytes that stand side by side in no token are never merged across: words may be cut there
        self.meet = np.zeros(1 << 16, bool)
        for token in self.ranks:
            self.meet[[token[i] << 8 | token[i + 1] for i in range(len(token) - 1)]] = True
        self.forget()

    def create(self, name: str, **columns) -> None:
        given = pa.table({k: pa.array(v) for k, v in columns.items()})  # noqa: F841  DuckDB reads it by its name
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")

    def forget(self) -> None:
        self.known, self.known_bytes = Numbers(), 0
        self.tokens, self.begin, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)  # of the known words

    def learn(self, words: list[str]) -> None:
        """Adds the tokens of words that are new, in the order of their numbers."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.known_bytes += int(size.sum())
        flat = np.frombuffer(b"".join(raw), np.uint8)
        word = np.repeat(np.arange(len(raw)), size)
        # a word that is itself a token is never merged step by step
        whole = np.array([self.ranks.get(w, -1) for w in raw], np.int64)
        start = np.ones(len(flat), bool)
        start[1:] = (word[1:] != word[:-1]) | ~self.meet[flat[:-1].astype(np.int64) << 8 | flat[1:]]
        run = np.cumsum(start) - 1
        rest = whole[word] < 0
        long = np.bincount(run)[run] > LONG_RUN if len(run) else rest
        first = np.cumsum(size) - size
        at, token = [first[whole >= 0]], [whole[whole >= 0]]
        for name, query, here in (("short", CONTRACT, rest & ~long), ("long", CONTRACT_LONG, rest & long)):
            if here.any():
                self.create(name, run=run[here], pos=np.flatnonzero(here), token=self.single[flat[here]])
                done = self.con.sql(query).to_arrow_table()
                at.append(done.column("pos").to_numpy())
                token.append(done.column("token").to_numpy())
        at, token = np.concatenate(at), np.concatenate(token)
        order = np.argsort(at)
        count = np.bincount(word[at], minlength=len(raw))
        self.begin = np.concatenate([self.begin, len(self.tokens) + np.cumsum(count) - count])
        self.tokens = np.concatenate([self.tokens, token[order].astype(np.int32)])
        self.count = np.concatenate([self.count, count])

    def words(self, text: str) -> list[str]:
        if self.unknown and self.beyond.search(text) and not self.unknown.isdisjoint(text):
            return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.hidden))]
        return self.pattern.findall(text)

    def encode(self, documents: list[str]) -> pa.Array:
        """Ids of each text, as lists."""
        if len(self.known) > REMEMBERED or self.known_bytes > REMEMBERED_BYTES:
            self.forget()
        rows = []
        for text in documents:
            words = self.words(text)
            rows.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        self.learn(self.known.new)
        self.known.new = []
        word = np.concatenate([*rows, np.empty(0, np.int64)])
        count = self.count[word]
        where = np.repeat(self.begin[word] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([0, *map(len, rows)])]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(self.tokens[where], pa.int32()))

    def decode(self, ids: pa.Array) -> list[bytes]:
        """Bytes of each list of ids; null and empty lists have none. An id without a token is an error."""
        sizes = np.array(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        doc = np.repeat(np.arange(len(ids)), sizes)
        tokens = pa.table({"doc": doc, "place": np.arange(len(doc)), "token": ids.flatten().cast(pa.int64())})
        if len(doc) and not np.isin(tokens.column("token").to_numpy(), np.fromiter(self.ranks.values(), np.int64, len(self.ranks))).all():
            raise ValueError("an id that no token has")
        out = [b""] * len(ids)
        rows = self.con.sql(DECODED).to_arrow_table()
        for i, letters in zip(rows.column("doc").to_pylist(), rows.column("letters").to_pylist()):
            out[i] = letters.replace("Ā", "\0").encode("latin-1")
        return out


CODERS: dict[tuple, Coder] = {}


def coder(*settings) -> Coder:
    """One for each worker process, which many tasks share."""
    if settings not in CODERS:
        CODERS[settings] = Coder(*settings)
    return CODERS[settings]


def slices(sizes: list[int], most: int):
    """Neighbouring rows of at most ``most`` together, or one larger row."""
    low = total = 0
    for i, size in enumerate(sizes):
        if i > low and total + size > most:
            yield low, i
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), and with ``decoded`` the bytes that the ids decode to.

    A null or empty text has no ids; bytes that are no UTF-8 count as U+FFFD; rows that repeat an id are coded each; other columns are not
    read. Memory: the tokens of one text, or of a slice of texts, at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern, unassigned()))

    def run(batches):
        code = coder(*shared.value)
        for batch in batches:
            raw = texts(batch)
            for low, high in slices([len(t) for t in raw], SLICE_BYTES):
                ids = code.encode([t.decode("utf-8", "replace") for t in raw[low:high]])
                columns = [batch.column("doc_id").slice(low, high - low), ids]
                if decoded:
                    columns.append(pa.array(code.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "bytes"][:len(columns)])

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, ids array<int>" + ", bytes binary" * decoded)


def decode(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids to doc_id and bytes."""
    shared = rows.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))

    def run(batches):
        code = coder(*shared.value)
        for batch in batches:
            ids = batch.column("ids")
            for low, high in slices(ids.value_lengths().fill_null(0).to_pylist(), SLICE_TOKENS):
                part = [batch.column("doc_id").slice(low, high - low), pa.array(code.decode(ids.slice(low, high - low)), pa.binary())]
                yield pa.RecordBatch.from_arrays(part, ["doc_id", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, bytes binary")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, ids and bytes to doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
