"""Secrets in texts, and how widely each value is held: copied examples apart from one owner's live-looking credentials."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 and more among all runs
RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
LEAST_VALUE, LEAST_ACCESS, LEAST_RUN = 6, 20, 24
#: A value held by more owners than this is a copied example.
MOST_OWNERS = 2
#: Least entropy a character, as a share of what so many characters can have: log2 of the length, at most of 32 (3 bits there).
LEAST_ENTROPY = 0.6
PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx")
HEX_RUNS = bytes(48 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
LONG_RUNS = bytes(48 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/_=-") else 32 for i in range(256))


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def live_looking(value: str, named: bool) -> bool:
    """Enough entropy for the length, no placeholder; letters and digits where nothing (``named``) says that it is a secret."""
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return (named or mixed) and entropy(value) >= LEAST_ENTROPY * math.log2(min(max(len(value), 2), 32)) and not PLACEHOLDER.search(value)


def scan(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, int, bytes, bool]]]:
    """Base spans (start, kind, end) and candidate values (start, end, digest, whether it looks live), in code points.

    A cheap look at the bytes decides which patterns can match at all.
    """
    base, values = [], {}
    raw = text.encode()
    low = raw.lower()
    if b"passw" in low or b"secret" in low or b"token" in low or b"key" in low:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                base.append((m.start(), "assign", m.end()))
                values[m.span(2)] = m[2]
    if b"AKIA" in raw:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                base.append((m.start(), "access", m.end()))
                values[m.span()] = m[0]
    if b"0" * LEAST_RUN in raw.translate(HEX_RUNS):
        for m in HEX.finditer(text):
            base.append((m.start(), "hex", m.end()))
            values[m.span()] = m[0]
    named = set(values)
    if b"0" * LEAST_RUN in raw.translate(LONG_RUNS):
        taken = sorted(named)
        for m in RUN.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken[:bisect_left(taken, (m.end(),))][-2:]):
                values[m.span()] = m[0]
    base.sort(key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    found = [(*at, hashlib.blake2b(v.encode(), digest_size=16).digest(), live_looking(v, at in named)) for at, v in sorted(values.items())]
    return base, found


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


SCANNED = ("row bigint, doc_id bigint, source string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
           "base array<struct<start:bigint,kind:string,end:bigint>>, found array<struct<start:bigint,end:bigint,value:binary,live:boolean>>")


def scanned(docs: DataFrame) -> DataFrame:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
    values = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary()), ("live", pa.bool_())]))

    def run(batches):
        for batch in batches:
            got = [scan(t or "") for t in batch.column("text").to_pylist()]
            count = lambda kind: pa.array([sum(s[1] == kind for s in base) for base, _ in got], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("source"), count("assign"), count("access"), count("hex"),
                 pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in got]),
                 pa.array([[dict(zip(("start", "kind", "end"), s)) for s in base] for base, _ in got], spans),
                 pa.array([[dict(zip(("start", "end", "value", "live"), v)) for v in found] for _, found in got], values)],
                ["row", "doc_id", "source", "n_assign", "n_access", "n_hex", "base_sha256", "base", "found"])
    columns = [F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
               F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")]
    return docs.select(columns).mapInArrow(run, SCANNED)


def ownership(found: DataFrame) -> DataFrame:
    """value, repositories, owners, copies over the whole corpus. A source is a repository; its part before '/' is the owner.

    Distinct holders are made before the counts, so a value in a third of all documents is folded where it is read.
    """
    holders = found.groupBy("value", "source").agg(F.count("*").alias("copies"))
    holders = holders.withColumn("owner", F.substring_index("source", "/", 1))
    per_owner = holders.groupBy("value", "owner").agg(F.count("source").alias("repositories"), F.sum("copies").alias("copies"))
    return per_owner.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count("owner").alias("owners"), F.sum("copies").alias("copies"))


def secrets(docs: DataFrame, work: Workspace, most_owners: int = MOST_OWNERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_copied, widest (most owners of one value).

    Base spans are whole matches. To them come spans of kind ``owned``: values (of base spans or other long runs) that look live and are
    held by at most ``most_owners`` owners; all more widely held ones, live-looking or not,
    count in n_copied. ``widest`` is over both kinds. Null text counts as empty; rows with a null source
    count for no repository and owner; a row of a repeated id is scanned for itself; an empty table gives no rows; other columns are not read.
    """
    rows = work.cut(scanned(docs), "scanned")
    found = rows.select("row", "source", F.explode("found").alias("f")).select("row", "source", "f.*")
    held = work.cut(ownership(found), "held")
    copied = F.col("owners") > most_owners
    owned = ~copied & F.col("live")
    span = F.struct("start", F.lit("owned").alias("kind"), "end")
    judged = found.join(held, "value").groupBy("row").agg(
        F.collect_list(F.when(owned, span)).alias("more"), F.count_if(owned).alias("n_owned"), F.count_if(copied).alias("n_copied"),
        F.max(F.when(copied | F.col("live"), F.col("owners"))).alias("widest"))
    order = F.array(*[F.lit(k) for k in KINDS])
    merged = F.array_sort(F.transform(F.concat("base", F.coalesce("more", F.array())), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.array_join(F.transform(merged, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return rows.join(judged, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_owned", "n_copied", "widest")])
