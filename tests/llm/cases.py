"""Small corpora with the awkward rows that every operator must take."""

import pytest

from millrace.llm.workspace import Workspace

DATA = "/root/testdata"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, keep_id string, score string, bin string, row int, h string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak and count every step it takes"


def corpus(spark, *extra):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose names operators use inside."""
    rows = [(1, PROSE, "en", "a/x"), (2, PROSE, "en", "a/y"), (3, None, None, None), (4, "", "en", "a/x"), (5, " \t\n ", "de", "b/x"),
            (6, LONG, "en", "a/x"), (7, PROSE + " today", "en", "b/x"), (8, "one", "en", "a/x"), (8, "one", "en", "a/x"),
            (None, PROSE, "en", "a/x"), (None, None, None, None), (9, "Ünïcode 漢字 \x1f \xa0 x", "fr", "c"), *extra]
    full = [(i, t, lang, s, None if t is None else len(t), "clash", "clash", "clash", "clash", 1, "clash") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def table(df, key="doc_id"):
    """Rows by id; ids are taken to be unique."""
    return {r[key]: r for r in df.collect()}


@pytest.fixture
def work(spark):
    return Workspace(spark, "test")
