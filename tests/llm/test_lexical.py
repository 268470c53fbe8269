"""Ranked search, against a score of every item and document."""

import math
import random
import re
from collections import Counter

import cases
import pytest
from cases import work  # noqa: F401

from millrace.llm import lexical


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, best=10):
    texts = [(i, split(t)) for i, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    held = Counter(w for _, words in texts for w in set(words))
    out = []
    for item, text in items:
        scored = []
        for doc, words in texts:
            counted, total = Counter(words), 0
            for w in split(text):
                if counted[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1)))
                    m = 100 - 75 + 75 * len(words) * n_docs // n_words
                    total += weight * (1_000_000_000 * counted[w] // (1000 * counted[w] + 8 * m))
            if total > 0:
                scored.append((-total, doc is None, doc or 0))
        out += [(item, k, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=repr)


def got(docs, items, **more):
    return sorted([tuple(r) for r in lexical.rank(docs, items, **more).collect()], key=repr)


@pytest.mark.parametrize("docs_a_block, masks", [(7, 1), (64, 3), (8192, 64)])
def test_rank_equals_brute_force(spark, monkeypatch, docs_a_block, masks):
    """Few words, so many ties and shared masks; every way of cutting the blocks."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(lexical, "MASKS", masks)
    monkeypatch.setattr(lexical, "SPREAD", 3)
    rng = random.Random(docs_a_block)
    word = lambda: rng.choice(["a", "B", "c1", "É", "dd", "ee", "F", "g-h", "ö_x"] + [f"rare{i}" for i in range(12)])
    docs = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 40])))) for i in range(300)]
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 6, 25])))) for i in range(25)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert got(frame, spark.createDataFrame(items, "item_id bigint, text string"), item_bytes=200) == brute(docs, items)


def test_rank_edges(spark):
    frame = cases.corpus(spark)
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    items = [(1, "the FOX, the owls"), (2, None), (None, "w5x5 one w5x5"), (3, "..."), (4, "absent"), (1, "today"), (5, "ünïcode 漢字"), (6, cases.LONG[:3000])]
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'clash' rank", "'clash' term")
    assert got(frame, asked) == brute(docs, items)
    assert got(frame, asked.limit(0)) == [] and got(cases.empty(spark), asked) == []


def test_large_scores_stay_whole(spark):
    docs, items = [(1, "x " * 5000 + "y"), (2, "y z"), (3, "q")], [(1, "x " * 3000 + "y z")]
    assert got(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")) == brute(docs, items)
