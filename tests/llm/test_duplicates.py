"""Exact and near duplicates, repeated passages, components: against brute force."""

import hashlib
import random

import cases
import pytest
from cases import work  # noqa: F401
import numpy as np

from millrace.llm import exact, neardup, repeats
from millrace.llm.components import components


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_exact_edges(spark, work):
    docs = cases.corpus(spark)
    got = sorted(exact.decide(docs, exact.fresh_index(spark, work), work).collect(), key=repr)
    assert len(got) == 12
    by = {}
    for r in docs.collect():
        by.setdefault(sha(r.text), []).append(r.doc_id)
    for r in got:
        ids = by[r.digest.hex()]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (max(known) if known else None) and r.kept == (r.doc_id == r.keep_id)
    left = exact.deduplicate(docs, exact.fresh_index(spark, work), work)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 6, 7, 8, 8, 9]  # 2 has the text of 1, 4 that of 3
    assert exact.decide(cases.empty(spark), exact.fresh_index(spark, work), work).collect() == []


def test_exact_index_persists(spark, work):
    folder = work.path("kept")
    first = exact.DigestIndex(spark, "first_load", folder, 3)
    one = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in exact.decide(one, first, work).collect() if r.kept) == [2, 3]
    first.forget()
    again = exact.DigestIndex(spark, "second_load", folder, 3)  # the files alone carry the index over
    assert again.rows().count() == 2
    two = spark.createDataFrame([(4, "b"), (5, "c"), (6, "c"), (7, None)], "doc_id bigint, text string")
    got = cases.table(exact.decide(two, again, work))
    assert {i for i, r in got.items() if r.kept} == {6, 7} and got[4].keep_id == 3
    assert again.rows().count() == 4
    plan = again.unseen(spark.createDataFrame([(b"x", 1)], "digest binary, top_id bigint"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_components(spark, work):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200, i) for i in range(201, 260)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), work).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def brute_components(rows):
    sets = {i: set(neardup.shingles((t or "").encode()).tolist()) for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return sets, label


def near_copies(seed, groups, size):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(words).title() if rng.random() < 0.3 else " ".join(words))
    return list(enumerate(rows, 1000))


def test_near_duplicates_listed_and_hot(spark, work, monkeypatch):
    rows = near_copies(3, 4, 14)
    sets, label = brute_components(rows)
    assert 4 < len(set(label.values())) < len(rows) - 15
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for listed, block in ((64, 256), (2, 3)):
        monkeypatch.setattr(neardup, "LISTED", listed)
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = cases.table(neardup.near_duplicates(docs, work))
        assert {i: (r.component_id, r.n_shingles, r.kept) for i, r in got.items()} == {i: (label[i], len(sets[i]), label[i] == i) for i in sets}


def test_near_duplicates_edges(spark, work):
    got = sorted(neardup.near_duplicates(cases.corpus(spark), work).collect(), key=repr)
    assert len(got) == 12
    seen = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [seen[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 1, 3, 4, 5, 6, 1, 8, 9]
    assert seen[3].n_shingles == 0 and seen[8].n_shingles == 1
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert neardup.near_duplicates(cases.empty(spark), work).collect() == []
    left = neardup.one_of_each(cases.corpus(spark), work)
    assert left.columns == cases.corpus(spark).columns and {r.doc_id for r in left.collect()} == {1, 3, 4, 5, 6, 8, 9, None}


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    assert (neardup.sketch(np.array([7], np.uint64), 120) < np.iinfo(np.uint64).max).all()
    for share in (0.5, 0.85):
        off = []
        for _ in range(60):
            items = rng.integers(0, 1 << 63, 400).astype(np.uint64)
            k = int(round(400 * 2 * share / (1 + share))) // 1
            other = np.concatenate([items[:k], rng.integers(0, 1 << 63, 400 - k).astype(np.uint64)])
            true = k / (800 - k)
            off.append((neardup.sketch(items, 120) == neardup.sketch(other, 120)).mean() - true)
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def brute_repeats(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            if key in seen:
                gone.update(range(at, at + window))
            seen.add(key)
        out[i] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return out


def test_repeats_against_brute_force(spark, work):
    rng = random.Random(5)
    shared = [" ".join(f"s{k}p{i}" for i in range(rng.randrange(15, 60))) for k in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randrange(40))) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(4), rng.choice(shared))
        rows.append((i, "  ".join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(5)] + [(300, "a b " * 40), (301, "z a b " * 30)]
    want = brute_repeats(rows, 20)
    assert sum(w[1] for w in want.values()) > 500
    got = cases.table(repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), work))
    assert {i: (r.n_words, r.n_removed, r.kept) for i, r in got.items()} == want


def test_repeats_edges(spark, work):
    got = sorted(repeats.without_repeats(cases.corpus(spark), work).collect(), key=repr)
    assert len(got) == 12
    seen = {r.doc_id: r for r in got if r.doc_id is not None}
    n = len(cases.PROSE.split())
    assert seen[1].n_removed == 0 and (seen[2].n_removed, seen[2].kept) == (n, "") and (seen[7].n_removed, seen[7].kept) == (n, "today")
    assert (seen[3].n_words, seen[3].kept, seen[5].n_words) == (0, "", 0)
    assert seen[9].kept == "Ünïcode 漢字 \x1f \xa0 x"
    assert repeats.without_repeats(cases.empty(spark), work).collect() == []


@pytest.mark.parametrize("turned", [False, True])
def test_the_largest_text_of_a_repeated_id(spark, work, turned):
    """Whichever row comes first: an id stands for its largest text, and each of its rows gets the same answer."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:30][::-1])), (1, " ".join(words)), (1, None), (3, " ".join(words) + " more"), (None, " ".join(words)), (5, " ".join(words[:30][::-1]))]
    docs = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id bigint, text string")
    got = sorted([tuple(r) for r in neardup.near_duplicates(docs, work).select("doc_id", "n_shingles", "component_id", "kept").collect()], key=repr)
    assert got == sorted([(1, 56, 1, True)] * 3 + [(3, 57, 1, False), (None, 56, None, True), (5, 26, 5, True)], key=repr)
