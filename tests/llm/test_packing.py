import random

import cases
from cases import work  # noqa: F401

from millrace.llm import packing


def naive(rows, capacity, per_source):
    """Looks at all bins for each piece."""
    bins, out = [], []
    repeated = {c for _, _, c, _ in rows if c is not None and sum(c == x[2] for x in rows) > 1}
    pieces = [(min(capacity, n - f), i, k, f, s, c) for i, s, c, n in rows for k, f in enumerate(range(0, max(n, 1), capacity))]
    for size, i, k, f, s, c in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        if not size:
            out.append((i, k, f, 0, None, None))
            continue
        fits = [(b["left"], at) for at, b in enumerate(bins) if b["left"] >= size and not (c in repeated and c in b["c"])
                and (s is None or b["s"].count(s) < per_source)]
        if not fits:
            bins.append({"left": capacity, "c": [], "s": []})
            fits = [(capacity, len(bins) - 1)]
        at = min(fits)[1]
        out.append((i, k, f, size, at, capacity - bins[at]["left"]))
        bins[at]["left"] -= size
        bins[at]["c"].append(c)
        bins[at]["s"].append(s)
    return out


def test_same_as_looking_at_all_bins():
    rng = random.Random(2)
    for capacity, per_source in ((50, 1), (50, 2), (200, 3)):
        rows = [(i, rng.choice(["a", "b", "c", "d", None]), bytes([rng.randrange(60)]), rng.choice([0, *range(1, 120)])) for i in range(300)]
        assert list(packing.pack(rows, capacity, per_source)) == naive(rows, capacity, per_source)


def test_bins_hold_what_they_may(spark, work):
    rows = [(i, " ".join(["w"] * (i * 37 % 90 + 1)) + f" {i // 3}", "en", f"s{i % 4}") for i in range(100, 400)]
    docs = cases.corpus(spark, *rows)
    got = packing.best_fit(docs, work, capacity=100, per_source=2, shard_rows=120).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append((r.text or "", r.source))
    words = {}
    for r in got:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.n_words
    assert words == {i: sum(len(t.encode().split()) for t, _ in ts) for i, ts in texts.items()}
    bins = {}
    for r in got:
        if r.n_words:
            bins.setdefault(r.bin_id, []).append(r)
    for rs in bins.values():
        rs.sort(key=lambda r: r.bin_start)
        assert all(a.bin_start + a.n_words == b.bin_start for a, b in zip(rs, rs[1:])) and rs[0].bin_start == 0
        assert sum(r.n_words for r in rs) <= 100
        held = [texts[r.doc_id][0] for r in rs]
        assert len({t for t, _ in held}) == len(held)
        assert all(sum(s == x for _, s in held) <= 2 for _, x in held if x)
    assert packing.best_fit(cases.empty(spark), work).collect() == []
