"""Models trained here: exact recursions against enumeration, gradients, held-out results, and the awkward rows."""

import itertools
import math
import random
import zlib

import cases
import numpy as np
import pytest
from cases import DATA, work  # noqa: F401

from millrace.llm import crf, hmm, latent, toxicity

SF = f"{DATA}/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_forward_is_the_sum_over_all_paths(monkeypatch):
    rng = np.random.default_rng(1)
    unit = lambda x: x / x.sum(-1, keepdims=True)
    k, classes = hmm.STATES, 5
    model = hmm.HMM(unit(rng.random(k)), unit(rng.random((k, k))), unit(rng.random((k, classes))).T)
    rows = [rng.integers(0, classes, n).astype(np.uint16) for n in (1, 4, 3, 4, 2)]
    for row, got in zip(rows, model.log10_likelihood(rows)):
        total = 0.0
        for path in itertools.product(range(k), repeat=len(row)):
            p = model.start[path[0]] * model.emit[row[0], path[0]]
            for t in range(1, len(row)):
                p *= model.step[path[t - 1], path[t]] * model.emit[row[t], path[t]]
            total += p
        assert got == pytest.approx(math.log10(total), rel=1e-9)


def test_expected_counts_by_enumeration(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    monkeypatch.setattr(hmm, "CLASSES", 4)
    rng = np.random.default_rng(2)
    unit = lambda x: x / x.sum(-1, keepdims=True)
    model = hmm.HMM(unit(rng.random(3)), unit(rng.random((3, 3))), unit(rng.random((3, 4))).T)
    rows = [rng.integers(0, 4, n) for n in (5, 5, 3, 1)]
    padded = np.zeros((4, 5), np.int64)
    for i, r in enumerate(rows):
        padded[i, :len(r)] = r
    counts = [np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))]
    score = model.expected(padded, np.array([5, 5, 3, 1]), np.array([True, True, False, True]), counts)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))]
    total = 0.0
    for row, opens in zip(rows, (True, True, False, True)):
        weights = {}
        for path in itertools.product(range(3), repeat=len(row)):
            p = model.start[path[0]] * model.emit[row[0], path[0]]
            for t in range(1, len(row)):
                p *= model.step[path[t - 1], path[t]] * model.emit[row[t], path[t]]
            weights[path] = p
        z = sum(weights.values())
        total += math.log(z)
        for path, p in weights.items():
            want[0][path[0]] += opens * p / z
            for t, s in enumerate(path):
                want[2][row[t], s] += p / z
                if t:
                    want[1][path[t - 1], s] += p / z
    assert score == pytest.approx(total, rel=1e-4)
    for a, b in zip(counts, want):
        assert np.allclose(a, b, atol=1e-4)


def test_lm_scores(spark, work):
    docs = read(spark, "documents")
    got = cases.table(hmm.score(docs, work, chunk_bytes=300_000))
    texts = {r.doc_id: r.text.encode().lower().split() + [None] for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    count = {}
    for i, t in texts.items():
        if i not in held:
            for w in t:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, t in texts.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(t), sum(w in count for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
    per_token = lambda key: sum(got[i][key] for i in held) / sum(got[i].n_tokens for i in held)
    assert per_token("score") > per_token("base_score") + 0.3


def test_lm_words_of_a_state_sum_to_one(spark, work):
    """One-word texts for every known word, an unknown one and none: with the end's probability their scores sum to that of two tokens."""
    docs = spark.createDataFrame([(i, "red red blue green green odd") for i in range(1, 30)], "doc_id bigint, text string")
    probes = [(1000 + 10 * k, w) for k, w in enumerate(["red", "blue", "green", "odd", "never"])]
    probes = [(next(j for j in range(i, i + 10**6) if zlib.crc32(str(j).encode()) % 10 == 0), w) for i, w in probes]
    got = cases.table(hmm.score(docs.union(spark.createDataFrame(probes, docs.schema)), work))
    empty = next(j for j in range(10**7) if zlib.crc32(str(j).encode()) % 10 == 0)
    total = sum(10 ** got[i].score for i, _ in probes)
    assert 0 < total < 1 and all(got[i].held_out for i, _ in probes) and empty is not None


def test_lm_edges(spark, work):
    got = hmm.score(cases.corpus(spark), work).collect()
    assert len(got) == 12 and all(r.score <= 0 and math.isfinite(r.score) and r.n_tokens >= 1 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert hmm.score(cases.empty(spark), work).collect() == []


def test_toxicity_held_out(spark, work):
    got = cases.table(toxicity.classify(read(spark, "documents"), read(spark, "labels"), work))
    marked = {r.doc_id: r.toxic for r in read(spark, "labels").collect()}
    held = [(got[i].predicted, y) for i, y in marked.items() if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in got.values())
    assert sum(p == y for p, y in held) / len(held) > 0.93
    english = [i for i, r in got.items() if r.held_out and marked.get(i) == 1 and r.predicted]
    assert len(english) >= 8


def test_toxicity_gradient_lowers_the_loss():
    docs = [toxicity.tokens(t.encode()) for t in ("you are a clown", "a fine day it is", "what a clown", "fine words here")] * 8
    labels = np.array([1, 0, 1, 0] * 8)
    model = toxicity.TextCNN.load(toxicity.TextCNN().fit(docs, labels, 0.5).dump())
    assert ((model.scores(docs) > 0.5) == labels).all()
    one = model.scores([docs[0]])[0]
    assert one == pytest.approx(model.scores(docs)[0])  # neighbours in a batch don't leak in
    assert model.scores([toxicity.tokens(b"")])[0] < 0.9


def test_toxicity_edges(spark, work):
    docs = cases.corpus(spark)
    some = [(i, 1, int(i % 2)) for i in range(1, 10)] + [(1, 1, None), (2, 0, 5), (7, 0, 0)]
    got = toxicity.classify(docs, cases.labels(spark, some), work).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in toxicity.classify(docs, cases.labels(spark), work).collect()} == {0.0}
    assert toxicity.classify(cases.empty(spark), cases.labels(spark), work).collect() == []
    left = toxicity.reject_toxic(docs, cases.labels(spark), work)
    assert left.columns == docs.columns and left.count() == 12


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    model = crf.CRF()
    for _ in range(50):
        model.start, model.step, e = rng.normal(size=2), rng.normal(size=(2, 2)), rng.normal(size=(rng.integers(1, 9), 2))
        value = lambda p: model.start[p[0]] + sum(e[t, s] for t, s in enumerate(p)) + sum(model.step[a, b] for a, b in zip(p, p[1:]))
        assert tuple(model.viterbi(e)) == max(itertools.product((0, 1), repeat=len(e)), key=value)


def test_blocks_of_broken_markup():
    found = crf.blocks("<body><nav><ul><li>One<li>Two</ul></nav><article><h1>A &amp; B</h1><p><b>First\n  part<br>x<p>Second</b> <i>it</i><script>var a='<p>no</p>'</script>"
                       "<!-- <p>no</p> --><div hidden>no</div><p title='a > b'>Third&nbsp;one</article><p>End &copy; <a href=x>link</a><p")
    assert [(b.text, b.path[-1]) for b in found] == [("One", "li"), ("Two", "li"), ("A & B", "h1"), ("First part x", "b"), ("Second it", "p"),
                                                     ("Third one", "p"), ("End © link", "p")]
    assert crf.blocks("") == [] and crf.blocks("  \n") == [] and [b.text for b in crf.blocks("just text")] == ["just text"]


def test_blocks_drop_nothing_else():
    texts = lambda page: [b.text for b in crf.blocks(page)]
    for tag in ("style", "script", "title", "textarea"):
        assert texts(f"<!-- old <{tag}> block --><article><p>Kept</p></article>") == ["Kept"]
        assert texts(f"<{tag}>no <!-- </{tag}><p>Kept</p>") == ["Kept"] and texts(f"<p>A</p><{tag}><article><p>Kept</p>")[-1] == "Kept"
    assert texts("<p>If a < b then the rest") == ["If a < b then the rest"] and texts("<p>If a < b</p>") == ["If a < b"]
    assert texts('<p title="a hidden gem">One</p><p class="col hidden lg:block">Two</p><p data-x="display:none">Three</p>') == ["One", "Two", "Three"]
    assert texts('<p hidden>a</p><p hidden="">b</p><p style="color:red; display: none">c</p><p aria-hidden=true>d</p><p>Kept</p>') == ["Kept"]


def test_extraction(spark, work):
    pages = read(spark, "pages")
    got = cases.table(crf.extract(pages, work, sample=60), "page_id")
    right = 0
    for r in pages.collect():
        want = "\n".join(b.text for b in crf.blocks(r.html) if crf.in_article(b))
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
        right += got[r.page_id].text == want
    assert right >= 0.98 * len(got)


def test_extraction_edges(spark, work):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>Only a paragraph, with words in it.</p>", "x"), (3, "u", "<p>Only a paragraph, with words in it.</p>", "x"),
            (None, "u", "<<>><p", "x"), (5, "u", "<nav>" * 3000 + "<p>deep</p>", "x"), (6, "u", "<article><p>" + "long text, " * 20000 + "</p></article>", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = crf.extract(pages, work).collect()
    assert len(got) == 7 and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert next(r.n_chars for r in got if r.page_id == 6) == len("long text, " * 20000) - 1
    assert crf.extract(pages.limit(0), work).collect() == []


def test_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.choice("abcde").encode() for _ in range(rng.randrange(1, 20))]
        b = [rng.choice("abcdef").encode() for _ in range(rng.randrange(0, 25))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent.longest_common(latent.positions(a), len(a), b) == table[-1][-1]


def test_singular_vectors(spark, work):
    """The decomposition's space is that of the dense matrix, where its values stand apart."""
    rng = random.Random(6)
    topics = [[f"t{k}w{i}" for i in range(12)] for k in range(4)]
    rows = [(i, " ".join(rng.choice(topics[i % 4]) for _ in range(32))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    space = latent.LatentSpace(docs, work, rank=8)
    a = np.zeros((400, latent.TERMS))
    for i, t in rows:
        for term in latent.terms(latent.plain_words(t.encode())):
            a[i, term] += space.weights[term]
        a[i] /= np.sqrt(sum(space.weights[x] ** 2 for x in latent.terms(latent.plain_words(t.encode()))))
    true = np.linalg.svd(a, compute_uv=False)[:4]
    assert np.allclose(np.sort(space.singular)[::-1][:4], true, rtol=0.02)


def test_contamination(spark, work):
    docs, bench = read(spark, "documents"), read(spark, "benchmark")
    item = bench.orderBy("item_id").first()
    words = item.text.split()
    changed = [w if i % 6 else "zzz" for i, w in enumerate(words)]  # a paraphrase: every sixth word, but not the last ones
    changed[-8:] = words[-8:]
    filler = " ".join(f"filler{i}" for i in range(100))
    extra = [(90001, f"{filler} {' '.join(changed)} {filler}"), (90002, f"{filler} {' '.join(words[::-1])}"), (90003, f"x {item.text.upper()} y"), (90004, filler)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    got = {(r.doc_id, r.item_id) for r in latent.contaminated(both, bench, work).collect()}
    plain = lambda t: b" " + b" ".join(latent.plain_words(t.encode())) + b" "
    items = [(r.item_id, plain(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in both.collect() for i, t in items if t in plain(r.text)}
    assert want <= got and len(want) > 10
    assert (90001, item.item_id) in got and not {90002, 90004} & {d for d, _ in got}
    assert len(got - want) <= 2
    left = {r.doc_id for r in latent.decontaminate(both, bench, work, block=15).collect()}
    assert left == {r.doc_id for r in both.collect()} - {d for d, _ in got}


def test_contamination_edges(spark, work):
    docs = cases.corpus(spark)
    bench = cases.benchmark(spark, [(1, cases.PROSE), (2, None), (3, ""), (4, "one"), (None, cases.PROSE)])
    got = latent.contaminated(docs, bench, work).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(1, 1), (2, 1), (7, 1), (None, 1)}
    assert latent.contaminated(docs, cases.benchmark(spark), work).collect() == []
    assert latent.contaminated(cases.empty(spark), bench, work).collect() == []
    left = latent.decontaminate(docs, bench, work)
    assert left.columns == docs.columns and {3, 4, 5, 6, 9} <= {r.doc_id for r in left.collect()}


def test_search_proposes_paraphrases_and_short_items():
    """Against the common subsequence of the planted place: shares 0.55-1, items of 1 to 200 words, at any offset."""
    rng = random.Random(5)
    vocabulary = [b"".join(rng.choice([b"ka", b"lo", b"mi", b"ru", b"te", b"so"]) for _ in range(4)) for _ in range(3000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    term_map = np.random.default_rng(2).normal(size=(latent.TERMS, latent.RANK + latent.RESIDUAL)).astype(np.float32)
    rows, docs, want = [], [], []
    for n in (1, 2, 3, 4, 5, 7, 9, 12, 16, 17, 25, 33, 48, 64, 100, 200):
        for _ in range(8):
            words, item = some(n), len(rows)
            rows.append((item, b" ".join(words[:-5]) + b". " + b" ".join(words[-5:]) if n > 9 else b" ".join(words)))
            for share in (1,) if n < 10 else (0.56, 0.6, 0.7, 0.8, 1):
                copy = list(words)
                for k in rng.sample(range(n - 5), round(n * (1 - share))) if share < 1 else ():
                    copy[k] = b"other%d" % rng.randrange(10 ** 6)
                common = latent.longest_common(latent.positions(words), n, copy)
                if share == 1 or common >= latent.PARAPHRASE * n:
                    docs.append([*some(rng.randrange(60)), *copy, *some(rng.randrange(60))])
                    want.append(item)
    found = latent.Items(rows, term_map).matches(docs)
    lost = [i for i, f in zip(want, found) if i not in f]
    assert len(want) > 400 and len(lost) <= 0.01 * len(want)


def test_common_words_of_many_rows():
    rng = np.random.default_rng(4)
    for n in (1, 7, 63, 64):
        item = [b"%d" % x for x in rng.integers(0, 20, n)]
        places = latent.positions(item)
        rows = [[b"%d" % x for x in rng.integers(0, 25, 90)] for _ in range(40)]
        near = np.array([[places.get(w, 0) for w in r] for r in rows], np.uint64)
        assert latent.common_words(near, n).tolist() == [latent.longest_common(places, n, r) for r in rows]


def test_partial_passages_and_long_items():
    """Runs of an item's words and passages of long items count, wherever they lie; shorter quotes don't."""
    rng = random.Random(6)
    vocabulary = [b"".join(rng.choice([b"ka", b"lo", b"mi", b"ru", b"te", b"so"]) for _ in range(4)) for _ in range(3000)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    term_map = np.random.default_rng(2).normal(size=(latent.TERMS, latent.RANK + latent.RESIDUAL)).astype(np.float32)
    items = [some(n) for n in (20, 27, 40, 64, 65, 90, 130, 200)]
    docs, want = [], []
    for i, words in enumerate(items):
        n = len(words)
        runs = [latent.needed_run(n), latent.needed_run(n) - 4, *([round(0.7 * n)] if n > 20 else []), *([100] if n > 100 else [])]
        for size in runs:
            for first in {0, rng.randrange(n - size + 1), n // 3, n - size}:
                if first + size <= n:
                    docs.append([*some(rng.randrange(30, 90)), *words[first:first + size], *some(rng.randrange(30, 90))])
                    want.append(i if size >= latent.needed_run(n) else None)
    for first in (0, 32, 64, 136):  # a passage with every eighth word changed: no long run
        docs.append([*some(40), *[w if k % 8 else b"changed" for k, w in enumerate(items[7][first:first + 64])], *some(40)])
        want.append(7)
    found = latent.Items([(i, b" ".join(w)) for i, w in enumerate(items)], term_map).matches(docs)
    assert [set(f) for f in found] == [set() if w is None else {w} for w in want] and None in want
    assert [latent.passages(n) for n in (5, 64, 65)] == [[(0, 5)], [(0, 64)], [(0, 32), (0, 64), (1, 65), (32, 65)]]
    for n in range(65, 300):  # any run of the longest needed length lies in one passage
        assert all(any(a <= k and k + latent.RUNS[1] <= b for a, b in latent.passages(n)) for k in range(n - latent.RUNS[1] + 1))


def test_block_features_see_the_whole_text():
    """Digits and marks are shares of the block, wherever they stand."""
    features = lambda text: set(crf.features(crf.Block(text, (), (), 0), 1, 3))
    assert "digits=True" in features("word " * 100 + "1234567 " * 20) and "digits=False" in features("1234567 " + "word " * 100)
    assert "mark=True" in features("a · b") and "mark=True" in features("x" * 100 + " · a" * 60) and "mark=False" in features("a · b " + "word " * 100)


def test_search_takes_each_window_by_the_plain_rule(monkeypatch):
    """All windows and passages one by one, on words that repeat; and terms are compared in order for many items at once."""
    rng = random.Random(12)
    vocabulary = [b"v%d" % k for k in range(60)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [some(n) for n in (1, 2, 4, 5, 8, 9, 20, 33, 64, 70) for _ in range(4)]
    docs = [[], some(3), some(700), *([*some(rng.randrange(40)), *words[2:], *some(20)] for words in items)]
    term_map = np.random.default_rng(3).normal(size=(latent.TERMS, 40)).astype(np.float32)
    want = set()
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            for a, b in latent.passages(len(item)):
                m, length = b - a, next(n for n in latent.LENGTHS if n >= b - a)
                v = term_map[latent.terms(item[a:b])].sum(0)
                places = latent.positions(latent.terms(item[a:b]).tolist())
                before, after = -(-(m // 4 + latent.STEP) // latent.STEP) * latent.STEP, -(-(m + m // 4 + latent.STEP) // latent.STEP) * latent.STEP
                for start in range(0, len(words), latent.STEP):
                    w = term_map[latent.terms(words[start:start + length])].sum(0)
                    near = latent.terms(words[max(0, start - before):start + after]).tolist()
                    if v @ w / np.linalg.norm(v) >= latent.least_cosine(m, length) * np.linalg.norm(w) and latent.longest_common(places, m, near) >= m / 2:
                        want.add((d, i, start, a, m))
    calls, common_words = [], latent.common_words
    monkeypatch.setattr(latent, "common_words", lambda near, n: calls.append(len(near)) or common_words(near, n))
    known = latent.Items([(i, b" ".join(w)) for i, w in enumerate(items)], term_map)
    got = [(d, i, start, a, m) for d, i, _, start, a, m in known.search([latent.terms(w) for w in docs])]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500
    assert len(calls) <= 1 + sum(calls) // 20_000
