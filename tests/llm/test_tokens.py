"""Encoding and decoding, against the tokenizer libraries themselves."""

import base64
import hashlib
import random
from collections import Counter

import cases
import public_tokenizers
import pytest
import tiktoken
from cases import work  # noqa: F401

from millrace.llm import alignment, bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN, bpe.unassigned())


def test_long_and_odd_words(library, coder):
    """Runs that overlap, that make pairs of lesser ranks, that no token crosses; white space; every kind of byte."""
    rng = random.Random(5)
    rows = ["", "a" * 1001, "aab" * 400, "ab" * 700, "the" * 300, " " * 777 + "x", "\n\n \t", "é" * 333, "漢字仮名" * 99, "don't I'LL we're", "\0\0\1", "Ā\0Ā",
            "\U0001F600" * 200, "=-" * 300, "1234567890" * 60, *("".join(rng.choice(letters) for _ in range(rng.randrange(200, 600))) for letters in ["eta"] * 12 + ["abcdefgh", "xyzq", "αβγ", "เ แ"])]
    assert coder.encode(rows).to_pylist() == [library.encode_ordinary(t) for t in rows]
    assert coder.decode(coder.encode(rows)) == [t.encode() for t in rows]


def test_characters_of_other_unicode_versions(library, coder):
    unknown = bpe.unassigned()
    rows = ["a" + unknown[i:i + 40] + "b 1" for i in range(0, len(unknown), 40)]
    assert rows and coder.encode(rows).to_pylist() == [library.encode_ordinary(t) for t in rows]


def test_forgetting_changes_nothing(library, coder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    rows = [cases.PROSE, cases.PROSE + " again and again", "the quick brown fox"]
    for row in rows * 2:
        assert coder.encode([row]).to_pylist() == [library.encode_ordinary(row)]


def test_decode_gives_bytes_that_are_no_text(coder):
    import pyarrow as pa

    ids = pa.array([[coder.ranks[b"\xff"], coder.ranks[b"\xc3"]], None, []], pa.list_(pa.int32()))
    assert coder.decode(ids) == [b"\xff\xc3", b"", b""]
    with pytest.raises(ValueError):
        coder.decode(pa.array([[1 << 30]], pa.list_(pa.int32())))


def test_bpe_edges(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 100)
    docs = cases.corpus(spark)
    got = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True)
    want = sorted((-1 if r.doc_id is None else r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids, bytes(r.bytes)) for r in got.collect()) == want
    back = bpe.decode(got.drop("bytes"), RANKS, public_tokenizers.PATTERN)
    assert sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.bytes)) for r in back.collect()) == [(i, b) for i, _, b in want]
    digests = bpe.digests(got).filter("doc_id = 7").first()
    ids = library.encode_ordinary(cases.PROSE + " today")
    assert digests.n_tokens == len(ids) and digests.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode(cases.empty(spark), RANKS, public_tokenizers.PATTERN, decoded=True).collect() == []


MODELS = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*alignment.read_models(*MODELS))


def groups(aligner, text):
    """Whole texts coded at once; groups by the bytes that tokens decode to."""
    ids = (aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)) if text else ([], [])
    own = [[table[i] for i in x] for x, table in zip(ids, (aligner.a_bytes, aligner.b_bytes))]
    if any(b"".join(x) != (" " + text).encode() for x in own):
        return []
    ends = [[len(b"".join(x[:i + 1])) for i in range(len(x))] for x in own]
    out, low = [], (0, 0)
    for cut in sorted(set(ends[0]) & set(ends[1])):
        high = [e.index(cut) + 1 for e in ends]
        out.append(tuple(x[a:b] for x, a, b in zip(ids, low, high)))
        low = high
    return out


def expected(aligner, rows):
    found = [groups(aligner, t or "") for t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in found]
    held = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for g, c in zip(found, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]),
                    sum(n * held[p] for p, n in c.items()), hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return out


ODD = ["a", " ", "  ", "x  y   z", "\n \n x", " lead", "trail ", "trail \n", "é" * 50, "漢字仮名 \U0001F9FF\U0001F9FF x \U0001F600", "▁ x", "<0x41> <|endoftext|> </s> <s>", "a\tb \t c", "\0x",
       "\xa0a\xa0 b\u3000 c", "ｆｕｌｌ ﬁ", "é ́", "\r\n \r\n", "x \x85 y\u2028z", "\x1c \x1f", "   q", "a" * 3000, "supercalifragilistic" * 30, "good text beside", "a ▁ b in one text"]


def rows_of(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted([tuple(-1 if r[c] is None else r[c] for c in names) for r in df.collect()])


@pytest.mark.parametrize("chunk_bytes", [60, 1 << 20])
def test_alignment_equals_brute_force(spark, work, aligner, chunk_bytes):
    rng = random.Random(4)
    rows = ODD + ["".join(rng.choice("ab é漢\n\t \U0001F9FFxyz▁") for _ in range(rng.randrange(1, 40))) for _ in range(150)] + [cases.PROSE] * 3
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    assert rows_of(alignment.align(docs, *MODELS, work, chunk_bytes)) == [(i, *r) for i, r in enumerate(expected(aligner, rows))]


def test_alignment_edges(spark, work, aligner):
    docs = cases.corpus(spark)
    given = sorted([(-1 if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()], key=lambda r: (r[0], r[1] or ""))
    short = [(i, t) for i, t in given if t != cases.LONG]
    got = rows_of(alignment.align(docs.filter(docs.text.isNull() | (docs.text != cases.LONG)), *MODELS, work))
    assert got == sorted((i, *r) for (i, _), r in zip(short, expected(aligner, [t for _, t in short])))
    whole = rows_of(alignment.align(docs, *MODELS, work))
    assert len(whole) == len(given) and next(r for r in whole if r[0] == 6)[3] > 30_000
    assert alignment.align(cases.empty(spark), *MODELS, work).collect() == []


def test_units_are_where_no_token_crosses():
    assert alignment.UNIT.findall(" a b  c\n d e ") == [" a", " b", "  c\n d", " e "]
    assert alignment.unpack(alignment.pack(alignment.np.array([5, -3, 1 << 40]))).tolist() == [5, -3, 1 << 40]
    assert alignment.unpack(alignment.pack(alignment.np.array([], int))).tolist() == []
