import corpus_pipeline
from cases import DATA, work  # noqa: F401

from millrace.llm import catalog, neardup


def test_stages_and_whole_run(spark):
    """Each stage filters what the one before kept; running them by hand gives the rows of run()."""
    folder = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == columns
        rows = kept.collect()
        assert 0 < len(rows) <= docs.count() and len({r.doc_id for r in rows}) == len(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    assert docs.count() < first
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
    key = lambda r: (r.doc_id, r.piece)
    assert sorted(corpus_pipeline.run(spark, folder).collect(), key=key) == sorted(packed.collect(), key=key)


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in catalog.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in catalog.QUERIES


def test_near_copies_from_080(spark):
    """Pairs at 0.80-0.85 lose a member, pairs just under 0.80 don't. One changed word in the middle of n takes five of n - 4 shingles."""
    rows = []
    for k, n in enumerate([49, 50, 52, 55, 58, 60] * 5):  # 40 of 50 shingles in common at 49 words, 51 of 61 at 60
        words = [f"p{k}w{i}" for i in range(n)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:20], "other", *words[21:]]))]
    for k in range(100, 105):
        words = [f"p{k}w{i}" for i in range(48)]  # 39 of 49
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:20], "other", *words[21:]]))]
    likeness = [len(a & b) / len(a | b) for a, b in ((set(neardup.shingles(s.encode())), set(neardup.shingles(t.encode())))
                                                     for (_, s), (_, t) in zip(rows[::2], rows[1::2]))]
    assert min(likeness[:30]) == 0.8 and max(likeness[:30]) < 0.85 and max(likeness[30:]) < 0.8
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert left == {2 * k for k in range(30)} | {i for k in range(100, 105) for i in (2 * k, 2 * k + 1)}


def test_sketch_bounds_follow_the_threshold():
    assert neardup.banding(85) == (24, 5) and neardup.least_agreeing(85, 120) == 84  # as op8 has been run
    for percent in (50, 70, 80, 90, 100):
        bands, rows = neardup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-6 and neardup.least_agreeing(percent, bands * rows) <= percent / 100 * bands * rows
    assert neardup.banding(80) == (30, 4) and neardup.least_agreeing(80, 120) == 76
