"""The registered queries of this package, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from millrace.llm import alignment, bpe, crf, exact, hmm, latent, lexical, neardup, packing, repeats, secrets, surrogates, toxicity
from millrace.llm.tables import table
from millrace.llm.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run
    return register


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op9_exact_dedup(spark, sf_dir):
    work = Workspace(spark, "exact")
    rows = exact.decide(table(spark, sf_dir, "documents"), exact.fresh_index(spark, work), work)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op5_best_fit_packing(spark, sf_dir):
    return packing.best_fit(table(spark, sf_dir, "documents"), Workspace(spark, "packing"))


@query()
def op4_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark, "toxicity"))


@query("""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    shingled AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
    sizes AS (SELECT doc_id, len(s) AS n FROM shingled),
    items AS (SELECT doc_id, unnest(s) AS x FROM shingled),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
    lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN lowest USING (doc_id)
""")
def op8_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "neardup"))


@query()
def op2_benchmark_decontamination(spark, sf_dir):
    return latent.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "latent"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


@query()
def op6_secret_scan(spark, sf_dir):
    return secrets.secrets(table(spark, sf_dir, "documents"), Workspace(spark, "secrets"))


@query()
def op10_html_extraction(spark, sf_dir):
    return crf.extract(table(spark, sf_dir, "pages"), Workspace(spark, "crf"))


@query("""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    placed AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS pos, words FROM w WHERE len(words) >= 20),
    windows AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 19], ' ')) AS h FROM placed),
    later AS (SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) > 1),
    gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range(20) AS r(k)),
    each AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(body, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
""")
def op1_substring_dedup(spark, sf_dir):
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"), Workspace(spark, "repeats"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_lm_scoring(spark, sf_dir):
    return hmm.score(table(spark, sf_dir, "documents"), Workspace(spark, "hmm"))


@query()
def op7_pii_surrogates(spark, sf_dir):
    return surrogates.pseudonymised(table(spark, sf_dir, "documents"), Workspace(spark, "surrogates"))


@query()
def op11_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True))


@query()
def op12_token_alignment(spark, sf_dir):
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf_dir, "documents"), *paths, Workspace(spark, "alignment"))


@query(r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
    corpus AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
    postings AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, corpus GROUP BY term),
    asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM i) GROUP BY ALL),
    scored AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
               FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10
""")
def op13_lexical_search(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
