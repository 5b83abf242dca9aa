"""The operators as queries over the driver's tables, and check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.llm import (
    bpe,
    decontaminate,
    fill_in_middle,
    lexical_search,
    line_dedup,
    pii,
    quality,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    token_counts,
    top_k,
    toxicity,
)
from content_signals.llm.common import table
from content_signals.plans.staging import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string")) % by


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Fitted on rows that are not held out: a quarter of the ids is."""
    learned = _remainder(F.col("doc_id"), 4) != 2
    trusted = table(spark, sf_dir, "labels").filter(learned & (F.col("quality") == 1))
    docs = table(spark, sf_dir, "documents").filter(learned)
    return quality.fit_on(docs, trusted, if_too_few=quality.undecided())


@query
def op1_quality_classifier(spark, sf_dir):
    scored = quality.score_quality(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op2_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), decontaminate.fit(docs))


@query
def op3_token_counts(spark, sf_dir):
    """With a cache of its own, empty at first: every distinct text is a miss."""
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(TOKENIZER),
        new_path(spark, "token-cache"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    learned = table(spark, sf_dir, "labels").filter(_remainder(F.col("doc_id"), 5) != 0)
    scored = toxicity.score_toxicity(docs, toxicity.fit_on(docs, learned, if_too_few=toxicity.Model({})))
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "sentences",
    )


@query
def op5_substring_dedup(spark, sf_dir):
    cut = substring_dedup.drop_repeated_passages(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op6_bpe_round_trip(spark, sf_dir):
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_simhash_near_dedup(spark, sf_dir):
    grouped = simhash_dedup.near_copies(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return grouped.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op8_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept_text", 256).alias("kept_sha256")
    return kept.select("row.doc_id", "n_lines", "n_dropped", digest)


@query
def op9_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
        for k in pii.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


@query
def op10_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@query
def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_suffix_array_dedup(spark, sf_dir):
    cut = suffix_dedup.drop_repeated_bytes(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


@query
def op13_fill_in_middle(spark, sf_dir):
    arranged = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return arranged.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


_BLANK = r"\x20\x09-\x0D"

SQL: dict[str, str] = {
    "op5_substring_dedup": rf"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+') AS words FROM documents),
        starts AS (SELECT doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM w WHERE len(words) >= 50),
        windows AS (SELECT doc_id, pos, md5(array_to_string(list_slice(words, pos, pos + 49), ' ')) AS h FROM starts),
        first AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
        bad AS (SELECT doc_id, pos FROM windows JOIN first USING (h) WHERE least < doc_id),
        word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
        judged AS (
            SELECT doc_id, word.pos, word,
                max(bad.pos) OVER (PARTITION BY doc_id ORDER BY word.pos
                    ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS removed
            FROM word LEFT JOIN bad USING (doc_id, pos)),
        kept AS (
            SELECT doc_id, count(*) FILTER (removed) AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed), '') AS kept
            FROM judged GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op8_line_dedup": rf"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
        k AS (
            SELECT doc_id, pos, line, translate(
                regexp_replace(line, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        common AS (
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        judged AS (
            SELECT doc_id, pos, line, coalesce(keeper <> doc_id, false) AS dropped
            FROM k LEFT JOIN common USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op10_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                coalesce(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
            vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op11_lexical_search": r"""
        WITH fold(upper, lower) AS (VALUES ('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
        d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents, fold),
        i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, upper, lower),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark, fold WHERE item_id IS NOT NULL),
        total AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0),
        tf AS (
            SELECT r, doc_id, len(words) AS n, term, count(*) AS times
            FROM (SELECT r, doc_id, words, unnest(words) AS term FROM d) GROUP BY ALL),
        df AS (SELECT term, count(*) AS held FROM tf GROUP BY term),
        s AS (
            SELECT item_id, r, doc_id, sum(floor(1000 * ln((2 * n_docs + 2) / (2 * held + 1)))::BIGINT
                * ((1000000000 * times) // (1000 * times + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT
                AS score
            FROM i JOIN tf USING (term) JOIN df USING (term), total GROUP BY item_id, r, doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
            doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 50""",
    "op12_suffix_array_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
        starts AS (SELECT r, unnest(range(0, octet_length(t) - 399)) AS pos, t FROM d WHERE octet_length(t) >= 400),
        h AS (SELECT r, pos, md5(t[pos + 1:pos + 400]) AS h FROM starts),
        again AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
        edge AS (
            SELECT r, pos, lag(pos) OVER (PARTITION BY r ORDER BY pos) AS before FROM h SEMI JOIN again USING (h)),
        first AS (SELECT r, pos FROM edge WHERE before IS NULL OR pos > before + 400),
        last AS (
            SELECT r, pos, lead(pos) OVER (PARTITION BY r ORDER BY pos) AS after FROM h SEMI JOIN again USING (h)),
        ends AS (SELECT r, pos + 400 AS pos FROM last WHERE after IS NULL OR after > pos + 400),
        cut AS (
            SELECT r, row_number() OVER (PARTITION BY r ORDER BY pos) AS n, pos FROM first),
        stop AS (
            SELECT r, row_number() OVER (PARTITION BY r ORDER BY pos) AS n, pos FROM ends
            UNION ALL SELECT r, 0, 0 FROM d),
        kept AS (SELECT stop.r, stop.n, stop.pos AS a, cut.pos AS b FROM stop LEFT JOIN cut ON cut.r = stop.r AND cut.n = stop.n + 1),
        left_over AS (
            SELECT r, max(n) AS n_spans, string_agg(hex(t[a + 1:coalesce(b, octet_length(t))]), '' ORDER BY n) AS x
            FROM kept JOIN d USING (r) GROUP BY r)
        SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, (octet_length(t) - length(x) // 2)::BIGINT AS n_removed,
            n_spans::BIGINT AS n_spans, sha256(unhex(x)) AS kept_sha256
        FROM d JOIN left_over USING (r)""",
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
                sha256('7:' || doc_id) AS h
            FROM documents),
        u AS (
            SELECT *, len(lines)::BIGINT AS n, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 100 AS plain,
                ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
                ('0x' || h[25:32])::BIGINT % 100 < 50 AS suffix_first
            FROM d),
        c AS (
            SELECT *, array_to_string(lines[1:least(a, b)], '') AS p,
                array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') AS m,
                array_to_string(lines[greatest(a, b) + 1:], '') AS s
            FROM u)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
            CASE WHEN NOT plain THEN length(p) END::BIGINT AS prefix_chars,
            CASE WHEN NOT plain THEN length(m) END::BIGINT AS middle_chars,
            sha256(CASE WHEN plain THEN t WHEN suffix_first THEN '<S>' || s || '<P>' || p || '<M>' || m
                ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM c""",
}
