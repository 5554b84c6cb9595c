"""One query for each operator over the whole intended table, with production
parameters. Each takes (spark, sf_dir); ``ORACLE`` has DuckDB SQL where SQL
can express the whole result. The others are tested against brute-force
versions, round trips or held-out accuracy in ``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import crf_language, exact_dedup, filter_audit, fim, lattice_lm, license_scan, line_dedup, merkle, mixing, pack, simhash, token_trees, weak_rules


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrase places, labels, score and template spans of every document."""
    return license_scan.scan_licenses(_documents(spark, sf_dir))


def op3_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source at the same share of characters, the mixture as large as
    the corpus: all copies of all documents in global random order."""
    return mixing.mix(_documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after two edits of every document: eight code
    points before the middle are doubled, and the source's name is put after
    the first tenth."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", "source")
    trees = token_trees.build_trees(docs)
    n = F.length(F.coalesce("text", F.lit("")))
    middle, tenth = F.floor(n / 2), F.floor(n / 10)
    low = F.greatest(middle - 8, F.lit(0))
    doubled = F.substring("text", low.cast("int") + 1, (middle - low).cast("int"))
    edits = F.array(
        F.struct(low.alias("start"), middle.alias("stop"), F.concat(doubled, doubled).alias("replacement")),
        F.struct(tenth.alias("start"), tenth.alias("stop"), F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit(" ")).alias("replacement")))
    edited = token_trees.apply_edits(trees.withColumn("edits", edits), keep_text=False)
    return edited.select("doc_id", "n_tokens", "edited_tokens", "encoded_chars", "n_leaves")


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice scores of every document."""
    return lattice_lm.score_texts(_documents(spark, sf_dir))


def op6_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and its share of every document."""
    return crf_language.train_and_identify(_documents(spark, sf_dir))


def op7_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rule and posterior verdict of every document."""
    return weak_rules.quality(_documents(spark, sf_dir))


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, compared."""
    return merkle.fingerprint_edits(_documents(spark, sf_dir))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return pack.pack(_documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its later repeated runs of lines."""
    return line_dedup.dedup_runs(_documents(spark, sf_dir)).select("doc_id", "text", "removed_lines", "removed_runs")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-the-middle output
    and of the text rebuilt from it."""
    done = fim.fill_in_middle(_documents(spark, sf_dir))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(fim.restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's filters in all 120 orders, step by step."""
    return filter_audit.filter_interactions(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of texts equal but for white space."""
    return exact_dedup.duplicate_groups(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_license_scan, op3_poisson_mix, op4_token_counts, op5_lattice_lm, op6_crf_language,
                            op7_weak_rules, op8_merkle, op9_pack, op10_line_dedup, op11_fim, op12_filter_audit, op13_exact_dedup)
}

ORACLE: dict[str, str] = {
    "op3_poisson_mix": f"""
WITH per AS (
    SELECT source, count(*) AS n_docs, sum(coalesce(length(text), 0))::BIGINT AS amount FROM documents GROUP BY source
), rates AS (
    SELECT source, coalesce((1.0::DOUBLE * sum(amount) OVER ()::DOUBLE * 1.0::DOUBLE)
                            / nullif(count(*) OVER ()::DOUBLE * amount, 0), 1.0::DOUBLE) AS rate FROM per
), terms AS (
    SELECT source, rate, k, CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1.0)) ELSE (k = 0)::INT END AS term
    FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates)
), steps AS (
    SELECT source, rate, sum(term) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms
), drawn AS (
    SELECT d.*, ('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT
                / 4503599627370496.0::DOUBLE AS u
    FROM documents d
), counted AS (
    SELECT s.source, s.rate, d.doc_id, d.u, count(*) FILTER (WHERE s.cdf <= d.u)::INT AS copies
    FROM drawn d JOIN steps s ON s.source IS NOT DISTINCT FROM d.source GROUP BY ALL
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.rate, c.copies, g.copy_no::INT AS copy_no,
       md5('{mixing.SEED}|order|' || coalesce(d.doc_id::VARCHAR, '') || '|' || g.copy_no::VARCHAR) AS shuffle_key
FROM drawn d JOIN counted c ON c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.u = d.u AND c.source IS NOT DISTINCT FROM d.source
CROSS JOIN LATERAL (SELECT unnest(range(0, c.copies)) AS copy_no) g
""",
    "op11_fim": r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents
), drawn AS (
    SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM units
), parts AS (
    SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
           array_to_string(u[greatest(a, b) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
    "op12_filter_audit": r"""
WITH marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), failed AS (
    SELECT x.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           [len(w) < 50, 100 * list_unique(w) < 65 * len(w), 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t),
            regexp_matches(t, '[#$%&*|]'), coalesce(x.doc_id > min(x.doc_id) OVER (PARTITION BY t), false)] AS f
    FROM texts x LEFT JOIN marks m ON m.doc_id = x.doc_id
), grouped AS (
    SELECT part, f, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic FROM failed GROUP BY part, f
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), orders AS (
    SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), steps AS (
    SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
           [ascii(x) - 64 for x in string_split(filter_order[:step - 1], '') if x <> ''] AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), cases AS (
    SELECT g.*, s.filter_order, s.step, s.own, len(list_filter(earlier, lambda i: f[i])) > 0 AS gone, f[own] AS fails,
           len(list_filter(f, lambda x: x)) AS n_fails
    FROM grouped g, steps s
), counted AS (
    SELECT part, filter_order, step, own, sum(n * (NOT gone AND NOT fails)::INT)::BIGINT AS kept,
           sum(n * (NOT gone AND fails)::INT)::BIGINT AS removed, sum(n * (gone AND fails)::INT)::BIGINT AS redundant,
           sum(n * (fails AND n_fails = 1)::INT)::BIGINT AS unique_fails, sum(n_good * (NOT gone AND fails)::INT)::BIGINT AS good_lost,
           sum(n_toxic * (NOT gone AND fails)::INT)::BIGINT AS toxic_lost
    FROM cases GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
""",
    "op13_exact_dedup": r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents
), ranked AS (
    SELECT doc_id, body, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, row_number() OVER w AS place
    FROM texts WINDOW w AS (PARTITION BY body ORDER BY size DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
""",
}
