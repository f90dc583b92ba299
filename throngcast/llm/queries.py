"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from throngcast.llm import (
    decontamination, fill_in_middle, language_id, lm_scoring, near_dedup, packing, periodic_runs, pii, quality_classifier,
    quality_rules, substring_dedup, token_counts, url_filters,
)
from throngcast.llm.common import crc_of_id
from throngcast.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = [
    url_filters.Rule("allow", "org/"),
    url_filters.Rule("block", "example.org/es/"),
    url_filters.Rule("block", "example.org/en/1"),
    url_filters.Rule("allow", "com/fr/"),
    url_filters.Rule("block", "com/de/"),
]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(configure(spark), sf_dir)
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark, d):
    return substring_dedup.dedup(table(spark, d, "documents")).drop("kept_text")


@query
def op2_url_filters(spark, d):
    """Outcomes: a page is labelled by the label with its number, bad where quality is 0."""
    outcomes = table(spark, d, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    judged = url_filters.judge(table(spark, d, "pages"), outcomes, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op3_quality_classifier(spark, d):
    return quality_classifier.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op4_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_lm_scoring(spark, d):
    held_out = crc_of_id(F.col("doc_id")) % 7 == 2
    scored = lm_scoring.score(table(spark, d, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op6_language_id(spark, d):
    docs = table(spark, d, "documents")
    held_out = crc_of_id(F.col("doc_id")) % 4 == 2
    found = language_id.identify(docs.select("doc_id", "text", "lang"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_set")


@query
def op7_decontamination(spark, d):
    """Pairs of a document and a benchmark item that it holds."""
    return decontamination.find(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op8_near_dedup(spark, d):
    return near_dedup.classes(table(spark, d, "documents"), words=5, percent=85)


@query
def op9_pii(spark, d):
    return pii.find(table(spark, d, "documents"))


@query
def op10_quality_rules(spark, d):
    labels = table(spark, d, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    return quality_rules.judge(table(spark, d, "documents"), labels)


@query
def op11_token_counts(spark, d):
    return token_counts.count_tokens(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_fill_in_middle(spark, d):
    made = fill_in_middle.transform(table(spark, d, "documents"), unit="line", seed=7, percent=100, spm_percent=50)
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )


@query
def op13_periodic_runs(spark, d):
    found = periodic_runs.collapse(table(spark, d, "documents"), min_length=24, min_exponent=3, prepare=periodic_runs.planted)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def _strength(level: str, units: str) -> str:
    return f"""
{level}_sums AS (SELECT count(*) AS k, sum(n) AS n, sum(bad) AS y, sum(n * n) AS nn, sum(bad * bad / n) AS yyn
    FROM {units} WHERE n > 0),
{level}_terms AS (SELECT k, y / n AS rate, yyn - n * (y / n) * (y / n) - (k - 1) * ((y / n) * (1 - y / n)) AS between_,
    (n - nn / n - (k - 1)) * ((y / n) * (1 - y / n)) AS room FROM {level}_sums),
{level}_prior AS (SELECT CASE WHEN k = 0 THEN 0.0 ELSE rate END AS rate, CASE WHEN k = 0 THEN 2.0 ELSE
    greatest(1 / least(greatest(CASE WHEN room > 0 THEN between_ / room ELSE 0 END, 0.001), 0.999) - 1, 2.0) END AS m FROM {level}_terms)"""


_FITS = {
    "block example.org/en/1": "example.org/en/1", "block example.org/es/": "example.org/es/",
    "allow com/fr/": "com/fr/", "block com/de/": "com/de/", "allow org/": "org/",
}


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"


#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": f"""
WITH parsed AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{url_filters.UPPER}', '{url_filters.UPPER.lower()}') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
counted AS (SELECT host, count(quality)::DOUBLE AS n, coalesce(sum(1 - quality), 0)::DOUBLE AS bad
    FROM parsed LEFT JOIN labels ON doc_id = page_id GROUP BY host),
hosts AS (SELECT *, CASE WHEN regexp_matches(host, '^[0-9.:]+$') OR regexp_extract(host, '([^.]+[.][^.]+)$', 1) = '' THEN host
    ELSE regexp_extract(host, '([^.]+[.][^.]+)$', 1) END AS domain,
    CASE WHEN regexp_matches(host, '^[0-9.:]+$') OR regexp_extract(host, '([^.]+)$', 1) = '' THEN host
    ELSE regexp_extract(host, '([^.]+)$', 1) END AS suffix FROM counted),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain),
{_strength("suffix", "suffixes")}, {_strength("domain", "domains")}, {_strength("host", "hosts")},
suffix_rates AS (SELECT suffix, (bad + m * rate) / (n + m) AS r FROM suffixes, suffix_prior),
domain_rates AS (SELECT domain, (d.bad + m * s.r) / (d.n + m) AS r FROM domains d JOIN suffix_rates s USING (suffix), domain_prior),
posterior AS (SELECT host, bad + m * r AS a, n - bad + m * (1 - r) AS b FROM hosts JOIN domain_rates USING (domain), host_prior),
bounds AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior)
SELECT page_id, host, path,
    CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for r in _FITS.values())} END AS rule,
    CASE {" ".join(f"WHEN {_fits(r)} THEN '{v.split()[0]}'" for v, r in _FITS.items())}
    WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM parsed LEFT JOIN bounds USING (host)""",
    "op8_near_dedup": f"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filters.UPPER}', '{url_filters.UPPER.lower()}'),
    '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
shingled AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(
        list_zip(w[:-5], w[2:-4], w[3:-3], w[4:-2], w[5:]), lambda x: concat_ws(' ', x[1], x[2], x[3], x[4], x[5])))) END AS s FROM worded),
sets AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS shingle FROM sets),
links AS (SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.shingle = b.shingle AND a.rep < b.rep
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT rep AS a, rep AS b FROM sets UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b),
components AS (SELECT a AS rep, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(d.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM shingled d LEFT JOIN sets ON sets.s = d.s LEFT JOIN components USING (rep)""",
    "op12_fill_in_middle": """
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS l, sha256('7:' || doc_id) AS h FROM documents),
numbers AS (SELECT *, len(l) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM drawn),
parts AS (SELECT *, array_to_string(l[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
    array_to_string(l[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
    array_to_string(l[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s,
    CASE WHEN doc_id IS NULL OR t = '' OR regexp_matches(t, '<[PSM]>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts""",
}
