"""The registered queries of this package and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import oracles
from ledgerlake.llm.tables import read
from ledgerlake.llm.urls import GENERIC

#: Key of the registered query; a real run passes its own secret.
PII_KEY = "example-key"


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.fingerprint import edited_neighbours
    return edited_neighbours(read(spark, sf_dir, "documents"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.licenses import scan
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.urls import judge, labelled_pages
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(pages, labelled_pages(pages, read(spark, sf_dir, "labels")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.substrings import duplicate_passages
    return duplicate_passages(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.quality import classify
    return classify(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")).drop("text")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.html import extract
    return extract(read(spark, sf_dir, "pages"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.jaccard import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


#: Sources are grouped into four domains by their number; the mixture they shall have.
DOMAINS = ("web", "news", "reference", "forum")
WEIGHTS = {"domain": {"web": 4, "news": 3, "reference": 2, "forum": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}


def domain_of_source(source: str = "source") -> Column:
    number = F.pmod(F.coalesce(F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1).try_cast("long"), F.lit(0)), F.lit(len(DOMAINS)))
    return F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), (number + 1).cast("int"))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.mixing import mix
    mixed = mix(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), domain_of_source(), weights=WEIGHTS)
    return mixed.select("doc_id", "domain", "lang", "source", "tokens", "epoch")


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.pii import pseudonymise
    return pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.decontam import decontaminate
    return decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark")).drop("text")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.collocations import collocations
    return collocations(read(spark, sf_dir, "documents"))


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.secret_scan import BASE_RULES, scan
    base = [r.kind for r in BASE_RULES]

    def listed(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    found = F.col("secrets")
    counts = [F.size(F.filter(found, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in base]
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(listed(F.filter(found, lambda x: x["kind"].isin(base))), 256).alias("base_sha256"), listed(found).alias("spans"))


def op13_merkle_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.manifest import manifest
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return manifest(read(spark, sf_dir, "documents"), tampered)


QUERIES = {f.__name__: f for f in (
    op1_document_fingerprints, op2_license_scans, op3_url_filters, op4_substring_dedup, op5_quality_classifier, op6_html_extraction, op7_ngram_jaccard_join, op8_source_mixture,
    op9_pii_pseudonyms, op10_benchmark_decontamination, op11_phrase_collocations, op12_secret_scans, op13_merkle_dataset_manifest)}

_URL = """SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages"""


def _level_sql(name: str, groups: str, key: str, parents: str, parent_key: str) -> str:
    """One level of the reputation's shrinkage, as ``urls._level`` defines it."""
    return f"""
{name}_both AS (SELECT g.*, p.mean AS m FROM ({groups}) g JOIN {parents} p ON g.{parent_key} = p.{parent_key}),
{name}_k AS (SELECT CASE WHEN room > 0 AND spread > by_chance THEN least(1000.0, greatest(1.0, room / (spread - by_chance) - 1)) WHEN room > 0 THEN 1000.0 ELSE 10.0 END AS k
    FROM (SELECT sum(n * pow(good / n - m, 2)) AS spread, sum(m * (1 - m)) AS by_chance, sum((n - 1) * m * (1 - m)) AS room FROM {name}_both WHERE n >= 2)),
{name} AS (SELECT b.*, (good + k * m) / (n + k) AS mean, n + k AS weight FROM {name}_both b, {name}_k)"""


_OP3 = f"""
WITH p AS (SELECT *, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), '(:[0-9]*|\\.)$', '') AS site FROM ({_URL})),
shown AS (SELECT site, try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\\.[a-z]+)?/?$', 1), '') AS bigint) AS doc_id FROM p),
marks AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
sums AS (SELECT site, count(*) AS n, sum(good) AS good FROM shown JOIN marks USING (doc_id) GROUP BY site),
kinds AS (SELECT site, regexp_matches(site, '^([0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}|\\[[^\\]]*\\])$') AS address,
    regexp_extract(site, '(?:^|\\.)((?:{"|".join(GENERIC)})\\.[a-z]{{2}})$', 1) AS two FROM (SELECT DISTINCT site FROM p)),
per_host AS (SELECT site, CASE WHEN address THEN site WHEN two <> '' THEN regexp_extract(site, '([^.]*\\.)?[^.]*\\.[^.]*$') ELSE regexp_extract(site, '([^.]*\\.)?[^.]*$') END AS domain,
    CASE WHEN address THEN site WHEN two <> '' THEN two ELSE regexp_extract(site, '[^.]*$') END AS suffix, coalesce(n, 0) AS n, coalesce(good, 0) AS good, '' AS one
    FROM kinds LEFT JOIN sums USING (site)),
top AS (SELECT '' AS one, (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean FROM per_host),
{_level_sql("suffixes", "SELECT suffix, one, sum(n) AS n, sum(good) AS good FROM per_host GROUP BY suffix, one", "suffix", "top", "one")},
{_level_sql("domains", "SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM per_host GROUP BY domain, suffix", "domain", "suffixes", "suffix")},
{_level_sql("hosts", "SELECT site, domain, n, good FROM per_host", "site", "domains", "domain")}
SELECT page_id, host, path,
    CASE WHEN block1 THEN 'example.org/en/1' WHEN block2 THEN 'example.org/es/' WHEN com_fr THEN 'com/fr/' WHEN com_de THEN 'com/de/' WHEN org THEN 'org/' END AS rule,
    CASE WHEN block1 OR block2 THEN 'block' WHEN com_fr THEN 'allow' WHEN com_de THEN 'block' WHEN org THEN 'allow'
         WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM (SELECT p.*, h.mean, h.weight,
        (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') AS block1,
        (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') AS block2,
        (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') AS com_fr,
        (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') AS com_de,
        (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') AS org
      FROM p JOIN hosts h USING (site))"""


def _shares_sql(name: str, nodes: str, parent: str, node: str) -> str:
    """Shares of siblings in their parent's budget, as ``mixing.shares`` defines them."""
    by = f"PARTITION BY {parent} ORDER BY supply / weight ASC NULLS LAST, {node} ASC NULLS FIRST"
    return f"""
{name} AS (SELECT *, least(supply::double, greatest(0.0, max(level) OVER (PARTITION BY {parent}) * weight)) AS share FROM (
    SELECT *, (budget - coalesce(sum(supply) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER ({by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ({nodes}) WHERE weight > 0 AND supply > 0))"""


_OP8 = f"""
WITH d AS (SELECT doc_id, lang, source, md5(coalesce(text, '')) AS h,
        ['web', 'news', 'reference', 'forum'][1 + coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS bigint), 0) % 4] AS domain,
        len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS tokens FROM documents),
rows AS (SELECT * FROM d WHERE tokens > 0),
leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens, sum(tokens) * 4 AS supply,
        CASE domain WHEN 'web' THEN 4.0 WHEN 'news' THEN 3.0 WHEN 'reference' THEN 2.0 ELSE 1.0 END::double AS w1,
        CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END::double AS w2, 1.0::double AS w3 FROM rows GROUP BY domain, lang, source),
{_shares_sql("top", "SELECT domain, w1 AS weight, sum(supply) AS supply, (SELECT sum(tokens) FROM rows)::double AS budget, 0 AS root FROM leaf GROUP BY domain, w1", "root", "domain")},
{_shares_sql("mid", "SELECT l.domain, l.lang, l.w2 AS weight, sum(l.supply) AS supply, any_value(t.share) AS budget FROM leaf l JOIN top t ON l.domain IS NOT DISTINCT FROM t.domain GROUP BY l.domain, l.lang, l.w2", "domain", "lang")},
{_shares_sql("low", "SELECT l.domain, l.lang, l.source, l.tokens, l.w3 AS weight, l.supply, m.share AS budget FROM leaf l JOIN mid m ON l.domain IS NOT DISTINCT FROM m.domain AND l.lang IS NOT DISTINCT FROM m.lang", "domain, lang", "source")},
plan AS (SELECT domain, lang, source, tokens AS total, floor(share + 1e-6)::bigint // tokens::bigint AS whole, floor(share + 1e-6)::bigint % tokens::bigint AS rest FROM low),
every AS (SELECT r.*, e.epoch::int AS epoch, p.whole, p.rest, md5('mix:' || e.epoch || ':' || coalesce(doc_id::varchar, '') || ':' || h) AS place
    FROM rows r JOIN plan p ON r.domain IS NOT DISTINCT FROM p.domain AND r.lang IS NOT DISTINCT FROM p.lang AND r.source IS NOT DISTINCT FROM p.source, range(0, 5) e(epoch) WHERE e.epoch <= p.whole)
SELECT doc_id, domain, lang, source, tokens::bigint AS tokens, epoch FROM (
    SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM every)
WHERE epoch < whole OR upto <= rest"""

ORACLE: dict[str, str] = {"op3_url_filters": _OP3, "op8_source_mixture": _OP8, **oracles.ORACLE}
