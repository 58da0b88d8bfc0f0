"""URL filters: fixed host and path rules first, host reputation for the rest.

Reputation is empirical Bayes over labelled page outcomes (1 good, 0 bad).  At each
level, host within registered domain within suffix within all pages, the good share is
a beta-binomial mean shrunk towards the level above: (good + k * parent) / (n + k).  The
prior weight k is fitted to the data by moments, from how far the groups of a level
differ beyond chance.  A host passes if the lower posterior bound, ``Z`` standard
deviations below its mean, reaches ``CUT``.  A host without outcomes takes the
posterior of its domain, then suffix, then all pages.

A reputation belongs to a site: the host without user information, port and a final dot.
The suffix of a site is its last label, or its last two if they are a generic label under
a country's (``GENERIC``: a.co.uk has the suffix co.uk), or what a table of public suffixes
says, if one is given (``public_suffixes``: plain rules, wildcards and exceptions).  The
registered domain is the suffix with the label before it; a site that is itself a suffix,
and an IP address, is its own domain, an IP address also its own suffix.

Everything is DataFrame expressions.  Outcomes are summed per host before any join, so a
host with a third of all pages is one row there, and page rows meet only the table of
hosts, whose join Spark can split where a host is hot.

A null URL, or one without "://", has an empty host and path, no rule, and the posterior
of the empty host.  Repeated pages are judged each; a null outcome counts for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written

#: (host, path, allow): fits the host and its subdomains if the path starts so.
RULES = (("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False))
CUT, Z = 0.5, 1.645
#: Prior pages at least and at most, and where no spread can be measured.
LEAST, MOST, USUAL = 1.0, 1000.0, 10.0
#: Labels that stand for a kind of registrant where they precede a country's label.
GENERIC = ("ac", "co", "com", "edu", "go", "gov", "mil", "ne", "net", "or", "org")
ADDED = ("host", "path", "rule", "verdict", "reputation", "bound")


def host_of(url: Column) -> Column:
    """A-Z are lower-cased one by one: lower() would also change other letters."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and whether it allows; both null if none fits."""
    text, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for h, p, ok in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0])):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, allow = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(ok)).otherwise(allow)
    return text, allow


def site_of(host: Column) -> Column:
    """The host without user information, port and a final dot."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"(:[0-9]*|\.)$", "")


def is_address(site: Column) -> Column:
    return site.rlike(r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[[^\]]*\])$")


def suffix_of(site: Column) -> Column:
    two = F.regexp_extract(site, rf"(?:^|\.)((?:{'|'.join(GENERIC)})\.[a-z]{{2}})$", 1)
    return F.when(is_address(site), site).when(two != "", two).otherwise(F.substring_index(site, ".", -1))


def domain_of(site: Column, suffix: Column) -> Column:
    """The suffix and the label before it."""
    labels = F.size(F.split(suffix, r"\.", -1)) + 1
    return F.when(is_address(site), site).otherwise(F.call_function("substring_index", site, F.lit("."), -labels))


def public_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """The rules (a column rule) of a file in the format of the public suffix list: one a
    line, comments after //."""
    return spark.read.text(path).select(F.lower(F.regexp_extract("value", r"^\s*([^\s/]+)", 1)).alias("rule")).where("rule <> ''").distinct()


def listed_suffixes(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """site and suffix, for the sites (distinct) that a rule fits: an exception (!www.ck)
    decides before all others and names a suffix one label shorter; else the longest tail
    that a rule (uk) or a wildcard (*.ck) names."""
    tails = sites.where(~is_address(F.col("site"))).select(
        "site", F.explode(F.sequence(F.lit(1), F.size(F.split("site", r"\.", -1)))).alias("labels"))
    tail = F.call_function("substring_index", F.col("site"), F.lit("."), -F.col("labels"))
    rest = F.call_function("substring_index", F.col("site"), F.lit("."), 1 - F.col("labels"))  # without its first label
    asked = tails.select("site", "labels", F.explode(F.array(
        F.struct(tail.alias("rule"), tail.alias("suffix"), F.lit(0).alias("first")),
        F.struct(F.concat(F.lit("*."), rest).alias("rule"), tail.alias("suffix"), F.lit(0).alias("first")),
        F.struct(F.concat(F.lit("!"), tail).alias("rule"), rest.alias("suffix"), F.lit(1).alias("first")))).alias("q")).select("site", "labels", "q.*")
    fits = asked.join(rules.select("rule").distinct(), "rule", "left_semi")
    return fits.groupBy("site").agg(F.max_by("suffix", F.struct("first", "labels")).alias("suffix"))


def _level(groups: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Posterior mean and number of pages (own and prior) of each group of one level.

    By moments: the groups' weighted variance about their parents' means is
    m (1 - m) / n beyond which the rest is m (1 - m) / (k + 1).
    """
    both = groups.join(parents.select(F.col(parent_key).alias("_p"), F.col("mean").alias("_m")), F.col(parent_key).eqNullSafe(F.col("_p")), "inner").drop("_p")
    chance = F.col("_m") * (1 - F.col("_m"))
    k = both.where("n >= 2").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("_m"), 2)).alias("spread"),
        F.sum(chance).alias("by_chance"), F.sum((F.col("n") - 1) * chance).alias("room"))
    k = k.select(F.when((F.col("room") > 0) & (F.col("spread") > F.col("by_chance")),
                        F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.col("room") / (F.col("spread") - F.col("by_chance")) - 1)))
                 .when(F.col("room") > 0, F.lit(MOST)).otherwise(F.lit(USUAL)).alias("k")).first()["k"]  # one number a level
    return both.select(
        *groups.columns, ((F.col("good") + F.lit(k) * F.col("_m")) / (F.col("n") + F.lit(k))).alias("mean"), (F.col("n") + F.lit(k)).alias("weight"))


def reputations(outcomes: DataFrame, sites: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Posterior mean and lower bound of every site of ``sites`` (a column site) or with
    an outcome.

    ``outcomes``: site and good (0 or 1, nulls ignored); ``suffixes``: see ``public_suffixes``.
    """
    sums = outcomes.where("good IN (0, 1)").groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    named = sites.select("site").union(sums.select("site")).distinct()
    suffix = suffix_of(F.col("site"))
    if suffixes is not None:
        named = named.join(listed_suffixes(named, suffixes).withColumnRenamed("suffix", "listed"), "site", "left")
        suffix = F.coalesce("listed", F.when(is_address(F.col("site")), F.col("site")).otherwise(F.substring_index("site", ".", -1)))
    per_host = named.join(sums, "site", "left").withColumn("suffix", suffix).select(
        "site", domain_of(F.col("site"), F.col("suffix")).alias("domain"), "suffix",
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("good", F.lit(0)).alias("good"))
    per_host = written(per_host, "host-outcomes")
    total = lambda by: per_host.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    top = per_host.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).select(
        F.lit("").alias("all"), ((F.col("good") + 1) / (F.col("n") + 2)).alias("mean"))
    suffixes = _level(total(["suffix"]).withColumn("all", F.lit("")), "suffix", top, "all")
    domains = _level(total(["domain", "suffix"]), "domain", suffixes, "suffix")
    ranked = _level(per_host, "site", domains, "domain")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return ranked.select("site", F.col("mean").alias("reputation"), F.greatest(F.lit(0.0), F.col("mean") - Z * deviation).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, cut: float = CUT, url: str = "url", suffixes: DataFrame | None = None) -> DataFrame:
    """All columns of ``pages`` with those of ADDED; input columns of these names are
    replaced.  ``outcomes``: url and good; ``suffixes``: see ``public_suffixes``."""
    kept = pages.select(*[c for c in pages.columns if c not in ADDED])
    rows = kept.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    sites = rows.select(site_of(F.col("host")).alias("site")).distinct()
    seen = outcomes.select(site_of(host_of(F.col("url"))).alias("site"), F.col("good").cast("int").alias("good"))
    known = written(reputations(seen, sites, suffixes), "host-reputation").withColumnRenamed("site", "_site")
    rule, allow = rule_of(F.col("host"), F.col("path"), rules)
    return rows.join(known, site_of(F.col("host")) == F.col("_site"), "left").select(
        *kept.columns, "host", "path", rule.alias("rule"),
        F.when(F.coalesce(allow, F.col("bound") >= cut), F.lit("allow")).otherwise(F.lit("block")).alias("verdict"), "reputation", "bound")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages: a page shows the document whose id ends its path, and the
    document's quality label (the smallest, if it has several) is the page's outcome."""
    doc_id = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    shown = pages.select("url", F.when(doc_id != "", doc_id.cast("long")).alias("doc_id")).where("doc_id IS NOT NULL")
    marks = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("good"))
    return shown.join(marks, "doc_id").select("url", "good")
