"""Operator 10: URL rules, and beyond them empirical-Bayes host reputation. DataFrame functions only.

Labelled pages count as good or bad. Bad shares are shrunk through beta-binomial priors:
a suffix towards all pages, a registered domain towards its suffix, a host towards its
domain. The strength of each prior comes from how far its groups differ (moments). A host
is blocked when the lower bound of its posterior share is above `threshold`.

Without a public suffix list a suffix is the last label of a host, a registered domain its
last two. Defined results: null url or one without `://` has empty host and path and no
rule, and is judged as the host ''; unlabelled hosts rest on their priors, without any
label the share is 0; several labels for one page count as bad if one is; an empty table
gives an empty result; repeated rows get equal results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict): a rule fits the host, its subdomains and paths that start with its own.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
Z, THRESHOLD, WEAKEST, STRONGEST = 1.645, 0.5, 1.0, 1000.0


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; of equal lengths, the longer host."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def strength(groups: DataFrame) -> float:
    """Pseudo-counts of the prior, from the spread of groups (n, k) around their parents' share: one number."""
    p = F.col("prior")
    found = groups.where("n > 0").agg(
        F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("q"), F.count("*").alias("g"),
        F.sum(F.col("n") * (F.col("k") / F.col("n") - p) * (F.col("k") / F.col("n") - p)).alias("s"), F.sum(F.col("n") * p * (1 - p)).alias("v"),
    )
    within = F.col("v") / F.col("t")
    rho = (F.col("s") - (F.col("g") - 1) * within) / ((F.col("t") - F.col("q") / F.col("t") - (F.col("g") - 1)) * within)
    weight = F.when((F.col("g") < 2) | (within <= 0) | (F.col("t") - F.col("q") / F.col("t") - (F.col("g") - 1) <= 0) | (rho <= 0), F.lit(STRONGEST)).otherwise(1 / rho - 1)
    return found.select(F.coalesce(F.least(F.greatest(weight, F.lit(WEAKEST)), F.lit(STRONGEST)), F.lit(STRONGEST)).alias("m")).first()["m"]


def reputation(visits: DataFrame) -> DataFrame:
    """visits(host, n, k: labelled pages and bad ones) -> host, share (posterior mean) and lower (its bound)."""
    hosts = visits.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    hosts = written(hosts, "hosts").withColumn("domain", F.regexp_extract("host", "([^.]*[.])?[^.]*$", 0)).withColumn("suffix", F.regexp_extract("host", "[^.]*$", 0))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    overall = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    prior = overall["k"] / overall["n"] if overall["n"] else 0.0

    def shrunk(groups: DataFrame, keep: str) -> DataFrame:
        m = strength(groups)
        total = F.col("n") + m
        return groups.select(keep, ((F.col("k") + m * F.col("prior")) / total).alias("share"), total.alias("weight"))

    s = written(shrunk(suffixes.withColumn("prior", F.lit(prior)), "suffix"), "suffixes").select("suffix", F.col("share").alias("prior"))
    d = written(shrunk(domains.join(s, "suffix"), "domain"), "domains").select("domain", F.col("share").alias("prior"))
    h = shrunk(hosts.join(d, "domain"), "host")
    return h.select("host", "share", (F.col("share") - Z * F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("weight") + 1))).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, id_column: str = "page_id", url_column: str = "url", rules: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """pages plus host, path, rule, verdict, bad_share and bad_lower. outcomes(id, bad 0/1) labels some pages."""
    rules = RULES if rules is None else rules
    known = outcomes.where(F.col("id").isNotNull() & F.col("bad").isNotNull()).groupBy("id").agg(F.max("bad").alias("bad"))
    visits = pages.select(F.col(id_column).alias("id"), host_of(F.col(url_column)).alias("host")).join(known, "id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    rep = reputation(visits).select(F.col("host").alias("_host"), F.col("share").alias("bad_share"), F.col("lower").alias("bad_lower"))
    columns = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "bad_share", "bad_lower")]
    placed = pages.select(*columns, host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    scored = placed.join(rep, F.col("host") == F.col("_host"), "left")
    method = F.when(F.col("bad_lower") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(*columns, "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_share", "bad_lower")


def level_sql(groups: str, key: str) -> str:
    """SQL of one level: groups (key, prior, n, k) shrunk."""
    return f"""
{key}_m AS (SELECT coalesce(least(greatest(CASE WHEN g < 2 OR v / t <= 0 OR t - q / t - (g - 1) <= 0 OR (s - (g - 1) * (v / t)) / ((t - q / t - (g - 1)) * (v / t)) <= 0 THEN {STRONGEST}
  ELSE 1 / ((s - (g - 1) * (v / t)) / ((t - q / t - (g - 1)) * (v / t))) - 1 END, {WEAKEST}), {STRONGEST}), {STRONGEST}) AS m
  FROM (SELECT sum(n)::DOUBLE AS t, sum(n * n)::DOUBLE AS q, count(*)::DOUBLE AS g, sum(n * (k / n - prior) * (k / n - prior)) AS s, sum(n * prior * (1 - prior)) AS v FROM {groups} WHERE n > 0)),
{key}_s AS (SELECT {key}, (k + m * prior) / (n + m) AS share, n + m AS weight FROM {groups}, {key}_m)"""


def oracle(rules: list[tuple[str, str, str]] = RULES) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0])))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in ordered]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + f" WHEN share - {Z} * sqrt(share * (1 - share) / (weight + 1)) > {THRESHOLD} THEN 'block' ELSE 'allow' END"
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
placed AS (SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
known AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k FROM placed LEFT JOIN known ON page_id = doc_id GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
suffix_g AS (SELECT suffix, n, k, (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0.0 END FROM suffixes) AS prior FROM suffixes),
{level_sql("suffix_g", "suffix")},
domain_g AS (SELECT domain, n, k, share AS prior FROM domains JOIN suffix_s USING (suffix)),
{level_sql("domain_g", "domain")},
host_g AS (SELECT host, n, k, share AS prior FROM hosts JOIN domain_s USING (domain)),
{level_sql("host_g", "host")}
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM placed JOIN host_s USING (host)"""
