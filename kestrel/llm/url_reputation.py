"""URL filter: explicit rules, else an empirical-Bayes reputation of the host."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialise, salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
MAX_RULES = 1000
# fixed values: second-level labels under which country registries sell names
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
MIN_GOOD = 0.5  # a host is blocked if even the upper bound of its good share is below this
Z = 1.645  # one-sided 95 % bound
# bounds of the correlation within a unit, hence of the prior's strength 1 / rho - 1
RHO = (0.001, 0.5)
PRIOR = (1.0, 1.0)  # pseudo-counts of good and bad outcomes above the suffixes


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or where ``://`` is missing.

    The host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased
    (user and port stay in it); the path from there to ``?``, ``#`` or the end.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host, three under a country's second-level registry; shorter hosts whole."""
    labels = F.split(host, r"\.")
    country = (F.size(labels) >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL)
    return F.when(country, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def suffix(domain: Column) -> Column:
    """What follows the first label of a registered domain; a domain of one label is its own suffix."""
    return F.when(F.instr(domain, ".") > 0, F.substring(domain, F.instr(domain, ".") + 1, F.length(domain))).otherwise(domain)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the expression takes up to {MAX_RULES}")
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1]))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _correlation(units: DataFrame) -> float:
    """Moment estimate of the correlation of outcomes within a unit (columns n, k, m: the parent's mean)."""
    spread = F.col("m") * (1 - F.col("m"))
    row = units.agg(
        F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2) / spread).alias("q"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"),
    ).first()
    rho = (row["q"] - row["n"]) / row["pairs"] if row["pairs"] else RHO[1]
    return min(max(rho, RHO[0]), RHO[1])


def _shrunk(units: DataFrame, mean: str) -> DataFrame:
    """Add ``mean``: the posterior mean under a beta prior with the parent's mean ``m`` and the level's strength."""
    strength = 1 / _correlation(units) - 1
    return units.withColumn(mean, (F.col("k") + F.lit(strength) * F.col("m")) / (F.col("n") + F.lit(strength))).withColumn(
        "strength", F.lit(strength)
    )


def host_reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """Posterior of the share of good pages for each host of ``hosts``: ``host, n, k, mean, upper``.

    ``outcomes`` has ``host`` and ``good`` (0 or 1, null: not labelled). Each
    level's share is shrunk to its parent's: suffix to all pages, registered domain
    to suffix, host to domain, by a beta-binomial prior whose strength is estimated per level
    from the spread of its units. Only the three strengths and the overall
    share reach the driver. ``upper`` is the posterior mean plus ``Z`` standard deviations, at most 1.
    A host without labels has its domain's mean; without any label at all every mean is 0.5.
    """
    counts = (
        outcomes.where(F.col("good").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("k"))
    )
    units = hosts.select("host").distinct().join(counts, "host", "left").fillna(0, ["n", "k"])
    units = units.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("domain")))
    units = materialise(units, "hosts")
    domains = units.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + PRIOR[0]) / ((total["n"] or 0) + sum(PRIOR))
    suffixes = _shrunk(suffixes.withColumn("m", F.lit(overall)), "mean")
    up = suffixes.select("suffix", F.col("mean").alias("m"))
    domains = _shrunk(salted_join(domains, up, ["suffix"], ["domain"]), "mean")
    up = domains.select("domain", F.col("mean").alias("m"))
    units = _shrunk(salted_join(units, up, ["domain"], ["host"]), "mean")
    weight = F.col("n") + F.col("strength")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return units.select("host", "n", "k", "mean", F.least(F.lit(1.0), F.col("mean") + Z * sd).alias("upper"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_good: float = MIN_GOOD,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, upper`` for every row of ``pages``.

    ``outcomes(page_id, good)`` holds labelled outcomes, at most one per page id;
    a page without one counts for no host. A rule fits its host and all
    subdomains where the path starts with the rule's; the longest rule decides.
    Without a rule a page is blocked where the upper posterior bound of its host's good share is under ``min_good``.

    Null or malformed URLs have empty host and path and share the reputation of the empty host. Equal rows
    are separate pages; an empty table gives an empty result; other columns are ignored.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    got = outcomes.select(F.col("page_id").alias("_o"), F.col("good").cast("int").alias("good"))
    labelled = rows.join(got, F.col("page_id") == F.col("_o")).select("host", "good")
    reputation = host_reputation(labelled, rows).select("host", "upper")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    judged = salted_join(rows.withColumn("_rule", rule), reputation, ["host"], ["page_id", "path"])
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("upper") < min_good, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "upper")


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """Outcome of each page: the quality label of the document that its path numbers (``/en/123.html``: 123).

    Of several labels of a document the lowest counts.
    """
    number = F.expr(f"try_cast(regexp_extract({url_col}, '://[^/?#]*/[^/?#]*/([0-9]+)', 1) as bigint)")
    good = labels.groupBy(F.col("doc_id").alias("_d")).agg(F.min("quality").alias("good"))
    return (
        pages.select("page_id", number.alias("n"))
        .join(good, F.col("n") == F.col("_d"))
        .groupBy("page_id")
        .agg(F.min("good").alias("good"))
    )


def oracle_sql() -> str:
    """The same verdicts in DuckDB."""
    lengths = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fit = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    rule = " ".join(f"WHEN {fit(h, p)} THEN '{h}{p}'" for h, p, _ in lengths)
    verdict = " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for h, p, v in lengths)
    second = ", ".join(f"'{x}'" for x in SECOND_LEVEL)

    def strength(name: str) -> str:
        return f"""{name}_rho AS (SELECT 1 / least(greatest(coalesce(CASE WHEN sum(n * (n - 1)) > 0
            THEN (sum(pow(k - n * m, 2) / (m * (1 - m))) - sum(n)) / sum(n * (n - 1)) END, {RHO[1]}::DOUBLE), {RHO[0]}::DOUBLE), {RHO[1]}::DOUBLE) - 1 AS a FROM {name}_in),
        {name} AS (SELECT u.*, a, (k + a * m) / (n + a) AS mean FROM {name}_in u, {name}_rho)"""

    return f"""
    WITH cut AS (SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    rows AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                    try_cast(regexp_extract(url, '://[^/?#]*/[^/?#]*/([0-9]+)', 1) AS BIGINT) AS number FROM cut),
    good AS (SELECT doc_id, min(quality) AS good FROM labels GROUP BY 1),
    counts AS (SELECT host, count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS k FROM rows LEFT JOIN good ON number = good.doc_id GROUP BY 1),
    parts AS (SELECT *, string_split(host, '.') AS l FROM counts),
    named AS (SELECT host, n, k, CASE WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ({second})
                THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM parts),
    units AS (SELECT *, CASE WHEN instr(domain, '.') > 0 THEN substr(domain, instr(domain, '.') + 1) ELSE domain END AS suffix FROM named),
    d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM units GROUP BY ALL),
    s_in AS (SELECT suffix, sum(n) AS n, sum(k) AS k,
                    (sum(sum(k)) OVER () + {PRIOR[0]}::DOUBLE) / (sum(sum(n)) OVER () + {sum(PRIOR)}::DOUBLE) AS m FROM d GROUP BY suffix),
    {strength("s")},
    d_in AS (SELECT d.*, s.mean AS m FROM d JOIN s USING (suffix)),
    {strength("dom").replace("dom_in", "d_in")},
    h_in AS (SELECT u.host, u.n, u.k, dom.mean AS m FROM units u JOIN dom USING (domain)),
    {strength("h")},
    bound AS (SELECT host, least(1.0::DOUBLE, mean + {Z}::DOUBLE * sqrt(mean * (1 - mean) / (n + a + 1))) AS upper FROM h)
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN upper < {MIN_GOOD} THEN 'block' ELSE 'allow' END AS verdict, round(upper, 9) AS upper
    FROM rows JOIN bound USING (host)
    """
