"""URL filter: block and allow rules, and empirical-Bayes host reputation.

Pages that a rule decides are labelled outcomes (block: bad).  Every host's
bad rate gets a beta-binomial posterior whose prior is its registered
domain's, whose prior is its suffix's, whose prior is the overall rate.  How
strongly each level shrinks towards the one above is estimated from the data
(method of moments on the spread between siblings).  Pages without a rule are
blocked when the lower bound of their host's bad rate exceeds ``max_bad``.

Only DataFrame expressions.  Per-host counts are aggregated before anything is
joined; the one join over pages is on the host, which Spark splits if hot.

Defined cases: NULL url or one without ``://``: host and path are empty and
the empty host has a reputation like any other.  An address or a user
part is part of the host as it stands (1.2.3.4 counts under 3.4), a port is left
out of the registered domain.  Repeated rows are judged and
counted one by one.  An empty table gives an empty result.  Other columns of
the input are ignored by ``judge`` unless named in ``keep``.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Suffixes of two labels below which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
                      "com.cn", "com.mx", "com.tr", "com.tw", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp",
                      "org.au", "org.uk")


@dataclass(frozen=True)
class Reputation:
    max_bad: float = 0.5        # block when the posterior's lower bound exceeds this bad rate
    z: float = 1.645            # bound: mean - z standard deviations (one-sided 95 %)
    strength_min: float = 1.0   # limits of the estimated prior strengths, in pages
    strength_max: float = 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host lower-cased A-Z, both empty without ``://``."""
    at = F.instr(url, F.lit("://"))
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), ASCII_UPPER, ASCII_UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (``host/path`` text) that fits, else NULL."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def registered_domain(host: Column) -> Column:
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    two = "|".join(s.replace(".", r"\.") for s in TWO_LABEL_SUFFIXES)
    long, short = (F.regexp_extract(bare, r, 1) for r in (rf"([^.]+\.(?:{two}))$", r"([^.]+\.[^.]+)$"))
    return F.when(long != "", long).when(short != "", short).otherwise(bare)


def suffix_of(domain: Column) -> Column:
    return F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1)


def _strength(level: DataFrame, name: str, r: Reputation) -> DataFrame:
    """One row: the prior strength of a level from (n, k, pn, pk), its own and
    its parent's counts.  Moments of a beta-binomial with correlation rho:
    E[n (p - m)^2] = m (1 - m) (1 + (n - 1) rho); strength = 1 / rho - 1."""
    m, p, n = F.col("pk") / F.col("pn"), F.col("k") / F.col("n"), F.col("n")
    spread, plain = F.sum(n * (p - m) * (p - m)), F.sum(m * (1 - m))
    weight = F.sum(m * (1 - m) * (n - 1))
    rho = F.when(weight > 0, (spread - plain) / weight)
    low, high = 1 / (r.strength_max + 1), 1 / (r.strength_min + 1)
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(low)), F.lit(low)), F.lit(high))
    return level.where("n > 0").agg((1 / rho - 1).alias(name))


def host_posteriors(outcomes: DataFrame, r: Reputation = Reputation()) -> DataFrame:
    """(host, n, k, alpha, beta, mean, lower) for each host of ``outcomes``
    (host, bad: 1, 0 or NULL for a page without a label)."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
    hosts = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    up = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = up(hosts, "domain", "suffix")
    suffixes = up(domains, "suffix")
    overall = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))

    parent = lambda df, *keep: df.select(*keep, F.col("n").alias("pn"), F.col("k").alias("pk"))
    s_up = suffixes.crossJoin(F.broadcast(parent(overall)))  # one row
    d_up = domains.join(parent(suffixes, "suffix"), "suffix")
    h_up = hosts.join(parent(domains, "domain"), "domain")
    strengths = _strength(s_up, "ms", r).crossJoin(_strength(d_up, "md", r)).crossJoin(_strength(h_up, "mh", r))  # one row each
    one = strengths.crossJoin(overall.select(((F.col("k") + 1) / (F.col("n") + 2)).alias("m0")))

    s = suffixes.crossJoin(F.broadcast(one)).select("suffix", "md", "mh", ((F.col("k") + F.col("ms") * F.col("m0")) / (F.col("n") + F.col("ms"))).alias("m_s"))
    d = domains.join(s, "suffix").select("domain", "mh", ((F.col("k") + F.col("md") * F.col("m_s")) / (F.col("n") + F.col("md"))).alias("m_d"))
    h = (hosts.join(d, "domain").withColumn("alpha", F.col("k") + F.col("mh") * F.col("m_d"))
         .withColumn("beta", F.col("n") - F.col("k") + F.col("mh") * (1 - F.col("m_d"))))
    size = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / size
    return h.select("host", "n", "k", "alpha", "beta", mean.alias("mean"),
                    (mean - r.z * F.sqrt(mean * (1 - mean) / (size + 1))).alias("lower"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], r: Reputation = Reputation(),
          keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict (allow or block) and, for
    pages without a rule, the host's posterior ``mean`` and ``lower`` bound."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(*keep, "url").select(*keep, host.alias("host"), path.alias("path"))
    known = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    parts = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_said", known[F.col("rule")])
    bad = F.when(F.col("_said") == "block", 1).when(F.col("_said") == "allow", 0)
    rep = host_posteriors(parts.select("host", bad.alias("bad")), r).select("host", "mean", "lower")
    method = F.when(F.round("lower", 9) > r.max_bad, "block").otherwise("allow")
    return (parts.join(rep, "host", "left")
            .select(*keep, "host", "path", "rule", F.coalesce("_said", method).alias("verdict"), "mean", "lower"))


RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def oracle(rules: Sequence[tuple[str, str]] = RULES, r: Reputation = Reputation()) -> str:
    """DuckDB SQL for op3's rows."""
    listed = ", ".join(f"('{x}', '{v}', '{x.partition('/')[0]}', '/{x.partition('/')[2]}')" for x, v in rules)
    two = "|".join(s.replace(".", r"\.") for s in TWO_LABEL_SUFFIXES)
    lo, hi = 1 / (r.strength_max + 1), 1 / (r.strength_min + 1)

    def strength(child: str, up: str, on: str) -> str:
        return f"""(SELECT 1 / least(greatest(coalesce(CASE WHEN sum(m*(1-m)*(n-1)) > 0
            THEN (sum(n*(p-m)*(p-m)) - sum(m*(1-m))) / sum(m*(1-m)*(n-1)) END, {lo!r}), {lo!r}), {hi!r}) - 1
          FROM (SELECT c.n AS n, c.k / c.n AS p, u.k / u.n AS m FROM {child} c JOIN {up} u ON {on} WHERE c.n > 0))"""

    return rf"""
WITH rules(rule, said, rhost, rpath) AS (VALUES {listed}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rid FROM rest),
fit AS (SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM parts
    JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid),
judged AS (SELECT p.*, f.rule, f.said FROM parts p LEFT JOIN fit f USING (rid)),
h0 AS (SELECT host, count(said) AS n, count(*) FILTER (said = 'block') AS k, regexp_replace(host, ':[0-9]*$', '') AS bare FROM judged GROUP BY host),
h1 AS (SELECT *, CASE WHEN regexp_extract(bare, '([^.]+\.(?:{two}))$', 1) <> '' THEN regexp_extract(bare, '([^.]+\.(?:{two}))$', 1)
    WHEN regexp_extract(bare, '([^.]+\.[^.]+)$', 1) <> '' THEN regexp_extract(bare, '([^.]+\.[^.]+)$', 1) ELSE bare END AS domain FROM h0),
h AS (SELECT *, regexp_extract(domain, '^[^.]*\.(.*)$', 1) AS suffix FROM h1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
o AS (SELECT coalesce(sum(n), 0) AS n, coalesce(sum(k), 0) AS k FROM s),
one AS (SELECT (k + 1) / (n + 2) AS m0, {strength('s', 'o', 'true')} AS ms,
    {strength('d', 's', 'c.suffix = u.suffix')} AS md, {strength('h', 'd', 'c.domain = u.domain')} AS mh FROM o),
s2 AS (SELECT suffix, (k + ms * m0) / (n + ms) AS m FROM s, one),
d2 AS (SELECT domain, (d.k + md * s2.m) / (d.n + md) AS m FROM d JOIN s2 USING (suffix), one),
h2 AS (SELECT host, h.k + mh * d2.m AS a, h.n - h.k + mh * (1 - d2.m) AS b FROM h JOIN d2 USING (domain), one)
SELECT page_id, judged.host AS host, path, rule, coalesce(said, CASE WHEN round(a / (a + b)
    - {r.z} * sqrt((a / (a + b)) * (1 - a / (a + b)) / (a + b + 1)), 9) > {r.max_bad} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN h2 ON judged.host = h2.host"""


def op3(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return judge(read(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")
