"""URL filtering by rules and by empirical-Bayes host reputation. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Levels from the widest to the narrowest, each with the one above it.
LEVELS = (("suffix", None), ("domain", "suffix"), ("host", "domain"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path. The host lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, with A-Z in lower
    case; the path follows up to ``?``, ``#`` or the end. Both are empty for a null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host, or all of it if it has fewer."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule ``(verdict, "host/path")`` that fits, as a struct of ``rule`` and ``verdict``; else null.

    A rule fits its host and all subdomains, if the path starts with the rule's path.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _strength(groups: DataFrame) -> DataFrame:
    """One row: mean bad rate ``mu`` and prior strength ``m`` of groups (n, bad) by the method of moments.

    The between-group variance is what the weighted spread of the rates has beyond the binomial part. The strength is
    held between 1 and 10^6; without spread, or without two labelled groups, it is 10^6: all groups share one rate.
    """
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    totals = groups.where("n > 0").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(n * n).alias("n2"),
        F.sum(bad * bad / n).alias("b2n"),
    )
    k, n, bad = F.col("k"), F.coalesce(F.col("n"), F.lit(0)).cast("double"), F.coalesce(F.col("bad"), F.lit(0)).cast("double")
    mu = (bad + 1) / (n + 2)
    spread = F.col("b2n") - 2 * F.col("mu") * bad + F.col("mu") * F.col("mu") * n
    within = F.col("mu") * (1 - F.col("mu"))
    scale = F.when(n > 0, n - F.col("n2") / n)
    between = F.when((k > 1) & (scale > 0), (spread - (k - 1) * within) / scale)
    m = F.when(between > 0, within / between - 1)
    return totals.withColumn("mu", mu).select(
        "mu", F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.coalesce(m, F.lit(1e6)))).alias("m")
    )


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior bad rate of every host: ``host, n, bad, rate, lower``.

    ``outcomes`` has ``host`` and ``bad`` (1, 0, or null for an unlabelled page). Rates are shrunk level by level: the
    mean of all pages is the prior of a suffix, its posterior mean that of a registered domain, and that one's the
    prior of a host; each level has the beta prior's strength fitted from its own groups. ``lower`` is the posterior
    mean less ``z`` posterior deviations. Counts are combined map-side, so a hot host moves one row per task; a table
    without labels gives every host the rate 1/2. Null hosts are treated as empty ones.
    """
    host = F.coalesce(F.col("host"), F.lit(""))
    counts = outcomes.groupBy(host.alias("host")).agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")
    )
    counts = counts.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))})
    above = None
    for level, parent in LEVELS:
        groups = counts.groupBy(*[k for k in (level, parent) if k]).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        fitted = _strength(groups)
        m, mu = fitted.select("m").scalar(), fitted.select("mu").scalar()
        if above is None:
            rows = groups.withColumns({"prior": mu, "m": m})
        else:
            rows = groups.join(above.select(F.col(parent), F.col("rate").alias("prior")), parent).withColumn("m", m)
        a, b = F.col("m") * F.col("prior") + F.col("bad"), F.col("m") * (1 - F.col("prior")) + F.col("n") - F.col("bad")
        above = rows.withColumn("rate", a / (a + b))
    total = F.col("m") + F.col("n")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))
    return above.select("host", "n", "bad", "rate", (F.col("rate") - z * deviation).alias("lower"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], most_bad: float = 0.5, z: float = 1.645,
    page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, rate, lower``.

    ``outcomes`` holds ``page_id`` and ``bad`` for labelled pages (several labels of a page all count, null labels do
    not). The longest fitting rule decides; where none fits, a page is blocked if the lower posterior bound of its
    host's bad rate exceeds ``most_bad``. A null url has an empty host and path and is judged as that host. Repeated
    rows stay. Other columns of both tables are ignored, whatever their names.
    """
    host, path = split_url(F.col(url))
    pages = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    labelled = outcomes.select(F.col(page_id).alias("page_id"), F.col("bad").cast("int").alias("bad"))
    hosts = host_reputation(pages.select("page_id", "host").join(labelled, "page_id", "left"), z)
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    judged = pages.withColumn("_rule", rule).join(hosts.select("host", "rate", "lower"), "host", "left")
    by_method = F.when(F.col("lower") > most_bad, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_method).alias("verdict"), "rate", "lower",
    )
