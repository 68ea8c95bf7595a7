"""Allow and block rules for URLs, by a sorted sweep over reversed-host keys.

Every URL has one canonical key per suffix of its host: the labels from the last to the first,
then the path. A rule's key, made the same way, is a prefix of exactly the keys it fits, that is,
an interval of the sorted keys; intervals of rules nest or are disjoint. Keys, interval starts and
interval ends are sorted together and swept once: a start puts its rule on top of the stack of
active rules, an end brings back the rule around it. The rule on top is the longest that fits.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.join import lookup

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "verdict string, host string, path string"
#: Keys of one host suffix that one sweep takes, or as many as the suffix has rules where these are
#: more, so that dealing rules to sweeps makes no more rows than there are keys.
KEYS_PER_SWEEP = 500


def _after_scheme(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substr(url, start + 3)).otherwise("")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _labels(name: Column) -> Column:
    return F.reverse(F.split(name, r"\.", -1))


def _key(suffix: Column, path: Column) -> Column:
    """Sorted as bytes. A zero byte ends the host, so no path can reach into another host's keys."""
    return F.encode(F.concat(suffix, F.lit("\0"), path), "utf-8")


def _rules(rules: DataFrame) -> DataFrame:
    """Each rule once, with the rule around it; a repeated pair keeps its first verdict by name."""
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.where("host is not null and path is not null").select(
        F.array_join(_labels(F.col("host")), ".").alias("suffix"),
        "path",
        F.struct(F.concat("host", "path").alias("rule"), "verdict").alias("top"),
    )
    cut = F.sequence(F.lit(0), F.length("path"))
    shorter = rules.select(
        "suffix", "path", F.explode(F.transform(cut, lambda n: F.substr("path", F.lit(1), n))).alias("outer")
    ).where("outer <> path")
    outer = rules.select("suffix", F.col("path").alias("outer"), F.col("top").alias("around"))
    outer = shorter.join(outer, ["suffix", "outer"]).groupBy("suffix", "path")
    outer = outer.agg(F.max_by("around", F.length("outer")).alias("around"))
    return rules.join(outer, ["suffix", "path"], "left")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names go).

    All other columns stay, whatever their names.

    ``rules`` has ``verdict, host, path``. A rule fits its host and all subdomains where the path
    starts with the rule's. Of several that fit, the one with the longest host counts, then the
    one with the longest path. Without one, ``rule`` is null and the verdict ``default``. A null
    URL or one without ``://`` has an empty host and path. Rules with a null host or path take no
    part. Repeated rows stay.

    Pages are reduced to distinct pairs of host and path first, so that a frequent URL is judged
    once. Only suffixes that are the host of some rule go into the sweep; the keys of a frequent
    suffix are dealt to as many sweeps as it needs, each with that suffix's rules. The verdicts
    return by a join that Spark can split where one URL is frequent.
    """
    parts = {"host": host(pages[url]), "path": path(pages[url])}
    names = {f"_column_{n}": c for n, c in enumerate(pages.columns) if c.lower() not in (*parts, "rule", "verdict")}
    pages = pages.select(
        *(pages[f"`{c}`"].alias(n) for n, c in names.items()), *(F.coalesce(c, F.lit("")).alias(n) for n, c in parts.items())
    )
    rules = _rules(rules)

    pairs = pages.select("host", "path").where("host <> ''").distinct()
    depth = rules.agg(F.max(F.size(F.split("suffix", r"\.", -1))).alias("n")).first()["n"] or 0
    labels = F.slice(_labels(F.col("host")), 1, depth) if depth else F.array().cast("array<string>")
    suffixes = F.transform(
        "labels", lambda _, n: F.array_join(F.slice("labels", F.lit(1), n + 1), ".")
    )
    keys = (
        pairs.withColumn("labels", labels)
        .select("host", "path", F.explode(suffixes).alias("suffix"))
    )
    named = rules.select(F.col("suffix").alias("named")).distinct()
    keys = keys.join(named, keys["suffix"] == named["named"], "left_semi")

    sizes = rules.groupBy("suffix").agg(F.greatest(F.count("*"), F.lit(KEYS_PER_SWEEP)).alias("size"))
    sweeps = keys.groupBy("suffix").agg(F.count("*").alias("n")).join(sizes, "suffix")
    sweeps = sweeps.select("suffix", F.ceil(F.col("n") / F.col("size")).alias("sweeps"))
    keys = lookup(keys, sweeps, "suffix", "inner", right_grouped=True).select(
        "suffix",
        F.pmod(F.xxhash64("host", "path"), "sweeps").alias("sweep"),
        _key(F.col("suffix"), F.col("path")).alias("key"),
        F.lit(2).alias("kind"),
        "host",
        "path",
        F.lit(None).cast(rules.schema["top"].dataType).alias("top"),
    )
    dealt = rules.join(sweeps, "suffix").withColumn("sweep", F.explode(F.expr("sequence(0L, sweeps - 1)")))
    start = _key(F.col("suffix"), F.col("path"))
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    nothing = F.lit(None).cast("string")
    ends = F.concat(start, F.lit(b"\xff"))  # behind all keys with this prefix, as UTF-8 has no such byte
    events = [
        dealt.select("suffix", "sweep", start.alias("key"), F.lit(1).alias("kind"), nothing.alias("host"), nothing.alias("path"), "top"),
        dealt.select("suffix", "sweep", ends.alias("key"), F.lit(0).alias("kind"), nothing.alias("host"), nothing.alias("path"), F.coalesce("around", none).alias("top")),
    ]
    # Of several ends at one place the outermost comes last, having the shortest key before the
    # closing byte; ends never share a place with starts or keys.
    order = Window.partitionBy("suffix", "sweep").orderBy("key", "kind")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = keys.unionByName(events[0]).unionByName(events[1])
    swept = swept.withColumn("top", F.last("top", ignorenulls=True).over(order))
    best = (
        swept.where("kind = 2 and top.rule is not null")
        .groupBy("host", "path")
        .agg(F.max_by("top", F.length("suffix")).alias("top"))
        .select(F.struct("host", "path").alias("place"), "top")
    )
    judged = lookup(pages.withColumn("place", F.struct("host", "path")), best, "place", right_grouped=True)
    return judged.withColumns(
        {"rule": F.col("top.rule"), "verdict": F.coalesce("top.verdict", F.lit(default))}
    ).drop("place", "top").withColumnsRenamed(names)
