"""Robots rules: landed files to rules, and decisions by the longest pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parsed_rules(files: DataFrame, agent: str = "*") -> DataFrame:
    """(host, kind, pattern) that hold for ``agent``; ``files`` is (host, body).

    A group is a run of agent lines with the rules after it; an agent line after
    rules starts a new group, but one after an agent whose group has no rules
    yet joins it. The first group that names the agent holds, else the first that
    names ``*``. Lines are few a file, and are gathered by file only.
    """
    lines = files.select("host", F.posexplode(F.split("body", "\r\n|\r|\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", ""))).filter(F.col("line").contains(":"))
    lines = lines.select("host", "pos", F.lower(F.trim(F.substring_index("line", ":", 1))).alias("field"), F.trim(F.regexp_replace("line", "^[^:]*:", "")).alias("value"))
    lines = lines.filter(F.col("field").isin("user-agent", "allow", "disallow", "crawl-delay") & ((F.col("value") != "") | (F.col("field") == "user-agent")))
    by_file = Window.partitionBy("host").orderBy("pos")
    starts = (F.col("field") == "user-agent") & (F.coalesce(F.lag("field").over(by_file), F.lit("")) != "user-agent")
    lines = lines.withColumn("section", F.sum(starts.cast("int")).over(by_file))
    named = lines.filter(F.col("field") == "user-agent")
    rank = F.when(F.lower("value") == agent.lower(), 0).when(F.col("value") == "*", 1)
    chosen = named.withColumn("rank", rank).filter("rank IS NOT NULL").groupBy("host").agg(F.min(F.struct("rank", "section")).alias("c")).select("host", F.col("c.section").alias("section"))
    return lines.join(chosen, ["host", "section"]).filter("field != 'user-agent'").select("host", F.col("field").alias("kind"), F.col("value").alias("pattern"))


def path_matches(path: Column, pattern: Column) -> Column:
    """``/`` fits all; with ``*`` the pattern is a regular expression at the path's start; else it is a prefix."""
    wild = F.concat(F.lit("^"), F.replace(pattern, F.lit("*"), F.lit(".*")))
    return F.when(pattern == "/", True).when(pattern.contains("*"), F.rlike(path, wild)).otherwise(path.startswith(pattern))


#: Rules that are held against every path, as a broadcast; more are met by their heads.
MAX_RULES = 1000


def decisions(paths: DataFrame, rules: DataFrame, key: str, path: str = "path", max_rules: int = MAX_RULES) -> DataFrame:
    """Adds ``allowed`` to ``paths`` by a rule table (kind, pattern) of one agent.

    The longest pattern that fits wins, disallow on a tie; none fits: allowed; a null path fits ``/`` only. Up to
    ``max_rules`` rules are broadcast. Of more, a path meets those whose head it begins with, a prefix rule's
    pattern or what a pattern with ``*`` begins with for sure: its beginnings of all lengths that heads have are joined with the heads.
    """
    few = rules.filter(F.col("kind").isin("allow", "disallow")).select("kind", "pattern").distinct()
    asked = paths.select(key, F.col(path).alias("_p"))
    if few.limit(max_rules + 1).count() <= max_rules:
        hits = asked.join(F.broadcast(few), path_matches(F.col("_p"), F.col("pattern")))
    else:
        sure = F.when(F.col("pattern").contains("|"), "").otherwise(F.regexp_extract("pattern", "^([A-Za-z0-9/_-]*)(?![?+{])", 1))
        heads = few.withColumn("_head", F.when(F.col("pattern") == "/", "").when(F.col("pattern").contains("*"), sure).otherwise(F.col("pattern")))
        lengths = heads.agg(F.collect_set(F.length("_head")).alias("_lengths"))  # one row, of as many numbers as the longest head has characters
        begun = asked.join(F.broadcast(lengths)).select(key, "_p", F.explode(F.filter("_lengths", lambda n: n <= F.length(F.coalesce("_p", F.lit(""))))).alias("_n"))
        begun = begun.withColumn("_start", F.expr("substring(coalesce(_p, ''), 1, _n)"))
        hits = begun.join(heads, (F.col("_start") == F.col("_head")) & path_matches(F.col("_p"), F.col("pattern")))
    best = hits.groupBy(key).agg(F.max(F.struct(F.length("pattern").alias("n"), (F.col("kind") == "disallow").alias("no"))).alias("b"))
    return paths.join(best, key, "left").withColumn("allowed", ~F.coalesce(F.col("b.no"), F.lit(False))).drop("b")


def crawl_delay(rules: DataFrame) -> DataFrame:
    return rules.filter("kind = 'crawl-delay'").groupBy("host").agg(F.max(F.col("pattern").try_cast("double")).alias("crawl_delay"))


def report(decided: DataFrame) -> DataFrame:
    return decided.groupBy("allowed").agg(F.count("*").alias("n_paths"))
