"""URL filters: path rules, then a weighted vocabulary matched by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.words import LOWER, UPPER


@dataclass(frozen=True)
class Vocabulary:
    """Weights of terms (lower-case ASCII), and the sum of the distinct terms of a url that rejects it.

    A term of weight ``limit`` is strict, as it rejects alone; all others are soft
    and take several.
    """

    weights: tuple[tuple[str, int], ...]
    limit: int = 10

    def of(self, strict: bool) -> tuple[tuple[str, int], ...]:
        return tuple((t, w) for t, w in self.weights if (w >= self.limit) == strict)


#: The default vocabulary. What adults' sites are named by weighs 6 and takes any other term; a lone x
#: takes one of these; other soft terms weigh 5 and take one more.
DEFAULT = Vocabulary((
    ("porn", 10), ("porno", 10), ("xxx", 10), ("hentai", 10), ("escort", 10), ("escorts", 10), ("camgirl", 10), ("camgirls", 10), ("casino", 10), ("casinos", 10), ("jackpot", 10),
    ("viagra", 10), ("cialis", 10), ("warez", 10), ("keygen", 10),
    ("adult", 6), ("nude", 6), ("sex", 6), ("sexy", 6), ("xx", 6),
    ("bet", 5), ("bets", 5), ("betting", 5), ("bonus", 5), ("cams", 5), ("cheap", 5), ("crack", 5), ("dating", 5), ("download", 5), ("free", 5), ("gamble", 5), ("hot", 5), ("loan", 5), ("loans", 5),
    ("pills", 5), ("poker", 5), ("slots", 5), ("torrent", 5), ("win", 5),
    ("x", 4),
))


def vocabulary_of(table: DataFrame, limit: int = 10, most: int = 1_000_000) -> Vocabulary:
    """The vocabulary of a table (term, weight), lower-cased; of a term's rows the largest weight counts.

    Every worker holds the automaton, so the table is bounded: more than ``most``
    terms are refused. Null and empty terms and null weights are left out.
    """
    rows = table.select(F.lower(F.trim("term")).alias("term"), F.col("weight").cast("int").alias("weight")).filter("term <> '' AND weight IS NOT NULL")
    found = rows.groupBy("term").agg(F.max("weight").alias("weight")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a url vocabulary of over {most} terms")
    return Vocabulary(tuple(sorted((r["term"], r["weight"]) for r in found)), limit)


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host``, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str


#: The production rules.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def host(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_column(host_col: Column, path_col: Column, rules: tuple[Rule, ...], out: str) -> Column:
    """``out`` ("text" or "verdict") of the longest rule that fits; of two as long, the earlier one."""
    chain = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.host) + len(r.path)):
        fits = ((host_col == r.host) | host_col.endswith("." + r.host)) & path_col.startswith(r.path)
        chain = F.when(fits, F.lit(r.host + r.path if out == "text" else r.verdict)).otherwise(chain)
    return chain


HITS = ("strict_hits", "soft_hits", "hit_weight")


def term_hits(urls: DataFrame, vocabulary: Vocabulary, url_col: str = "url") -> DataFrame:
    """Adds ``strict_hits``, ``soft_hits`` and ``hit_weight`` (int): distinct terms in the lower-cased url, and their weights.

    A term counts where no ASCII letter or digit touches either end. A null url
    has none. All other columns stay; columns of those three names are replaced.
    """
    names = [c for c in urls.columns if c not in HITS]
    schema = T.StructType([urls.schema[c] for c in names])
    for name in HITS:
        schema = schema.add(name, "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in vocabulary.weights:
            machine.add_word(term, (term, weight))
        if vocabulary.weights:
            machine.make_automaton()
        fold = str.maketrans(UPPER, LOWER)
        word = lambda c: c.isascii() and c.isalnum()

        def count(url: str | None) -> tuple[int, int, int]:
            text, hits = (url or "").translate(fold), {}
            for last, (term, weight) in machine.iter(text) if vocabulary.weights else ():
                first = last - len(term) + 1
                if not (first and word(text[first - 1])) and not (last + 1 < len(text) and word(text[last + 1])):
                    hits[term] = weight
            strict = sum(w >= vocabulary.limit for w in hits.values())
            return strict, len(hits) - strict, sum(hits.values())

        for batch in batches:
            found = [count(u.as_py()) for u in batch.column(url_col)]
            made = [pa.array([f[i] for f in found], pa.int32()) for i in range(len(HITS))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + made, names=schema.names)

    return urls.mapInArrow(run, schema)


def judge(urls: DataFrame, rules: tuple[Rule, ...] = RULES, vocabulary: Vocabulary = DEFAULT, url_col: str = "url") -> DataFrame:
    """Adds host, path, rule, verdict, strict_hits, soft_hits and hit_weight to the rows of ``urls``.

    ``verdict`` is the longest fitting rule's, else block if the weights of the
    url's distinct terms reach ``vocabulary.limit``, which one strict term or
    several soft ones do, else allow. Columns of these names are replaced. A null url, or one
    without ``://``, has an empty host and path and fits no rule; its text is
    still searched. Every row is judged alone: no shuffle, no state.
    """
    counted = term_hits(urls, vocabulary, url_col)
    h, p = host(F.col(url_col)), path(F.col(url_col))
    rejected = F.col("hit_weight") >= vocabulary.limit
    return (
        counted.withColumns({"host": h, "path": p})
        .withColumn("rule", rule_column(F.col("host"), F.col("path"), rules, "text"))
        .withColumn("verdict", F.coalesce(rule_column(F.col("host"), F.col("path"), rules, "verdict"), F.when(rejected, "block").otherwise("allow")))
    )
