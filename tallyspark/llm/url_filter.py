"""URL filters: host and path rules first, then a weighted vocabulary matched by one automaton.

An automaton of all terms reads each URL once. A hit counts only between boundaries, so that a term inside a longer word
stays silent. One strict term rejects a URL, and so do several different soft ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Different soft terms that reject a URL.
SOFT_HITS = 2
# Terms that reject a URL alone, and terms that do so only together.
STRICT = "porn porno xxx xvideos hentai escort camsex casino viagra cialis warez keygen torrent malware phishing".split()
SOFT = "adult sex nude hot live cam dating bet poker bonus slot free win crack serial pills pharma cheap loan spam".split()


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host, all its subdomains, and the paths that begin with ``path``."""

    allow: bool
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    Rule(False, "net"),
    Rule(True, "example.net", "/en/"),
    Rule(False, "example.com", "/de/"),
    Rule(True, "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path. The host lies after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name of the longest rule that fits, NULL if none does, and whether it allows.

    Rules are tried from the longest down, of equally long ones the first by name.
    """
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, allow = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.allow).otherwise(allow)
    return name, allow


def vocabulary(strict: list[str], soft: list[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term in soft:
        automaton.add_word(term, (term, False))
    for term in strict:
        automaton.add_word(term, (term, True))
    automaton.make_automaton()
    return automaton


def hits(automaton: ahocorasick.Automaton, url: str | None) -> tuple[int, int]:
    """How many different strict and soft terms a URL has between characters other than ASCII letters and digits."""
    low = (url or "").translate(_TO_LOWER)
    strict, soft = set(), set()
    for end, (term, is_strict) in automaton.iter(low):
        start = end - len(term) + 1
        if (start == 0 or low[start - 1] not in _INNER) and (end + 1 == len(low) or low[end + 1] not in _INNER):
            (strict if is_strict else soft).add(term)
    return len(strict), len(soft)


_TO_LOWER = str.maketrans(_UPPER, _LOWER)
_INNER = frozenset(_LOWER + "0123456789")


def term_hits(url: Column, strict: list[str], soft: list[str]) -> Column:
    """A struct of the numbers of different strict and soft terms."""

    @F.pandas_udf(T.StructType([T.StructField("strict", T.IntegerType()), T.StructField("soft", T.IntegerType())]))
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = vocabulary(strict, soft)
        for batch in batches:
            yield pd.DataFrame([hits(automaton, u) for u in batch], columns=["strict", "soft"], dtype="int32")

    return counted(url)


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    strict: list[str] = STRICT,
    soft: list[str] = SOFT,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the term counts for each row of ``pages``.

    The longest fitting rule decides; where none fits, the vocabulary does. A NULL url, or one without ``://``, has an
    empty host and path and fits no rule; an empty one has no term. URLs of any length are read whole. Repeated rows and
    NULL ids are judged like any other; an empty table gives no row; other columns are not looked at.
    """
    host, path = parts(F.col("url"))
    found = pages.select("page_id", "url", host.alias("host"), path.alias("path"), term_hits(F.col("url"), strict, soft).alias("hits"))
    rule, allow = longest_rule(F.col("host"), F.col("path"), rules)
    rejected = (F.col("hits.strict") > 0) | (F.col("hits.soft") >= soft_hits)
    return found.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.when(F.coalesce(allow, ~rejected), "allow").otherwise("block").alias("verdict"),
        F.col("hits.strict").alias("strict_terms"),
        F.col("hits.soft").alias("soft_terms"),
    )
