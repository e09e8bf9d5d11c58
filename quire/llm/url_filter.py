"""URL filters: rules of host and path, then a weighted vocabulary that one automaton counts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import OWN, with_columns

# Terms of which one is enough, and terms of which several different ones are.
STRICT = (
    "porn", "porno", "pornography", "freeporn", "gayporn", "xxx", "hentai", "camgirl", "camgirls", "camsex", "escorts", "escortservice", "callgirls", "sexcam", "sexcams", "sexchat", "sexvideo", "sexvideos",
    "livesex", "cybersex", "nsfw", "milf", "milfs", "bdsm", "blowjob", "gangbang", "upskirt", "bukkake", "webcamsex", "xxxvideos", "fetishes", "onlinecasino", "keygen", "keygens", "phentermine",
)
SOFT = (
    "adult", "adults", "amateur", "bet", "bets", "betting", "bingo", "bonus", "casino", "casinos", "cheap", "cheapest", "cialis", "clickbait", "coupon", "coupons", "crack", "cracked", "dating", "discount", "doorway", "erotic", "escort",
    "farm", "fetish", "free", "gambling", "giveaway", "hookup", "hookups", "jackpot", "lingerie", "loan", "loans", "lottery", "naked", "nude", "nudes", "payday", "pharmacy", "pills", "poker", "replica", "roulette", "sex", "sexy", "singles",
    "slots", "spam", "sportsbook", "strip", "tadalafil", "torrent", "torrents", "viagra", "wager", "warez", "win", "winner",
)
#: Weights of the two kinds; a url is blocked from LIMIT on.
STRICT_WEIGHT, SOFT_WEIGHT, LIMIT = 1.0, 0.5, 1.0
VOCABULARY = {**dict.fromkeys(SOFT, SOFT_WEIGHT), **dict.fromkeys(STRICT, STRICT_WEIGHT)}
#: Terms of a vocabulary that is read from a table; past that an error, since every task holds the automaton.
MAX_TERMS = 1_000_000
# Fixed values: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = frozenset("0123456789" + _LOW)
_TO_LOW = {ord(a): b for a, b in zip(_UPPER, _LOW, strict=True)}


def automaton_of(terms: Mapping[str, float]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for t, weight in terms.items():
        if t:
            a.add_word(t.translate(_TO_LOW), (weight, t.translate(_TO_LOW)))
    a.make_automaton()
    return a


def vocabulary_from(table: DataFrame, term_col: str = "term", weight_col: str = "weight") -> dict[str, float]:
    """A vocabulary from a table of terms and weights; null terms or weights are left out, of repeated terms the greatest weight holds."""
    rows = table.select(F.translate(F.col(f"`{term_col}`"), _UPPER, _LOW).alias("t"), F.col(f"`{weight_col}`").cast("double").alias("w")).dropna().groupBy("t").agg(F.max("w").alias("w"))
    found = rows.limit(MAX_TERMS + 1).collect()
    if len(found) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms: every task holds the automaton")
    return {r["t"]: r["w"] for r in found if r["t"]}


def term_hits(url: str | None, automaton: ahocorasick.Automaton, limit: float = LIMIT) -> tuple[int, int, float]:
    """Distinct strict terms (which reach the limit alone), soft terms, and the sum of their weights, in a url.

    A term counts where no A-Z, a-z or 0-9 stands before or after it.
    """
    low, found = (url or "").translate(_TO_LOW), {}
    for end, (weight, t) in automaton.iter(low) if len(automaton) else ():
        start = end + 1 - len(t)
        if (start == 0 or low[start - 1] not in _ALNUM) and (end + 1 == len(low) or low[end + 1] not in _ALNUM):
            found[t] = weight
    strict = sum(w >= limit for w in found.values())
    return strict, len(found) - strict, math.fsum(found.values())


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOW)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_verdicts(pages: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, terms: Mapping[str, float] = VOCABULARY, limit: float = LIMIT) -> DataFrame:
    """Every row of pages with host, path, rule, n_strict, n_soft, weight and verdict.

    The longest rule that fits decides; without one, a url is blocked if the weights of its distinct terms sum up to the
    limit: one strict term, which weighs that much, or several soft ones. terms: weights by term (see vocabulary_from for
    tables). One pass, no shuffle. A null url, or one without `://`, has an empty host and path, which no rule fits; its
    terms count all the same (null: none). Empty tables, repeated rows and very long urls are nothing special; columns of
    pages with the result's names give way.
    """

    @F.pandas_udf("struct<strict:int,soft:int,weight:double>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = automaton_of(terms)
        for urls in batches:
            yield pd.DataFrame([term_hits(u if isinstance(u, str) else None, automaton, limit) for u in urls], columns=["strict", "soft", "weight"])

    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select("*", host_of(url).alias(OWN + "host"), path_of(url).alias(OWN + "path"), count(url).alias(OWN + "hits"))
    host, path, hits = F.col(OWN + "host"), F.col(OWN + "path"), F.col(OWN + "hits")
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in rules]
    order = sorted(range(len(rules)), key=lambda i: len(rules[i][0] + rules[i][1]))
    rule = reduce(lambda rest, i: F.when(fits[i], F.lit(rules[i][0] + rules[i][1])).otherwise(rest), order, F.lit(None).cast("string"))
    said = reduce(lambda rest, i: F.when(fits[i], F.lit(rules[i][2])).otherwise(rest), order, F.lit(None).cast("string"))
    method = F.when(hits["weight"] >= limit, F.lit("block")).otherwise(F.lit("allow"))
    out = with_columns(rows, {"host": host, "path": path, "rule": rule, "n_strict": hits["strict"], "n_soft": hits["soft"], "weight": hits["weight"], "verdict": F.coalesce(said, method)})
    return out.select(*(f"`{c}`" for c in out.columns if not c.startswith(OWN)))


def _counted(terms: Sequence[str]) -> str:
    return " + ".join(f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INTEGER)" for t in terms)


ORACLE = rf"""
WITH u AS (SELECT page_id, translate(url, '{_UPPER}', '{_LOW}') AS low,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{_UPPER}', '{_LOW}'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
c AS (SELECT *, coalesce({_counted(STRICT)}, 0) AS n_strict, coalesce({_counted(SOFT)}, 0) AS n_soft FROM u),
r(rule_host, rule_path, said) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
m AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(said, length(rule_host || rule_path)) AS said
    FROM c JOIN r ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY 1)
SELECT page_id, host, path, rule, n_strict, n_soft,
    coalesce(said, CASE WHEN {STRICT_WEIGHT} * n_strict + {SOFT_WEIGHT} * n_soft >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN m USING (page_id)
"""
