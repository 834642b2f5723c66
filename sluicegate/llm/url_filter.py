"""URL filter by a weighted vocabulary.

Strict and soft terms are found in one Aho-Corasick pass over host and path.  A hit counts only
between boundaries (no letter or digit on either side).  One strict hit rejects, and so do
distinct soft terms whose weights reach ``soft_limit``.

Rules on hosts and paths come first.  A rule fits its host and all subdomains if the path starts
with the rule's path; of several the longest wins, of equally long ones the last in order of their texts.

Nulls and texts without ``://`` have an empty host and path, no rule and no hits, so they are
allowed.  Repeated rows are judged one by one, urls of any length whole; an empty table gives no rows.
``host``, ``path``, ``rule``, ``verdict`` and the counts are written over columns so named, other columns stay."""

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HITS = "_url_filter_hits"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# The vocabulary.  A strict term alone says what a page is; soft terms weigh by how often
# they stand in other addresses too, so that one never rejects and two or three of a kind do.
STRICT = (
    "bdsm", "bukkake", "camgirl", "camgirls", "casino", "cialis", "escort", "escorts", "gangbang",
    "hentai", "milf", "onlinecasino", "pharmacyonline", "porn", "porno", "pornos", "sexcam", "sexcams",
    "sexshop", "spam", "viagra", "warez", "xxx", "xxxvideos",
)
SOFT = {
    "nude": 1.5, "nudes": 1.5, "sex": 1.5, "sexy": 1.25, "erotic": 1.5, "fetish": 1.5, "webcam": 0.75,
    "adult": 1.0, "dating": 0.75, "hot": 0.5, "girls": 0.75, "18": 0.5,
    "poker": 1.25, "bet": 1.25, "bets": 1.25, "betting": 1.25, "bingo": 1.25, "jackpot": 1.25, "slots": 1.25,
    "roulette": 1.25, "lottery": 1.0, "gambling": 1.25, "bonus": 0.75, "win": 0.5, "winner": 0.5,
    "pills": 1.25, "pharma": 0.75, "pharmacy": 0.75, "cheap": 0.75, "discount": 0.5, "replica": 1.0,
    "weightloss": 1.25, "diet": 0.5, "loan": 1.0, "loans": 1.0, "payday": 1.25, "credit": 0.5, "forex": 1.0,
    "crypto": 0.5, "free": 0.75, "download": 0.5, "crack": 1.25, "cracked": 1.25, "keygen": 1.5, "torrent": 1.25,
    "torrents": 1.25, "serial": 0.5, "seo": 0.75, "backlinks": 1.5, "ads": 0.75, "click": 0.75, "clicks": 0.75,
    "promo": 0.75, "tracker": 0.75, "affiliate": 1.0, "farm": 0.5,
}


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple = STRICT
    soft: dict = field(default_factory=lambda: dict(SOFT))
    soft_limit: float = 2.0


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self):
        return self.host + self.path


def hits(vocabulary):
    """A column function: text -> struct<strict int, soft int, soft_weight double>.

    ``strict`` counts all hits, ``soft`` the distinct terms hit."""
    strict, soft = tuple(vocabulary.strict), dict(vocabulary.soft)

    @F.pandas_udf("strict int, soft int, soft_weight double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()  # once a task
        for term in {*strict, *soft}:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for texts in batches:
            rows = []
            for text in texts:
                n, found = 0, set()
                for end, term in automaton.iter(text or ""):
                    start = end - len(term)
                    if start >= 0 and text[start].isalnum():
                        continue
                    if end + 1 < len(text) and text[end + 1].isalnum():
                        continue
                    if term in soft:
                        found.add(term)
                    else:
                        n += 1
                rows.append((n, len(found), float(sum(soft[t] for t in found))))
            yield pd.DataFrame(rows, columns=["strict", "soft", "soft_weight"])

    return count


def filter_urls(pages, url="url", rules=(), vocabulary=Vocabulary()):
    """Adds host, path, rule, strict_hits, soft_terms, soft_weight and verdict (allow or block)."""
    part = lambda n: F.coalesce(F.regexp_extract(F.col(url), SPLIT, n), F.lit(""))
    parts = pages.withColumn("host", F.translate(part(1), UPPER, LOWER)).withColumn("path", part(2))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col(
            "path"
        ).startswith(r.path)
        rule = F.when(fits, r.text).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    scanned = F.concat("host", F.translate("path", UPPER, LOWER))
    rejects = (F.col(f"{HITS}.strict") > 0) | (F.col(f"{HITS}.soft_weight") >= vocabulary.soft_limit)
    return (
        parts.withColumn("rule", rule)
        .withColumn(HITS, hits(vocabulary)(scanned))
        .withColumn("strict_hits", F.col(f"{HITS}.strict"))
        .withColumn("soft_terms", F.col(f"{HITS}.soft"))
        .withColumn("soft_weight", F.col(f"{HITS}.soft_weight"))
        .withColumn("verdict", F.coalesce(verdict, F.when(rejects, "block").otherwise("allow")))
        .drop(HITS)
    )
