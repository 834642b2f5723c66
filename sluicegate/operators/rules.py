"""Routing rules: an ordered list of (pattern, bucket), from text, a list or a table."""

import json
import math
from collections import deque
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluicegate.config import CATCH_ALL
from sluicegate.functions.rules import can_join, first_match, first_match_joined, in_order
from sluicegate.operators import rule_index

# Up to so many rules are searched one by one; more are joined into larger patterns, each of
# about 8 times the root of their number: one search per pattern for a message without a match
# there, and the searches inside one pattern for the message it matches.
FEW_RULES = 8
JOINED_RULES = 64  # at least in one pattern
JOINED_BYTES = 40_000  # of patterns in one; the JVM's limit for a text constant is 65,535

# Patterns per column.  More become several columns, each for the messages the ones before left
# unmatched, because the JVM does not optimise generated methods much larger.
COLUMN_PATTERNS = 16

INDEXED_RULES = 64  # so many rules are filed by the text they ask for, see rule_index
NO_CODE = "~"  # behind all codes

_CHECKED = deque(maxlen=8)  # rules found good lately: micro-batches bring the same ones again

RULE_COLUMNS = "ord int, pattern string, bucket string"


@dataclass(frozen=True)
class Rules:
    """Rules in order of precedence."""

    pairs: tuple

    @classmethod
    def of(cls, rules):
        """From pairs, a mapping, JSON object text, or a rules table."""
        if isinstance(rules, cls):
            return rules
        if hasattr(rules, "sparkSession"):
            return cls.from_table(rules)
        if isinstance(rules, str):
            return cls.from_json(rules)
        pairs = rules.items() if isinstance(rules, dict) else rules
        return cls(tuple((str(p), str(b)) for p, b in pairs))

    @classmethod
    def from_json(cls, text):
        """From a JSON object of pattern -> bucket; the order of its keys is kept."""
        try:
            found = json.loads(text)
        except ValueError as e:
            raise ValueError(f"rules are not JSON: {e}") from None
        if not isinstance(found, dict):
            raise ValueError("rules must be a JSON object of pattern -> bucket")
        return cls.of(found)

    @classmethod
    def from_table(cls, table):
        """From a table ``ord, pattern, bucket`` as it is now."""
        rows = table.select("ord", "pattern", "bucket").collect()  # configuration
        if not rows:
            raise ValueError("the rules table is empty")
        if any(value is None for r in rows for value in r):
            raise ValueError("the rules table has nulls")
        if len({r.ord for r in rows}) != len(rows):
            raise ValueError("the rules table has several rules with the same ord")
        return cls(tuple((r.pattern, r.bucket) for r in sorted(rows)))

    def check(self, spark):
        """Raise ``ValueError`` for a pattern Spark cannot use, before any message is read."""
        if self.pairs not in _CHECKED:
            patterns = list(dict.fromkeys(p for p, _ in self.pairs))
            if not _usable(spark, patterns):
                bad = [p for p in patterns if not _usable(spark, [p])]
                raise ValueError(f"not regular expressions: {bad}")
            _CHECKED.append(self.pairs)
        return self

    @property
    def buckets(self):
        return tuple(dict.fromkeys(b for _, b in self.pairs))


def _usable(spark, patterns):
    """Whether all are regular expressions; one row of literals, evaluated while planning."""
    try:
        found = F.transform(F.lit(patterns), lambda p: F.regexp_like(F.lit(""), p))
        spark.sql("select 1").select(found).head()
    except PySparkException:
        return False
    return True


def _joined(pairs):
    """The rules in runs: ``(whether they can be joined, rules)``, in order."""
    most = max(JOINED_RULES, int(8 * math.sqrt(len(pairs))))
    runs, size = [], 0
    for pattern, bucket in pairs:
        joins = can_join(pattern)
        length = len(pattern.encode()) + 40
        last = runs[-1] if runs else None
        if last and last[0] == joins and len(last[1]) < most and size + length <= JOINED_BYTES:
            last[1].append((pattern, bucket))
            size += length
        else:
            runs.append((joins, [(pattern, bucket)]))
            size = length
    return runs


def _matches(text, pairs, anchored):
    """Expressions of which the first that is not null is the bucket."""
    for joins, some in _joined(pairs):
        if joins and len(some) > FEW_RULES:
            yield first_match_joined(text, some, anchored)
        else:
            for i in range(0, len(some), FEW_RULES):
                yield first_match(text, in_order(some[i : i + FEW_RULES], anchored=anchored))


def _searched(frame, text, pairs, anchored):
    """``(frame, bucket)`` by searching the rules: several columns where they are many."""
    bucket = F.lit(None).cast("string")
    found = list(_matches(text, pairs, anchored))
    for i in range(0, len(found), COLUMN_PATTERNS):
        some = F.coalesce(*found[i : i + COLUMN_PATTERNS])
        frame = frame.withColumn("bucket", F.when(bucket.isNull(), some).otherwise(bucket))
        bucket = F.col("bucket")
    return frame, bucket


def apply_rules(decoded, rules, config):
    """Add ``bucket`` for the text in ``route_value``: no shuffle.  Few rules are expressions alone; many
    are filed under the text they ask for and looked up in broadcast tables, see ``rule_index``.

    Unmatched messages get the bucket of the catch-all rule, if there is one."""
    text = F.coalesce("route_value", F.lit(""))
    pairs = in_order(rules.pairs, config.match)
    index, rest = {}, ()
    if len(pairs) >= INDEXED_RULES and sum(len(p) + len(b) for p, b in pairs) <= rule_index.MOST_BYTES:
        index, rest = rule_index.filed(pairs, config.anchored)
    if index:
        others = [(pairs[i][0], rule_index.code(i, pairs[i][1])) for i in rest]
        matched, codes = rule_index.looked_up(decoded, text, pairs, index, config.anchored)
        matched, other = _searched(matched, text, others, config.anchored)
        first = F.least(*codes, other, F.lit(NO_CODE))
        bucket = F.when(first < NO_CODE, F.substring(first, rule_index.CODE + 1, 1 << 30))
        matched = matched.withColumn("bucket", bucket).select(*decoded.columns, "bucket")
        bucket = F.col("bucket")
    else:
        matched, bucket = _searched(decoded, text, pairs, config.anchored)
    if config.null_field == "default":
        bucket = F.when(F.col("route_value").isNotNull(), bucket)
    default = F.lit(dict(rules.pairs).get(CATCH_ALL)).cast("string")
    return matched.withColumn("bucket", F.coalesce(bucket, default))
