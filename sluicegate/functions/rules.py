"""Ordered regular-expression rules as column expressions."""

import re

from pyspark.sql import functions as F

# What gives a pattern another meaning inside a larger one: references and names of groups,
# quoting, and flags, which hold for the rest of the pattern.
NOT_JOINED = re.compile(r"\\[1-9kQE]|\(\?(?![:=!>]|<[=!])")


def at_start(pattern):
    """A pattern that must match from the first character on."""
    return rf"\A(?:{pattern})"


def in_order(rules, match="first", anchored=False):
    """The rules so that the first match decides: ``last`` turns their order round."""
    ordered = list(rules) if match == "first" else list(reversed(rules))
    return [(at_start(p), b) for p, b in ordered] if anchored else ordered


def first_match(text, rules):
    """Bucket of the first rule whose pattern is found in ``text``, else null."""
    cases = [F.when(text.rlike(p), F.lit(b)) for p, b in rules]
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def can_join(pattern):
    """Whether a pattern keeps its meaning as one branch of a larger pattern."""
    return not NOT_JOINED.search(pattern)


def tried_at_start(pattern, anchored):
    """Whether the rule can match at the start of the text only."""
    at_its_start = re.match(r"(?:\^|\\A)(?![*+?{])", pattern) and "|" not in pattern
    return anchored or bool(at_its_start)


def branch(pattern, anchored):
    """A branch, tried at the start of the text, that matches if the rule does."""
    whole = f"(?:{pattern})" if "|" in pattern else pattern
    return whole if tried_at_start(pattern, anchored) else rf"[\s\S]*?{whole}"


def any_of(patterns, anchored):
    """A pattern that is found if any rule matches.  Those for the start are tried only there."""
    here = "|".join(p for p in patterns if tried_at_start(p, anchored))
    there = [p for p in patterns if not tried_at_start(p, anchored)]
    return "|".join([rf"\A(?:{here})"] * (len(there) < len(patterns)) + there)


def first_match_joined(text, rules, anchored=False, blocks=4):
    """The same for patterns that can be joined, with few searches for many rules.

    One search asks whether any rule matches, then one per block of rules whether it is there."""
    size = max(-(-len(rules) // blocks), 2)
    inside = [match_in_block(text, rules[i : i + size], anchored) for i in range(0, len(rules), size)]
    return F.when(text.rlike(any_of([p for p, _ in rules], anchored)), F.coalesce(*inside))


def match_in_block(text, rules, anchored):
    """The same again for few rules: the bucket's number takes a search per binary digit.

    An atomic group keeps the first branch that matches, and the reference behind it asks whether
    that was a branch with the digit set, as only those hold an (empty) group."""
    buckets = list(dict.fromkeys(b for _, b in rules))
    branches = [(branch(p, anchored), buckets.index(b)) for p, b in rules]
    number = F.lit(0)
    for digit in range((len(buckets) - 1).bit_length()):
        name = f"d{digit}n"
        is_set = [i for i, (_, n) in enumerate(branches) if n >> digit & 1]
        groups = {i: f"(?<{name}{i}>)" for i in is_set}
        first = "|".join(p + groups.get(i, "") for i, (p, _) in enumerate(branches))
        held = "|".join(rf"\k<{name}{i}>" for i in is_set)
        found = text.rlike(rf"\A(?>{first})(?:{held})")
        number = number + F.when(found, 1 << digit).otherwise(0)
    bucket = F.get(F.array(*map(F.lit, buckets)), number) if len(buckets) > 1 else F.lit(buckets[0])
    return F.when(text.rlike(any_of([p for p, _ in rules], anchored)), bucket)
