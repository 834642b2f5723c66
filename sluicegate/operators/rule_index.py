"""An index of rules by text that a match must start or end with.

Most patterns of a long rule list ask for a literal at the start (``^\\+7...``) or at the end (``...042$``).
A rule is filed under one such key, and a message looks its own start and end up in a broadcast
table: the few rules found there are the only ones of all filed whose expressions run.  The plan and the
generated code are the same for any number of filed rules.  Rules without a key, or whose key too many
share, are matched as before; whichever rule comes first in order decides."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sluicegate.functions.rules import at_start, can_join

LENGTHS = (16, 12, 8, 6, 4, 3, 2, 1)  # of keys; each that is used is a look-up per message
MOST_SAME = 16  # rules of one key
LEAST_FILED = 32  # rules of one kind and length of key; fewer are not worth a look-up
MOST_BYTES = 16 << 20  # of patterns and buckets in the broadcast tables
TERMINATORS = "\n\r\u0085\u2028\u2029"  # before one of these at the end of a text, $ matches too
CODE = 10  # digits of a rule's place in front of its bucket

META = set(r"\.[]{}()*+?^$|")
LONG_ESCAPE = re.compile(r"\\[0-9xucpPNkQE]")


def start_literal(pattern, anchored):
    """Characters that every match starts the text with."""
    whole = re.match(r"(?:\^|\\A)(?![*+?{])", pattern)
    at, out = (whole.end() if whole else 0), []
    if not (whole or anchored):
        return ""
    while at < len(pattern):
        char, after = pattern[at], at + 1
        if char == "\\":
            if after == len(pattern) or pattern[after].isalnum():
                break
            char, after = pattern[after], after + 1
        elif char in META:
            break
        next_ = pattern[after : after + 1]
        if next_ in ("*", "?", "{"):  # it may be left out
            break
        out.append(char)
        if next_ == "+":
            break
        at = after
    return "".join(out)


def end_literal(pattern):
    """Characters that every match ends the text with, but for a line terminator behind them."""
    if not pattern.endswith("$") or LONG_ESCAPE.search(pattern):
        return ""
    body, at = pattern[:-1], len(pattern) - 1
    while at and body[at - 1] not in META:
        at -= 1
    if at and body[at - 1] == "\\":  # the first of them belongs to an escape
        at += 1
    found = body[at:]
    return "" if any(c in TERMINATORS for c in found) else found


def keys(pattern, anchored):
    """Keys ``(kind, length, text)`` the rule may be filed under."""
    if "|" in pattern or not can_join(pattern):
        return []
    out = []
    for kind, found in (("start", start_literal(pattern, anchored)), ("end", end_literal(pattern))):
        for n in LENGTHS:
            if n <= len(found):
                out.append((kind, n, found[:n] if kind == "start" else found[-n:]))
                break
    return out


def filed(pairs, anchored):
    """``({(kind, length): {key: [place in order]}}, places of the rest)``."""
    options = [keys(p, anchored) for p, _ in pairs]
    common = Counter(k for found in options for k in found)
    index, rest = defaultdict(lambda: defaultdict(list)), []
    for place, found in enumerate(options):
        best = min(found, key=lambda k: (common[k], -k[1]), default=None)
        if best is None or common[best] > MOST_SAME:
            rest.append(place)
        else:
            index[best[:2]][best[2]].append(place)
    for kind in [k for k, table in index.items() if sum(map(len, table.values())) < LEAST_FILED]:
        rest += [place for places in index.pop(kind).values() for place in places]
    return index, sorted(rest)


def code(place, bucket):
    """A text that sorts by the rule's place and holds its bucket."""
    return f"{place:0{CODE}d}{bucket}"


def looked_up(frame, text, pairs, index, anchored):
    """``(frame, codes)``: the frame with the rules found for each row, and the least code that matches,
    an expression per kind of key."""
    spark, codes = frame.sparkSession, []
    last = F.right(text, F.lit(1))
    stripped = F.when(
        last.isin(*TERMINATORS), F.regexp_replace(text, r"(?:\r\n|[\n\r\u0085\u2028\u2029])\z", "")
    ).otherwise(text)
    for number, ((kind, length), table) in enumerate(sorted(index.items())):
        rows = [
            (key, [(code(p, pairs[p][1]), at_start(pairs[p][0]) if anchored else pairs[p][0]) for p in places])
            for key, places in table.items()
        ]
        name, found = f"_index_key{number}", f"_index_rules{number}"
        side = spark.createDataFrame(rows, f"{name} string, {found} array<struct<code:string,pattern:string>>")
        own = F.substring(text, 1, length) if kind == "start" else F.right(stripped, F.lit(length))
        frame = frame.join(F.broadcast(side), own == F.col(name), "left").drop(name)
        hits = F.filter(F.col(found), lambda r: F.regexp_like(text, r["pattern"]))
        codes.append(F.array_min(F.transform(hits, lambda r: r["code"])))
    return frame, codes
