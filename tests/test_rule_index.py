"""The index of rules against the rules one by one."""

import random
import re

import pytest
from helpers import plan, texts
from test_stages import SUBJECTS, TRICKY

from sluicegate import RouterConfig, Rules
from sluicegate.operators import rule_index
from sluicegate.operators import rules as rule_steps
from sluicegate.operators.rules import apply_rules


@pytest.mark.parametrize(
    "pattern, anchored, start",
    [
        (r"^\+7\d{10}$", False, "+7"), (r"\Aab", False, "ab"), ("^abc*", False, "ab"), ("^ab+c", False, "ab"),
        ("^ab?", False, "a"), ("^ab{0,2}", False, "a"), ("ab", False, ""), ("ab", True, "ab"), ("^?ab", False, ""),
        (r"^a\.b", False, "a.b"), (r"^a\d", False, "a"), ("^", False, ""), (r"^a(b)", False, "a"), ("^ж.", False, "ж"),
    ],
)
def test_start_literals(pattern, anchored, start):
    assert rule_index.start_literal(pattern, anchored) == start


@pytest.mark.parametrize(
    "pattern, end",
    [
        (r"^\+7\d{8}42$", "42"), (r"\d12$", "12"), (r"\.12$", "12"), (r"a\$", ""), ("ab", ""), ("$", ""), ("[a-z]b$", "b"),
        (r"a+bc$", "bc"), (r"\x4112$", ""), (r"\p{L}b$", ""), ("(a)b$", "b"), ("a?$", ""), ("a\n$", ""), (r"(?:x)*yz$", "yz"),
        (r"\\ab$", "b"), ("жы$", "жы"),
    ],
)
def test_end_literals(pattern, end):
    assert rule_index.end_literal(pattern) == end


def test_keys_are_texts_that_matches_have():
    """Every text a pattern is found in starts and ends as its keys say (checked with Python's engine)."""
    draw = random.Random(1)
    pieces = ["a", "b", r"\d", r"\.", "a+", "b?", "[ab]", "(ab)", "c{2}", "(?:c|a)", "é"]
    for _ in range(2000):
        pattern = draw.choice(["^", ""]) + "".join(draw.choice(pieces) for _ in range(draw.randint(1, 5))) + draw.choice(["$", ""])
        found = rule_index.keys(pattern, False)
        for _ in range(20):
            text = "".join(draw.choice("abc1.é\n") for _ in range(draw.randint(0, 6)))
            if re.search(pattern, text):
                for kind, n, key in found:
                    assert text.startswith(key) if kind == "start" else text.removesuffix("\n").endswith(key)


@pytest.mark.parametrize("match", ["first", "last"])
@pytest.mark.parametrize("anchored", [False, True])
def test_filed_rules_match_as_the_rules_one_by_one(spark, monkeypatch, match, anchored):
    literals = [f"^{a}{b}" for a in "abc" for b in "abc"] + [f"{a}{b}$" for a in "abc" for b in "abc"]
    literals += [r"^a.*c$", r"^\.", "a\\.$", "^a$", "", "^ab+$", "x$"]
    more = ["abc", "abc\n", "ab\r\n", "bc\u2028", "bc\n\n", "b\n\r", "cab", ".", "a.", "ab\n", "cc\u0085", "\n", "abab"]
    subjects = SUBJECTS + more
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(subjects)], "route_value string, offset int")
    config = RouterConfig(match=match, anchored=anchored)
    monkeypatch.setattr(rule_index, "LEAST_FILED", 2)
    for seed in range(5):
        draw = random.Random(seed)
        chosen = draw.sample(TRICKY, 6) + draw.sample(literals, 12)
        draw.shuffle(chosen)
        rules = Rules.of([(p, "" if i == 3 else f"b{i % 7}") for i, p in enumerate(chosen)]).check(spark)
        found = {}
        for indexed in (1, 10**9):
            monkeypatch.setattr(rule_steps, "INDEXED_RULES", indexed)
            rows = apply_rules(frame, rules, config)
            assert rows.columns == ["route_value", "offset", "bucket"]
            found[indexed] = texts(rows, "bucket")
        assert found[1] == found[10**9]


def test_the_plan_does_not_grow_with_the_rules(spark):
    frame = spark.createDataFrame([("+71234500042", 0), ("+7", 1), (None, 2)], "route_value string, offset int")
    sizes = []
    for many in (100, 5000):
        rules = Rules.of([*[(rf"^\+7\d{{5}}{n:05d}$", f"b{n}") for n in range(many)], (".*", "rest")])
        found = apply_rules(frame, rules, RouterConfig())
        assert texts(found, "bucket") == ["b42", "rest", "rest"]
        sizes.append(found._jdf.queryExecution().analyzed().toString().count("LIKE"))
        assert "BroadcastHashJoin" in plan(found) and "hashpartitioning" not in plan(found)
    assert sizes[0] == sizes[1]


def test_rules_that_share_a_key_are_searched():
    pairs = [(rf"^\+7{'.' * n}a?", "x") for n in range(100)]
    index, rest = rule_index.filed(pairs, False)
    assert not index and rest == list(range(100))
