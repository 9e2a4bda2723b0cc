"""Filter payloads."""

from __future__ import annotations

import json

import pytest

from tablebridge.operators.comparisons import like_pattern
from tablebridge.operators.filters import FilterError, filter_rows

ROWS = [
    (1, "red bolt", 1.5, "2024-01-01"),
    (2, "100% re_d", 2.5, "2024-01-02"),
    (3, None, None, None),
    (4, "Red\\nut", 10.0, "2024-02-01"),
    (5, "", 0.0, "2023-12-31"),
]


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.createDataFrame(ROWS, "id int, name string, price double, day string")
    return rows.withColumn("day", rows.day.cast("date"))


def ids(df):
    return sorted(row.id for row in df.select("id").collect())


def entry(column, operator, value=None, to=None):
    return {"column": {"name": column}, "operator": operator, "value": value, "valueTo": to}


@pytest.mark.parametrize(
    ("condition", "expected"),
    [
        (entry("name", "contains", "ed"), [1, 4]),
        (entry("name", "CONTAINS", "_d"), [1, 2, 4]),
        (entry("name", "CONTAINS", "\\_d"), [2]),
        (entry("name", "CONTAINS", "d\\\\n"), [4]),
        (entry("name", "CONTAINS", "\\bolt"), [1]),
        (entry("name", "not contain", "red"), [2, 4, 5]),
        (entry("name", "NOT_CONTAINS", "red"), [2, 4, 5]),
        (entry("name", "starts_with", "red"), [1]),
        (entry("name", "ENDS WITH", "ut"), [4]),
        (entry("name", "MATCHES", "^[rR]ed"), [1, 4]),
        (entry("name", "NOT_MATCHES", "^[rR]ed"), [2, 5]),
        (entry("name", "=", ""), [5]),
        (entry("name", "!=", ""), [1, 2, 4]),
        (entry("id", "EQUALS", "4"), [4]),
        (entry("id", ">", 1.5), [2, 3, 4, 5]),
        (entry("id", ">=", 2), [2, 3, 4, 5]),
        (entry("price", "<", "2"), [1, 5]),
        (entry("price", "LESS_THAN_OR_EQUAL", 1.5), [1, 5]),
        (entry("price", "BETWEEN", 1, "3"), [1, 2]),
        (entry("price", "NOT_BETWEEN", 1, 3), [4, 5]),
        (entry("day", "BETWEEN", "2024-01-01", "2024-01-31"), [1, 2]),
        (entry("day", ">", "2024-01-01"), [2, 4]),
        (entry("id", "IN", "1, 3,,"), [1, 3]),
        (entry("id", "NOT_IN", [1, "3"]), [2, 4, 5]),
        (entry("price", "NOT_IN", [1.5]), [2, 4, 5]),
        (entry("name", "IS_NULL"), [3]),
        (entry("name", "is not null"), [1, 2, 4, 5]),
        (entry("id", "CONTAINS", 4), [4]),
        (entry("id", "MATCHES", "^[12]$"), [1, 2]),
    ],
)
def test_operator(table, condition, expected):
    assert ids(filter_rows(table, [condition])) == expected
    assert ids(filter_rows(table, json.dumps([condition]), strict=True)) == expected


def test_conditions_are_anded(table):
    both = [entry("id", ">", 1), entry("name", "CONTAINS", "ed")]
    assert ids(filter_rows(table, both)) == [4]


@pytest.mark.parametrize(
    "payload",
    [
        "not json",
        '{"a": 1}',
        "  ",
        17,
        ["text"],
        [{}],
        [{"column": "id", "operator": "=", "value": 1}],
        [entry("id; --", "=", 1)],
        [entry("id", "LIKE", 1)],
        [entry("id", None, 1)],
        [entry("id", "=")],
        [entry("id", "BETWEEN", 1)],
        [entry("id", "IN", " , ")],
        [entry("id", "IN", 5)],
        [entry("id", "CONTAINS")],
    ],
)
def test_unusable_entries(table, payload):
    assert ids(filter_rows(table, payload)) == [1, 2, 3, 4, 5]
    with pytest.raises(FilterError):
        filter_rows(table, payload, strict=True)


def test_no_filters(table):
    assert ids(filter_rows(table, None, strict=True)) == [1, 2, 3, 4, 5]
    assert ids(filter_rows(table, [], strict=True)) == [1, 2, 3, 4, 5]


def test_bad_literal_raises(table):
    with pytest.raises(ValueError):
        filter_rows(table, [entry("id", "=", "five")])


def test_like_pattern_backslashes():
    assert like_pattern("contains", "a\\b") == "%ab%"
    assert like_pattern("contains", "a\\\\b") == "%a\\\\b%"
    assert like_pattern("starts_with", "50\\%") == "50\\%%"


@pytest.mark.parametrize(
    ("pattern", "text", "hit"),
    [
        ("^[[:alpha:]]+$", "abcé", True),
        ("^[[:alpha:]]+$", "ab1", False),
        ("[^[:digit:][:space:]]", "1 2", False),
        ("a.c", "a\nc", True),
        ("a$", "a\n", False),
        ("a\\$", "a$", True),
        ("[$]$", "a$", True),
        ("[]x]", "]", True),
        ("[^]x]", "]", False),
        ("[a[]", "[", True),
        ("^[a&&b]+$", "&ab", True),
        ("\\mcat\\M", "a cat!", True),
        ("\\mcat\\M", "concat", False),
        ("[[:<:]]cat[[:>:]]", "a cat!", True),
        ("\\ycat", "concat", False),
        ("(?i)CAT", "cat", True),
        ("[\\d.]+\\Z", "1.5", True),
    ],
)
def test_pattern_syntax(spark, pattern, text, hit):
    row = spark.createDataFrame([(text,)], "name string")
    payload = [entry("name", "MATCHES", pattern)]
    assert (filter_rows(row, payload).count() == 1) == hit


@pytest.mark.parametrize("pattern", ["[a", "[[:nope:]]"])
def test_bad_pattern(table, pattern):
    with pytest.raises(ValueError):
        filter_rows(table, [entry("name", "MATCHES", pattern)])


def test_filter_reaches_the_scan(spark, tmp_path, table):
    table.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    payload = [entry("id", ">", 1), entry("name", "STARTS_WITH", "red")]
    plan = filter_rows(stored, payload).select("id")._jdf.queryExecution().toString()
    assert "GreaterThan(id,1)" in plan and "StringStartsWith(name,red)" in plan


LITERALS = {
    "^red": ("red", []),
    "ring": ("", ["ring"]),
    "^a+b*c?d{2}e{0,1}f": ("a", ["d", "f"]),
    r"^12\.5 [a-z]+ end$": ("12.5 ", [" end"]),
    "(ab)c(d)?e": ("", ["c", "e"]),
    "a|b": ("", []),
    "(a|b)c[|]d": ("", ["c", "d"]),
    "^(red|blue) .*t$": ("", [" ", "t"]),
    "^ab(c|d|": ("ab", []),
    "(?i)abc": ("", []),
    r"\d+abc\w": ("", ["abc"]),
    "ab{3}c": ("", ["ab", "c"]),
    "x[]a]y[^b]z": ("", ["x", "y", "z"]),
    "^": ("", []),
    "": ("", []),
    "a(b(c)[)]d)e": ("", ["a", "e"]),
    "ab??c": ("", ["a", "c"]),
}


@pytest.mark.parametrize("pattern", LITERALS)
def test_required_literals(pattern):
    from tablebridge.functions.patterns import required_literals

    assert required_literals(pattern) == LITERALS[pattern]


def test_literals_never_lose_a_match():
    """Random expressions over a small alphabet: every value that matches holds them."""
    import random
    import re

    from tablebridge.functions.patterns import required_literals

    rng = random.Random(6)
    pieces = ["a", "b", "c", "ab", "(a|bc)", ".", "[ab]", "[^c]", "(b)", "(ab)", "\\.", "\\w", "a{2}", "b{0,2}", "c{1,}"]
    values = ["".join(rng.choice("abc.") for _ in range(rng.randint(0, 9))) for _ in range(400)]
    useful = 0
    for _ in range(600):
        pattern = rng.choice(["", "^"]) + "".join(rng.choice(pieces) + rng.choice(["", "", "", "?", "*", "+", "+?", "*?"]) for _ in range(rng.randint(1, 5))) + rng.choice(["", "$"])
        try:
            found = re.compile(pattern)
        except re.error:  # a quantifier behind another
            continue
        prefix, literals = required_literals(pattern)
        useful += bool(prefix or literals)
        for value in values:
            if found.search(value):
                assert value.startswith(prefix) and all(piece in value for piece in literals), (pattern, value)
    assert useful > 200
