"""Query specs."""

from __future__ import annotations

import json

import pytest

from tablebridge.plans.spec import SpecError, run_spec


@pytest.fixture(scope="module")
def tables(spark):
    a = spark.createDataFrame(
        [
            (1, "x", 10, 2.5, [1, 2], ["p", "q r"], "2024-01-31", True),
            (2, "y", 7, None, [], [None, 'a"b'], "2023-12-01", False),
            (3, None, None, 4.0, None, None, None, None),
            (4, "x", 10, 4.0, [3], ["", "NULL"], "2024-02-01", True),
        ],
        "id int, tag string, n int, v double, nums array<int>, words array<string>, day string, ok boolean",
    )
    b = spark.createDataFrame(
        [(1, "2023-01-31", 3), (2, "2023-12-31", 2), (9, "2024-01-01", 1)],
        "id int, day string, n int",
    )
    return {
        "a": a.withColumn("day", a.day.cast("date")),
        "b": b.withColumn("day", b.day.cast("date")),
    }


def pick(*names, table="a"):
    return [{"table": table, "field": name, "selectType": "NORMAL"} for name in names]


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def where(tables, *conditions, invert=False):
    spec = {"baseTable": "a", "selectedFields": pick("id"), "whereConditions": list(conditions)}
    return [row[0] for row in rows(run_spec(spec, tables, invert))]


def cond(field, operator, value=None, kind="string", **more):
    return {"table": "a", "field": field, "operator": operator, "value": value, "valueType": kind, **more}


@pytest.mark.parametrize(
    ("condition", "expected"),
    [
        (cond("tag", "=", "x"), [1, 4]),
        (cond("tag", "!=", "x"), [2]),
        (cond("tag", "CONTAINS", "x"), [1, 4]),
        (cond("tag", "NOT CONTAIN", "x"), [2]),
        (cond("tag", "STARTS WITH", "y"), [2]),
        (cond("tag", "ENDS WITH", "y"), [2]),
        (cond("tag", "MATCHES", "^[xy]$"), [1, 2, 4]),
        (cond("tag", "NOT MATCHES", "^x$"), [2]),
        (cond("tag", "IN", ["x", "z"], "list"), [1, 4]),
        (cond("tag", "IN", "x,y", "string"), []),
        (cond("tag", "NOT IN", "x, z", "list"), [2]),
        (cond("n", "IN", "7, 8", "number"), [2]),
        (cond("n", "IN", [7, 8], "number"), [2]),
        (cond("tag", "IS NULL"), [3]),
        (cond("tag", "IS NOT NULL"), [1, 2, 4]),
        (cond("n", ">", 7.5, "number"), [1, 4]),
        (cond("n", ">=", "7", "string"), [1, 2, 4]),
        (cond("v", "BETWEEN", 2, "number", secondValue=3), [1]),
        (cond("v", "NOT BETWEEN", 2, "number", secondValue=3), [3, 4]),
        (cond("day", ">", "2024-01-01", "Date"), [1, 4]),
        (cond("day", "<", "2024-01-01 00:00:00", "Datetime"), [2]),
        (cond("ok", "=", False, "boolean"), [2]),
        (cond("words", "LIST CONTAINS", "q r"), [1]),
        (cond("nums", "LIST CONTAINS", 3, "number"), [4]),
        (cond("nums", "LIST NOT CONTAINS", 3, "number"), [1, 2]),
        # An unknown element makes absence unknown.
        (cond("words", "LIST NOT CONTAINS", "zzz"), [1, 4]),
    ],
)
def test_value_operator(tables, condition, expected):
    assert where(tables, condition) == expected


def test_and_binds_tighter_than_or(tables):
    chain = [
        cond("id", "=", 1, "number", connector="OR"),
        cond("tag", "=", "x", connector="and"),
        cond("id", "=", 4, "number", connector="OR"),
        cond("id", "=", 3, "number"),
    ]
    assert where(tables, *chain) == [1, 3, 4]


def test_invert_keeps_unknown_out(tables):
    assert where(tables, cond("tag", "=", "x"), invert=True) == [2]
    assert where(tables, invert=True) == [1, 2, 3, 4]


def joined(tables, **condition):
    base = {"table": "a", "targetTable": "b", "comparisonType": "COLUMN"}
    spec = {
        "baseTable": "a",
        "selectedFields": pick("id"),
        "joins": [
            {"targetTable": "b", "conditions": [{"sourceField": "id", "targetField": "id"}]}
        ],
        "whereConditions": [base | condition],
    }
    return [row[0] for row in rows(run_spec(spec, tables))]


def test_column_conditions(tables):
    same = {"field": "n", "targetField": "n"}
    assert joined(tables, **same, compareOperator=">") == [1, 2]
    assert joined(tables, **same) == []
    assert joined(tables, **same, compareOperator="-", operator=">", value="6") == [1]
    assert joined(tables, **same, compareOperator="*", operator="=", value=30) == [1]
    # Integers divide to integers.
    assert joined(tables, **same, compareOperator="/", operator="=", value=3) == [1, 2]
    assert joined(tables, **same, compareOperator="%", operator="=", value=1) == [1, 2]


def test_date_conditions(tables):
    days = {"field": "day", "targetField": "day", "valueType": "Date", "operator": "="}
    assert joined(tables, **days, dateUnit="YEAR", value=1) == [1]
    assert joined(tables, **days, dateUnit="MONTH", value=12) == [1]
    assert joined(tables, **days, dateUnit="MONTH", value=0) == [2]
    assert joined(tables, **days, dateUnit="DAY", value=-30) == [2]
    with pytest.raises(ValueError):
        joined(tables, **{**days, "operator": None})


def test_array_text(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": [
            {"field": "id"},
            {"field": "words", "selectType": "NORMAL", "type": "list"},
            {"field": "nums", "selectType": "NORMAL", "type": "set"},
        ],
    }
    assert rows(run_spec(spec, tables)) == [
        (1, '{p,"q r"}', "{1,2}"),
        (2, '{NULL,"a\\"b"}', "{}"),
        (3, None, None),
        (4, '{"","NULL"}', "{3}"),
    ]


def test_select_names(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": [
            {"field": "id", "alias": " the id "},
            {"table": "a", "field": "n", "selectType": "AGGREGATE", "aggregate": ""},
        ],
    }
    assert run_spec(json.dumps(spec), tables).columns == ["the_id", "n"]
    measures = [
        {"selectType": "AGGREGATE", "aggregate": name, "field": "n"}
        for name in ("count", "SUM", "AVG", "MIN", "MAX", "COUNT(DISTINCT)", "COUNT(*)")
    ]
    result = run_spec({"baseTable": "a", "selectedFields": measures}, tables)
    assert result.columns == ["count", "sum", "avg", "min", "max", "count", "count"]
    assert rows(result) == [(3, 27, 9.0, 7, 10, 2, 4)]


def test_star_keeps_all_columns_of_joined_tables(tables):
    spec = {
        "baseTable": "a",
        "joins": [
            {"targetTable": "b", "conditions": [{"sourceField": "id", "targetField": "id"}]}
        ],
    }
    result = run_spec(spec, tables)
    assert result.columns == tables["a"].columns + tables["b"].columns
    assert result.count() == 2


def test_distinct_at_any_position(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": [
            {"field": "n"},
            {"field": "tag", "selectType": "AGGREGATE", "aggregate": "DISTINCT"},
        ],
    }
    assert rows(run_spec(spec, tables)) == [(10, "x"), (7, "y"), (None, None)]


def test_having(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": pick("tag"),
        "groupByFields": [{"table": "a", "field": "tag"}, {"table": "a"}],
        "having": [
            {"isAggregation": True, "aggregate": "count", "isCountAll": True, "operator": ">",
             "value": "1", "connector": "OR"},
            {"field": "n", "connector": "OR"},
            {"table": "a", "field": "tag", "operator": "IS NULL", "connector": "AND"},
            {"isAggregation": True, "aggregate": "MAX", "table": "a", "field": "v",
             "operator": ">=", "value": 4, "valueType": "number"},
        ],
    }
    assert rows(run_spec(spec, tables)) == [("x",), (None,)]


def test_global_having_without_rows(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": [{"selectType": "AGGREGATE", "aggregate": "COUNT(*)"}],
        "having": [
            {"isAggregation": True, "aggregate": "SUM", "field": "n", "operator": ">", "value": "99"}
        ],
    }
    assert rows(run_spec(spec, tables)) == []


def test_same_field_name_in_two_tables(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": [
            {"table": "b", "field": "n"},
            {"table": "a", "field": "n", "selectType": "AGGREGATE", "aggregate": "SUM"},
        ],
        "joins": [
            {"joinType": "right", "targetTable": "b",
             "conditions": [{"sourceField": "id", "targetField": "id"}]}
        ],
        "groupByFields": [{"table": "b", "field": "n"}],
    }
    assert rows(run_spec(spec, tables)) == [(1, None), (2, 7), (3, 10)]


@pytest.mark.parametrize(
    "spec",
    [
        {},
        {"baseTable": "zzz"},
        {"baseTable": "a", "selectedFields": [{"field": "zzz"}]},
        {"baseTable": "a", "selectedFields": [{"field": "n"}], "groupByFields": [{"field": "tag"}]},
        {"baseTable": "a", "groupByFields": [{"field": "tag"}]},
        {"baseTable": "a", "whereConditions": [{"field": "n", "operator": "~~", "value": 1}]},
        {"baseTable": "a", "whereConditions": [{"field": "n", "operator": "="}]},
        {"baseTable": "a", "whereConditions": [{"operator": "=", "value": 1}]},
        {"baseTable": "a", "joins": [{"targetTable": "b", "conditions": [{"sourceField": "id"}]}]},
        {"baseTable": "a",
         "joins": [{"targetTable": "a",
                    "conditions": [{"sourceField": "id", "targetField": "id"}]}]},
        {"baseTable": "a",
         "selectedFields": [{"selectType": "AGGREGATE", "aggregate": "MEDIAN", "field": "n"}]},
    ],
)
def test_invalid(tables, spec):
    with pytest.raises(ValueError):
        run_spec(spec, tables)


def test_joins_without_target_or_conditions_are_ignored(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": pick("id"),
        "joins": [{"targetTable": "b", "conditions": []}, {"conditions": [{}]}],
    }
    assert len(rows(run_spec(spec, tables))) == 4


def test_ambiguous_bare_field(tables):
    spec = {
        "baseTable": "a",
        "selectedFields": [{"field": "n"}],
        "joins": [
            {"targetTable": "b", "conditions": [{"sourceField": "id", "targetField": "id"}]}
        ],
    }
    with pytest.raises(SpecError):
        run_spec(spec, tables)


def test_random_chains_agree_with_sql(spark):
    """AND/OR chains with nulls, inverted or not, against a second engine."""
    import random

    from tests.compare import duck_tables
    from tests.conftest import SMALL

    made = random.Random(23)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    price = "CASE WHEN o_totalprice > 100000 THEN o_totalprice END"
    tables = {"orders": orders.selectExpr("*", f"{price} AS price")}
    duck = duck_tables(SMALL)
    terms = [
        (("price", "<", 250000, "number"), "price < 250000"),
        (("price", "NOT BETWEEN", 150000, "number"), "price NOT BETWEEN 150000 AND 300000"),
        (("price", "IS NULL", None, "number"), "price IS NULL"),
        (("o_orderstatus", "!=", "F", "string"), "o_orderstatus != 'F'"),
        (("o_orderstatus", "NOT IN", "F, O", "list"), "o_orderstatus NOT IN ('F', 'O')"),
        (("o_orderpriority", "CONTAINS", "-_R", "string"), "o_orderpriority LIKE '%-_R%'"),
        (("o_orderdate", ">=", "1998-06-01", "Date"), "o_orderdate >= '1998-06-01'"),
        (("o_orderpriority", "NOT MATCHES", "^[12]", "string"),
         "NOT regexp_matches(o_orderpriority, '^[12]')"),
    ]
    for _ in range(12):
        chosen = [made.choice(terms) for _ in range(made.randint(1, 6))]
        connectors = [made.choice(["AND", "OR"]) for _ in chosen]
        conditions = [
            {"field": f, "operator": op, "value": v, "valueType": kind, "secondValue": 300000,
             "connector": c}
            for ((f, op, v, kind), _), c in zip(chosen, connectors)
        ]
        text = chosen[0][1]
        for connector, (_, sql) in zip(connectors, chosen[1:]):
            text += f" {connector} {sql}"
        for invert in (False, True):
            spec = {
                "baseTable": "orders",
                "selectedFields": [{"field": "o_orderkey"}],
                "whereConditions": conditions,
            }
            found = sorted(row[0] for row in run_spec(spec, tables, invert).collect())
            source = f"(SELECT *, {price} AS price FROM orders)"
            test = f"NOT ({text})" if invert else text
            rows = duck.execute(f"SELECT o_orderkey FROM {source} WHERE {test}").fetchall()
            assert found == sorted(row[0] for row in rows), (text, invert)
