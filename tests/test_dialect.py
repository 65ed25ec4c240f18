from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrow.dialect import DialectError, interval_parts, rewrite, scan


def test_literals_and_comments_are_left_alone():
    out = rewrite("SELECT '$1 ::int4' AS a, \"we $2 ird\" AS b -- $3\n/* $4 */ FROM t")
    assert out.parameters == 0
    assert "'$1 ::int4'" in out.sql and "`we $2 ird`" in out.sql


def test_parameters_count_by_highest_number():
    assert rewrite("SELECT $2::int4, $2::text AS x").parameters == 2


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("SELECT a FROM t ORDER BY a", "ORDER BY a NULLS LAST"),
        ("SELECT a FROM t ORDER BY a DESC LIMIT 3", "ORDER BY a DESC NULLS FIRST LIMIT 3"),
        ("SELECT a FROM t ORDER BY a NULLS FIRST, b", "ORDER BY a NULLS FIRST , b NULLS LAST"),
        ("SELECT x.a FROM (SELECT a FROM t ORDER BY lower(a, b)) x", "lower ( a , b ) NULLS LAST )"),
    ],
)
def test_nulls_are_largest_by_default(sql, expected):
    assert expected in rewrite(sql).sql


@pytest.mark.parametrize("sql", ["SELECT (1, 2", "SELECT 1)", "SELECT 1::", "SELECT 'x'::bytes7", "SELECT '{'::json", "SELECT generate_series(1)"])
def test_what_no_statement_has(sql):
    with pytest.raises(DialectError):
        rewrite(sql)


@pytest.mark.parametrize(
    "text, parts",
    [("1 mon -2 days 03:04:05.5", (1, -2, 11045500000000)), ("2 weeks", (0, 14, 0)), ("-00:00:01", (0, 0, -1000000000)), ("1 yr 1 sec", (12, 0, 1000000000))],
)
def test_intervals(text, parts):
    assert interval_parts(text) == parts


@given(st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_any_literal_survives(value):
    token = scan("'" + value.replace("'", "''") + "'")
    assert len(token) == 1 and token[0].kind == "text"
    if all(ord(c) > 31 and c not in "'\\" for c in value):
        assert f"'{value}'" in rewrite("SELECT '" + value + "' AS v").sql
