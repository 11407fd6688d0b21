from __future__ import annotations

import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyworks.functions import text
from tallyworks.operators import keys, lists, lookups


def test_list_keeps_duplicates_and_drops_nulls(rows):
    df = rows("k int, v string", (1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (3, ""))
    got = {r["k"]: r["items"] for r in lists.listagg_by_group(df, "k", "v").collect()}
    assert got == {1: "a,b,b", 2: None, 3: ""}
    longer = {r["k"]: r["items"] for r in lists.listagg_by_group(df, "k", "v", ", ").collect()}
    assert longer[1] == "a, b, b"


def test_list_sorts_by_value_not_by_text(rows):
    df = rows("k int, v int", (1, 10), (1, 9), (1, 9))
    assert lists.listagg_by_group(df, "k", "v").first()["items"] == "9,9,10"


def test_list_of_first_rows(rows):
    df = rows("v string, o int", ("c", 3), ("a", 9), ("b", 1))
    assert lists.listagg_top_n(df, "v", 2, ["o"]).first()["items"] == "b,c"


def test_split_golden_rows(rows):
    df = lists.split_trim(rows("t string", ("[A], [B] ,[C]",)), "t")
    assert [r["item"] for r in df.collect()] == ["[A]", "[B]", "[C]"]
    dots = lists.split_trim(rows("t string", ("a.b",)), "t", ".")
    assert [r["item"] for r in dots.collect()] == ["a", "b"]


def test_sums_from_a_list_of_names(rows):
    names = lists.names_from_list("[A],[B],[C]")
    assert names == ["A", "B", "C"]
    df = lists.sum_columns_from_list(rows("A int, B int, C int, D int", (1, 2, 3, 4), (1, 1, 1, 1)), names)
    assert [tuple(r) for r in df.collect()] == [(2, 3, 4)] and df.columns == names


def test_overlay_golden(rows):
    df = rows("a string, b string", ("ABCDEFG", ",Willis,Lucy")).select(
        text.overlay_text(F.col("a"), 3, 2, "000").alias("a"),
        text.overlay_text(F.col("b"), 1, 1, "").alias("b"),
    )
    assert tuple(df.first()) == ("AB000EFG", "Willis,Lucy")


def test_wildcards_taken_literally(rows):
    df = rows("t string", ("10% off",), ("100 off",), ("a_b",), ("a!b",))
    found = [[r["t"] for r in lookups.like_literal(df, "t", x).collect()] for x in ("10%", "_", "!")]
    assert found == [["10% off"], ["a_b"], ["a!b"]]


def test_new_keys_continue_the_numbers(rows):
    known = rows("id long, badge string", (4, "A"))
    incoming = rows("badge string", (" A ",), ("C",), ("  ",), ("B ",), ("B",), (None,))
    got = keys.insert_new_keys(known, incoming, "badge")
    assert as_set(got) == [(4, "A"), (5, "B"), (6, "C")]
    assert as_set(keys.insert_new_keys(got, incoming, "badge")) == as_set(got)


SESSIONS = "session_id long, login string, blocking_id long, blocked_count int"


@pytest.mark.parametrize(("hour", "minute", "act"), [(19, 0, True), (18, 59, False), (7, 59, True), (8, 0, False)])
def test_blocking_pairs(rows, hour, minute, act):
    sessions = rows(
        SESSIONS,
        (1, "slow", None, 3), (2, "win", 1, 0), (3, "slow", 1, 0), (4, "lose", 1, 0),
        (5, "free", None, 1), (6, "win", 5, 0), (7, "mid", 1, 1), (8, "win", 7, 0),
    )
    at = dt.datetime(2024, 1, 5, hour, minute)
    pairs = keys.blocking_pairs(sessions, ["win", "slow"], ["free"], at)
    got = [(r["row_num"], r["blocker_session_id"], r["victim_session_id"], r["act"]) for r in pairs.collect()]
    assert got == [(1, 1, 2, act)]
    flagged = keys.flag_log(sessions, pairs, at).where("flagged").select("session_id")
    assert as_set(flagged) == ([(1,)] if act else [])


def test_streak_counts_each_day_once(rows):
    days = [1, 1, 2, 3, 5, 6, 31]
    df = rows("k int, t timestamp_ntz", *[(1, dt.datetime(2024, 1, d, 9)) for d in days], (1, dt.datetime(2024, 2, 1)), (2, dt.datetime(2024, 1, 1)))
    assert as_set(keys.longest_streak(df, ["k"], "t")) == [(1, 3), (2, 1)]


def test_wide_gaps_are_filled(rows):
    first = rows("id int, d_2 string, l_2 int, d_3 string, l_3 int", (1, "x", None, "y", 5), (2, None, None, None, None))
    second = rows("id int, l_2 int, l_3 int", (1, 7, 8))
    df = keys.coalesce_wide(first, second, "id", [2, 3], ["d_{}"], ["l_{}"])
    assert df.columns == ["id", "d_2", "d_3", "l_2", "l_3"]
    assert {tuple(r) for r in df.collect()} == {(1, "x", "y", 7, 5), (2, None, None, None, None)}


def test_max_over_fitting_tables(rows):
    day = dt.date(2001, 1, 2)
    frames = {
        "temp2_b": rows("enrolled date", (day,), (None,)), "temp1_a": rows("was_enrolled date", (day,)),
        "tempX_c": rows("enrolled date", (day,)), "temp3_d": rows("other date", (day,)),
    }
    got = keys.max_per_table(frames, r"temp[0-9]_.*", "enrolled")
    assert as_set(got) == [("temp1_a", "2001-01-02"), ("temp2_b", "2001-01-02")]
    with pytest.raises(ValueError):
        keys.max_per_table({}, "x", "y")


def test_case_results(rows):
    df = rows("d int, p int", (1, 0), (3, 3), (3, 4), (3, 5), (4, 3), (None, 1))
    steps = [(F.col("d").isin(1, 2), "A"), (F.col("d") == 3, ("p", {3: "B-1", 4: "B-2"}))]
    got = lookups.nested_case(df, steps, "C", "grade").collect()
    assert [r["grade"] for r in got] == ["A", "B-1", "B-2", None, "C", "C"]
    salaries = rows("n string, s int", ("b", 2500), ("a", 2499), ("c", None), ("a", 9000))
    assert [r["n"] for r in lookups.case_sort(salaries, "s", 2500, "n").collect()] == ["a", "c", "a", "b"]


def test_undefined_products_sort_dates_as_text(rows):
    day = dt.date
    df = rows(
        "p string, d date, s string",
        ("x", day(2001, 1, 31), "Not"), ("x", day(2000, 5, 1), "Not"), ("y", day(2002, 1, 2), "Not"),
        ("IsCard z", day(2001, 1, 1), "Not"), ("w", day(2001, 1, 1), "Ok"), (None, day(2001, 1, 1), "Not"),
    )
    got = lookups.undefined_products(df, "p", "d", ["%IsCard%"], F.col("s") == "Not")
    assert [tuple(r) for r in got.collect()] == [
        ("x", 2, "   01-05-2000", "   31-01-2001"), ("y", 1, "   02-01-2002", "   02-01-2002"),
    ]


def test_lookups(rows):
    df = rows("k int, v string, d date", (1, "a", dt.date(2001, 1, 1)), (2, "a", dt.date(2001, 1, 2)), (3, "b", dt.date(2001, 1, 1)))
    one = lookups.day_slice(df, "v", "a", "d", dt.date(2001, 1, 1), dt.date(2001, 1, 2))
    assert [r["k"] for r in one.collect()] == [1]
    assert lookups.point_lookup(df, "v", "a", ["k"]).columns == ["k"]
    assert lookups.max_text_length(rows("t string", ("ab   ",), ("abc",)), "t").first()[0] == 3
    star = lookups.star_denormalize(df, [(rows("code string, name string", ("a", "first")), "v", "code", {"name": "shown"})])
    assert sorted((r["k"], r["shown"]) for r in star.collect() if r["shown"]) == [(1, "first"), (2, "first")]
    assert star.count() == 3
