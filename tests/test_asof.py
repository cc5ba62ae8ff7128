"""Validity intervals and lookups as of a day, against plain loops."""
import datetime as dt
import random

import pytest

from starledger.operators.asof import lookup_as_of, validity_dim
from tests.conftest import rows

DAY = lambda n: dt.date(2019, 1, 1) + dt.timedelta(days=n)


def brute(seen):
    """{key: [(attrs, from, to)]} of (key, attrs, day) observations."""
    low = lambda a: tuple((x is not None, x) for x in a)
    days: dict = {}
    for key, attrs, day in seen:
        if key is not None and day is not None:
            old = days.setdefault(key, {}).get(day)
            days[key][day] = attrs if old is None else max(old, attrs, key=low)
    out = {}
    for key, by_day in days.items():
        runs = []
        for day in sorted(by_day):
            if not runs or runs[-1][0] != by_day[day]:
                runs.append((by_day[day], day))
        out[key] = [(a, f, runs[i + 1][1] if i + 1 < len(runs) else None) for i, (a, f) in enumerate(runs)]
    return out


def test_intervals_and_lookup_match_loops(spark):
    rnd = random.Random(5)
    seen = [(rnd.choice(["hot", "hot", "a", "b", None]), (rnd.choice(["x", "y", None]), rnd.randrange(2)),
             None if rnd.random() < .05 else DAY(rnd.randrange(1500))) for _ in range(600)]
    want = brute(seen)
    dim = validity_dim(spark.createDataFrame([(k, *a, d) for k, a, d in seen], "code string, name string, n int, seen date"),
                       "code", ["name", "n"], "seen")
    assert dim.columns == ["code", "name", "n", "valid_from", "valid_to"]
    assert rows(dim) == sorted([(k, *a, f, t) for k, runs in want.items() for a, f, t in runs],
                               key=lambda t: tuple((x is None, str(x)) for x in t))
    facts = [(i, rnd.choice(["hot", "a", "b", "unknown", None]), None if i % 37 == 0 else DAY(rnd.randrange(-400, 2500))) for i in range(400)]
    fact = spark.createDataFrame(facts + facts[:9], "id int, agency string, action_date date")
    got = lookup_as_of(fact, dim, "agency", "action_date", "code", {"name": "agency_name", "valid_from": "since"})

    def found(key, day):
        for (name, _), since, to in want.get(key, []):
            if day is not None and since <= day and (to is None or day < to):
                return name, since
        return None, None
    assert rows(got) == sorted([(i, k, d, *found(k, d)) for i, k, d in facts + facts[:9]],
                               key=lambda t: tuple((x is None, str(x)) for x in t))


def test_edges_and_plan(spark):
    dim = validity_dim(spark.createDataFrame([("a", "x", DAY(0)), ("a", "y", DAY(400)), ("a", "x", DAY(401))], "k string, name string, d date"),
                       "k", "name", "d")
    assert rows(dim) == [("a", "x", DAY(0), DAY(400)), ("a", "x", DAY(401), None), ("a", "y", DAY(400), DAY(401))]
    fact = spark.createDataFrame([("a", DAY(400)), ("a", DAY(399)), ("a", DAY(9999)), ("a", DAY(-1))], "k string, d date")
    got = lookup_as_of(fact, dim, "k", "d")
    assert rows(got) == [("a", DAY(-1), None), ("a", DAY(399), "x"), ("a", DAY(400), "y"), ("a", DAY(9999), "x")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "_year" in plan and "Cartesian" not in plan
    assert lookup_as_of(fact.limit(0), dim, "k", "d").count() == 0
    assert rows(lookup_as_of(fact, dim.limit(0), "k", "d").select("name").distinct()) == [(None,)]
    with pytest.raises(ValueError, match="name"):
        lookup_as_of(fact.withColumnRenamed("d", "name"), dim, "k", "name")
