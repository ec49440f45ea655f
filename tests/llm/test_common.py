import pytest

from tallyforge.llm import common


@pytest.mark.parametrize("join", [common.spread_join, common.salted_join])
def test_joins_of_hot_keys(spark, join, monkeypatch):
    monkeypatch.setattr(common, "PARTS", 5)
    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('k', id % 700) ELSE 'none' END AS key")
    facts = rows.where("key <> 'none'").groupBy("key").count().selectExpr("key", "count AS uses", "count AS n")
    found = join(rows, facts, ["key"], "uses")
    assert sorted(found.columns) == ["id", "key", "n"]
    want = rows.join(facts.drop("uses"), "key")
    assert sorted(tuple(r) for r in found.select("id", "key", "n").collect()) == sorted(tuple(r) for r in want.select("id", "key", "n").collect())
    assert join(rows.limit(0), facts.limit(0), ["key"], "uses").collect() == []


def test_running_sums_over_ranges(spark):
    rows = spark.range(500).selectExpr("CASE WHEN id < 400 THEN 'a' ELSE concat('g', id % 7) END AS grp", "id * 7919 % 500 AS at", "id % 4 AS n")
    found = {(r["grp"], r["at"]): (r["before"], r["total"]) for r in common.running(rows.repartition(9), ["grp"], ["at"], "n").collect()}
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["grp"], []).append((r["at"], r["n"]))
    want = {}
    for grp, values in groups.items():
        before = 0
        for at, n in sorted(values):
            want[grp, at] = (before, sum(v for _, v in values))
            before += n
    assert found == want


def test_numbers_ascend(spark):
    rows = common.numbered(spark.range(300).selectExpr("id * 7919 % 300 AS key").repartition(7), ["key"]).orderBy("name").collect()
    assert [r["key"] for r in rows] == list(range(300)) and len({r["name"] for r in rows}) == 300
