"""Rows that refer to no suspect are left out before a shuffle; violations stay the same."""

import random

from test_presence import brute, tables

from provenlake.operators import presence, release


def test_rows_of_no_suspect_are_left_out(spark):
    ids = spark.range(40_000).selectExpr("if(id % 2 = 0, 's', 't') AS space", "cast(id AS string) AS id", "id AS n")
    suspects = ids.where("n % 100 < 3").select("space", "id").repartition(3)
    left = {r.n for r in presence.possible(ids, suspects).select("n").collect()}
    assert {n for n in range(40_000) if n % 100 < 3} <= left and len(left) < 1_300
    assert presence.possible(ids, suspects.limit(0)).isEmpty()


def test_many_suspects_give_the_same_violations(spark, monkeypatch):
    monkeypatch.setattr(presence, "FEW", 0)
    for seed in range(2):
        raw, dfs = tables(spark, random.Random(seed))
        found = [(r.code, r.path, r.row_key, r.detail.removeprefix("references unknown ") if r.code == "referential_integrity" else "") for r in release.integrity_violations(dfs).collect()]
        assert sorted(found) == brute(raw)
