"""A query works out the summaries that it reads, and no others."""

from provenlake.functions import binary
from provenlake.operators import normalize
from provenlake.queries import semantics

DATA = "/root/testdata/sf0.001"


def test_unread_summaries_are_not_worked_out(spark):
    plan = semantics.normalize_solutions(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "part_type_histogram" in plan and "opcode_histogram" not in plan and "track_hex_count" not in plan


def test_named_summaries_are_those_of_the_whole(spark):
    decoded = binary.decode_solutions(semantics.line_solutions(spark, DATA)).selectExpr("*", "'P' AS puzzle_id").limit(50)
    whole = {r.solution_id: r.summaries.asDict() for r in normalize.normalize_solutions(decoded).collect()}
    some = normalize.normalize_solutions(decoded, summaries=["part_count", "opcode_histogram"]).collect()
    assert whole and all(len(s) == 7 for s in whole.values())
    for r in some:
        assert r.summaries.asDict() == {n: whole[r.solution_id][n] for n in ("part_count", "opcode_histogram")}
