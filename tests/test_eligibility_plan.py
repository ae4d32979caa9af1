"""Artifacts are shuffled and chosen once, though the chosen ones are read twice."""

from provenlake.queries import evaluation

DATA = "/root/testdata/sf0.001"


def test_chosen_artifacts_are_worked_out_once(spark):
    plan = evaluation.eligibility_rows(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    # The sources and the presence of artifacts; the choice itself is settled.
    assert plan.count("Relation [l_orderkey") == 2 and "sha2(" not in plan
