"""Visits without a plan are found without a join that Spark moves below the visits' distinct."""

import pytest

from tests.small_study import AS_OF, chain, study
from visittrail.operators.counted import once
from visittrail.operators.reconcile import (
    counted_right_visit,
    distinct_plan_visits,
    plan_visit_rows,
)
from visittrail.plans.report import distinct_visits, plans_with_monitors


@pytest.mark.parametrize("together", [
    distinct_plan_visits, plan_visit_rows,
    lambda plans, visits: counted_right_visit(plans, once(visits)),
])
def test_unplanned_visits_are_not_an_anti_join(spark, together):
    tables = study(spark, mv=chain((1, "2024-06-01"), (3, "2024-06-03")))
    frame = together(plans_with_monitors(tables), distinct_visits(tables, AS_OF))
    assert "LeftAnti" not in frame._jdf.queryExecution().optimizedPlan().toString()
