"""What the physical plans must and must not hold."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def study(spark):
    return entry.Study(spark, SF)


@pytest.mark.parametrize("name", ["visit_report", "next_approval", "site_country", "layout_matrix"])
def test_no_pairwise_join_and_no_python(study, name):
    text = physical(entry.QUERIES[name](study))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


def test_scans_read_only_what_is_used(study):
    text = physical(entry.QUERIES["stage_sequence"](study))
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_visits_are_computed_once_for_both_joins(study):
    report = entry.QUERIES["visit_report"](study)
    report.collect()
    final = physical(report).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 3
    assert final.count("collect_list(struct(approvalid") <= 2
