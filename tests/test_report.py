"""Reports of hand-made studies against values worked out by hand."""

from tests.small_study import AS_OF, chain, study
from visittrail.fixed_values import REPORT_COLUMNS
from visittrail.operators.approvals import approval_facts, complete_approvals, next_approval
from visittrail.plans.report import studies_report, visit_report
from visittrail.sources.studies import all_studies

GOOD = [(1, "2024-06-01"), (2, "2024-06-03"), (1, "2024-06-03"), (3, "2024-06-05")]


def report(spark, **rows):
    return [row.asDict() for row in visit_report(study(spark, **rows), AS_OF).collect()]


def one(spark, **rows):
    found = report(spark, **rows)
    assert len(found) == 1, found
    return found[0]


def test_clean_visit(spark):
    row = one(spark, mv=chain(*GOOD))
    assert list(row) == REPORT_COLUMNS
    assert row["stage"] == "S,R,S,A"
    assert row["total_submit_len"] == 5 and row["total_cra_time"] == 1
    assert row["submission_round"] == 2 and row["rejection_round"] == 1
    assert row["data_issues"] == ""
    assert row["process_issues"] == ""
    assert row["planmvtyp"] == "Monitoring Visit Report" and row["planmvstat"] == "Completed"
    assert row["current_stage"] == "Approved" and row["site_monitors"] == "Mo Nitor"
    assert row["country"] == "Estonia" and row["gp_pn"] == "CD2"
    assert row["submission_next"] == "2024-06-01,2024-06-03;2024-06-03,2024-06-05"
    assert row["reject_submit"] == "2024-06-03,2024-06-03"
    assert row["planned_visit"] is None and row["performed_visit"] == 1
    assert row["calc_mv_2_submit"] == 4 and row["calc_submit_2_approve"] == 5


def test_open_submission_runs_to_the_report_date(spark):
    row = one(spark, mv=chain((1, "2024-06-10")))
    assert row["last_submit_len"] == 5 and row["submission_next"] is None
    assert row["current_stage"] == "Submitted"


def test_next_step_earlier(spark):
    row = one(spark, mv=chain((1, "2024-06-02"), (3, "2024-06-01")))
    assert row["last_submit_len"] == 1
    assert "Wrong order of dates in pair(s) of stages; Subm-Next" in row["data_issues"]


def test_never_submitted(spark):
    row = one(spark, mv=chain((3, "2024-06-05")))
    assert row["total_submit_len"] is None and row["submission_round"] == 0
    assert "Missing at least 1 submission stage" in row["data_issues"]
    assert "Wrong stage order" in row["data_issues"]
    assert "Exceeded: Time after MV without a report" in row["process_issues"]


def test_unknown_performance_drops_the_visit(spark):
    row = one(spark, mv=chain(*GOOD, mvperf=None))
    assert row["planmvstat"] == "Completed-missing MV"
    assert row["planned_visit"] is None and row["performed_visit"] is None
    assert row["stage"] == "NA" and row["submission_round"] == 0


def test_visit_without_plan(spark):
    row = one(spark, mv=chain(*GOOD), plan=[])
    assert row["planmvstat"] == "Missing plan" and row["performed_visit"] == 1
    assert row["planmvtyp"] == "Monitoring Visit Report"


def test_pair_of_other_type_is_shown_twice(spark):
    rows = report(spark, mv=chain(*GOOD), plan=[dict(planmvtyp=1)])
    assert sorted(r["planmvtyp"] for r in rows) == [
        "Monitoring Visit Report", "Site Initiation Visit Report",
    ]


def test_plan_and_visit_with_missing_start_do_not_meet(spark):
    rows = report(spark, mv=chain(*GOOD, mvdat=None), plan=[dict(planmvdat=None)])
    assert sorted(r["planmvstat"] for r in rows) == ["Completed-missing MV", "Missing plan"]


def test_limits(spark):
    late = one(spark, mv=chain((1, "2024-06-05"), (3, "2024-06-12")))
    assert late["calc_mv_2_submit"] == 8 and late["first_submission_on_time"] == 0
    assert late["calc_mv_2_approve"] == 15 and late["finalization_on_time"] == 0
    assert late["process_issues"].split(",") == [
        "Exceeded: Time spent in the latest SUBM", "Exceeded: Time MV end + 1 → 1st SUBM",
        "Exceeded: Time MV end + 1 → APPR ", "Exceeded: Time 1st SUBM → APPR",
    ]
    in_time = one(spark, mv=chain((1, "2024-06-04"), (3, "2024-06-11")))
    assert in_time["calc_mv_2_approve"] == 14 and in_time["finalization_on_time"] == 1


def test_every_site_of_the_document_is_shown(spark):
    rows = report(spark, mv=chain(*GOOD), site=[{}, dict(siteid=" s\t2", sitemonseq="2")])
    assert sorted(r["siteid"] for r in rows) == ["s1", "s2"]


def test_monitor_without_first_name(spark):
    row = one(spark, mv=chain(*GOOD), site=[dict(sitemonfirst=None)])
    assert row["site_monitors"] is None and row["data_issues"] == "Missing monitor name"


def test_monitors_repeat_for_copies_of_a_plan(spark):
    site = [{}, dict(sitemonfirst="Ab"), dict(sitemonfirst="Ab")]
    row = one(spark, mv=chain(*GOOD), plan=[{}, {}], site=site)
    assert row["site_monitors"] == ",".join(["Ab Nitor"] * 4 + ["Mo Nitor"] * 2)


def test_control_words_ignore_case_and_trailing_spaces(spark):
    row = one(spark, mv=chain(*GOOD, record_status="Complete "), link=[dict(tblname="plan ")])
    assert row["site_monitors"] == "Mo Nitor"


def test_overdue_plan(spark):
    row = one(spark, mv=[], plan=[dict(planmvstat=1)])
    assert row["process_issues"] == "Overdue plan" and row["planned_visit"] == 1


def test_plan_duration(spark):
    weekend = dict(planmvdat="2024-01-05", planmvendat="2024-01-08")
    for days, issue in ((4, False), (2, False), (3, True)):
        row = one(spark, mv=[], plan=[dict(weekend, planmvdurat=days)])
        assert ("Incorrect planned duration" in row["data_issues"]) is issue


def test_next_step_by_key(spark):
    def following(**usual):
        rows = study(spark, mv=[dict(usual, approvalid=1), dict(usual, approvalid=5)]).mv
        found = next_approval(complete_approvals(rows)).collect()
        return {r["approvalid"]: r["next_approval_id"] for r in found}

    assert following() == {1: 5, 5: None}
    assert following(mvseq=None) == {1: 5, 5: None}
    assert following(docid=None) == {1: None, 5: None}
    assert following(sitecounter=None) == {1: None, 5: None}


def test_facts_collapse_copies_and_keep_each_next_date(spark):
    mv = chain((1, "2024-06-01"), (2, "2024-06-03")) * 2
    mv += [dict(approvalid=2, approvalstage=2, approvaldat="2024-06-04")]
    facts = approval_facts(complete_approvals(study(spark, mv=mv).mv), AS_OF).collect()
    first = [f for f in facts if f["approvalid"] == 1]
    assert sorted(str(f["next_date"]) for f in first) == ["2024-06-03", "2024-06-04"]
    assert len(facts) == 4


def test_step_dates_of_other_site_counters_are_attached(spark):
    mv = chain((1, "2024-06-01"), sitecounter="1") + chain((1, "2024-06-02"), sitecounter="2")
    rows = report(spark, mv=mv)
    dates = {(str(r["first_submission"]), str(r["latest_submission"])) for r in rows}
    assert len(dates) == 4
    # Each of the two visits, told apart by its own duration, with every pair of dates.
    assert len(rows) == 8 and {r["total_submit_len"] for r in rows} == {13, 14}


def test_studies_stay_apart(spark):
    north = study(spark, "north", mv=chain(*GOOD))
    south = study(spark, "south", mv=[])
    rows = studies_report(all_studies([north, south]), AS_OF).collect()
    assert {r["study_prefix"]: r["planmvstat"] for r in rows} == {
        "north": "Completed", "south": "Completed-missing MV",
    }
