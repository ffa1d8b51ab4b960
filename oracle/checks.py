"""One SQL statement per query, over the tables of the driver."""

from oracle.tables import (
    APPROVAL_BASE,
    PLAN_BASE,
    SLICE,
    STORED,
    TODAY,
    clean,
    decoded,
    day_number,
    elapsed,
    on_time,
    sunday,
    weekdays,
    weekend,
    with_tables,
)
from visittrail.fixed_values import (
    BAD_STAGE_PAIRS,
    PROTOCOL_ALIASES,
    REPORT_COLUMNS,
    STAGE_ISSUES,
    VISIT_TYPE_NAMES,
)
from visittrail.schema import TABLE_COLUMNS
from visittrail.sources.warehouse import STORED_STUDIES

VISIT = "docid, sitecounter, countryid, visitid, mvseq"
MILESTONES = (
    "docid, planspid, mvdat, mvendat, first_submission, latest_rejection, approval_date"
)
DAY_COUNTS = [
    "calc_mv_len", "calc_mv_2_submit", "calc_submit_2_reject", "calc_mv_2_approve",
    "calc_submit_2_approve",
]
KIND = "CASE " + " ".join(
    f"WHEN table_name LIKE 'repdata%{kind}' THEN '{kind}'"
    for kind in ("mv", "plan", "site", "sites", "study")
) + " END"
BAD_ORDER = "stage NOT LIKE 'S%' OR " + " OR ".join(
    f"stage LIKE '{pair}'" for pair in BAD_STAGE_PAIRS
)


def scan(kind: str, source: str) -> str:
    return f"SELECT {', '.join(TABLE_COLUMNS[kind])} FROM {source}"


STATEMENTS = {
    "scan_plan": scan("plan", "plan_rows"),
    "scan_approvals": scan("mv", "approval_rows"),
    "scan_site": scan("site", "site_rows"),
    "scan_site_labels": scan("sites", "site_label_rows"),
    "scan_study": scan("study", "study_rows"),
    "scan_link": scan("link", "link_rows"),
    "catalog_tables": f"SELECT table_name, {KIND} AS kind FROM table_rows",
    "catalog_columns": "SELECT table_name, column_name FROM column_rows",
    "catalog_prefixes": "SELECT prefix FROM prefixes",
    "layout_counts": "SELECT * FROM mv_count",
    "layout_matrix": "SELECT * FROM matrix",
    "layout_classify": "SELECT * FROM classes",
    "complete_plans": f"SELECT {PLAN_BASE} FROM plan_rows WHERE record_status = 'complete'",
    "plan_site_links": "SELECT * FROM link_ok",
    "performed_visits": f"SELECT {VISIT}, mvperf, mvdat, mvendat FROM summary WHERE mvperf <> 2",
    "submissions": "SELECT * FROM submitted",
    "rejections": "SELECT * FROM rejected",
    "weekend_flags": f"""
        SELECT planspid, planmvdat, CAST({day_number('planmvdat')} AS INTEGER) AS weekday,
            {weekend('planmvdat')} AS is_weekend FROM plan_rows""",
    "decode_codes": f"""
        SELECT visitid, approvalstage,
            {decoded('approvalstage', {1: 'S', 2: 'R', 3: 'A'})} AS stage,
            {decoded('visitid', VISIT_TYPE_NAMES)} AS visit_type, count(*) AS n
        FROM approval_rows GROUP BY visitid, approvalstage""",
    "plan_flags": "SELECT * FROM plan_ok",
    "plan_duration_check": f"""
        SELECT planspid, planmvdat, planmvendat, planmvdurat,
            CAST(planmvendat - planmvdat + 1 AS INTEGER) AS calendar_days,
            {weekdays('planmvendat', 'planmvdat')} AS weekdays, data_issue_incorrect_plan_durat
        FROM plan_ok""",
    "current_stage": f"""
        SELECT {VISIT}, stage, CASE right(stage, 1) WHEN 'S' THEN 'Submitted'
            WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Rejected' END AS current_stage FROM summary""",
    "stage_order_check": f"""
        SELECT {VISIT}, stage, CASE WHEN {BAD_ORDER} THEN 1 END AS data_issue_wrong_stage_order
        FROM summary""",
    "report_defaults":
        "SELECT docid, mvseq, mvdat, submission_round, rejection_round, stage FROM shown",
    "report_stage": """
        SELECT docid, planspid, planmvstat, current_stage,
            CASE WHEN planmvstat IN (1, 3) THEN NULL ELSE current_stage END AS shown_stage
        FROM counted""",
    "protocol_alias": f"""
        SELECT docid, studyid AS protocolnumber,
            {decoded('studyid', PROTOCOL_ALIASES, 'NULL')} AS fixed_alias, alias AS gp_pn
        FROM study_rows LEFT JOIN alias_rows ON studyid = protocol""",
    "plan_links": """
        SELECT docid, planspid, countryid, siteid_t, countryid_t, sitemonseq_t FROM plan_linked""",
    "plan_monitors": "SELECT * FROM plan_monitor",
    "plan_monitors_agg": "SELECT * FROM plan_agg",
    "monitor_name": f"""
        SELECT docid, siteid, {clean('sitemonfirst')} || ' ' || {clean('sitemonlast')}
            AS monitor_name FROM site_rows""",
    "next_approval": "SELECT * FROM approval_next",
    "next_approval_date":
        f"SELECT {APPROVAL_BASE}, next_date, next_approval_id, next_stage_reject "
        "FROM approval_dated",
    "open_stage_age": f"""
        SELECT {VISIT}, approvalid, approvaldat, {TODAY} AS next_date,
            CAST({TODAY} - approvaldat AS INTEGER) AS open_days
        FROM approval_next WHERE next_approval_id IS NULL AND approvalstage IN (1, 2)""",
    "approval_facts": "SELECT * FROM facts",
    "submission_duration": f"""
        SELECT {VISIT}, approvalid, approvaldat, next_date, submission_duration FROM facts
        WHERE stage = 'S'""",
    "rejection_duration": f"""
        SELECT {VISIT}, approvalid, approvaldat, next_date, rejection_duration FROM facts
        WHERE stage = 'R'""",
    "durations":
        f"SELECT docid, planspid, mvdat, mvendat, {', '.join(DAY_COUNTS)} FROM counted",
    "visit_summary": "SELECT * FROM summary",
    "visit_names": f"""
        SELECT {VISIT}, mvrepname, submitter_name, stagesubmittorname, approvalname, reviewername
        FROM summary""",
    "stage_sequence": f"SELECT {VISIT}, stage FROM summary",
    "stage_date_pairs": f"SELECT {VISIT}, submission_next, reject_submit FROM summary",
    "visit_rounds": f"SELECT {VISIT}, submission_round, rejection_round FROM summary",
    "visit_issue_counts": f"SELECT {VISIT}, {', '.join(STAGE_ISSUES)} FROM summary",
    "review_time": f"SELECT {VISIT}, total_submit_len FROM summary",
    "author_time": f"SELECT {VISIT}, total_cra_time FROM summary",
    "visit_first_submission": """
        SELECT v.docid, v.sitecounter, v.countryid, v.visitid, v.mvseq,
            v.first_submission_approvalid, f.approvaldat AS first_submission
        FROM summary v LEFT JOIN submitted f ON v.docid = f.docid AND v.countryid = f.countryid
            AND v.visitid = f.visitid AND v.mvseq IS NOT DISTINCT FROM f.mvseq
            AND v.first_submission_approvalid = f.approvalid""",
    "visit_last_submission": """
        SELECT v.docid, v.sitecounter, v.countryid, v.visitid, v.mvseq,
            v.latest_submission_approvalid, f.approvaldat AS latest_submission,
            f.submission_duration AS last_submit_len
        FROM summary v LEFT JOIN submitted f ON v.docid = f.docid AND v.countryid = f.countryid
            AND v.visitid = f.visitid AND v.mvseq IS NOT DISTINCT FROM f.mvseq
            AND v.latest_submission_approvalid = f.approvalid""",
    "visit_last_rejection": """
        SELECT v.docid, v.sitecounter, v.countryid, v.visitid, v.mvseq,
            v.latest_rejection_approvalid, f.approvaldat AS latest_rejection,
            f.rejection_duration AS last_reject_len
        FROM summary v LEFT JOIN rejected f ON v.docid = f.docid AND v.countryid = f.countryid
            AND v.visitid = f.visitid AND v.mvseq IS NOT DISTINCT FROM f.mvseq
            AND v.latest_rejection_approvalid = f.approvalid""",
    "visit_stage_dates": "SELECT * FROM staged",
    "visit_flags": "SELECT * FROM checked",
    "plan_left_visit": "SELECT * FROM pv_left",
    "plan_right_visit": "SELECT * FROM pv_right",
    "completed_missing_visit": """
        SELECT docid, countryid, planspid, planmvdat, planmvstat FROM pv_left
        WHERE planmvstat = 9""",
    "plan_visit_reconcile": "SELECT * FROM pv",
    "site_country": """
        SELECT docid, siteid, countryid, label AS country FROM site_ok
        JOIN site_label_rows ON left(countryid, 3) = left(sitecode, 3)""",
    "site_directory": "SELECT * FROM directory",
    "clean_text": f"""
        SELECT docid, siteid, {clean('siteid')} AS site, {clean('sitemonfirst')} AS first_name
        FROM site_rows""",
    "week_start": f"SELECT planspid, planmvdat, {sunday('planmvdat')} AS week_start FROM plan_rows",
    "weekdays_between": f"""
        SELECT planspid, planmvdat, planmvendat, {weekdays('planmvdat', 'planmvendat')} AS weekdays,
            {weekdays('planmvendat', 'planmvdat')} AS weekdays_back
        FROM plan_rows""",
    "period_label": """
        SELECT planspid, CAST(year(planmvendat) AS VARCHAR) || '.'
            || CAST(month(planmvendat) AS VARCHAR) AS period_planned_visit
        FROM plan_rows""",
    **{name: f"SELECT {MILESTONES}, {name} FROM counted" for name in DAY_COUNTS},
    "data_issues": "SELECT docid, planmvdat, mvdat, mvseq, data_issues FROM shown",
    "process_issues": "SELECT docid, planmvdat, mvdat, mvseq, process_issues FROM shown",
    "issue_text": """
        SELECT data_issues, process_issues, count(*) AS n FROM shown
        GROUP BY data_issues, process_issues""",
    "visit_counters": """
        SELECT docid, planspid, planmvstat, CASE WHEN planmvstat = 1 THEN 1 END AS planned_visit,
            CASE WHEN planmvstat = 2 OR planmvstat IS NULL THEN 1 END AS performed_visit
        FROM counted""",
    "on_time_flags": f"""
        SELECT docid, mvdat, mvseq, calc_mv_2_submit,
            {on_time('calc_mv_2_submit', 7)} AS first_submission_on_time, calc_mv_2_approve,
            {on_time('calc_mv_2_approve', 14)} AS finalization_on_time
        FROM counted""",
    "visit_report": f"SELECT {', '.join(REPORT_COLUMNS)} FROM report",
    "all_studies": f"""
        SELECT 'north' AS study_prefix, {', '.join(REPORT_COLUMNS)} FROM report UNION ALL
        SELECT 'south' AS study_prefix, {', '.join(REPORT_COLUMNS)} FROM report""",
}

STATEMENTS |= {
    "study_readiness": "SELECT * FROM readiness",
    "sql_functions": f"""
        SELECT docid, planspid, {clean("' ' || CAST(planspid AS VARCHAR) || '  ' || countryid")}
                AS label, {weekdays('planmvdat', 'planmvendat')} AS weekdays,
            {sunday('planmvdat')} AS week_start, {elapsed('planmvdat', 'planmvendat', 1)} AS days,
            CAST(CASE WHEN planmvendat <= planmvdat THEN 1
                WHEN planmvendat > planmvdat THEN {weekdays('planmvdat', 'planmvendat')} END
                AS INTEGER) AS visit_length,
            CAST(year(planmvdat) AS VARCHAR) || '.' || CAST(month(planmvdat) AS VARCHAR) AS period,
            {weekend('planmvdat')} AS is_weekend
        FROM plan_rows""",
}

# Row-by-row results once more with equal rows counted.
STATEMENTS |= {
    f"{name}_counted": f"SELECT *, count(*) AS n FROM ({STATEMENTS[name]}) GROUP BY ALL"
    for name in (
        "plan_links", "plan_monitors", "next_approval_date", "visit_first_submission",
        "visit_last_submission", "visit_last_rejection", "visit_stage_dates", "visit_flags",
        "plan_left_visit", "plan_right_visit",
    )
}

_OF_STUDY = f"(SELECT DISTINCT {SLICE} AS slice FROM study_rows)"
_STORED_COLUMNS = ", ".join(
    f"({i}, '{prefix}{kind}', '{name}')"
    for i, (prefix, missing) in enumerate(STORED_STUDIES)
    for kind, names in TABLE_COLUMNS.items() for name in names
    if name not in missing.get(kind, ())
)
_STORED_LAYOUTS = {
    "repdata_s0": (1, None), "repdatas1": (2, None), "repdata_s2": (3, None),
    "repdatas3": (4, None), "repdata_s4": (0, "plan has 9 of 10 columns"),
    "repdata_s5": (1, "no link table"), "repdata_s6": (1, None),
}
_LAYOUT_ROWS = ", ".join(
    f"({i}, '{prefix}', {_STORED_LAYOUTS[prefix][0]}, "
    + ("NULL" if _STORED_LAYOUTS[prefix][1] is None else f"'{_STORED_LAYOUTS[prefix][1]}'") + ")"
    for i, (prefix, _) in enumerate(STORED_STUDIES)
)
STORED_STATEMENTS = {
    "database_columns": f"""
        SELECT table_name, column_name FROM {_OF_STUDY}
        JOIN (VALUES {_STORED_COLUMNS}) AS e(slice, table_name, column_name) USING (slice)""",
    "database_layouts": f"""
        SELECT prefix, query_number, reason IS NULL AS report_ready, reason FROM {_OF_STUDY}
        JOIN (VALUES {_LAYOUT_ROWS}) AS e(slice, prefix, query_number, reason) USING (slice)""",
    "database_report": f"""
        SELECT prefix AS study_prefix, {', '.join(REPORT_COLUMNS)} FROM report
        JOIN (VALUES {_LAYOUT_ROWS}) AS e(slice, prefix, query_number, reason) USING (slice)
        WHERE reason IS NULL""",
}

CHECKS = {name: with_tables(statement) for name, statement in STATEMENTS.items()} | {
    name: with_tables(statement, STORED) for name, statement in STORED_STATEMENTS.items()
}
