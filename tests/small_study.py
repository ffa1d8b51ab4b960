"""A study written row by row; what a row leaves out is filled with an unremarkable value."""

import datetime

from visittrail.schema import TABLE_COLUMNS, column_type
from visittrail.sources.studies import StudyTables, normalized

AS_OF = datetime.date(2024, 6, 14)

USUAL = {
    "plan": dict(docid="d1", countryid="001-S", planspid="p1", planmvtyp=2, planmvid="p1",
                 planmvdat="2024-05-27", planmvendat="2024-05-28", planmvdurat=2, planmvstat=2,
                 record_status="complete"),
    "mv": dict(docid="d1", sitecounter="1", countryid="001-S", visitid=2, approvalid=1, mvseq="1",
               mvperf=1, mvrepname="rep", mvdat="2024-05-27", mvdate2="2024-05-28",
               approvalstage=1, approvaldat="2024-06-01", approvalname="ann",
               record_status="complete"),
    "site": dict(docid="d1", siteid="s1", sitemonfirst="Mo", sitemonlast="Nitor",
                 countryid="001-S", sitemonseq="1", record_status="complete"),
    "sites": dict(label="Estonia", sitecode="001"),
    "study": dict(studyid="CD2", docid="d1"),
    "link": dict(docid="d1", countryid="001-S", planspid="p1", tblname="PLAN",
                 fldname="link_mvplanning", sitecounter_t="1", countryid_t="001-S",
                 siteid_t="s1", sitemonseq_t="1", tblname_t="SITE"),
}


def study(spark, prefix="p", **rows):
    """Tables from lists of changes to the usual row; one usual row where none are given."""
    def table(kind):
        fields = ", ".join(
            f"{c} {column_type(c) if column_type(c) != 'date' else 'string'}"
            for c in TABLE_COLUMNS[kind]
        )
        values = [
            tuple({**USUAL[kind], **change}.get(c) for c in TABLE_COLUMNS[kind])
            for change in rows.get(kind, [{}])
        ]
        return normalized(kind, spark.createDataFrame(values, fields), prefix)

    return StudyTables(**{kind: table(kind) for kind in TABLE_COLUMNS})


def chain(*steps, **usual):
    """Approval rows of one visit from (stage, date) pairs, numbered from 1."""
    return [
        dict(usual, approvalid=i, approvalstage=stage, approvaldat=date)
        for i, (stage, date) in enumerate(steps, 1)
    ]
