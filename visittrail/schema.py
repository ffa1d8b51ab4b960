"""Schemas of the six tables of a study and of the catalog listing."""

from visittrail.fixed_values import EXPECTED_COLUMNS

# Every study row carries the study it belongs to; keys start with it.
STUDY = "study_prefix"

DATES = {"planmvdat", "planmvendat", "mvdat", "mvdate2", "approvaldat"}
INTEGERS = {
    "approvalstage", "approvalid", "planmvstat", "planmvtyp", "planmvdurat", "visitid", "mvperf",
}
# Identifiers nothing computes with: they keep the type the source has.
OPAQUE_KEYS = {
    "docid", "sitecounter", "planspid", "planmvid", "mvseq", "sitemonseq",
    "sitecounter_t", "sitemonseq_t",
}
# Words compared without regard to case or trailing spaces.
CONTROL_WORDS = {"record_status", "tblname", "tblname_t", "fldname"}

TABLE_COLUMNS = {
    "plan": EXPECTED_COLUMNS["plan"],
    "mv": EXPECTED_COLUMNS["mv"],
    "site": [
        "docid", "siteid", "sitemonfirst", "sitemonlast", "sitemonact", "sitemondeact",
        "countryid", "sitemonseq", "record_status",
    ],
    "sites": ["label", "sitecode"],
    "study": ["studyid", "docid"],
    "link": [
        "docid", "countryid", "planspid", "tblname", "fldname", "sitecounter_t", "countryid_t",
        "siteid_t", "sitemonseq_t", "tblname_t",
    ],
}


def column_type(name: str) -> str:
    if name in DATES:
        return "date"
    return "int" if name in INTEGERS else "string"
