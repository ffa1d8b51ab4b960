"""Planned visits: validation and the monitors behind each plan."""

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from visittrail.fixed_values import COMPLETE, MONITOR_LINK, PLAN_ISSUES
from visittrail.functions import is_weekend, monitor_name, repeated, weekdays_between
from visittrail.operators.counted import COUNT, counted, expanded, joined, summed
from visittrail.schema import STUDY
from visittrail.sources.studies import TYPED_PLANS

PLAN_KEY = [STUDY, "docid", "planspid", "countryid"]
# The same in the order rows are sorted by: documents tell most rows apart, studies few.
PLAN_ORDER = ["docid", "countryid", "planspid", STUDY]
# Rows of a document and country are put in one partition, once. All that follows is grouped and
# joined by at least these columns and therefore stays there. The study is left out: where it is
# the same for all rows, Spark takes it out of the groupings and would shuffle again.
TOGETHER = ["docid", "countryid"]
PLAN_COLUMNS = [
    STUDY, "docid", "countryid", "planspid", "planmvtyp", "planmvid", "planmvdat",
    "planmvdurat", "planmvendat", "planmvstat",
]


def together(rows: DataFrame) -> DataFrame:
    # A study that is the same for all rows is taken out of sorts, but not out of all groupings,
    # which then count as unsorted. So it is made to look as if it hung on the document.
    first = F.pmod(F.hash("docid"), F.lit(1)) + 1
    return rows.repartition(*TOGETHER).withColumn(STUDY, F.elt(first, F.col(STUDY)))


def in_order(rows: DataFrame, keys: list[str]) -> GroupedData:
    """Groups of rows that lie together, sorted first: a group is read through and no table is kept.

    Spark would hash the groups in part, then in full, and sort both wherever a list is gathered.
    """
    return rows.sortWithinPartitions(*keys).groupBy(*keys)


def complete_rows(table: DataFrame) -> DataFrame:
    return table.filter(F.col("record_status") == COMPLETE).drop("record_status")


def plan_flags(plan: DataFrame) -> DataFrame:
    """Complete plans with a 1 in the column of each finding."""
    start, end, days = F.col("planmvdat"), F.col("planmvendat"), F.col("planmvdurat")
    findings = {
        "data_issue_missing_plan_start_date": start.isNull(),
        "data_issue_missing_plan_end_date": end.isNull(),
        "data_issue_missing_plan_durat": days.isNull(),
        "data_issue_incorrect_plan_durat": (days != F.datediff(end, start) + 1)
        & (days != weekdays_between(end, start)),
        "data_issue_planned_visit_type": F.col("planmvtyp").isNull() & F.col(TYPED_PLANS),
        "data_issue_plan_start_after_end": start > end,
        "data_issue_plan_state_date_is_weekend": is_weekend(start),
        "data_issue_plan_end_date_is_weekend": is_weekend(end),
    }
    return complete_rows(plan).select(
        *PLAN_COLUMNS, *(F.when(found, 1).alias(flag) for flag, found in findings.items())
    )


def distinct_plans(flagged: DataFrame) -> DataFrame:
    """Each different plan once, without its findings, which follow from it."""
    return flagged.select(*PLAN_COLUMNS).distinct()


def plan_site_links(link: DataFrame) -> DataFrame:
    """Links from a plan to the site entry of its monitor."""
    for column, word in MONITOR_LINK.items():
        link = link.filter(F.col(column) == word)
    return link.select(
        *PLAN_KEY, "sitecounter_t", "countryid_t", "siteid_t", "sitemonseq_t"
    )


def counted_plan_links(plans: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct plans with each of their distinct link targets, and how many rows these stand for."""
    targets = counted(links.select(*PLAN_KEY, *_link_target()))
    return joined(counted(plans), targets, PLAN_KEY).select(
        *plans.columns, *_link_target(), COUNT)


def plan_links(plans: DataFrame, links: DataFrame) -> DataFrame:
    """Every plan with each of its links."""
    return expanded(counted_plan_links(plans, links))


def counted_plan_monitors(plans: DataFrame, links: DataFrame, site: DataFrame) -> DataFrame:
    """Distinct plans with each name of a linked site entry, and how many rows these stand for."""
    linked = counted_plan_links(plans, links)
    name = monitor_name(F.col("sitemonfirst"), F.col("sitemonlast")).alias("site_monitor")
    staff = counted(complete_rows(site).select(
        F.col(STUDY).alias("site_study"), "siteid", F.col("countryid").alias("site_country"),
        "sitemonseq", name))
    same = (
        (F.col(STUDY) == F.col("site_study")) & (F.col("siteid_t") == F.col("siteid"))
        & (F.col("countryid_t") == F.col("site_country"))
        & (F.col("sitemonseq_t") == F.col("sitemonseq"))
    )
    return summed(joined(linked, staff, same).select(*plans.columns, "site_monitor", COUNT))


def plan_monitors(plans: DataFrame, links: DataFrame, site: DataFrame) -> DataFrame:
    """One row per plan, link and monitor of the linked site entry."""
    return expanded(counted_plan_monitors(plans, links, site))


def plan_monitors_agg(plans: DataFrame, links: DataFrame, site: DataFrame) -> DataFrame:
    """Distinct plans with the names of all their monitors as text.

    Names are counted per site entry and then per plan key, so copies of a site entry or of
    a plan do not multiply; a plan meets at most one row of names.
    """
    site = complete_rows(site)
    site_key = [STUDY, "siteid", "countryid", "sitemonseq"]
    name = monitor_name(F.col("sitemonfirst"), F.col("sitemonlast")).alias("name")
    staff = (
        site.select(*site_key, name).dropna()
        .groupBy(*site_key, "name").agg(F.count(F.lit(1)).alias("staff"))
    )
    named = links.join(staff, _same_site(links, staff)).select(
        *(links[c] for c in PLAN_KEY), "name", "staff")
    counted_names = together(named).groupBy(*PLAN_KEY, "name").agg(F.sum("staff").alias("n"))
    monitors = in_order(counted_names, PLAN_ORDER).agg(
        F.collect_list(F.struct("name", "n")).alias("monitors"))
    # Copies of a plan have the same findings, but for the type that its table may not record.
    findings = [c for c in PLAN_ISSUES if c != "data_issue_planned_visit_type"]
    distinct = [c for c in [*PLAN_COLUMNS, *PLAN_ISSUES] if c not in (*PLAN_ORDER, *findings)]
    copies = in_order(together(plans), [*PLAN_ORDER, *distinct]).agg(
        F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in findings))
    return (
        copies.join(monitors, PLAN_ORDER, "left")
        .withColumn("site_monitors", _names_text("monitors", "copies"))
        .select(
            *PLAN_COLUMNS,
            "site_monitors",
            *PLAN_ISSUES,
            F.when(F.col("site_monitors").isNull(), 1).alias("data_issue_missing_monitor_name"),
        )
    )


def _names_text(monitors: str, copies: str):
    """Names in order, each as often as it occurs over all copies of the plan."""
    return F.array_join(F.transform(
        F.sort_array(monitors),
        lambda m: repeated(m["name"], m["n"] * F.col(copies), ","),
    ), ",")


def _link_target() -> list[str]:
    return ["siteid_t", "countryid_t", "sitemonseq_t"]


def _same_site(links: DataFrame, site: DataFrame):
    return (
        (links[STUDY] == site[STUDY])
        & (links["siteid_t"] == site["siteid"])
        & (links["countryid_t"] == site["countryid"])
        & (links["sitemonseq_t"] == site["sitemonseq"])
    )
