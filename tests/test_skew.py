"""Visits with very many steps or copies, against a count in plain Python."""

import pytest
from pyspark.sql import functions as F

from tests.small_study import AS_OF, chain, study
from visittrail.operators import approvals as A
from visittrail.operators import plans as P
from visittrail.operators import reconcile as R
from visittrail.operators import sites as S
from visittrail.operators import visits as V
from visittrail.operators.counted import counted, expanded, once
from visittrail.plans.report import plans_with_monitors, visit_report


def long_visit(spark, numbers):
    return study(spark, mv=[
        dict(approvalid=n, approvalstage=1 if n % 2 else 2, approvaldat=f"2024-06-{n % 9 + 1:02}")
        for n in numbers
    ])


@pytest.mark.parametrize("numbers", [
    list(range(1, 2500)),
    [1, 2, 1023, 1024, 1025, 5000, 9000, 70000],
    [3000, 3001, 9000],
    [-5, -1, 0, 4, 4096],
])
def test_steps_are_linked_across_blocks(spark, numbers):
    rows = A.complete_approvals(long_visit(spark, numbers).mv)
    found = {r["approvalid"]: r["next_approval_id"] for r in A.next_approval(rows).collect()}
    assert found == dict(zip(numbers, [*numbers[1:], None]))
    dates = {r["approvalid"]: r["approvaldat"] for r in rows.collect()}
    facts = A.approval_facts(rows, AS_OF).collect()
    following = dict(zip(numbers, numbers[1:]))
    assert {f["approvalid"]: f["next_date"] for f in facts} == {
        n: dates[following[n]] if n in following else AS_OF for n in numbers
    }


def test_texts_of_a_long_visit_follow_its_numbers(spark):
    """60,000 steps: the texts are put together from blocks, in the order of the numbers."""
    number = F.explode(F.sequence(F.lit(-30_000), F.lit(29_999)))
    base = study(spark, mv=[{}]).mv.drop("approvalid").withColumn("approvalid", number)
    long = base.withColumns({
        "approvalstage": F.pmod("approvalid", F.lit(3)).cast("int") + 1,
        "approvalname": F.concat(F.lit("n"), F.pmod("approvalid", F.lit(4)).cast("string")),
        "approvaldat": F.when(F.col("approvalid") % 1000 != 0, F.col("approvaldat")),
    })
    unnumbered = base.limit(1).withColumns(
        {"approvalid": F.lit(None).cast("int"), "approvalstage": F.lit(3)})
    rows = A.complete_approvals(long.unionByName(unnumbered))
    row = V.visit_summary(A.approval_steps(rows, A.step_chain(rows), AS_OF)).first()
    letters = ["SRA"[n % 3] for n in range(-30_000, 30_000)]
    assert row["stage"] == ",".join(["A", *letters])
    assert row["stagesubmittorname"] == "n0,n1,n2,n3"
    assert row["submission_round"] == letters.count("S") == 20_000
    dated = [n for n in range(-30_000, 29_999) if n % 3 == 0 and n % 1000 and (n + 1) % 1000]
    assert row["submission_next"].count(";") == len(dated) - 1
    assert row["data_issue_missing_first_submission_date"] == 0


def test_copies_of_steps_do_not_multiply(spark):
    """5,000 copies of each of three steps, entered by different people."""
    base = study(spark, mv=chain((1, "2024-06-01"), (2, "2024-06-03"), (3, "2024-06-04")))
    people = spark.range(5000).select(F.col("id").cast("string").alias("person"))
    crowd = base.mv.drop("username").join(people, F.lit(True)).withColumn(
        "username", F.col("person")
    ).drop("person")
    tables = type(base)(**{**base.__dict__, "mv": crowd})
    row = visit_report(tables, AS_OF).first()
    assert row["submission_round"] == 5000 and row["rejection_round"] == 5000
    assert row["stage"] == ",".join(["S"] * 5000 + ["R"] * 5000 + ["A"] * 5000)
    assert row["total_submit_len"] == 15000
    assert row["latest_rejection"].isoformat() == "2024-06-03"


def test_many_site_counters_share_one_step(spark):
    mv = [dict(sitecounter=str(i), approvaldat=f"2024-06-{i % 3 + 1:02}") for i in range(300)]
    rows = visit_report(study(spark, mv=mv), AS_OF).collect()
    # Site counters are not shown: what remains are 3 durations by 9 pairs of dates.
    assert len(rows) == 27
    assert len({(r["first_submission"], r["latest_submission"]) for r in rows}) == 9


def test_negative_numbers_use_several_blocks(spark):
    numbers = list(range(-5000, 0, 7))
    rows = A.complete_approvals(long_visit(spark, numbers).mv)
    found = {r["approvalid"]: r["next_approval_id"] for r in A.next_approval(rows).collect()}
    assert found == dict(zip(numbers, [*numbers[1:], None]))
    assert A._outcomes(rows).select("block").distinct().count() == 5


def test_codes_of_a_country_do_not_multiply_its_sites(spark):
    """1,000 sites and 1,000 codes of one country: one label row per site."""
    site = [dict(docid=str(i), siteid=f"s{i}", countryid="001-S") for i in range(1000)]
    sites = [dict(label="Land", sitecode=f"001{i}") for i in range(1000)]
    rows = [dict(docid=str(i), studyid="P") for i in range(1000) for _ in range(2)]
    tables = study(spark, mv=[], site=site, sites=sites, study=rows)
    joined = S._with_protocol(tables.site, tables.sites, tables.study)
    assert joined.count() == 1000


def crowded(spark, copies=5000):
    """A study with 5,000 copies of each row that joins read: steps, links, sites and plans."""
    base = study(spark, mv=chain((1, "2024-06-01"), (2, "2024-06-03"), (1, "2024-06-04")))
    times = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    return type(base)(**{
        kind: table.withColumn("copy", times).drop("copy") if kind in ("mv", "link", "site", "plan")
        else table for kind, table in vars(base).items()})


def test_copies_are_counted_through_joins(spark):
    tables = crowded(spark)
    n = 5000
    flagged, links = P.plan_flags(tables.plan), P.plan_site_links(tables.link)
    assert [r["n"] for r in P.counted_plan_links(flagged, links).collect()] == [n ** 2]
    found = P.counted_plan_monitors(flagged, links, tables.site).collect()
    assert [(r["site_monitor"], r["n"]) for r in found] == [("Mo Nitor", n ** 3)]
    rows = A.complete_approvals(tables.mv)
    dated = {r["approvalid"]: r["n"] for r in A.counted_next_approval_date(rows, AS_OF).collect()}
    assert dated == {1: n, 2: n, 3: 1}


def test_copies_of_key_steps_are_counted(spark):
    """Steps entered by 5,000 people each: 5,000 rows of the first, last and rejected step."""
    base = study(spark, mv=chain((1, "2024-06-01"), (2, "2024-06-03"), (1, "2024-06-04")))
    people = F.explode(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda i: i.cast("string")))
    rows = A.complete_approvals(base.mv.withColumn("username", people))
    facts = A.approval_facts(rows, AS_OF)
    summary = V.visit_rows(V.visit_summary(A.approval_steps(rows, A.step_chain(rows), AS_OF)))
    submitted, rejected = V.submissions(facts), V.rejections(facts)
    staged = V.counted_stage_dates(once(summary), submitted, rejected)
    assert [r["n"] for r in staged.collect()] == [5000 ** 3]
    checked = V.counted_visit_flags(staged)
    assert [r["n"] for r in checked.collect()] == [5000 ** 3]
    plans = plans_with_monitors(base)
    assert [r["n"] for r in R.counted_left_visit(plans, checked).collect()] == [5000 ** 3]
    assert [r["n"] for r in R.counted_right_visit(plans, checked).collect()] == [5000 ** 3]
    assert V.visit_first_submission(summary, submitted).count() == 5000


def test_counted_rows_expand_to_their_copies(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 10_001), (None, 4096)], "x string, n long")
    found = {r["x"]: r["count"] for r in expanded(rows).groupBy("x").count().collect()}
    assert found == {"a": 1, "b": 10_001, None: 4096}
    assert {tuple(r) for r in counted(expanded(rows)).collect()} == {tuple(r) for r in rows.collect()}
