"""Planned against performed visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visittrail.fixed_values import COMPLETED, COMPLETED_WITHOUT_VISIT
from visittrail.operators.counted import COUNT, summed
from visittrail.operators.plans import PLAN_ORDER, in_order
from visittrail.schema import STUDY

VISIT_KEY = [STUDY, "docid", "countryid", "mvdat"]


def plan_left_visit(plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Every plan with each visit of its document, country and start date."""
    paired = _met(plans, visits, "left")
    return paired.withColumn("planmvstat", _status()).select(
        *plans.columns, *_visit_columns(visits)
    )


def plan_right_visit(plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Every visit with each plan; document, country and type are those of the visit."""
    return _by_visit(_met(plans, visits, "right"), plans, visits)


def counted_left_visit(plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Distinct plans with each counted visit of the same slot; an unmet plan counts once."""
    return plan_left_visit(plans, visits).withColumn(COUNT, F.coalesce(COUNT, F.lit(1)))


def counted_right_visit(plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Counted visits with each plan: plans that differ in their type alone become one row.

    Rows that become equal are of one slot, so they are summed up where the join left them.
    """
    return summed(_by_visit(_met(plans, visits, "right"), plans, visits))


def _by_visit(rows: DataFrame, plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Joined rows with the study, document, country and type of the visit."""
    own = {**{c: F.col(f"slot.{c}") for c in VISIT_KEY[:-1]}, "planmvtyp": F.col("visitid")}
    return rows.select(
        *(own.get(c, F.col(c)).alias(c) for c in plans.columns), *_visit_columns(visits))


def plan_visit_rows(
    plans: DataFrame, visits: DataFrame, plan_keys: DataFrame | None = None
) -> DataFrame:
    """Plans with their visits, then visits without a plan; not yet free of repeated rows.

    A pair whose planned type is not the visit's type appears with both types. Both joins
    may be split on a key that holds many rows, which a full outer join may not, and both
    read the same shuffled visits. plan_keys are rows with the same keys as the plans,
    where those are cheaper to get.
    """
    slotted = _slotted(visits)
    paired = _typed(plans, slotted, visits).drop("plan_slot")
    return paired.unionByName(_unplanned(plans, _alone(plans, slotted, plan_keys), visits))


def distinct_plan_visits(plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Each different row of plan_visit_rows once, for distinct visits.

    Plans that differ in type and status alone are one row with all of these, which are made
    distinct as they come out, so that the wide rows are not compared. A full outer join reads both
    sides once, where visits and plans of a document and country already lie together.
    """
    others = [c for c in plans.columns if c not in ("planmvtyp", "planmvstat", *PLAN_ORDER)]
    merged = in_order(plans, [*PLAN_ORDER, *others]).agg(
        F.collect_set(F.struct("planmvtyp", "planmvstat")).alias("kinds"))

    def kind(planmvtyp: Column, planmvstat: Column) -> Column:
        return F.struct(planmvtyp.alias("planmvtyp"), planmvstat.alias("planmvstat"))

    lost = F.transform("kinds", lambda k: kind(k["planmvtyp"], _when_lost(k["planmvstat"])))
    actual = F.transform("kinds", lambda k: kind(F.col("visitid"), k["planmvstat"]))
    alone = F.array(kind(F.col("visitid"), F.lit(None)))
    kinds = (
        F.when(F.col("slot").isNull(), F.array_distinct(lost))
        .when(F.col("plan_slot").isNull(), alone)
        .otherwise(F.array_union("kinds", actual))
    )
    own = {c: F.coalesce(c, f"slot.{c}") for c in VISIT_KEY[:-1]}
    own |= {c: F.col(f"kind.{c}") for c in ("planmvtyp", "planmvstat")}
    return _met(merged, visits, "full").withColumn("kind", F.explode(kinds)).select(
        *(own.get(c, F.col(c)).alias(c) for c in plans.columns), *_visit_columns(visits))


def _typed(plans: DataFrame, slotted: DataFrame, visits: DataFrame) -> DataFrame:
    """Plans with their visits; a pair that differs in its types appears with both."""
    planned, actual = F.col("planmvtyp"), F.col("visitid")
    differs = F.col("slot").isNotNull() & ~planned.eqNullSafe(actual)
    types = F.when(differs, F.array(planned, actual)).otherwise(F.array(planned))
    return (
        _paired(plans, slotted)
        .withColumn("planmvstat", _status())
        .withColumn("planmvtyp", F.explode(types))
        .select("plan_slot", *plans.columns, *_visit_columns(visits))
    )


def completed_without_visit(plans: DataFrame, visits: DataFrame) -> DataFrame:
    """Completed plans that no visit meets, with the status that says so."""
    days = _slotted(visits.select(*VISIT_KEY).distinct())
    completed = plans.filter(F.col("planmvstat") == COMPLETED).withColumn("plan_slot", _plan_slot())
    lost = completed.join(days, F.col("plan_slot") == F.col("slot"), "left_anti")
    return lost.withColumn("planmvstat", F.lit(COMPLETED_WITHOUT_VISIT)).drop("plan_slot")


def _slotted(visits: DataFrame) -> DataFrame:
    """The visit's key as one struct, so that both joins shuffle the same columns."""
    others = [c for c in visits.columns if c not in VISIT_KEY]
    return visits.select(F.struct(*VISIT_KEY, F.lit(0).alias("apart")).alias("slot"), *others)


def _paired(plans: DataFrame, slotted: DataFrame, how: str = "left") -> DataFrame:
    return plans.withColumn("plan_slot", _plan_slot()).join(
        slotted, F.col("plan_slot") == F.col("slot"), how
    ).withColumn("mvdat", F.col("slot.mvdat"))


def _met(plans: DataFrame, visits: DataFrame, how: str) -> DataFrame:
    """Plans and visits of the same slot, joined where a document and country lie together.

    Document and country are keys of their own beside the slot, so that visits and plans that
    already lie together by these are not shuffled for the join.
    """
    # Rows without a document or country meet none, by the slot as well.
    placed = _slotted(visits.withColumns(
        {"at_docid": F.col("docid"), "at_country": F.col("countryid")}))
    same = (
        (F.col("docid") == F.col("at_docid")) & (F.col("countryid") == F.col("at_country"))
        & (F.col("plan_slot") == F.col("slot"))
    )
    return plans.withColumn("plan_slot", _plan_slot()).join(placed, same, how).withColumn(
        "mvdat", F.col("slot.mvdat"))


def _is_placed() -> Column:
    known = F.col("docid").isNotNull() & F.col("countryid").isNotNull()
    return known & F.col("planmvdat").isNotNull()


def _plan_slot() -> Column:
    """A plan that lacks a part meets no visit: it is set apart by a number that no visit has.

    The number comes from the plan, so that such plans spread over all partitions of the join.
    """
    number = F.pmod(F.xxhash64("docid", "countryid", "planspid", "planmvid"), F.lit(1 << 20)) + 1
    # Never null, as the visits' own: keys of one type are not cast.
    apart = F.when(_is_placed(), 0).otherwise(F.coalesce(number.cast("int"), F.lit(1)))
    return F.struct(
        STUDY, "docid", "countryid", F.col("planmvdat").alias("mvdat"), apart.alias("apart"))


def _alone(
    plans: DataFrame, slotted: DataFrame, plan_keys: DataFrame | None = None
) -> DataFrame:
    """Visits whose slot has no plan.

    Not an anti join: Spark moves that below the visits' distinct, where it reads other visits than
    the join with the plans, and all steps are followed and shuffled a second time.
    """
    # Plans that lack a part are set apart already; a filter would change the type of the key.
    keys = plans if plan_keys is None else plan_keys
    taken = keys.select(_plan_slot().alias("plan_slot")).distinct()
    marked = slotted.join(
        taken.withColumn("taken", F.lit(1)), F.col("slot") == F.col("plan_slot"), "left")
    return marked.filter(F.col("taken").isNull()).select(*slotted.columns)


def _unplanned(plans: DataFrame, alone: DataFrame, visits: DataFrame) -> DataFrame:
    known = {STUDY: "slot." + STUDY, "docid": "slot.docid", "countryid": "slot.countryid",
             "planmvtyp": "visitid"}
    types = dict(plans.dtypes)
    return alone.withColumn("mvdat", F.col("slot.mvdat")).select(
        *((F.col(known[c]) if c in known else F.lit(None).cast(types[c])).alias(c)
          for c in plans.columns),
        *_visit_columns(visits),
    )


def _status() -> Column:
    status = F.col("planmvstat")
    return F.when(F.col("slot").isNull(), _when_lost(status)).otherwise(status)


def _when_lost(status: Column) -> Column:
    """Status of a plan that no visit meets."""
    return F.when(status == COMPLETED, COMPLETED_WITHOUT_VISIT).otherwise(status)


def _visit_columns(visits: DataFrame) -> list[str]:
    return [c for c in visits.columns if c not in (STUDY, "docid", "countryid")]
