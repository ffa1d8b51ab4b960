"""Code columns decoded to text."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from visittrail.fixed_values import (
    BAD_STAGE_PAIRS,
    PROTOCOL_ALIASES,
    STAGE_NAMES,
    STAGE_START,
)


def decode(code: Column, names: dict) -> Column:
    """Name of a code; an unknown code stays as text."""
    return F.coalesce(_lookup(code, names), code.cast("string"))


def protocol_alias(protocol: Column) -> Column:
    return _lookup(protocol, PROTOCOL_ALIASES)


def latest_stage(stages: Column) -> Column:
    """What the last letter of a stage sequence stands for."""
    return _lookup(F.right(stages, F.lit(1)), STAGE_NAMES)


def is_bad_stage_order(stages: Column) -> Column:
    """A sequence that does not open with a submission or has a forbidden pair."""
    return reduce(or_, (stages.like(pair) for pair in BAD_STAGE_PAIRS), ~stages.like(STAGE_START))


def _lookup(code: Column, names: dict) -> Column:
    cases = F
    for key, name in names.items():
        cases = cases.when(code == key, name)
    return cases
