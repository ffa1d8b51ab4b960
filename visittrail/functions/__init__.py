from visittrail.functions.codes import decode, is_bad_stage_order, latest_stage, protocol_alias
from visittrail.functions.dates import (
    elapsed_days,
    is_weekend,
    period_label,
    visit_length,
    week_start,
    weekdays_between,
)
from visittrail.functions.text import (
    clean_text,
    joined_entries,
    joined_names,
    monitor_name,
    repeated,
)

__all__ = [
    "clean_text", "decode", "elapsed_days", "is_bad_stage_order", "is_weekend",
    "joined_entries", "joined_names", "latest_stage", "monitor_name", "period_label",
    "protocol_alias", "repeated", "visit_length", "week_start", "weekdays_between",
]
