"""Text columns: cleaning, names and joined lists."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """Tabs and line ends deleted, one pass of two spaces to one, outer spaces trimmed."""
    # Taken apart letter by letter only where there is something to delete.
    broken = reduce(or_, (F.contains(text, F.lit(sign)) for sign in "\t\n\r"))
    without_breaks = F.when(broken, F.translate(text, "\t\n\r", "")).otherwise(text)
    return F.trim(F.replace(without_breaks, F.lit("  "), F.lit(" ")))


def monitor_name(first: Column, last: Column) -> Column:
    """Full name, NULL when either part is NULL."""
    return F.concat(clean_text(first), F.lit(" "), clean_text(last))


def joined_names(names: Column) -> Column:
    """Sorted distinct names of an array joined by commas, NULL when it holds none."""
    known = F.array_compact(names)
    return F.when(F.size(known) > 0, F.array_join(F.sort_array(F.array_distinct(known)), ","))


def joined_entries(entries: Column, separator: str) -> Column:
    """Text of (..., text, n) entries in their sort order, each text n times, NULL when empty.

    Every entry has a text.
    """
    texts = F.transform(F.sort_array(entries), lambda e: repeated(e["text"], e["n"], separator))
    return F.when(F.size(entries) > 0, F.array_join(texts, separator))


def repeated(text: Column, n: Column, separator: str) -> Column:
    """A text n times; mostly once, when it is not copied."""
    more = F.repeat(F.concat(F.lit(separator), text), n.cast("int") - 1)
    return F.when(n == 1, text).otherwise(F.concat(text, more))
