"""Parts of a URL and its reversed-host key, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ://; empty if there is none."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """Up to / ? # or the end, A-Z lower-cased; empty for a null url or one without ://."""
    return F.translate(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ? # or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """a.example.net as net,example,a, : a domain's key is a prefix of its subdomains' keys."""
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(",")))


def url_key(url: Column) -> Column:
    """The reversed host, then path and query in one order for all URLs of a host."""
    after = F.regexp_extract(_rest(url), r"(?s)^[^/?#]*(.*)$", 1)
    return F.concat(reversed_host(host_of(url)), F.lit(")"), after)
