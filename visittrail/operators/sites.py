"""Sites with their country and protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visittrail.functions import clean_text
from visittrail.operators.plans import complete_rows
from visittrail.schema import STUDY

CODE_LENGTH = 3


def site_country(site: DataFrame, sites: DataFrame) -> DataFrame:
    """Complete site rows with the label of each site code that shares their first letters."""
    return _labelled(site, _labels(sites))


def _labels(sites: DataFrame) -> DataFrame:
    return sites.select(
        F.col(STUDY).alias("label_study"), F.left("sitecode", F.lit(CODE_LENGTH)).alias("code"),
        F.col("label").alias("country"),
    )


def _labelled(site: DataFrame, labels: DataFrame) -> DataFrame:
    site = complete_rows(site)
    same = (F.col(STUDY) == F.col("label_study")) & (
        F.left("countryid", F.lit(CODE_LENGTH)) == F.col("code")
    )
    return site.join(labels, same).select(*site.columns, "country")


def site_directory(site: DataFrame, sites: DataFrame, study: DataFrame) -> DataFrame:
    return _with_protocol(site, sites, study).select(
        STUDY, "docid", "siteid",
        F.concat("sitemonfirst", F.lit(" "), "sitemonlast").alias("monitor_name"),
        "sitemonact", "sitemondeact", "country", "protocolnumber",
    ).distinct()


def report_sites(site: DataFrame, sites: DataFrame, study: DataFrame) -> DataFrame:
    """Only what the report shows of the directory, so fewer rows meet its documents."""
    return _with_protocol(site, sites, study).select(
        STUDY, "docid", clean_text(F.col("siteid")).alias("siteid"), "country", "protocolnumber"
    ).distinct()


def _with_protocol(site: DataFrame, sites: DataFrame, study: DataFrame) -> DataFrame:
    """Each label of a code and each protocol of a document once, so that neither multiplies rows."""
    known = site.filter(F.col("siteid").isNotNull())
    protocols = study.select(STUDY, "docid", F.col("studyid").alias("protocolnumber")).distinct()
    return _labelled(known, _labels(sites).distinct()).join(protocols, [STUDY, "docid"])
