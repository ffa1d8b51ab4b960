"""Study table families as DataFrames of one shape."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visittrail.fixed_values import TABLE_HEAD
from visittrail.schema import (
    CONTROL_WORDS,
    OPAQUE_KEYS,
    STUDY,
    TABLE_COLUMNS,
    column_type,
)

# True on plan rows of studies whose plan table records the visit type at all.
TYPED_PLANS = "typed_plans"
# Deletes the shuffled files of a command when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class StudyTables:
    """The six tables, each with the study prefix in front."""

    plan: DataFrame
    mv: DataFrame
    site: DataFrame
    sites: DataFrame
    study: DataFrame
    link: DataFrame


def normalized(kind: str, table: DataFrame, prefix: str | Column) -> DataFrame:
    """Expected columns only, typed; absent ones are NULL and bad dates become NULL."""
    present = {name.lower(): name for name in table.columns}
    study = F.lit(prefix) if isinstance(prefix, str) else prefix

    def column(name: str) -> Column:
        if name not in present:
            return F.lit(None).cast(column_type(name)).alias(name)
        value = F.col(present[name])
        if name in CONTROL_WORDS:
            value = F.lower(F.rtrim(value))
        elif name not in OPAQUE_KEYS and dict(table.dtypes)[present[name]] != column_type(name):
            value = value.try_cast(column_type(name))
        return value.alias(name)

    columns = [study.alias(STUDY), *(column(name) for name in TABLE_COLUMNS[kind])]
    if kind == "plan":
        columns.append(F.lit("planmvtyp" in present).alias(TYPED_PLANS))
    return table.select(*columns)


def read_study(spark: SparkSession, prefix: str, database: str | None = None) -> StudyTables:
    """Tables named <prefix><kind>; an absent link or other table is an error.

    A prefix is as the discovery gives it (repdata_p1, or repdatap1 where names have no
    underscore), or its part behind repdata_ alone.
    """
    study = prefix.removeprefix(f"{TABLE_HEAD}_")
    head = prefix if prefix.startswith(TABLE_HEAD) else f"{TABLE_HEAD}_{prefix}"
    path = f"`{database}`." if database else ""
    return StudyTables(**{
        kind: normalized(kind, spark.table(f"{path}`{head}{kind}`"), study)
        for kind in TABLE_COLUMNS
    })


def read_listed_studies(
    spark: SparkSession, database: str, listing: DataFrame, prefixes: Iterable[str]
) -> StudyTables:
    """The tables of many studies of a catalog listing, each row with its study's prefix.

    All Parquet tables of a kind that have the same columns are one scan, whose rows find their
    study by the folder they come from; so a plan grows with the layouts in use, not with the
    studies. Views, partitioned tables and other formats are read one by one.
    """
    wanted = {f"{prefix}{kind}": (prefix, kind) for prefix in prefixes for kind in TABLE_COLUMNS}
    groups: dict[str, dict] = {kind: {} for kind in TABLE_COLUMNS}
    for row in listing.filter(F.lower("table_name").isin(list(wanted))).collect():
        prefix, kind = wanted[row["table_name"].lower()]
        alone = row["stored_as"] != "parquet" or row["folder"] is None
        layout = row["table_name"] if alone else row["layout"]
        groups[kind].setdefault(layout, []).append((prefix, row["table_name"], row["folder"]))
    return StudyTables(**{
        kind: _stacked([_one_layout(spark, database, kind, own) for own in layouts.values()])
        if layouts else normalized(kind, spark.createDataFrame([], "docid string"), "")
        for kind, layouts in groups.items()
    })


def _one_layout(
    spark: SparkSession, database: str, kind: str, tables: list[tuple[str, str, str | None]]
) -> DataFrame:
    prefix, name, _ = tables[0]
    first = spark.table(f"`{database}`.`{name}`")
    if len(tables) == 1:
        return normalized(kind, first, prefix)
    # A table that was never written to may have no folder; the others have at least one.
    folders = [f for f in dict.fromkeys(t[2] for t in tables) if _exists(spark, f)]
    if not folders:
        return normalized(kind, first, prefix)
    rows = spark.read.schema(first.schema).parquet(*folders)
    studies = spark.createDataFrame(
        [(prefix, folder) for prefix, _, folder in tables], f"{STUDY} string, folder string")
    # A file's path has its special characters escaped, a table's folder has not.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_replace(path, "/[^/]*$", "")
    placed = rows.withColumn("_folder", _one_slash(folder)).join(
        studies.select(STUDY, _one_slash(F.col("folder")).alias("_folder")), "_folder")
    return normalized(kind, placed, F.col(STUDY))


def _one_slash(folder: Column) -> Column:
    return F.regexp_replace(F.rtrim(folder, F.lit("/")), "^([a-z0-9]+):/+", "$1:/")


def read_study_files(spark: SparkSession, root: str) -> StudyTables:
    """Parquet under <root>/<kind>, partitioned by study_prefix: one scan for all studies."""
    return StudyTables(**{
        kind: normalized(kind, spark.read.parquet(f"{root}/{kind}"), F.col(STUDY).cast("string"))
        for kind in TABLE_COLUMNS
    })


def all_studies(studies: Iterable[StudyTables]) -> StudyTables:
    """Several studies stacked so one job reports on all of them."""
    studies = list(studies)
    return StudyTables(**{
        part.name: _stacked([getattr(study, part.name) for study in studies])
        for part in fields(StudyTables)
    })


def _stacked(tables: list[DataFrame]) -> DataFrame:
    """Union by name; an identifier typed differently across studies becomes text."""
    types = [dict(table.dtypes) for table in tables]
    mixed = [name for name in types[0] if len({t[name] for t in types}) > 1]
    as_text = [
        table.withColumns({name: F.col(name).cast("string") for name in mixed})
        for table in tables
    ]
    return reduce(DataFrame.unionByName, as_text)


def labelled(tables: StudyTables, prefix: str) -> StudyTables:
    """The same rows as a study of another prefix."""
    return StudyTables(**{
        part.name: getattr(tables, part.name).withColumn(STUDY, F.lit(prefix))
        for part in fields(StudyTables)
    })


def stored_study(tables: StudyTables, folder: str) -> StudyTables:
    """The same study with plans, steps and links written to a folder and read from there.

    The report reads these many times; where they are derived by joins, they are so once, and what
    these joins shuffled is deleted when a table is written.
    """
    def stored(kind: str) -> DataFrame:
        table = getattr(tables, kind)
        conf = table.sparkSession.conf
        usual = conf.get(SHUFFLE_CLEANUP, "false")
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            table.write.parquet(f"{folder}/{kind}")
        finally:
            conf.set(SHUFFLE_CLEANUP, usual)
        return table.sparkSession.read.schema(table.schema).parquet(f"{folder}/{kind}")

    return replace(tables, **{kind: stored(kind) for kind in ("plan", "mv", "link")})


def write_report(report: DataFrame, path: str, studies: Iterable[str] = ()) -> None:
    """Writes a report. That of several studies is partitioned by study and replaces only its own.

    Studies without a row in the report keep what is stored, unless they are named in `studies`:
    then they were done anew and have nothing to show, and what is stored of them goes.
    """
    if STUDY not in report.columns:
        report.write.mode("overwrite").parquet(path)
        return
    seen = Observation()
    _replace_studies(report.observe(seen, F.collect_set(STUDY).alias("studies")), path)
    for study in set(studies) - set(seen.get["studies"]):
        _drop_study(report.sparkSession, path, study)


def write_layouts(layouts: DataFrame, path: str) -> None:
    """Writes the layout of every prefix found; prefixes listed before and not now are kept."""
    _replace_studies(layouts.withColumnRenamed("prefix", STUDY), path)


def _replace_studies(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        STUDY).parquet(path)


def _drop_study(spark: SparkSession, path: str, study: str) -> None:
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    system, folder = _file_system(spark, f"{path}/{STUDY}={escaped.escapePathName(study)}")
    system.delete(folder, True)


def _exists(spark: SparkSession, folder: str) -> bool:
    system, path = _file_system(spark, folder)
    return system.exists(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
