"""Report-file scans.

Every scan names its schema, so no file is read twice for inference, and takes a
batch (`spark.read`) or a streaming (`spark.readStream`) reader alike. Values stay
text here; `gridspan.operators.typing` types them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.session import materialize

REJECT = "_rejected_line"
LANDING = "_landing"
#: Folder of a file's version: the microsecond it was written at, and which file it is.
VERSION = "/version=([0-9]{1,18})-[0-9a-f]{32}/"
#: The line or document of a row that can't be read whole.
BROKEN = "_broken"
#: Reports whose dates travel with the tasks that read their generators.
DATED_REPORTS = 100_000


def with_landing(scan: DataFrame, root: str) -> DataFrame:
    """Adds which report a row came from and when its file landed.

    A report is a folder below the landing folder `root`, with all files in it, or a file
    in `root` itself. Folders should be named so that later fetches sort later. A version
    that `streaming.versions` took of a file that is written anew landed when its folder's
    name says.
    """
    def bare(path: Column) -> Column:
        return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?|/+$", "")

    file = F.col("_metadata.file_path")
    folder = bare(F.regexp_replace(file, "/[^/]*$", ""))
    report = F.when(folder == bare(F.lit(root)), bare(file)).otherwise(folder)
    taken = F.regexp_extract(file, VERSION, 1)
    taken = F.timestamp_micros(F.when(taken != "", taken).try_cast("bigint"))
    return scan.withColumn(
        LANDING,
        F.struct(
            F.coalesce(taken, F.col("_metadata.file_modification_time")).alias("landed_at"),
            report.alias("report"),
        ),
    )


def _scan_csv(reader, path: str, names: list[str], header: bool = False) -> DataFrame:
    """Without column pruning, as a line's field count shows only when all are parsed."""
    schema = ", ".join(f"`{n}` STRING" for n in [*names, REJECT])
    return (
        reader.format("csv")
        .schema(schema)
        .options(header=str(header).lower(), mode="PERMISSIVE", escape='"', columnPruning="false")
        .option("columnNameOfCorruptRecord", REJECT)
        .load(path)
    )


def scan_demand_csv(reader, path: str) -> DataFrame:
    """Headerless demand report, four columns by position."""
    return _scan_csv(reader, path, schemas.DEMAND_COLUMNS)


def scan_archive_csv(reader, path: str) -> DataFrame:
    """The older demand layout, whose value columns are named with blanks."""
    return _scan_csv(reader, path, schemas.ARCHIVE_DEMAND_COLUMNS)


def scan_zonal_csv(reader, path: str) -> DataFrame:
    """Headerless zonal demand report, fifteen columns by position."""
    return _scan_csv(reader, path, schemas.ZONAL_COLUMNS)


def scan_series_csv(reader, path: str, names: list[str]) -> DataFrame:
    """An exported table with a header line."""
    return _scan_csv(reader, path, names, header=True)


def over_long_rows(names: list[str]) -> Column:
    """True where a line had more fields than the layout; short lines are padded and fine."""
    fields = F.size(F.split(F.regexp_replace(REJECT, r'"(""|[^"])*"', ""), ","))
    return F.coalesce(fields > len(names), F.lit(False))


def with_broken(scan: DataFrame, names: list[str] | None) -> DataFrame:
    """Adds the text of lines with too many fields, or of broken XML documents."""
    broken = F.when(over_long_rows(names), F.col(REJECT)) if names else F.col(REJECT)
    return scan.withColumn(BROKEN, broken)


def _scan_xml(reader, path: str, row_tag: str, schema: str, strict: bool) -> DataFrame:
    """Prefixed, default and absent namespaces all match, as tags are compared without one."""
    return (
        reader.format("xml")
        .schema(f"{schema}, {REJECT} STRING")
        .options(rowTag=row_tag, ignoreNamespace="true")
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECT)
        .load(path)
    )


def scan_fuel_xml(reader, path: str, strict: bool = True) -> DataFrame:
    """One row per day of the output-by-fuel report."""
    return _scan_xml(reader, path, "DailyData", schemas.FUEL_DAY, strict)


def scan_capability_xml(reader, path: str, strict: bool = True) -> DataFrame:
    """One row per capability report; its date and its generators sit in one body."""
    return _scan_xml(reader, path, "IMODocBody", schemas.CAPABILITY_REPORT, strict)


def scan_generator_blocks(
    spark: SparkSession, path: str, prefix: str = "", parts: bool = False
) -> DataFrame:
    """One row per generator of capability reports, in the layout of `scan_capability_xml`.

    For large documents: files are cut behind each generator's closing tag, so that one is
    read by many tasks, and each block is parsed by itself. A report's date stands before its
    generators, in one block only, and is joined to the others by report. A file holds one
    report; with `parts` a folder does, in files that are cut behind generators. Dates are a
    stored table, which travels with the tasks if it has at most DATED_REPORTS rows. `prefix` is that of the tags, with its colon. Closing tags must not stand in
    comments. A block that cannot be parsed fails the job.
    """
    pieces = spark.read.option("lineSep", f"</{prefix}Generator>").text(path)
    file = F.col("_metadata.file_path")
    report = F.regexp_replace(file, "/[^/]*$", "") if parts else file
    pieces = pieces.select("value", report.alias("_report"))
    date = F.regexp_extract("value", rf"<{prefix}Date>([^<]*)</{prefix}Date>", 1)
    dated = pieces.withColumn("Date", date).filter("`Date` <> ''").groupBy("_report").agg(F.max("Date").alias("Date"))
    dates = materialize(dated, "report-dates")
    if dates.limit(DATED_REPORTS + 1).count() <= DATED_REPORTS:
        dates = F.broadcast(dates)
    at = F.regexp_instr("value", F.lit(rf"<{prefix}Generator[\s>]"))
    block = F.concat(F.substr("value", at), F.lit(f"</{prefix}Generator>"))
    bare = F.regexp_replace(block, rf"(</?){prefix}", "$1") if prefix else block
    options = {"rowTag": "Generator", "mode": "FAILFAST", "ignoreNamespace": "true"}
    parsed = F.from_xml(bare, schemas.GENERATOR, options)
    rows = pieces.filter(at > 0).select("_report", parsed.alias("g")).join(dates, "_report", "left")
    nested = f"STRUCT<Generator: ARRAY<{schemas.GENERATOR}>>"
    return rows.select("Date", F.lit(None).cast(nested).alias("Generators"), F.array("g").alias("Generator"))
