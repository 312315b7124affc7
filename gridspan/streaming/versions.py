"""Reports that are written anew under the name they have.

A file source takes a path in once. Where a report is fetched into the same file each hour,
its versions are taken first: a file that is new, or whose time or length isn't that of a
version taken before, is copied to a folder named by its time and path, and the stream picks
up from there. Versions are noted once their copies are complete; a run that stops before
that takes them again, to the same folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan import schemas
from gridspan.sinks.store import Store

TAKEN_SCHEMA = "landing STRING, path STRING, modificationTime TIMESTAMP, length BIGINT, version STRING"
_KEY = ["path", "modificationTime", "length"]


def _listed(store: Store, landing: str) -> DataFrame:
    """(path, modificationTime, length) of all files; their content isn't read."""
    reader = store.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(landing).select(*_KEY)


def _bare(path: Column) -> Column:
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def take_versions(store: Store, landing: str, versions: str, most: int = 10_000) -> int:
    """Copies versions not taken before to the folder `versions`; how many there were.

    At most `most` in a call, oldest first; call again until there are none. The names of
    that many files reach the driver.
    """
    taken = store.read_log(schemas.TAKEN_VERSIONS, TAKEN_SCHEMA)
    taken = taken.filter(F.col("landing") == landing)
    new = _listed(store, landing).join(taken, _KEY, "left_anti")
    micros = F.unix_micros("modificationTime").cast("string")
    new = new.withColumn("version", F.concat_ws("-", micros, F.md5("path")))
    found = new.orderBy("modificationTime", "path").limit(most).collect()
    if not found:
        return 0
    # A file written anew meanwhile is copied as it is now, and taken again by its new time.
    names = store.spark.createDataFrame(
        [(r.path, r.modificationTime, r.length, r.version) for r in found],
        "path STRING, modificationTime TIMESTAMP, length BIGINT, version STRING",
    )
    # A scan names its files as URLs, a listing doesn't.
    url = F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))
    text = store.spark.read.option("wholetext", "true").text([r.path for r in found])
    text = text.select("value", _bare(F.url_decode(url)).alias("_path"))
    bare = names.select(_bare(F.col("path")).alias("_path"), "version")
    copies = text.join(F.broadcast(bare), "_path")
    writer = copies.select("value", "version").write.mode("overwrite").partitionBy("version")
    writer.option("partitionOverwriteMode", "dynamic").text(versions)
    noted = names.select(F.lit(landing).alias("landing"), *_KEY, "version")
    noted.coalesce(1).write.mode("append").parquet(store.path(schemas.TAKEN_VERSIONS))
    return len(found)
