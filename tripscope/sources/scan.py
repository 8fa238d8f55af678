"""Scans of trip files in any format Spark reads.

* self-describing formats (Parquet, ORC): read as stored, then
  conformed by name; the column pruning and any filter a query adds reach the
  scan (``ReadSchema`` / ``PushedFilters``).  Files whose stored schemas differ
  (monthly files drift) are conformed schema by schema, so a column that is
  long in one and double in another loads, and a required column that any file
  lacks is an error, not silently NULL.  The footers are read by one
  distributed pass over the list of files;
* CSV: read with a header and *without* ``inferSchema`` (inference is a
  second full pass over the data), as strings, then conformed by name with
  ``try_cast``; every file's header must match the first one's.  ``split_csv``
  sets records apart that do not parse, with file and reason;
* JSON: keys are matched to TRIP_SCHEMA in any case, by one distributed pass
  over the keys of all records; values are read as strings and conformed.
  Where a key has several spellings, records are matched one by one in any
  case; a required key that no record holds is an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripscope.schema import REQUIRED_COLUMNS, TRIP_SCHEMA, TripSchemaError, conform, unparsed

STORED_SCHEMA = ("parquet", "orc")


def read_trips(
    spark: SparkSession,
    path: str | list[str],
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Load trip files (a directory, a glob or a list of paths) as trips.

    ``schema``, when the files' schema is known, skips the inference step
    (for Parquet a job reading footers) at every load.
    """
    reader = spark.read.format(format)
    fmt = format.lower()
    if fmt == "csv":
        # Column names come from the first file's header and later files are
        # read by position, so every header is checked against it: a file
        # with its columns in another order fails instead of being misread.
        reader = (
            reader.option("header", "true")
            .option("inferSchema", "false")
            .option("enforceSchema", "false")
        )
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**dict(options))
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None and fmt == "json":
        given = dict(options or {})
        names = json_names(spark, paths, given)
        if any(len(own) > 1 for own in names.values()):
            return conform(json_in_any_case(_json_text(spark.read, given).load(paths), given))
        fields = [StructField(next(iter(own), name), StringType()) for name, own in names.items()]
        reader = reader.schema(StructType(fields))
    if schema is None and fmt in STORED_SCHEMA:
        return _conform_each_schema(spark, paths, fmt, dict(options or {}))
    return conform(reader.load(paths))


def _json_text(reader, options: Mapping[str, str]):
    """``reader`` (batch or stream) for the records of JSON files as text."""
    whole = any(k.lower() == "multiline" and str(v).lower() == "true" for k, v in options.items())
    return reader.format("text").options(**dict(options)).option("wholetext", str(whole).lower())


def json_names(spark: SparkSession, paths: list[str], options: Mapping[str, str] | None = None) -> dict[str, list[str]]:
    """Every spelling of each trip column among the keys of all records; only
    these names reach the driver.  A required key that no record holds is an
    error; one file may lack it, as writers leave out keys that are null."""
    wanted = [f.name.lower() for f in TRIP_SCHEMA.fields]
    records = _json_text(spark.read, options or {}).load(paths)
    keys = records.select(F.explode(F.json_object_keys("value")).alias("key"))
    # None stands for the keys of other columns.
    found = keys.select(F.when(F.lower("key").isin(wanted), F.col("key")).alias("key")).distinct().collect()
    names = sorted(r.key for r in found if r.key is not None)
    present = {k.lower() for k in names}
    missing = [c for c in REQUIRED_COLUMNS if c.lower() not in present]
    if found and missing:
        raise TripSchemaError(f"JSON records lack required columns: {missing}")
    return {f.name: [k for k in names if k.lower() == f.name.lower()] for f in TRIP_SCHEMA.fields}


def json_in_any_case(records: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """The trip columns, as strings, of JSON ``records`` (value) whose keys may
    be spelt in any case, each record on its own; of several spellings in one
    record, the first that is not null."""
    keys = F.from_json("value", "map<string,string>", dict(options or {}))

    def column(name: str):
        other = F.filter(
            F.map_entries("record"), lambda e: (F.lower(e["key"]) == name.lower()) & e["value"].isNotNull()
        )
        return F.coalesce(F.try_element_at("record", F.lit(name)), F.get(other, F.lit(0))["value"]).alias(name)

    rows = records.where(F.trim("value") != "").select(keys.alias("record"))
    return rows.select(*[column(f.name) for f in TRIP_SCHEMA.fields])


# Files whose footers one task reads.
FOOTERS_PER_TASK = 64


def file_list(spark: SparkSession, paths: list[str], fmt: str, options: Mapping[str, str]) -> list[str]:
    """The data files that a scan of ``paths`` would read, as the scan's own
    listing gives them; no file is opened."""
    known = {k: v for k, v in options.items() if k.lower() in ("pathglobfilter", "recursivefilelookup", "modifiedbefore", "modifiedafter")}
    listed = spark.read.format("binaryFile").options(**known).load(paths).inputFiles()
    return sorted(unquote(f) for f in listed)


def _footer_schemas(fmt: str):
    """For a pass over a table of file paths: the schema that each file's
    footer states, as text (None if no file system here knows the path)."""

    def read(parts):
        import pandas as pd
        from pyarrow import fs

        for part in parts:
            texts = []
            for path in part["path"]:
                try:
                    system, inner = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:", "", path))
                except Exception:  # a store that only Spark's own readers reach
                    texts.append(None)
                    continue
                with system.open_input_file(inner) as f:
                    if fmt == "parquet":
                        from pyarrow import parquet

                        texts.append(str(parquet.ParquetFile(f).schema).split("\n", 1)[1])
                    else:
                        from pyarrow import orc

                        texts.append(str(orc.ORCFile(f).schema.remove_metadata()))
            yield pd.DataFrame({"path": part["path"], "stored": pd.Series(texts, dtype=object)})

    return read


def stored_schemas(spark: SparkSession, files: list[str], fmt: str) -> DataFrame:
    """(path, stored): each file with its footer's schema as text, read by
    tasks that take FOOTERS_PER_TASK files each."""
    table = spark.createDataFrame([(f,) for f in files], "path string")
    tasks = -(-len(files) // FOOTERS_PER_TASK)
    return table.repartition(tasks).mapInPandas(_footer_schemas(fmt), "path string, stored string")


def files_by_schema(spark: SparkSession, files: list[str], fmt: str, options: Mapping[str, str]) -> dict[str, list[str]]:
    """Spark's schema (JSON) to the files that have it.

    One distributed pass reads the footers.  What reaches the driver is one
    row for each distinct schema, with an example file that Spark then
    reads the schema of; and, only if there are several, which file has which.
    """
    footers = stored_schemas(spark, files, fmt)
    kinds = footers.groupBy("stored").agg(F.min("path").alias("example"), F.count("*").alias("n")).collect()
    read = spark.read.format(fmt).options(**options)
    if any(k.stored is None for k in kinds):  # out of pyarrow's reach: Spark asks file by file
        found = [(read.load(f).schema.json(), f) for f in files]
    else:
        schema_of = {k.stored: read.load(k.example).schema.json() for k in kinds}
        if len(set(schema_of.values())) == 1:
            return {next(iter(schema_of.values())): files}
        found = [(schema_of[r.stored], r.path) for r in footers.collect()]
    groups: dict[str, list[str]] = {}
    for stored, file in sorted(found, key=lambda r: r[1]):
        groups.setdefault(stored, []).append(file)
    return groups


def _conform_each_schema(spark: SparkSession, paths: list[str], fmt: str, options: dict) -> DataFrame:
    """Files grouped by their stored schema (footers only), each group
    conformed on its own; optional columns that a group lacks are NULL."""
    files = file_list(spark, paths, fmt, options)
    reader = spark.read.format(fmt).options(**options)
    if len(files) < 2:
        return conform(reader.load(paths))
    groups = files_by_schema(spark, files, fmt, options)
    if len(groups) == 1:
        return conform(reader.load(paths))
    out = None
    for stored_json, own in sorted(groups.items()):
        stored = StructType.fromJson(json.loads(stored_json))
        try:
            part = conform(spark.read.format(fmt).options(**options).schema(stored).load(own))
        except TripSchemaError as error:
            raise TripSchemaError(f"{error} in {own[0]}") from None
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    names = [f.name for f in TRIP_SCHEMA.fields if f.name in out.columns]
    return out.select(*names)


# ---------------------------------------------------------------- rejected records

_CORRUPT = "__corrupt_record"


def split_csv(
    spark: SparkSession, path: str | list[str], options: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(trips, rejects) of headed CSV files: every record is in one of them.

    A record is rejected if it has too few or too many fields for the header,
    or a value that is there but does not parse as its column's type.
    ``rejects``: ``file``, ``record`` (the line as it stands, or the values
    joined by commas) and ``reason`` (all of its faults).  Blank lines are no
    records.  Both are lazy reads of the same files; every file's header must
    match the first one's.
    """
    paths = [path] if isinstance(path, str) else list(path)
    given = {k: v for k, v in dict(options or {}).items() if k.lower() not in ("header", "mode", "inferschema", "enforceschema")}
    names = spark.read.options(**given).option("header", "true").csv(paths).columns
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField(_CORRUPT, StringType())])
    raw = (
        spark.read.schema(schema)
        .options(**given)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(paths)
    )
    faults = unparsed(raw.drop(_CORRUPT))
    broken = F.col(_CORRUPT).isNotNull()
    rows = raw.withColumn("__faults", F.when(broken, F.array(F.lit("number of fields differs from the header"))).otherwise(faults))
    trips = conform(rows.where(F.size("__faults") == 0).drop("__faults", _CORRUPT))
    values = F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names])
    rejects = rows.where(F.size("__faults") > 0).select(
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(F.col(_CORRUPT), values).alias("record"),
        F.array_join("__faults", "; ").alias("reason"),
    )
    return trips, rejects


def read_trips_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet glob scan: one flat directory of monthly files."""
    return read_trips(spark, path, "parquet")


def read_trips_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headed CSV scan, columns matched by header name."""
    return read_trips(spark, path, "csv")
