"""Reading JSON and delimited files chosen by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from datamove.functions.flatten import flatten_structs


@dataclass(frozen=True)
class FileType:
    """How a kind of file ends and, for delimited text, what parts its fields by default."""

    name: str
    ending: str
    delimiter: str | None


# File types by the two-letter code used in control tables and by name.  Free
# text (TX) has no delimiter of its own and takes a comma unless told otherwise.
_CODES = {
    "JS": FileType("JSON", "json", None),
    "CS": FileType("CSV", "csv", ","),
    "TS": FileType("TSV", "tsv", "\t"),
    "TX": FileType("TXT", "txt", ","),
}
FILE_TYPES = _CODES | {t.name: t for t in _CODES.values()}


def file_type(code: str) -> FileType:
    if code not in FILE_TYPES:
        raise ValueError(f"unknown file type {code!r}, expected one of {sorted(FILE_TYPES)}")
    return FILE_TYPES[code]


def name_pattern(prefix: str, ending: str) -> str:
    """Glob for file names that start with ``prefix``, taken literally, and end with ``ending``."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", prefix) + "*" + ending


def selection(prefix: str, ending: str) -> dict[str, str]:
    """Reader options that pick files by name below a directory, at any depth."""
    return {"pathGlobFilter": name_pattern(prefix, ending), "recursiveFileLookup": "true"}


def select_files(spark: SparkSession, path: str, prefix: str, kind: str) -> DataFrame:
    """The files below ``path`` that a load would read: path, length and modification time.

    Contents are not opened.  No match gives no rows.
    """
    listed = spark.read.format("binaryFile").options(**selection(prefix, file_type(kind).ending)).load(path)
    return listed.select("path", "length", "modificationTime")


def json_options(multi_line: bool) -> dict[str, str]:
    return {"multiLine": str(multi_line).lower(), "inferTimestamp": "false"}


def delimited_options(kind: str, delimiter: str | None, header: bool) -> dict[str, str]:
    found = file_type(kind)
    if found.delimiter is None:
        raise ValueError(f"{found.name} files are not delimited")
    options = {"sep": delimiter or found.delimiter, "header": str(header).lower()}
    # A header that does not name the columns in the schema's order is an error, not ignored.
    return options | {"enforceSchema": "false"} if header else options


def read_json_flat(
    spark: SparkSession,
    path: str,
    prefix: str = "",
    multi_line: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """JSON files with their structs flattened; timestamps stay text.

    ``multi_line`` reads each file as one document and hence in one task; files with one
    record per line are split over tasks when it is off.  A ``schema`` saves the extra pass
    that infers it.
    """
    if schema is None and select_files(spark, path, prefix, "JSON").isEmpty():
        return spark.createDataFrame([], T.StructType())
    reader = spark.read.options(**selection(prefix, file_type("JSON").ending), **json_options(multi_line))
    return flatten_structs((reader.schema(schema) if schema is not None else reader).json(path))


def read_delimited(
    spark: SparkSession,
    path: str,
    prefix: str = "",
    kind: str = "CSV",
    delimiter: str | None = None,
    header: bool = True,
    schema: T.StructType | str | None = None,
    mixed_headers: bool = False,
) -> DataFrame:
    """CSV, TSV or TXT files; a given delimiter wins over the type's own.

    Column types are inferred, at the price of one extra pass, unless ``schema`` is given.
    Files with a header are bound to a schema by its names, whatever their order; files
    whose headers differ from each other are an error, unless ``mixed_headers`` (with a schema) has each file read by
    its own header, see ``read_by_header``, at the price of a pass over the text.
    """
    if mixed_headers:
        if schema is None or not header:
            raise ValueError("mixed headers need files with a header, and a schema")
        names = [r["path"] for r in select_files(spark, path, prefix, kind).select("path").collect()]
        return read_by_header(spark, names, kind, delimiter, schema)
    if schema is None and select_files(spark, path, prefix, kind).isEmpty():
        return spark.createDataFrame([], T.StructType())
    reader = spark.read.options(
        **selection(prefix, file_type(kind).ending), **delimited_options(kind, delimiter, header)
    )
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    if not header:
        return reader.schema(schema).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    named = _in_file_order(reader.csv(path).columns, wanted)
    return reader.schema(named).csv(path).select(*[f"`{f.name}`" for f in wanted.fields])


def read_by_header(
    spark: SparkSession, paths: Sequence[str], kind: str, delimiter: str | None, schema: T.StructType | str, extra: bool = False
) -> DataFrame:
    """Delimited files, each read by its own header, put together by name.

    Files with the same header are read together.  Columns a header lacks are null; those the schema lacks are kept as
    text behind the others with ``extra``, and an error without it.  An empty file has no rows.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = delimited_options(kind, delimiter, True) | {"enforceSchema": "true"}
    fields = {f.name.lower(): f for f in wanted.fields}
    found: list[tuple[list[str], list[str]]] = []
    for header, files in _headers(spark, paths):
        found.append((next(csv.reader([header.removeprefix("\ufeff")], delimiter=options["sep"])), files))
    more = {n.lower(): n for names, _ in found for n in names if n.lower() not in fields}
    if more and not extra:
        raise ValueError(f"files have columns the schema lacks: {sorted(more.values())}")
    whole = [*wanted.fields, *[T.StructField(n, T.StringType()) for n in more.values()]]
    made = spark.createDataFrame([], T.StructType(whole))
    for names, files in found:
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"a header names a column twice: {names}")
        listed = T.StructType([fields.get(n.lower()) or T.StructField(more[n.lower()], T.StringType()) for n in names])
        read = spark.read.options(**options).schema(listed).csv([literal_path(f) for f in files])
        made = made.unionByName(read, allowMissingColumns=True)
    return made


def _headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, list[str]]]:
    """The distinct first lines of files, with the files of each."""
    if not paths:
        return []
    lines = spark.read.text([literal_path(p) for p in paths])
    lines = lines.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    first = lines.where("file_block_start = 0 AND trim(value) <> ''").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    grouped = first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    # Paths come as addresses, in which some characters are written as numbers.
    known = {spark._jvm.org.apache.hadoop.fs.Path(p).toUri().toString(): p for p in paths}
    return sorted((r["header"], [known.get(f, f) for f in r["files"]]) for r in grouped.collect())


def literal_path(path: str) -> str:
    """A file's path with the characters that would make it a pattern taken literally."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)


def _in_file_order(header: list[str], schema: T.StructType) -> T.StructType:
    """The schema's fields as a header lists them; as they are where the header names others."""
    fields = {f.name.lower(): f for f in schema.fields}
    if sorted(h.lower() for h in header) != sorted(fields):
        return schema
    return T.StructType([fields[h.lower()] for h in header])
