"""Export files: one per subject and kind, called ``<subject>_<kind>.csv``.

A file may also be a directory of that name, as Spark writes it. What belongs to a file rather than to a line (kind,
subject, header, whether quoted fields span lines) is found once and kept as a small relation, a row per file. All
files of a kind are then parsed by position in one splittable read, whatever their headers, and joined with their
file's row, which says where each column stands. Only files with fields that span lines are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from carelens import constants as K
from carelens.functions.ids import uuid5
from carelens.session import scratch_path

# Kind -> {file name -> subject}, for files that lack the subject in their name.
Aliases = Mapping[str, Mapping[str, str]]


def export_schema(kind: str) -> StructType:
    """What reading one kind returns: subject, row id and the text columns used."""
    return _texts("subject", "row_id", *K.EXPORT_COLUMNS[kind])


def _texts(*names: str) -> StructType:
    return reduce(lambda schema, name: schema.add(name, StringType()), names, StructType())


def _decoded(path: Column) -> Column:
    # The metadata column holds a URL; a plus sign in it is a literal plus.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


class ExportFolder:
    """Which subject a file belongs to, as expressions over the file's path."""

    def __init__(self, folder: str, aliases: Aliases | None = None, only: str | None = None, files: Iterable[str] | None = None):
        """``files`` are the raw paths that count, if not all do."""
        self.folder, self.only = folder.rstrip("/"), only
        self.files = None if files is None else sorted(files)
        self.aliases = {kind: dict(names) for kind, names in (aliases or {}).items()}
        bare = re.sub(r"^[a-z0-9+.-]+:/+", "/", self.folder).removeprefix("./")
        # Only the folder itself counts, not folders below it.
        self.prefix = rf"\Q{'/' + bare.lstrip('/')}\E/"

    def may_be(self, kind: str) -> Column:
        """A test of the path alone, so files are left out when they are listed; false ones may pass."""
        raw = F.col("_metadata.file_path")
        regular = F.contains(raw, F.lit(f"_{kind}.csv"))
        names = self.aliases.get(kind, {})
        if self.only is not None:
            wanted = self.only.lower()
            regular &= F.contains(F.lower(_decoded(raw)), F.lit(f"{wanted}_{kind}.csv"))
            names = {name: owner for name, owner in names.items() if owner.lower() == wanted}
        found = reduce(lambda found, name: found | F.endswith(_decoded(raw), F.lit(f"/{name}")), names, regular)
        return found if self.files is None else found & raw.isin(self.files)

    def subject(self, kind: str, path: Column) -> Column:
        """The subject of a decoded path; empty for files of other kinds and subjects.

        An aliased file belongs to the subject given for it, and that subject's
        regularly named file is left alone.
        """
        names = self.aliases.get(kind, {})
        name = F.regexp_extract(path, rf"{self.prefix}([^/]+)_{kind}\.csv(?:/[^/]+)?$", 1)
        # A partitioned write labels the directory (file=<subject>_<kind>.csv) and escapes the value.
        label = F.regexp_extract(name, r"^[^=]+=(.*)$", 1)
        subject = F.when(F.contains(name, F.lit("=")), _decoded(label)).otherwise(name)
        if names:
            subject = F.when(subject.isin(*names.values()), "").otherwise(subject)
        for file_name, owner in names.items():
            aliased = F.rlike(path, F.lit(rf"{self.prefix}\Q{file_name}\E$"))
            subject = F.when(aliased, F.lit(owner)).otherwise(subject)
        if self.only is not None:
            subject = F.when(F.lower(subject) == self.only.lower(), subject).otherwise("")
        return subject


def _reader(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")


def lines_of(spark: SparkSession, source: ExportFolder, kinds: tuple[str, ...]) -> DataFrame:
    """Lines of all files that may be exports, numbered in the order they stand in their file."""
    try:
        lines = _reader(spark).text(source.folder)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no export folder {source.folder}") from problem
        raise
    lines = lines.where(reduce(lambda a, b: a | b, (source.may_be(kind) for kind in kinds)))
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        (F.col("_metadata.file_block_start") == 0).alias("opens"),
        F.monotonically_increasing_id().alias("line"),
    )


def files_of(spark: SparkSession, source: ExportFolder, kinds: Iterable[str]) -> DataFrame:
    """Per file: raw path, kind, subject, header, its column names, those it lacks, and whether a quoted field may
    span lines.

    Kind and subject are told from the path once per file.
    """
    kinds = tuple(kinds)
    path = _decoded(F.col("file"))
    told = [F.when(source.subject(kind, path) != "", F.struct(F.lit(kind).alias("kind"), source.subject(kind, path).alias("subject"))) for kind in kinds]
    names = F.transform(F.split("header", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'), _unquoted)
    required = F.coalesce(*(F.when(F.col("of.kind") == kind, F.array(*map(F.lit, K.REQUIRED_COLUMNS[kind]))) for kind in kinds))
    found = layouts(lines_of(spark, source, kinds)).withColumns({"of": F.coalesce(*told), "names": names})
    # Written down, so that lines are not read again for it. A filter on the kind before that would be pushed to the lines.
    files = found.select("file", "of.*", "multiline", "header", "names", F.array_except(required, "names").alias("missing"))
    target = scratch_path(spark, "export-files")
    files.write.parquet(target)
    return spark.read.schema(files.schema).parquet(target).where(F.col("kind").isNotNull())


def layouts(lines: DataFrame) -> DataFrame:
    """Per file: its header and whether a quoted field may span lines.

    One pass over splittable text that keeps numbers only, so nothing is sorted; the headers' text is fetched from the
    first blocks afterwards.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    filled = F.col("opens") & (F.length(F.trim("value")) > 0)
    seen = lines.groupBy("file").agg(
        F.min(F.when(filled, F.col("line"))).alias("line"), F.max(quotes % 2 == 1).alias("multiline")
    )
    heads = lines.where(filled).select("line", F.replace("value", F.lit("\ufeff"), F.lit("")).alias("header"))
    return seen.join(heads, "line").select("file", "multiline", "header")


def listed(spark: SparkSession, folder: str, aliases: Aliases | None = None) -> DataFrame:
    """Every export file with its size, time, kind and subject, from one listing; no file is opened."""
    source, path = ExportFolder(folder, aliases), _decoded(F.col("id"))
    try:
        found = _reader(spark).format("binaryFile").load(source.folder)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no export folder {source.folder}") from problem
        raise
    files = found.select(
        F.col("_metadata.file_path").alias("id"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
    )
    told = [
        F.when(source.subject(kind, path) != "", F.struct(F.lit(kind).alias("kind"), source.subject(kind, path).alias("subject")))
        for kind in K.EXPORT_KINDS
    ]
    return files.withColumn("of", F.coalesce(*told)).where("of IS NOT NULL").select("id", "size", "modified", "of.*")


def _unquoted(name: Column) -> Column:
    bare = F.regexp_replace(F.trim(name), '^"|"$', "")
    return F.when(F.startswith(F.trim(name), F.lit('"')), F.replace(bare, F.lit('""'), F.lit('"'))).otherwise(name)


def _records(spark: SparkSession, folder: str, width: int, multiline: bool) -> DataFrame:
    """Records of all files by position. The folder is listed here, once for all kinds."""
    reader = _reader(spark).schema(_texts(*(f"#{i}" for i in range(width)))).option("header", True).option("escape", '"')
    return reader.option("multiLine", multiline).csv(folder)


def _parse(records: DataFrame, source: ExportFolder, kind: str, files: DataFrame, multiline: bool) -> DataFrame:
    """Rows of the kind's files with or without fields that span lines: subject and the columns in use."""
    fields = F.array(*(F.col(f"`{slot}`") for slot in records.columns))
    rows = records.where(source.may_be(kind)).select(F.col("_metadata.file_path").alias("file"), fields.alias("fields"))
    # Of repeated names the first one counts. A column the file lacks stands nowhere.
    columns = K.EXPORT_COLUMNS[kind]
    places = (F.nullif(F.array_position("names", F.lit(name)), F.lit(0)).alias(f"at {i}") for i, name in enumerate(columns))
    own = files.where((F.col("kind") == kind) & (F.col("multiline") == multiline)).select("file", "subject", *places)
    picked = (F.get("fields", F.col(f"`at {i}`").cast("int") - 1).alias(name) for i, name in enumerate(columns))
    return rows.join(own, "file").select("subject", *picked)


def _identified(rows: DataFrame, kind: str) -> DataFrame:
    """Rows with an id from what they say and a number among equal ones.

    It depends on no file name, split or order. Equal rows are counted before they are moved, and spread out again.
    """
    columns = K.EXPORT_COLUMNS[kind]
    names = [f"`{name}`" for name in ("subject", *columns)]
    counted = rows.groupBy(*names).agg(F.count("*").alias("copies"))
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    said = (F.coalesce(F.col(name), F.lit("\x00")) for name in names)
    key = F.concat_ws("\x1f", F.lit(kind), *said, F.col("copy").cast("string"))
    return numbered.select("subject", uuid5(K.SUBJECT_NAMESPACE, key).alias("row_id"), *names[1:])


def read_all_exports(
    spark: SparkSession,
    folder: str,
    aliases: Aliases | None = None,
    kinds: Iterable[str] = K.EXPORT_KINDS,
    only: str | None = None,
    files: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """All rows of each kind as text, with their subject and a row id; with ``only``, those of one subject, and with
    ``files`` (raw paths), those of these files.

    Columns are taken by name, so files may order them differently or carry
    more; an absent optional column is NULL, an absent required one raises.
    A kind without files has no rows; a folder that does not exist raises.
    """
    source = ExportFolder(folder, aliases, only, files)
    kinds = tuple(kinds)
    files = files_of(spark, source, kinds)
    # As many rows as there are kinds, twice.
    bad = F.when(F.size("missing") > 0, F.struct("missing", "header"))
    found = files.groupBy("kind", "multiline").agg(F.max(F.size("names")).alias("width"), F.min(bad).alias("bad")).collect()
    width = max((row.width for row in found), default=1)
    records = {multi: _records(spark, source.folder, width, multi) for multi in {row.multiline for row in found}}
    result = {}
    for kind in kinds:
        for row in found:
            if row.kind == kind and row.bad:
                raise ValueError(f"{kind} export lacks {', '.join(row.bad.missing)}; its header is {row.bad.header!r}")
        parts = [_parse(records[row.multiline], source, kind, files, row.multiline) for row in found if row.kind == kind]
        if parts:
            result[kind] = _identified(reduce(DataFrame.unionByName, parts), kind)
        else:
            result[kind] = spark.createDataFrame([], export_schema(kind))
    return result


def read_exports(
    spark: SparkSession, folder: str, kind: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """One kind alone; ``aliases`` maps a file name to its subject."""
    return read_all_exports(spark, folder, {kind: aliases or {}}, (kind,))[kind]
