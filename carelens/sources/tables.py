"""The six stored relations, the raw projections over them, and their text form.

A stored relation is a table of the catalog that is partitioned by lineage tag, bucket and the load that wrote the rows, and
a view that shows, of each tag and bucket, the loads that count. A load adds partitions of its own, which nobody sees, and then
turns the view; that is one step of the catalog, so a reader finds the rows before it or after it, and writes nothing.
What a load replaced is dropped by the next one, for readers still at it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType

from carelens import schemas
from carelens.functions.text import typed_projection
from carelens.functions.time import format_timestamp

#: What a table's own name ends with, its view having the plain one; and its partition columns after the tag.
ROWS, BUCKET, WRITTEN = "__rows", "bucket", "written"
#: Properties of a view: which load turned it last, the loads that count per tag and bucket, and notes of who turned it.
TURNED, LIVE, NOTE = "turned", "live.", "note."

#: Loads that count, by tag and bucket.
Live = dict[tuple[str, str], list[str]]


def table_name(base: str, table: str) -> str:
    return f"`{base}`.`{table}`"


def rows_name(name: str) -> str:
    """The table behind a view."""
    return f"{name[:-1]}{ROWS}`" if name.endswith("`") else name + ROWS


def open_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All six relations of the database ``base``, stored form (with the lineage tag).

    ``base`` is the only thing that differs between environments. Tables that are missing raise: a wrong base must not
    look like one without rows.
    """
    require_tables(spark, base, tuple(schemas.TABLES))
    return {table: spark.table(table_name(base, table)) for table in schemas.TABLES}


def create_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """An empty relation with the columns of ``schema``, the tag ``source`` among them; an existing one is left as it is."""
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "source")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {rows_name(name)} ({own}, source STRING, {BUCKET} STRING, {WRITTEN} STRING) "
        f"USING parquet PARTITIONED BY (source, {BUCKET}, {WRITTEN})"
    )
    if not spark.catalog.tableExists(name):
        show(spark, name, {}, new_load())


def new_load() -> str:
    """A name for what one load writes; names sort by time."""
    return f"{datetime.now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def show(spark: SparkSession, name: str, live: Live, load: str, notes: dict[str, str] | None = None) -> None:
    """Turn the view to the rows of these loads."""
    columns = ", ".join(f"`{c}`" for c in spark.table(rows_name(name)).columns if c not in (BUCKET, WRITTEN))
    known = {TURNED: load} | {f"{LIVE}{tag}/{bucket}": ",".join(loads) for (tag, bucket), loads in live.items()}
    known |= {f"{NOTE}{key}": value for key, value in (notes or {}).items()}
    properties = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in known.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS SELECT {columns} FROM {rows_name(name)} WHERE {condition(live)}")


def condition(live: Live) -> str:
    """What partitions of these loads fulfil; only partition columns take part, so others are not even listed."""
    places = [_quoted(f"{tag}/{bucket}/{load}") for (tag, bucket), loads in live.items() for load in loads]
    return f"concat_ws('/', source, {BUCKET}, {WRITTEN}) IN ({', '.join(places)})" if places else "false"


@dataclass
class Shown:
    """What a view shows: the load that turned it, the loads that count, and notes."""

    turned: str
    live: Live
    notes: dict[str, str]


def shown(spark: SparkSession, name: str) -> Shown:
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    places = {k.removeprefix(LIVE): v for k, v in properties.items() if k.startswith(LIVE)}
    notes = {k.removeprefix(NOTE): v for k, v in properties.items() if k.startswith(NOTE)}
    return Shown(properties[TURNED], {tuple(k.rsplit("/", 1)): v.split(",") for k, v in places.items()}, notes)


def partitions(spark: SparkSession, name: str, load: str | None = None) -> list[tuple[str, str, str]]:
    """Tag, bucket and load of the table's partitions, or of those of one load, as the catalog has them."""
    of = f" PARTITION ({WRITTEN} = {_quoted(load)})" if load else ""
    found = spark.sql(f"SHOW PARTITIONS {rows_name(name)}{of}").collect()
    return [tuple(part.split("=", 1)[1] for part in row.partition.split("/")) for row in found]


def drop_partitions(spark: SparkSession, name: str, places: list[tuple[str, str, str]]) -> None:
    """Drop partitions with their files."""
    if places:
        specs = (f"PARTITION (source = {_quoted(a)}, {BUCKET} = {_quoted(b)}, {WRITTEN} = {_quoted(c)})" for a, b, c in places)
        spark.sql(f"ALTER TABLE {rows_name(name)} DROP IF EXISTS {', '.join(specs)}")


def require_tables(spark: SparkSession, base: str, names: tuple[str, ...]) -> None:
    """Fail with the names of all tables that are missing."""
    missing = [name for name in names if not spark.catalog.tableExists(table_name(base, name))]
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")


def raw(rows: DataFrame, table: str) -> DataFrame:
    """The columns models may read; the lineage tag is left out, so every source counts."""
    return rows.select(*schemas.TABLES[table].fieldNames())


def raw_relations(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: raw(rows, name) for name, rows in tables.items()}


def write_text(rows: DataFrame, table: str, path: str) -> None:
    """Overwrite ``path`` with the rows as CSV: a header, fixed columns, blanks for NULL."""
    stored = schemas.with_source(schemas.TABLES[table])
    rows.select(
        *(
            format_timestamp(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, TimestampNTZType)
            else F.col(f.name)
            for f in stored
        )
    ).write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).option("header", True).option(
        "escape", '"'
    ).csv(path)


def read_text(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The rows written by ``write_text``, typed by column name."""
    stored = schemas.with_source(schemas.TABLES[table])
    text = StructType()
    for name in stored.fieldNames():
        text.add(name, StringType())
    # Notes may span lines. Files are bounded when written, so not splitting them costs little.
    reader = spark.read.schema(text).option("header", True).option("escape", '"').option("multiLine", True)
    rows = reader.csv(path)
    return typed_projection(rows, stored)
