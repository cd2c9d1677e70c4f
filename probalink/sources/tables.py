"""Readers and writers: company registers, translations, invoices, result tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probalink.functions.normalize import filled
from probalink.sources.storage import stored

# The register's headers and the columns they become.
REGISTER_COLUMNS = {
    "CompanyNumber": "company_number",
    "CompanyName": "company_name",
    "RegAddress.AddressLine1": "address_line1",
    "RegAddress.AddressLine2": "address_line2",
    "RegAddress.PostTown": "post_town",
    "RegAddress.County": "county",
    "RegAddress.Country": "country",
    "RegAddress.PostCode": "postcode",
    "CompanyCategory": "company_category",
    "CompanyStatus": "company_status",
    "IncorporationDate": "incorporation_date",
    "SICCode.SicText_1": "sic_1",
    "PreviousName_1.CompanyName": "previous_name",
}
INVOICE_SCHEMA = "id_invoice LONG, issued_date DATE, country STRING, service STRING, total DOUBLE, discount DOUBLE, tax DOUBLE, invoice_status STRING, balance DOUBLE, due_date DATE, client STRING"


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """A company register in CSV: headers are stripped and found by name, texts trimmed, empty ones null, dates parsed (dd/mm/yyyy).

    Only the needed columns are parsed. A missing header or company number is an error.
    """
    raw = spark.read.csv(path, header=True, escape='"')
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    text = {new: filled(F.trim(F.col(f"`{old}`"))) for old, new in REGISTER_COLUMNS.items()}
    text["incorporation_date"] = F.to_date(text["incorporation_date"], "dd/MM/yyyy")
    return required(raw.select(*[c.alias(n) for n, c in text.items()]), "company_number")


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """Translations in CSV; a quote inside a quoted cell is doubled."""
    return spark.read.csv(path, header=True, escape='"', schema="company_number STRING, registered_name STRING, language STRING, translated_name STRING")


def read_invoices(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Invoices in CSV; with infer, columns and types as the file has them, names in lower case."""
    if infer:
        raw = spark.read.csv(path, header=True, escape='"', inferSchema=True)
        return raw.toDF(*[c.lower() for c in raw.columns])
    return spark.read.csv(path, header=True, escape='"', schema=INVOICE_SCHEMA, enforceSchema=True)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").csv(path, header=True, escape='"')


def from_rows(spark: SparkSession, rows: Iterable[Sequence[Any] | Mapping[str, Any]], schema: str | T.StructType) -> DataFrame:
    """A table of the caller's own rows."""
    return spark.createDataFrame(list(rows), schema)


def required(df: DataFrame, *columns: str) -> DataFrame:
    """df, failing at the first row where one of the columns is null, whatever is read of it: the check is a filter, which no choice of
    columns removes and a count runs too."""
    for c in columns:
        df = df.where(F.when(F.col(c).isNotNull(), True).otherwise(F.raise_error(F.lit(f"{c} is null")).cast("boolean")))
    return df


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df as table `name`, replacing an older one; df may read the older one.

    The rows go to a folder of their own, and the catalogue's entry for the table is pointed to it in one step: at any time the table has
    the old rows or the new ones. The folder before the last is deleted, so that a statement that runs meanwhile can end. A
    table whose columns change is the exception: its entry is dropped and made anew.
    """
    spark = df.sparkSession
    # Spark's own names for a table's folder are those of managed tables; these stand beside them
    home = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tables/{name}"
    folder = f"{home}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    columns = lambda kind: [(f.name.lower(), f.dataType.simpleString()) for f in kind]
    before = None
    if spark.catalog.tableExists(name):
        before = scalar(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").select("data_type"))
        if columns(spark.table(name).schema) == columns(df.schema):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, folder, "parquet", schema=df.schema)
    spark.catalog.refreshTable(name)
    place = spark._jvm.org.apache.hadoop.fs.Path(home)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = {folder.rpartition("/")[2], (before or "").rstrip("/").rpartition("/")[2]}
    for old in files.listStatus(place):
        if old.getPath().getName() not in kept:
            files.delete(old.getPath(), True)
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drops a table and, if `replace_table` has made it, its folders."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tables/{name}")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def append(table: DataFrame, more: DataFrame) -> DataFrame:
    return table.unionByName(more)


def merged(table: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """table with `columns` taken from the update of the same key, nulls included, where there is one."""
    new = updates.select(F.col(key).alias("__key"), F.struct(*columns).alias("__new"))
    joined = table.join(new, table[key] == new["__key"], "left")
    values = {c: F.when(F.col("__key").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(values).select(*table.columns)


def with_row_id(files: DataFrame, column: str = "row_id") -> DataFrame:
    """df, read from Parquet files, with an id that names a row by its place and so is the same at every read."""
    return files.select("*", F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")).alias(column))


def with_content_id(df: DataFrame, column: str = "row_id", columns: Sequence[str] | None = None) -> DataFrame:
    """df with an id that names a row by its content, all of its columns or those given: their SHA-256, and which of the rows of equal
    content it is, from 1 on. The ids are the same for whatever files hold the rows, in whatever order; a null differs from an empty
    text. Rows of equal content, however many, are counted within parts of the table, whose counts are then added up. Hashes aren't
    written with the rows but made where they are read, and dealt out as 32 bytes; only parts that come after others of their content are joined.
    """
    own = list(columns or df.columns)
    content = F.unhex(F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256))
    rows = stored(df.withColumn("__part", F.spark_partition_id()), "contents").withColumn("__content", content)
    counts = rows.groupBy("__content", "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("__content").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    offsets = stored(counts.select("__content", "__part", F.sum("__n").over(earlier).alias("__before")).where("__before > 0"), "offsets")  # and its shuffles go
    within = F.row_number().over(Window.partitionBy("__content", "__part").orderBy(F.lit(0)))
    numbered = rows.withColumn("__number", within).join(offsets, ["__content", "__part"], "left")
    number = F.coalesce("__before", F.lit(0)) + F.col("__number")
    return numbered.select(*df.columns, F.concat_ws("#", F.lower(F.hex("__content")), number.cast("string")).alias(column))


def run_script(spark: SparkSession, script: str, args: Mapping[str, Any] | None = None) -> DataFrame | None:
    """Runs the statements of a script one after another and returns the result of the last (None, if there are none).

    A statement may have several lines and ends at a line that holds only a slash. args are bound to the markers (:name) of those
    statements that have them, so values never become part of the text.
    """
    result = None
    for statement in re.split(r"(?m)^[ \t]*/[ \t]*$", script):
        if statement.strip():
            used = {n: v for n, v in (args or {}).items() if re.search(rf":{n}\b", statement)}
            result = spark.sql(statement, args=used) if used else spark.sql(statement)
    return result


def scalar(df: DataFrame) -> Any:
    """The single value of a one-row result."""
    return df.first()[0]


def secret(name: str) -> str:
    """A key from the environment of the process that asks: never a column, a literal or a setting that the UI shows."""
    try:
        return os.environ[name]
    except KeyError:
        raise RuntimeError(f"the environment variable {name} is not set") from None
