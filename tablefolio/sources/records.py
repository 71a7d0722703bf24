"""Structured inputs: manifests, users, activity logs, inventories, spans, layout cells, master companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio import schemas
from tablefolio.functions.numbers import to_id
from tablefolio.operators.grid import file_id

MANIFEST = ("extended_metadata struct<page_count:int>, elements array<struct<filePaths:array<string>,Page:int,"
            "attributes:struct<NumCol:int,NumRow:int>>>")
USERS = "users array<struct<id:bigint,firstName:string,lastName:string>>"
ACTIVITY = "userId string, createdAt string, updatedAt string, pageName string, actionType string"
INVENTORY = ("Path string, Name string, GP string, Stage string, Year string, Geo string, Modified string, "
             "`Modified By` string, `Doc Type` string")

SPREAD_BYTES = 4 << 20  # of the input's files, for a partition


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Give heavy row work a partition for every few MB of input, and one per core at least.

    The splits of a file are of many times that size, and a file of one row group is a single one: their rows would meet
    in one task, whose memory grows with the file.
    """
    if not df.inputFiles():
        return df
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size")).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES)), *keys)


def manifest_elements(manifests: DataFrame) -> DataFrame:
    """Table files named in element manifests (`name`, `extended_metadata`, `elements`).

    Elements without files do not count for the file number; elements without a page are left out.
    """
    listed = F.filter("elements", lambda e: e["filePaths"].isNotNull())
    found = manifests.select("name", F.col("extended_metadata.page_count").alias("page_count"),
                             F.posexplode(listed).alias("idx", "e"))
    path = F.concat(F.col("name"), F.lit("/"), F.col("name"), F.lit("_"), F.col("idx").cast("string"), F.lit(".csv"))
    return found.where("e.Page IS NOT NULL").select(
        "name", "page_count", path.alias("csv_path"), F.col("e.attributes.NumCol").alias("col_num"),
        F.col("e.attributes.NumRow").alias("row_num"), F.col("e.Page").alias("page"))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(MANIFEST).json(path, multiLine=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return manifest_elements(raw.withColumn("name", name))


def table_file_id(name: Column) -> Column:
    return file_id(name)


def user_names(raw: DataFrame) -> DataFrame:
    """id, firstName, lastName, userName of nested user lists; a missing part leaves the name null."""
    users = raw.select(F.inline("users"))
    return users.select("id", "firstName", "lastName", F.concat("firstName", F.lit(" "), "lastName").alias("userName"))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return user_names(spark.read.schema(USERS).json(path, multiLine=True))


def typed_activity(raw: DataFrame) -> DataFrame:
    """Text activity to types; rows without a numeric user are dropped."""
    return raw.withColumns({
        "userId": to_id(F.col("userId")),
        "createdAt": F.try_to_timestamp("createdAt"), "updatedAt": F.try_to_timestamp("updatedAt"),
    }).dropna(subset=["userId"])


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    return typed_activity(spark.read.schema(ACTIVITY).csv(path, header=True))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INVENTORY).csv(path, header=True, multiLine=True)


def read_layout_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LAYOUT_CELLS).json(path)


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SPANS).json(path)


def pages_of_spans(spans: DataFrame) -> DataFrame:
    """Flat spans to one row per page with its text and ordered span array; a page bounds the array."""
    fields = ["text", "size", "dir_x", "block_y0", "x0", "y0", "x1", "y1"]
    ordered = F.array_sort(F.collect_list(F.struct("span_ord", F.struct(*fields).alias("span"))))
    pages = spans.groupBy("doc_id", "page").agg(F.max("page_height").alias("height"), ordered.alias("o"))
    all_spans = F.transform("o", lambda s: s["span"])
    return pages.select("doc_id", "page", "height", all_spans.alias("spans"),
                        F.array_join(F.transform(all_spans, lambda s: s["text"]), "\n").alias("text"))


def master_companies(spark: SparkSession, table: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """company_id and company_name_master from the catalog, or over JDBC where the table is not there."""
    if spark.catalog.tableExists(table):
        source = spark.table(table)
    elif jdbc:
        query = f"SELECT CompanyID, CompanyName FROM {table}"
        source = spark.read.format("jdbc").options(**jdbc).option("query", query).load()
    else:
        raise ValueError(f"{table} is not in the catalog and no JDBC options are given")
    return source.select(F.col("CompanyID").alias("company_id"), F.col("CompanyName").alias("company_name_master"))
