"""A keyed table on Parquet whose readers only ever see whole versions.

A version is a list of buckets and the folder each lies in. An upsert writes new folders for the buckets it touches and
then, as the last step, the list of the next version; untouched buckets stay where they are. A writer that dies before
that step leaves folders no list names. Batches carry a name, and one that some version names already is not applied
again. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LIST = "version long, batch string, bucket int, path string"


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str, keys: tuple[str, ...], buckets: int = 64):
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), keys, buckets

    def _lists(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LIST).parquet(f"{self.folder}/versions/*")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The number of the current version; -1 before the first."""
        lists = self._lists()
        return -1 if lists is None else lists.agg(F.max("version")).first()[0]

    def _paths(self, version: int) -> dict[int, str]:
        return {r.bucket: r.path for r in self._lists().where(F.col("version") == version).collect()}

    def _commit(self, version: int, batch: str, paths: dict[int, str]) -> None:
        rows = [(version, batch, b, p) for b, p in sorted(paths.items())] or [(version, batch, None, None)]
        self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/versions/{version:09d}")

    def _write(self, rows: DataFrame, schema_of: DataFrame) -> dict[int, str]:
        """Write rows by bucket; the folders of the buckets that got rows."""
        place = f"{self.folder}/data/{uuid.uuid4().hex}"
        placed = rows.select(*schema_of.columns).withColumn("__bucket", self._bucket())
        placed.repartition(F.col("__bucket")).write.partitionBy("__bucket").parquet(place)
        there = self.spark.read.parquet(place).select("__bucket").distinct().collect() if placed.limit(1).count() else []
        return {r[0]: f"{place}/__bucket={r[0]}" for r in there}

    def read(self, version: int | None = None) -> DataFrame:
        """A whole version, the current one by default."""
        number = self.version() if version is None else version
        paths = [p for p in self._paths(number).values() if p]
        schema = self.spark.read.parquet(f"{self.folder}/schema").schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def create(self, rows: DataFrame, batch: str = "create") -> None:
        """The first version."""
        rows.limit(0).write.mode("overwrite").parquet(f"{self.folder}/schema")
        self._commit(0, batch, self._write(rows, rows))

    def upsert(self, rows: DataFrame, batch: str, order: Column | None = None) -> int:
        """Replace the rows whose keys come again, add the others, and give the version that holds the batch. Of several
        rows with one key the one with the largest `order` counts, and of these the largest."""
        lists = self._lists()
        done = lists.where(F.col("batch") == batch).agg(F.max("version")).first()[0]
        if done is not None:
            return done
        number = self.version()
        paths = self._paths(number)
        old = self.read(number)
        columns = old.columns
        whole = F.struct(*([order.alias("__order")] if order is not None else []), F.struct(*columns).alias("__row"))
        new = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in self.keys]).agg(F.max(whole).alias("__new")).select("__new.__row.*")
        touched = sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())  # no more than `buckets`
        kept = [paths[b] for b in touched if paths.get(b)]
        before = self.spark.read.schema(old.schema).parquet(*kept) if kept else old.limit(0)
        merged = before.join(new.select(*self.keys), list(self.keys), "left_anti").select(*columns).unionByName(new)
        written = self._write(merged, old)
        self._commit(number + 1, batch, {b: p for b, p in {**paths, **written}.items() if p})
        return number + 1

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """The keys that differ between two versions and how: inserted, updated or deleted. Buckets in the same folder in
        both are not read."""
        a, b = self._paths(since), self._paths(self.version() if until is None else until)
        schema = self.read(since).schema

        def side(mine: dict[int, str], other: dict[int, str], name: str) -> DataFrame:
            paths = [p for k, p in mine.items() if p and other.get(k) != p]
            rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
            return rows.select(*self.keys, F.struct(*rows.columns).alias(name))

        both = side(a, b, "old").join(side(b, a, "new"), list(self.keys), "full")
        kind = F.when(F.col("old").isNull(), F.lit("inserted")).when(F.col("new").isNull(), F.lit("deleted")).otherwise(F.lit("updated"))
        return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*self.keys, kind.alias("change"))
