"""The medallion tables: Parquet folders under versioned manifests.

A merge writes the partitions that its batch touches to a new folder and commits them by one manifest, with
the key index if the table has one.  Until then nothing has changed for readers; a job that dies before leaves
files that no manifest names, and its batch is repeated.  Merges are idempotent, which makes replays harmless.
The newest versions are kept, so a table can be read as of a batch.

Where a key does not tell its partition, a key index stands beside the table: key and partition, in slices of
the key.  A merge reads the slices of its batch and takes in the partitions that hold its keys now, so a key
that arrives for another partition moves there and stays one row.

Once a table has been written, its absence is an error, not an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.upsert import RULES, fold
from ..schemas import TABLES, Table
from .manifest import Folders, History, Lease, Manifest

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WHOLE = ""  # the only part of a table without partitions
KEEP_VERSIONS = 20
KEYS_IN_A_SLICE = 20  # bits of a whole-number key; other keys are dealt by hash
HASH_SLICES = 256
LEASE_SECONDS = 6 * 3600


class MedallionTables:
    def __init__(self, spark: SparkSession, root: str, keep_versions: int = KEEP_VERSIONS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions
        self.folders = Folders(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def history(self, name: str) -> History:
        return History(self.folders, f"{self.path(name)}/_versions")

    def exists(self, path: str) -> bool:
        return self.folders.exists(path)

    def delete(self, path: str) -> None:
        self.folders.delete(path)

    def lease(self, owner: str | None = None, seconds: float = LEASE_SECONDS) -> Lease:
        """The right to write to these tables; another owner's run is refused until it is given back or runs out."""
        return Lease(self.folders, f"{self.root}/_lease.json", owner or self.spark.sparkContext.applicationId, seconds)

    def write_report(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        """Keep a batch's report; the same batch again replaces it."""
        folder = f"{self.root}/reports/{name}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    # reading

    def manifest(self, name: str, as_of: int | None = None) -> Manifest | None:
        """What the table is now, or was after a batch; None if it was never written."""
        history = self.history(name)
        found = history.newest() if as_of is None else history.as_of(as_of)
        if found is None and as_of is None and self.exists(f"{self.root}/_written/{name}"):
            raise FileNotFoundError(f"table {name} was written to {self.path(name)}, and is gone")
        return found

    def _load(self, base: str, folders: Iterable[str], schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read.option("basePath", base)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(*[f"{base}/{f}" for f in sorted(set(folders))])

    def read(self, name: str, as_of: int | None = None) -> DataFrame:
        """The table's rows now, or as they were after batch ``as_of``, if that version is still kept."""
        schema, found = TABLES[name].schema, self.manifest(name, as_of)
        if found is None or not found.parts:
            return self.spark.createDataFrame([], schema)
        rows = self._load(f"{self.path(name)}/data", found.parts.values(), schema)
        return rows.select(*schema.fieldNames())

    def read_derived(self, name: str) -> DataFrame:
        """A table outside the registry, with the columns that it was written with."""
        found = self.manifest(name)
        if found is None or not found.parts:
            raise FileNotFoundError(f"table {name} has no rows that tell its columns")
        return self._load(f"{self.path(name)}/data", found.parts.values(), None).drop("commit")

    # writing

    def _commit(
        self, name: str, batch_id: int, parts: dict[str, str | None],
        keys: dict[str, str] | None = None, marks: dict[str, int] | None = None,
    ) -> None:
        history = self.history(name)
        before = history.newest() or Manifest(0, batch_id)
        history.commit(before.changed(batch_id, parts, keys or {}, marks or {}))
        self.folders.make(f"{self.root}/_written/{name}")
        for folder in history.drop_before(self.keep_versions):
            for kind in ("data", "keys"):
                self.delete(f"{self.path(name)}/{kind}/{folder}")

    def _write(self, name: str, kind: str, rows: DataFrame, partition: str | None) -> dict[str, str]:
        """Rows in a new folder: the name of each partition written, and where it lies."""
        commit = f"commit=c{uuid.uuid4().hex}"
        folder = f"{self.path(name)}/{kind}/{commit}"
        if partition is None:
            rows.write.parquet(folder)
            return {WHOLE: commit}
        # Rebalancing splits a hot partition over several writers.
        rows.hint("rebalance", F.col(partition)).write.partitionBy(partition).parquet(folder)
        return {part: f"{commit}/{part}" for part in self.folders.names(folder, True)}

    @staticmethod
    def _part(partition: str, value) -> str:
        return f"{partition}={NULL_PARTITION if value is None else value}"

    def append(self, name: str, rows: DataFrame, batch_id: int, mark: str | None = None) -> DataFrame:
        """Add a batch's rows, none merged; the same batch again replaces itself.

        ``mark`` names a column whose highest value is kept in the manifest, see :meth:`highest`.
        """
        table = TABLES[name]
        commit = f"commit=c{uuid.uuid4().hex}"
        folder = f"{self.path(name)}/data/{commit}"
        rows.hint("rebalance", F.col(table.partition)).write.partitionBy(table.partition).parquet(folder)
        written = self.spark.read.schema(table.schema).parquet(folder).select(*table.columns)
        marks = {f"batch_id={batch_id}": written.agg(F.max(mark)).first()[0] or 0} if mark else {}
        self._commit(name, batch_id, {f"batch_id={batch_id}": commit}, marks=marks)
        return written

    def highest(self, name: str, before_batch: int) -> int:
        """The highest mark that batches before this one left; a replay does not see its own."""
        found = self.manifest(name)
        marks = found.marks if found else {}
        return max((high for part, high in marks.items() if int(part.split("=")[1]) < before_batch), default=0)

    def replace_table(self, name: str, batch_id: int, rows: Callable[[], DataFrame]) -> None:
        """Write the next version of a table without partitions; a batch that did is not computed again."""
        found = self.history(name).newest()
        if found and found.batch == batch_id:
            return
        self.put_table(name, batch_id, rows())

    def put_table(self, name: str, batch_id: int, rows: DataFrame) -> None:
        """The next version of a table without partitions, whatever was there."""
        self._commit(name, batch_id, self._write(name, "data", rows, None))

    def replace_partitions(self, name: str, batch_id: int, partition: str, days: list, rows: DataFrame) -> None:
        """Put ``rows`` in place of some partitions; those that get none are gone."""
        gone = {self._part(partition, day): None for day in days}
        self._commit(name, batch_id, {**gone, **self._write(name, "data", rows, partition)})

    def touched(self, rows: DataFrame, partition: str) -> list:
        """The partitions a batch falls into, NULL among them: calendar days, so a bounded list."""
        return [r[0] for r in rows.select(partition).distinct().collect()]

    @staticmethod
    def within(rows: DataFrame, partition: str, days: list) -> DataFrame:
        """The rows of some partitions; the scan is pruned, and NULL is a partition like the others."""
        return rows.where(_among(partition, days))

    def merge(self, name: str, arrivals: DataFrame, batch_id: int) -> list:
        """Fold a batch of arrivals into a partitioned table; gives the partitions touched."""
        table, rule = TABLES[name], RULES[name]
        arrivals = arrivals.select(*table.columns)
        days = self.touched(arrivals, table.partition)
        if not days:
            return []
        slices, index = [], None
        if table.moving:
            slices = self.touched(arrivals.select(key_slice(table)), "slice")
            index = self._index(table, slices)
            here = index.join(arrivals.select(*table.key).distinct(), list(table.key), "left_semi")
            days = list({*days, *self.touched(here, table.partition)})
        merged = fold(
            self.within(self.read(name), table.partition, days), arrivals, rule["keys"],
            rule["order"], rule.get("guard"), rule.get("keep", ()), rule.get("changed", ()), rule.get("arrival"),
        )
        written = self._write(name, "data", merged, table.partition)
        keys = self._index_after(table, index, written, days, slices) if table.moving else {}
        self._commit(name, batch_id, {**{self._part(table.partition, d): None for d in days}, **written}, keys)
        return days

    def _index(self, table: Table, slices: list) -> DataFrame:
        """(key, partition) of the stored rows in some slices of the key."""
        columns = [*table.key, table.partition]
        schema = T.StructType([table.schema[c] for c in columns]).add("slice", "long")
        found = self.manifest(table.name)
        wanted = [found.keys[p] for p in (self._part("slice", s) for s in slices) if p in found.keys] if found else []
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self._load(f"{self.path(table.name)}/keys", wanted, schema).select(*schema.fieldNames())

    def _index_after(self, table: Table, index: DataFrame, written: dict[str, str], days: list, slices: list) -> dict[str, str]:
        """The slices' keys once the partitions ``days`` are what was written."""
        rows = self._load(f"{self.path(table.name)}/data", written.values(), table.schema)
        fresh = rows.select(*table.key, table.partition, key_slice(table)).where(_among("slice", slices))
        elsewhere = index.where(~_among(table.partition, days))
        return self._write(table.name, "keys", elsewhere.unionByName(fresh), "slice")


def _among(partition: str, values: list) -> Column:
    wanted = F.coalesce(F.col(partition).isin([v for v in values if v is not None]), F.lit(False))
    if None in values:
        return wanted | F.col(partition).isNull()
    return wanted & F.col(partition).isNotNull()


def key_slice(table: Table) -> Column:
    """The slice of the key index that a row's key lies in: whole-number keys in order, others by hash."""
    kinds = [table.schema[k].dataType for k in table.key]
    if kinds == [T.LongType()]:
        return F.shiftright(table.key[0], KEYS_IN_A_SLICE).alias("slice")
    return F.pmod(F.xxhash64(*table.key), F.lit(HASH_SLICES)).cast("long").alias("slice")
