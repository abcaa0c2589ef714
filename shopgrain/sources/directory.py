"""Key directory of a table that is divided by month: which months may hold a key.

(key, month) pairs lie in hash buckets, so a join of incoming keys reads them without shuffling
them, and a few keys read only their buckets. Pairs are added before the table's new version is
committed and are never taken away: a pair that is no longer true, or never came true because
the write stopped, costs one month more to read and changes no result. When many small additions
have piled up, the pairs are written anew.

A file for each generation, written last, names its folder; the highest one is in use.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.sources.files import delete, join, names, read_text, write_text

# Keys looked up by value, so that only their buckets are read; more of them are joined.
FEW_KEYS = 500
# Additions after which the pairs are written anew.
ADDITIONS = 32

KEY, MONTH = "key", "month"


class KeyDirectory:
    """The directory at `path` (below the table's folder), over one key column."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _generation(self) -> int:
        """The highest generation that is complete, 0 without any."""
        found = [name for name in names(self.spark, self.path) if name.endswith(".json")]
        return max((int(name[1:9]) for name in found), default=0)

    def exists(self) -> bool:
        return self._generation() > 0

    def pairs(self) -> DataFrame:
        """The bucketed pairs; a pair may be listed more than once."""
        number = self._generation()
        entry = json.loads(read_text(self.spark, self._entry(number)))
        return self.spark.table(self._table(number, entry["type"], entry["buckets"]))

    def of(self, keys: DataFrame) -> DataFrame:
        """The pairs of `keys` (one column); a pair may be listed more than once."""
        column = keys.columns[0]
        few = [row[0] for row in keys.distinct().limit(FEW_KEYS + 1).collect()]
        pairs = self.pairs()
        if len(few) <= FEW_KEYS:
            return pairs.where(F.col(KEY).isin([k for k in few if k is not None]))
        return pairs.join(keys.select(F.col(column).alias(KEY)), KEY, "left_semi")

    def months(self, keys: DataFrame) -> DataFrame:
        """(month) that may hold any of `keys` (one column), each once."""
        return self.of(keys).select(MONTH).distinct()

    def add(self, pairs: DataFrame) -> None:
        """Add (key, month) pairs of rows about to be committed; known ones are left out."""
        if not self.exists():
            self.build(pairs)
            return
        number = self._generation()
        entry = json.loads(read_text(self.spark, self._entry(number)))
        fresh = pairs.toDF(KEY, MONTH).distinct().join(self.pairs(), [KEY, MONTH], "left_anti")
        table = self._table(number, entry["type"], entry["buckets"])
        self._write(fresh, table, self._folder(number), entry["buckets"])
        self.spark.catalog.refreshTable(table)
        files = [n for n in names(self.spark, self._folder(number)) if n.endswith(".parquet")]
        if len(files) > ADDITIONS * entry["buckets"]:
            self.build(self.pairs())

    def build(self, pairs: DataFrame) -> None:
        """Write a new generation from (key, month) pairs and drop the ones before the last."""
        number = max([self._generation(), *[
            int(name[1:9]) for name in names(self.spark, self.path) if name.startswith("g")
        ]]) + 1
        kind = pairs.dtypes[0][1]
        table = self._table(number, kind, self.buckets)
        self._write(pairs.toDF(KEY, MONTH).distinct(), table, self._folder(number), self.buckets)
        self.spark.catalog.refreshTable(table)
        entry = {"type": kind, "buckets": self.buckets}
        write_text(self.spark, self._entry(number), json.dumps(entry))
        for name in names(self.spark, self.path):
            if name[1:9].isdigit() and int(name[1:9]) < number - 1:
                if not name.endswith(".json"):
                    self.spark.sql(f"drop table if exists {self._name(int(name[1:9]))}")
                delete(self.spark, join(self.path, name))

    @staticmethod
    def _write(pairs: DataFrame, table: str, folder: str, buckets: int) -> None:
        # One file for each bucket of an addition: rows arrive dealt as the buckets are.
        dealt = pairs.repartition(buckets, KEY)
        dealt.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).mode("append").option(
            "path", folder
        ).saveAsTable(table)

    def _folder(self, number: int) -> str:
        return join(self.path, f"g{number:08d}")

    def _entry(self, number: int) -> str:
        return join(self.path, f"v{number:08d}.json")

    def _name(self, number: int) -> str:
        return f"shopgrain_keys_{hashlib.md5(self._folder(number).encode()).hexdigest()[:16]}"

    def _table(self, number: int, kind: str, buckets: int) -> str:
        """The folder as a table of the session's catalog, which only tells Spark of the buckets."""
        name = self._name(number)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"create table if not exists {name} ({KEY} {kind}, {MONTH} string) using parquet "
                f"options (path '{self._folder(number)}') "
                f"clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets"
            )
        return name
