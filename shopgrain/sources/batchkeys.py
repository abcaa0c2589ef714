"""Keys that several landed batches hold, without reading the batches that cannot hold them.

A key directory lists which batch may hold a key. Incoming keys meet the directory; only the
batches it names are looked at, in their key column, so the result is exact also where a batch was
landed again with other rows. Null keys name no row and are left out.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopgrain.operators.lookup import lookup_join
from shopgrain.rules import EntityRules
from shopgrain.runtime import written
from shopgrain.sources import landing
from shopgrain.sources.directory import KEY, MONTH, KeyDirectory
from shopgrain.sources.files import join, names, write_text

OTHER = "other_batch"


class BatchKeys:
    """Keys of the landed batches of one entity below `root`, kept at `path` in hash buckets."""

    def __init__(
        self, spark: SparkSession, root: str, rules: EntityRules, path: str, buckets: int,
        schema: StructType | None = None,
    ):
        self.spark, self.root, self.rules, self.schema = spark, root, rules, schema
        self.directory = KeyDirectory(spark, path, buckets)
        # One empty file for each batch whose keys are in the directory.
        self.ledger = f"{path.rstrip('/')}-batches"

    def landed(self) -> list[str]:
        """Ids of the landed batches, from folder names alone."""
        path = landing.entity_path(self.root, self.rules.source_type, self.rules.name)
        days = [day for day in names(self.spark, path) if day.startswith("ingestion_date=")]
        found = {name for day in days for name in names(self.spark, join(path, day))}
        return sorted(unquote(n.split("=", 1)[1]) for n in found if n.startswith("batch_id="))

    def enter(self, batches: list[str]) -> None:
        """Add the keys of these batches. Known ones are left out, so doing it twice does no harm."""
        entered = self._entered()
        for start in range(0, len(batches), 100):
            part = batches[start:start + 100]
            self.directory.add(self._keys(part))
            for batch in set(part) - entered:
                write_text(self.spark, join(self.ledger, quote(batch, safe="")), "")

    def repeated(self, batch_id: str) -> DataFrame:
        """(key, batch_id, other_batch): keys of the batch that another landed batch holds too, a row
        for each of the others. Batches that are not in the directory yet are entered first."""
        key = self.rules.key
        known = self._entered()
        # Its own keys are entered anew, as it may have been landed again.
        self.enter([b for b in self.landed() if b == batch_id or b not in known])
        keys = written(self._keys([batch_id]).select(KEY).distinct(), "batch-keys")
        may = written(
            self.directory.of(keys).where(F.col(MONTH) != batch_id).distinct(), "batch-candidates"
        )
        others = [row[0] for row in may.select(MONTH).distinct().collect()]
        held = lookup_join(self._keys(others), may, [KEY, MONTH]).distinct()
        # Written down: the batches may be landed again before the result is used.
        return written(held.select(
            F.col(KEY).alias(key), F.lit(batch_id).alias("batch_id"), F.col(MONTH).alias(OTHER)
        ), "repeated-keys")

    def _entered(self) -> set[str]:
        return {unquote(name) for name in names(self.spark, self.ledger)}

    def _keys(self, batches: list[str]) -> DataFrame:
        """(key, batch) of the rows of some batches; only their folders are read."""
        # One batch is read by its folder, several by partition values.
        one = batches[0] if len(batches) == 1 else None
        rows = landing.read_landed(self.spark, self.root, self.rules, self.schema, one)
        return rows.where(F.col("batch_id").isin(batches)).where(
            F.col(self.rules.key).isNotNull()
        ).select(F.col(self.rules.key).alias(KEY), F.col("batch_id").alias(MONTH))
