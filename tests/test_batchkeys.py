"""Keys that several landed batches hold, and which batches are read to find them."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from shopgrain.rules import ORDERS
from shopgrain.sources import directory as kd
from shopgrain.sources import landing
from shopgrain.sources.batchkeys import BatchKeys

DDL = "order_id long, order_status string"


def land(rows, root, batch, day, keys):
    frame = rows(DDL, *[(k, "pending") for k in keys])
    landing.land(landing.with_lineage(frame, landing.Batch(batch, day, f"{day}T00:00:00+00:00"), "s", "orders"),
                 root, ORDERS)


@pytest.mark.parametrize("few", [0, 500])
def test_equals_sets(spark, rows, tmp_path, monkeypatch, few):
    monkeypatch.setattr(kd, "FEW_KEYS", few)
    root, rng, held = str(tmp_path / "bronze"), random.Random(few), {}
    kept = BatchKeys(spark, root, ORDERS, str(tmp_path / "keys"), 4)
    # One id is landed twice, with other rows; ids need not be plain names; nulls and repeats.
    for step, batch in enumerate(["b1", "b 2/x", "b1", "b3"]):
        keys = [rng.choice([None, *range(12)]) for _ in range(8)]
        land(rows, root, batch, "2024-01-01" if batch == "b1" else f"2024-01-0{step + 1}", keys)
        held[batch] = {k for k in keys if k is not None}
        got = [tuple(r) for r in kept.repeated(batch).collect()]
        assert sorted(got) == sorted(
            (k, batch, other) for other in held if other != batch for k in held[other] & held[batch]
        )
    assert kept.landed() == ["b 2/x", "b1", "b3"]


def test_unaffected_batches_are_not_read(spark, rows, tmp_path):
    root = str(tmp_path / "bronze")
    kept = BatchKeys(spark, root, ORDERS, str(tmp_path / "keys"), 2,
                     schema=rows(DDL).schema)
    land(rows, root, "b1", "2024-01-01", [1, 2])
    land(rows, root, "b2", "2024-01-02", [3, 4])
    kept.enter(kept.landed())
    for file in glob.glob(f"{root}/**/batch_id=b1/*.parquet", recursive=True):
        with open(file, "wb") as out:
            out.write(b"unreadable")
    land(rows, root, "b3", "2024-01-03", [4, 5])
    assert [tuple(r) for r in kept.repeated("b3").collect()] == [(4, "b3", "b2")]


def test_nothing_landed_nothing_shared(spark, rows, tmp_path):
    root = str(tmp_path / "bronze")
    kept = BatchKeys(spark, root, ORDERS, str(tmp_path / "keys"), 2)
    assert kept.landed() == []
    land(rows, root, "b1", "2024-01-01", [1, 2])
    assert kept.repeated("b1").collect() == []
    land(rows, root, "b2", "2024-01-02", [None, None])
    assert kept.repeated("b2").select(F.count("*")).first()[0] == 0
