from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldmill.operators import frame_difference
from fieldmill.plans import bids
from fieldmill.sources import new_shared_folder, read_json
from fieldmill.streaming import (
    gold,
    in_view_flag,
    merged_type,
    run_available,
    silver_device,
    silver_imp,
    silver_site,
    stream_json,
)


def bid(number, imps, status=1, os="ios"):
    record = {
        "id": f"b{number}",
        "device": {"os": os, "ua": "x", "geo": {"country": "DE"}},
        "app": {"id": f"a{number}", "name": "App"},
    }
    if imps is not None:
        record["imp"] = [
            {"id": f"{number}-{i}", "bidfloor": 0.5 * i, "banner": {"h": 50, "w": 320, "pos": i}}
            for i in range(imps)
        ]
    if status is not None:
        record["ext"] = {"ads_txt": {"status": status}}
    return record


FIRST = [bid(1, 2), bid(2, 0, status=0), bid(3, None, status=None)]
SECOND = [bid(4, 1), bid(5, 3, status=None)]


@pytest.fixture
def stage(spark):
    root = Path(new_shared_folder(spark, "stage"))
    (root / "incoming").mkdir()
    return root / "incoming", bids.BidTables(str(root / "tables"))


def drop_file(folder, name, records):
    (folder / name).write_text(json.dumps(records, indent=1))


def run_all(spark, incoming, tables):
    bronze = bids.update_bronze(spark, str(incoming), tables, bids.BID_SCHEMA)
    silver = bids.update_silver(spark, tables, schema=bids.BID_SCHEMA)
    return bronze, silver


def test_bronze_keeps_every_field_and_takes_up_new_ones(spark, stage):
    incoming, tables = stage
    drop_file(incoming, "one.json", FIRST)
    bids.update_bronze(spark, str(incoming), tables)
    first = bids.update_silver(spark, tables, ["device"])["device"]
    assert "device_model" not in first.columns
    later = bid(9, 1)
    later["at"], later["device"]["model"], later["device"]["geo"]["city"] = 7, "m", "Ulm"
    drop_file(incoming, "two.json", [later])
    bronze = bids.update_bronze(spark, str(incoming), tables)
    silver = bids.update_silver(spark, tables, ["device"])["device"]
    kept = {r["id"]: (r["at"], r["model"], r["city"]) for r in bronze.select("id", "at", "device.model", "device.geo.city").collect()}
    assert kept == {"b1": (None,) * 3, "b2": (None,) * 3, "b3": (None,) * 3, "b9": (7, "m", "Ulm")}
    models = {r["device_auction_id"]: (r["device_model"], r["device_city"]) for r in silver.collect()}
    assert models == {"b1": (None, None), "b2": (None, None), "b3": (None, None), "b9": ("m", "Ulm")}


def test_only_new_files_are_inferred(spark, stage, monkeypatch):
    incoming, tables = stage
    looked_at = []

    def counted(spark, paths, **options):
        looked_at.append(sorted(Path(path).name for path in paths))
        return read_json(spark, paths, **options)

    monkeypatch.setattr(bids, "read_json", counted)
    drop_file(incoming, "one.json", FIRST)
    drop_file(incoming, "a 1.json", FIRST[:1])
    bids.update_bronze(spark, str(incoming), tables)
    drop_file(incoming, "two.json", SECOND)
    assert bids.update_bronze(spark, str(incoming), tables).count() == 6
    bids.update_bronze(spark, str(incoming), tables)
    assert looked_at == [["a 1.json", "one.json"], ["two.json"]]


def test_a_field_may_need_a_wider_type(spark, stage):
    incoming, tables = stage
    numbers = [("one", 1), ("two", 1.5), ("three", "much"), ("four", {"a": 1}), ("five", 2)]
    for i, (name, at) in enumerate(numbers):
        record = bid(i, 1)
        record["at"], record["device"]["geo"]["zone"] = at, at
        drop_file(incoming, f"{name}.json", [record])
        bronze = bids.update_bronze(spark, str(incoming), tables)
        silver = bids.update_silver(spark, tables)
        table = bids.update_gold(spark, tables, F.lit(1.0))
        assert frame_difference(table, bids.build_gold(spark, tables, F.lit(1.0))).count() == 0
    assert len(tables.schema_log(spark).generations()) == 3
    assert [r["at"] for r in bronze.orderBy("id").select("at").collect()] == ["1", "1.5", "much", '{"a":1}', "2"]
    zones = silver["device"].orderBy("device_auction_id").select("device_zone").collect()
    assert [r[0] for r in zones] == ["1", "1.5", "much", '{"a":1}', "2"]
    assert table.count() == silver["imp"].count() == 5


def test_merged_types():
    old = StructType.fromDDL("a bigint, s struct<x: bigint, y: string>, l array<struct<z: bigint>>, t string")
    new = StructType.fromDDL("a double, s struct<x: bigint, w: boolean>, l array<struct<z: bigint, v: double>>, t bigint, n bigint")
    merged = merged_type(old, new)
    assert merged == StructType.fromDDL(
        "a double, s struct<x: bigint, y: string, w: boolean>, l array<struct<z: bigint, v: double>>, t string, n bigint"
    )
    assert merged_type(merged, old) == merged == merged_type(merged, merged)
    assert merged_type(StructType.fromDDL("a array<bigint>"), StructType.fromDDL("a boolean")) == StructType.fromDDL("a string")


def test_gold_rebuilds_the_buckets_of_changed_auctions_only(spark, stage):
    incoming, root = stage[0], stage[1].root
    tables = bids.BidTables(root, buckets=8)

    def update():
        bids.update_bronze(spark, str(incoming), tables)
        bids.update_silver(spark, tables)
        gold_table = bids.update_gold(spark, tables, F.lit(1.0))
        assert frame_difference(gold_table, bids.build_gold(spark, tables, F.lit(1.0))).count() == 0
        return gold_table, {p: p.stat().st_mtime_ns for p in Path(tables.table("gold")).glob("bucket=*/*.parquet")}

    drop_file(incoming, "one.json", [bid(i, i % 3) for i in range(40)])
    table, first = update()
    assert {p.parent.name for p in first} == {f"bucket={k}" for k in range(8)}
    assert update()[1] == first
    drop_file(incoming, "two.json", [bid(7, 2, os="android")])
    table, second = update()
    assert len({p.parent.name for p in second.items() ^ first.items() for p in [p[0]]}) == 1
    assert table.where("device_auction_id = 'b7'").count() == 2 * 2 * 3
    gated = bids.update_gold(spark, bids.BidTables(root, buckets=8), F.lit(1.0))
    assert gated.count() == table.count()


def test_gold_without_rows_and_without_buckets(spark, stage):
    incoming, tables = stage
    run_all(spark, incoming, tables)
    assert bids.update_gold(spark, tables, schema=bids.BID_SCHEMA).count() == 0
    drop_file(incoming, "one.json", FIRST + SECOND)
    run_all(spark, incoming, tables)
    table = bids.update_gold(spark, tables, F.lit(1.0), schema=bids.BID_SCHEMA)
    assert frame_difference(table, bids.build_gold(spark, tables, F.lit(1.0))).count() == 0 and table.count() == 8


def test_each_run_takes_only_new_files(spark, stage):
    incoming, tables = stage
    drop_file(incoming, "one.json", FIRST)
    bronze, silver = run_all(spark, incoming, tables)
    assert bronze.count() == 3
    assert {name: table.count() for name, table in silver.items()} == {"device": 3, "imp": 2, "site": 3}

    # A run without new files adds nothing.
    bronze, silver = run_all(spark, incoming, tables)
    assert (bronze.count(), silver["imp"].count()) == (3, 2)

    drop_file(incoming, "two.json", SECOND)
    bronze, silver = run_all(spark, incoming, tables)
    assert {name: table.count() for name, table in silver.items()} == {"device": 5, "imp": 6, "site": 5}

    # The streamed tables equal the batch steps over all files.
    batch = read_json(spark, str(incoming), multi_line=True, schema=bids.BID_SCHEMA)
    assert frame_difference(bronze, batch).count() == 0
    for name, step in bids.SILVER_STEPS.items():
        assert silver[name].columns == step(batch).columns
        assert frame_difference(silver[name], step(batch)).count() == 0

    table = bids.build_gold(spark, tables, F.lit(1.0))
    assert frame_difference(
        table, gold(silver_device(batch), silver_imp(batch), silver_site(batch), F.lit(1.0))
    ).count() == 0


def test_gold_keeps_bids_without_impressions(spark, stage):
    incoming, tables = stage
    drop_file(incoming, "one.json", FIRST + SECOND)
    run_all(spark, incoming, tables)
    table = bids.build_gold(spark, tables)
    assert table.columns == [
        "device_auction_id", "device_os", "device_ua", "device_country",
        "imp_auction_id", "imp_id", "imp_bidfloor", "imp_banner",
        "site_auction_id", "site_gdpr_status", "site_id", "site_name",
        "in_view",
    ]
    per_bid = {r[0]: r[1] for r in table.groupBy("device_auction_id").count().collect()}
    assert per_bid == {"b1": 2, "b2": 1, "b3": 1, "b4": 1, "b5": 3}
    assert table.where("imp_id is null").count() == 2
    gated = bids.build_gold(spark, tables, only_valid_consent=True)
    assert {r[0] for r in gated.select("device_auction_id").collect()} == {"b1", "b4"}


def test_an_empty_folder_gives_empty_tables(spark, stage):
    incoming, tables = stage
    bronze, silver = run_all(spark, incoming, tables)
    assert bronze.count() == 0
    assert all(table.count() == 0 for table in silver.values())
    assert bids.build_gold(spark, tables).count() == 0


def test_inferred_schema_serves_the_stream(spark, stage):
    incoming, tables = stage
    drop_file(incoming, "one.json", FIRST)
    schema = read_json(spark, str(incoming), multi_line=True).schema
    bronze = bids.update_bronze(spark, str(incoming), tables, schema)
    assert bronze.where("get(imp, 0).banner.h = 50").count() == 1


def test_line_files_stream_too(spark, stage):
    incoming, tables = stage
    (incoming / "lines.json").write_text("\n".join(json.dumps(record) for record in FIRST))
    assert bids.update_bronze(spark, str(incoming), tables, multi_line=False).count() == 3


def test_a_backlog_is_cut_into_batches(spark, stage):
    incoming, tables = stage
    for i in range(3):
        drop_file(incoming, f"{i}.json", [bid(10 * i + k, 1) for k in range(2)])
    bronze = bids.update_bronze(spark, str(incoming), tables, maxFilesPerTrigger="1")
    assert bronze.count() == 6
    batches = list((Path(tables.checkpoint("bronze")) / "commits").glob("[0-9]*"))
    assert len(batches) == 3


def test_a_failed_run_resumes_without_repeats(spark, stage):
    incoming, tables = stage
    for i in range(4):
        drop_file(incoming, f"{i}.json", [bid(i, 1)])
        os.utime(incoming / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = stream_json(spark, str(incoming), bids.BID_SCHEMA, True, maxFilesPerTrigger="1")
    failing = stream.withColumn(
        "id", F.when(F.col("id") == "b2", F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    )
    table, progress = tables.table("bronze"), tables.checkpoint("bronze")
    with pytest.raises(StreamingQueryException):
        run_available(failing, table, progress)
    assert {r["id"] for r in spark.read.parquet(table).collect()} == {"b0", "b1"}
    run_available(stream, table, progress)
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == ["b0", "b1", "b2", "b3"]


def test_sink_partitions(spark, stage):
    incoming, tables = stage
    drop_file(incoming, "one.json", FIRST)
    stream = stream_json(spark, str(incoming), bids.BID_SCHEMA, True)
    rows = run_available(
        stream.selectExpr("id", "device.os AS os"), tables.table("t"), tables.checkpoint("t"), ["os"]
    )
    assert rows.count() == 3
    assert [p.name for p in Path(tables.table("t")).glob("os=*")] == ["os=ios"]


def test_in_view_flag(spark):
    flags = spark.range(20_000).select("id", in_view_flag(F.col("id"), seed=3).alias("f"))
    assert {r[0] for r in flags.select("f").distinct().collect()} == {0.0, 1.0}
    share = flags.agg(F.avg("f")).first()[0]
    assert abs(share - 0.6) < 0.02
    again = flags.repartition(7).orderBy("id")
    assert frame_difference(flags, again).count() == 0
    drawn = spark.range(20_000).select(in_view_flag(seed=3).alias("f"))
    assert abs(drawn.agg(F.avg("f")).first()[0] - 0.6) < 0.02
