from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fieldmill import sources as src


@pytest.fixture
def folder(spark):
    return src.new_shared_folder(spark, "test")


def put(folder, name, text):
    from pathlib import Path

    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(text, encoding="utf-8")
    return f"{folder}/{name}"


def test_shared_folder_lies_under_the_configured_one(spark, folder):
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != src.new_shared_folder(spark, "test")


def test_delimited_quotes_empties_and_markers(spark, folder):
    path = put(folder, "a.csv", 'id,name,v\n1,"says ""hi"", ok",NA\n2,,3\n')
    frame = src.read_delimited(spark, path)
    assert frame.dtypes == [("id", "string"), ("name", "string"), ("v", "string")]
    assert [tuple(r) for r in frame.collect()] == [("1", 'says "hi", ok', "NA"), ("2", None, "3")]
    typed = src.read_delimited(spark, path, infer=True, nullValue="NA")
    assert typed.dtypes == [("id", "int"), ("name", "string"), ("v", "int")]


def test_delimited_numbers_dates_and_bad_values(spark, folder):
    path = put(folder, "b.csv", "1.5|2021-04-03\nNaN|bad\nInf|\n-Inf|1999-12-31\n")
    frame = src.read_delimited(spark, path, sep="|", header=False, schema="v double, d date")
    got = [(str(r["v"]), str(r["d"])) for r in frame.collect()]
    assert got == [("1.5", "2021-04-03"), ("nan", "None"), ("inf", "None"), ("-inf", "1999-12-31")]


def test_delimited_encoding_and_many_paths(spark, folder):
    from pathlib import Path

    put(folder, "c1.csv", "n\nx\n")
    (Path(folder) / "c2.csv").write_bytes("n\nhé\n".encode("latin-1"))
    one = src.read_delimited(spark, f"{folder}/c2.csv", encoding="ISO-8859-1")
    assert one.first()[0] == "hé"
    both = src.read_delimited(spark, [f"{folder}/c1.csv", f"{folder}/c2.csv"])
    assert both.count() == 2


def test_missing_file_is_an_error(spark, folder):
    with pytest.raises(AnalysisException):
        src.read_delimited(spark, f"{folder}/none.csv")


def test_borrowed_header(spark, folder, sorted_rows):
    first = put(folder, "first.csv", "Year,Unique Carrier\n1987,AA\n")
    rest = [put(folder, "r1.csv", "1988,UA\n"), put(folder, "r2.csv", "1989,NA\n")]
    frame = src.read_with_borrowed_header(spark, first, rest)
    assert frame.columns == ["Year", "Unique Carrier"]
    assert sorted_rows(frame) == [("1987", "AA"), ("1988", "UA"), ("1989", "NA")]


def test_control_separated_and_padded_text(spark, folder):
    pairs = put(folder, "kv.txt", "238\x01val_238\n86\x01val_86\n")
    frame = src.read_delimited(spark, pairs, sep="\x01", header=False, schema="k int, v string")
    assert [tuple(r) for r in frame.collect()] == [(238, "val_238"), (86, "val_86")]
    people = put(folder, "people.txt", "Michael, 29\nAndy, 30\n")
    frame = src.read_delimited(
        spark, people, header=False, schema="name string, age int", ignoreLeadingWhiteSpace="true"
    )
    assert [tuple(r) for r in frame.collect()] == [("Michael", 29), ("Andy", 30)]


def test_json_lines_with_a_missing_field(spark, folder):
    path = put(folder, "people.json", '{"name":"Michael"}\n{"name":"Andy", "age":30}\n')
    frame = src.read_json(spark, path)
    assert frame.dtypes == [("age", "bigint"), ("name", "string")]
    assert [tuple(r) for r in frame.collect()] == [(None, "Michael"), (30, "Andy")]


def test_multi_line_document_widens_mixed_arrays(spark, folder):
    text = '{"meta": {"v": 1},\n "data": [\n ["row-1", 0, 1574264158, null, "ZOË"],\n ["row-2"]\n]}'
    path = put(folder, "doc.json", text)
    for frame in (
        src.read_json(spark, path, multi_line=True),
        src.read_json(spark, path, multi_line=True, schema="data array<array<string>>"),
    ):
        assert dict(frame.dtypes)["data"] == "array<array<string>>"
        assert frame.select("data").first()[0] == [["row-1", "0", "1574264158", None, "ZOË"], ["row-2"]]


def test_json_view_in_sql(spark, folder):
    path = put(folder, "it's.json", '{\n"a": [1,\n2]}')
    src.json_view(spark, "doc_view", path, multi_line=True)
    assert spark.sql("SELECT a[1] FROM doc_view").first()[0] == 2
    with pytest.raises(AnalysisException):
        src.json_view(spark, "doc_view", path, multi_line=True, replace=False)
    src.json_view(spark, "doc_view", put(folder, "l.json", '{"a": 1}\n{"a": 2}\n'))
    assert spark.table("doc_view").count() == 2


@pytest.mark.parametrize("n, per_document", [(0, 5), (1, 5), (5, 5), (6, 5), (1000, 7), (1000, 5000)])
def test_written_documents_are_complete(spark, folder, n, per_document):
    import json
    from pathlib import Path

    out = f"{folder}/docs-{n}-{per_document}"
    records = spark.range(0, n, 1, 3).select(F.concat(F.lit('["'), "id", F.lit('", null]')))
    src.write_documents(records, out, '{"data": [', "]}", rows_per_document=per_document)
    documents = [
        json.loads(file.read_text()) for file in Path(out).glob("part-*") if file.stat().st_size
    ]
    assert all(len(d["data"]) <= per_document for d in documents)
    ids = sorted(int(record[0]) for d in documents for record in d["data"])
    assert ids == list(range(n))
    if n:
        read = src.read_json(spark, out, True, "data array<array<string>>")
        assert read.select(F.explode("data")).count() == n


def test_replace_table_managed(spark):
    frame = spark.createDataFrame([(1, "x")], "a int, b string")
    src.replace_table(frame, "managed_demo")
    table = src.replace_table(frame.withColumn("a", F.col("a") + 1), "managed_demo")
    assert [tuple(r) for r in table.collect()] == [(2, "x")]
    src.drop_table(spark, "managed_demo")
    assert not spark.catalog.tableExists("managed_demo")
    src.drop_table(spark, "managed_demo")


def test_replace_table_external_and_partitioned(spark, folder):
    from pathlib import Path

    out = f"{folder}/carriers"
    frame = spark.createDataFrame([(1, "AA"), (2, "UA"), (3, "AA")], "n int, carrier string")
    table = src.replace_table(frame, "carriers", partition_by=["carrier"], path=out)
    assert sorted(p.name for p in Path(out).glob("carrier=*")) == ["carrier=AA", "carrier=UA"]
    pruned = table.where("carrier = 'AA'")
    assert "PartitionFilters: [isnotnull(carrier" in pruned._jdf.queryExecution().toString()
    assert pruned.count() == 2
    src.drop_table(spark, "carriers")
    assert spark.read.parquet(out).count() == 3


def test_stored_keeps_schema_and_rows(spark, sorted_rows):
    frame = spark.createDataFrame([(1, [2, 3]), (None, None)], "a int, b array<int>")
    kept = src.stored(frame, "kept")
    assert kept.schema == frame.schema
    assert sorted_rows(kept) == sorted_rows(frame)
    assert src.stored(frame.where("a > 5"), "kept").count() == 0


def test_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        src.new_shared_folder(cluster, "x")


def test_shared_folders_can_be_removed(spark, monkeypatch):
    from pathlib import Path

    from fieldmill.sources import shared

    monkeypatch.setattr(shared, "_made_here", [])
    made = [src.new_shared_folder(spark, "gone") for _ in range(2)]
    assert all(Path(folder).is_dir() for folder in made)
    assert src.remove_shared_folders(spark) == 2
    assert not any(Path(folder).exists() for folder in made)
    assert src.remove_shared_folders(spark) == 0
