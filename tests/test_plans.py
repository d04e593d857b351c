from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldmill.operators import frame_difference, require_shape
from fieldmill.plans import births, flights, temps
from fieldmill.sources import drop_table, new_shared_folder, read_json, replace_table

# ---------------------------------------------------------------- temperatures

# The readings and the expected answer.
READINGS = [
    ("BLI", date(2021, 4, 3), 52, 43),
    ("BLI", date(2021, 4, 2), 50, 38),
    ("BLI", date(2021, 4, 1), 52, 41),
    ("PDX", date(2021, 4, 3), 64, 45),
    ("PDX", date(2021, 4, 2), 61, 41),
    ("PDX", date(2021, 4, 1), 66, 39),
    ("SEA", date(2021, 4, 3), 57, 43),
    ("SEA", date(2021, 4, 2), 54, 39),
    ("SEA", date(2021, 4, 1), 56, 41),
]
WARM_DAYS = [
    ("PDX", date(2021, 4, 3), 64, 45),
    ("PDX", date(2021, 4, 2), 61, 41),
    ("SEA", date(2021, 4, 3), 57, 43),
    ("SEA", date(2021, 4, 2), 54, 39),
]


def test_warm_days_golden(spark):
    frame = temps.temps_from_rows(spark, READINGS + READINGS[3:5])
    assert not any(field.nullable for field in frame.schema.fields)
    replace_table(frame, "temps_demo")
    answer = temps.warm_days(spark, "temps_demo", without="BLI", after="2021-04-01")
    assert [tuple(row) for row in answer.collect()] == WARM_DAYS
    drop_table(spark, "temps_demo")


# ---------------------------------------------------------------- flights

HEADER = (
    "Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,FlightNum,"
    "TailNum,ActualElapsedTime,CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,Distance,TaxiIn,"
    "TaxiOut,Cancelled,CancellationCode,Diverted,CarrierDelay,WeatherDelay,NASDelay,SecurityDelay,"
    "LateAircraftDelay"
)


def flight(day, carrier, dep, crs_dep, arr, crs_arr, arr_delay, dep_delay, origin, dest, cancelled=0):
    return (
        f"1987,2,{day},3,{dep},{crs_dep},{arr},{crs_arr},{carrier},7,NA,60,61,NA,{arr_delay},{dep_delay},"
        f"{origin},{dest},447,NA,NA,{cancelled},NA,0,NA,NA,NA,NA,NA"
    )


FIRST = [
    flight(1, "AA", 930, 1015, 1100, 1050, 10, -45, "SEA", "PDX"),
    flight(2, "AA", 1020, 1015, 1130, 1050, 40, 5, "SEA", "XXX"),
    flight(30, "UA", "NA", 1015, "NA", 1050, "NA", "NA", "SEA", "PDX", cancelled=1),
]
REST = [
    flight(3, "UA", 800, 800, 850, 900, -10, 0, "PDX", "SEA"),
    flight(3, "UA", 830, 800, 935, 900, 10, 30, "PDX", "SEA"),
    flight(3, "DL", 801, 800, 930, 900, 30, 1, "PDX", "SEA"),
    flight(3, "NA", 805, 800, 900, 900, 0, 5, "PDX", "SEA"),
]


@pytest.fixture(scope="module")
def prepared(spark):
    folder = Path(new_shared_folder(spark, "flights"))
    (folder / "first.csv").write_text("\n".join([HEADER, *FIRST]) + "\n")
    (folder / "rest.csv").write_text("\n".join(REST) + "\n")
    (folder / "codes.txt").write_text("IATA\tCity\tState\nSEA\tSeattle\tWA\nPDX\t Portland \tOR\n\tNowhere\t\n")
    airports = flights.load_airports(spark, str(folder / "codes.txt"))
    assert sorted(map(tuple, airports.collect())) == [("PDX", "Portland"), ("SEA", "Seattle")]
    raw = flights.load_flights(spark, str(folder / "first.csv"), [str(folder / "rest.csv")])
    assert len(raw.columns) == 29 and raw.columns == sorted(raw.columns)
    return flights.prepare_flights(raw, airports).persist()


def test_declared_types_cover_36_columns():
    assert len(flights.FLIGHT_TYPES) == 36
    assert list(flights.FLIGHT_TYPES) == sorted(flights.FLIGHT_TYPES)


def test_prepared_columns(prepared):
    assert dict(prepared.dtypes)["date"] == "date"
    assert dict(prepared.dtypes)["arrdelay"] == "int"
    gone = {"airtime", "tailnum", "taxiin", "taxiout", "cancellationcode", "carrierdelay", "weatherdelay",
            "nasdelay", "securitydelay", "lateaircraftdelay"}
    assert set(prepared.columns) == set(flights.FLIGHT_TYPES) - gone
    assert prepared.count() == 7


def test_prepared_values(prepared):
    row = prepared.where("uniquecarrier = 'AA' and dayofmonth = 1").first()
    assert (row["origcity"], row["destcity"], row["route"]) == ("Seattle", "Portland", "SEA-PDX")
    assert (row["date"], row["day"]) == (date(1987, 2, 1), "Wed")
    # 9:30 is before 10:15 although its text is the larger one.
    assert (row["isdepdelay"], row["isarrdelay"]) == (0, 1)
    cancelled = prepared.where("cancelled = 1").first()
    assert cancelled["date"] is None
    assert (cancelled["isdepdelay"], cancelled["isarrdelay"]) == (0, 0)
    assert prepared.where("dest = 'XXX'").first()["destcity"] is None


def test_questions(prepared):
    assert [tuple(r) for r in flights.most_delayed(prepared).collect()] == [
        (None, 1), ("AA", 1), ("DL", 1), ("UA", 1),
    ]
    assert [tuple(r) for r in flights.mean_delay(prepared).collect()] == [
        ("DL", 30.0), ("AA", 25.0), (None, 0.0), ("UA", 0.0),
    ]
    assert {r[0]: r[2] for r in flights.early_or_late(prepared).collect()} == {
        None: "early", "AA": "late", "DL": "late", "UA": "early",
    }
    assert {tuple(r) for r in flights.timing(prepared).collect()} == {
        ("AA", 25.0, "Late"), ("DL", 30.0, "Late"), ("UA", 0.0, "On-time"),
    }


def test_departure_stats(prepared):
    stats = flights.departure_stats(prepared).where("origcity = 'Portland'").collect()
    assert [r["depdelay"] for r in stats] == [1, 5, 30]
    assert {tuple(r)[-4:] for r in stats} == {(1, 30, 12.0, 36)}


def test_four_ways_to_count_carriers(prepared):
    known = prepared.na.drop(subset=["uniquecarrier"]).select("uniquecarrier").distinct().count()
    assert known == prepared.where(F.col("uniquecarrier").isNotNull()).select("uniquecarrier").distinct().count()
    assert known == prepared.agg(F.count_distinct("uniquecarrier")).first()[0] == 3
    assert prepared.groupBy("uniquecarrier").count().count() == known + 1
    assert prepared.dropDuplicates(["uniquecarrier"]).distinct().count() == known + 1


# ---------------------------------------------------------------- births

# The first record has the documented form.
BIRTHS = """{"meta": {"view": {"id": 1}},
"data": [
 [ "row-r9pv-p86t.ifsp", "00000000-0000-0000-0838-60C2FFCC43AE", 0, 1574264158, null, 1574264158, null,
   "{ }", "2007", "ZOEY", "KINGS", "F", "11" ],
 [ "row-2", "id-2", 0, 1574264159, null, null, null, "{ }", "2007", "Ann. Lee", "St. Law", "F", "30" ],
 [ "row-3", "id-3", 0, 1574264159, null, null, null, "{ }", "2007", "Bea", "Kings ", "F", "30" ],
 [ "row-4", "id-4", 0, 1574264159, null, null, null, "{ }", "2008", "ZOEY", "KINGS", "F", "20" ],
 [ "row-5", "id-5", 0, 1574264159, null, null, null, "{ }", "2008", "ZOEY", "QUEENS", "F", "20" ],
 [ "row-6", "id-6", 0, 1574264159, null, null, null, "{ }", "2008", "DAN", "QUEENS", "M", "25" ],
 [ "row-7", "id-7" ]
]}"""


@pytest.fixture(scope="module")
def birth_file(spark):
    path = Path(new_shared_folder(spark, "births")) / "births.json"
    path.write_text(BIRTHS)
    return str(path)


def test_birth_records(spark, birth_file):
    records = births.explode_births(read_json(spark, birth_file, multi_line=True))
    require_shape(records, births.BIRTH_SHAPE)
    row = records.where("sid = 'row-r9pv-p86t.ifsp'").first()
    assert row["created_at_ts"] == datetime(2019, 11, 20, 15, 35, 58)
    assert (row["count"], row["county_clean"], row["first_name_clean"]) == (11, "kings", "zoey")
    assert records.where("sid = 'row-2'").first()["first_name_clean"] == "annlee"
    short = records.where("sid = 'row-7'").first()
    assert short["year"] is None and short["count"] is None and short["created_at_ts"] is None
    assert "created_at" not in records.columns


def test_top_names_in_sql_and_frames_agree(spark, birth_file):
    births.publish_births(spark, birth_file, "births_demo")
    records = spark.table("births_demo").where("year is not null")
    records.createOrReplaceTempView("births_known")
    in_sql = births.top_names_sql(spark, "births_known")
    in_frames = births.top_names(records)
    assert sorted(map(tuple, in_sql.collect())) == [
        ("annlee", 30, "2007"), ("bea", 30, "2007"), ("dan", 25, "2008"),
    ]
    assert frame_difference(in_sql, in_frames).count() == 0
    one = births.top_names(records, ties="one")
    assert [tuple(r) for r in one.collect()] == [("annlee", 30, "2007"), ("dan", 25, "2008")]
    assert [tuple(r) for r in in_sql.exceptAll(one).collect()] == [("bea", 30, "2007")]
    summed = births.top_names(records, ties="one", sum_first=True)
    assert [tuple(r) for r in summed.collect()] == [("annlee", 30, "2007"), ("zoey", 40, "2008")]


def visitor(*ages):
    inner = "".join(
        f'<visitor id="{i}"' + ("" if age is None else f' age="{age}"') + ' sex="F"/>' for i, age in enumerate(ages)
    )
    return f"<visitors>{inner}</visitors>"


VISITED = [
    ("Zoey", "KINGS", visitor(68, 34)),
    ("Ann", "Kings ", visitor(34)),
    ("Bea", "KINGS", visitor()),
    ("Cat", "KINGS", None),
    ("Dan", "KINGS", "<visitors><visitor"),
    ("Eve", "QUEENS", visitor(20, None, 40)),
    ("Fay", "QUEENS", visitor(40, 20)),
    ("Gus", None, visitor(99)),
]


@pytest.fixture(scope="module", params=["declared", "inferred"])
def visited(spark, request):
    frame = spark.createDataFrame(VISITED, "first_name string, county string, visitors string")
    schema = "visitor array<struct<_id: bigint, _age: bigint, _sex: string>>"
    return births.parse_visitors(frame, schema if request.param == "declared" else None).persist()


def test_visits(visited):
    assert visited.count() == 7
    assert "visitors" not in visited.columns
    sizes = {r["first_name"]: r["num_visitors"] for r in visited.collect()}
    assert sizes == {"Zoey": 2, "Ann": 1, "Bea": 0, "Cat": 0, "Dan": 0, "Eve": 3, "Fay": 2}


def test_visit_statistics(visited):
    assert [tuple(r) for r in births.busiest_counties(visited).collect()] == [("queens", 2.5)]
    means = {r[0]: r[1] for r in births.mean_visitor_age(visited).collect()}
    assert means == {"kings": (51 + 34) / 2, "queens": (20 + 30) / 2}
    pooled = {r[0]: r[1] for r in births.mean_visitor_age(visited, pooled=True).collect()}
    assert pooled == {"kings": 136 / 3, "queens": 120 / 5}
    assert sorted(map(tuple, births.most_common_age(visited).collect())) == [
        ("kings", 34, 2), ("queens", 20, 2),
    ]


def test_array_mean_equals_a_fold_over_slots(visited):
    from functools import reduce

    from fieldmill.functions import array_mean

    longest = visited.agg(F.max("num_visitors")).first()[0]
    slots = [F.coalesce(F.get(F.col("ages"), F.lit(i)), F.lit(0)) for i in range(longest)]
    folded = F.try_divide(reduce(lambda a, b: a + b, slots).cast("double"), F.col("num_visitors"))
    wrong = visited.where(~array_mean(F.col("ages")).eqNullSafe(folded))
    assert wrong.count() == 0
