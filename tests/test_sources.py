"""CSV feeds, folder import, booking-demand layout, sinks and streaming."""

import os

import pytest
from pyspark.sql import functions as F

from wayfarer.operators import clean as C
from wayfarer.schema import LISTING_COLUMNS, SourceSpec, attraction_spec, booking_spec
from wayfarer.sources import booking_demand as BD
from wayfarer.sources import csv as CSV
from wayfarer.sources import feeds as FD


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


BOOKING = ("hotel_name,city,property_type,price_per_night,nights,rating,review_snippet\n"
           'Seaside Inn,Barcelona,hotel,120,2,4.5,"Near the beach, lovely."\n'
           "Budget Stay,London,hostel,65,1,,Good value\n")
ATTRACTION = ("title,destination,attraction_type,total_price,days,review_rating,review_excerpt\n"
              "Old Town Walk,Prague,tour,48,1,4.6,Knowledgeable\n")
EXTERNAL = ("hotel_name,price,rating,location,review\n"
            "Grand Plaza,189.0,4.5,Paris,Amazing stay!\n"
            "City Inn,$1,250 / night,3.9,London,Small rooms\n")


def test_spec_import_and_failing_source(spark, tmpdir_path):
    a = os.path.join(tmpdir_path, "booking.csv")
    b = os.path.join(tmpdir_path, "attraction.csv")
    _write(a, BOOKING)
    _write(b, ATTRACTION)
    specs = [booking_spec(a), attraction_spec(b), SourceSpec("missing", os.path.join(tmpdir_path, "nope.csv"))]
    out = FD.import_sources(spark, specs).collect()
    assert len(out) == 3 and out[0].name == "Seaside Inn"
    assert {r.source for r in out} == {"booking:export_sample", "tripadvisor:export_sample"}
    seaside = [r for r in out if r.name == "Seaside Inn"][0]
    assert seaside.price == 120.0 and seaside.duration == 2.0 and seaside.review_text == "Near the beach, lovely."
    budget = [r for r in out if r.name == "Budget Stay"][0]
    assert budget.rating is None and budget.type == "hostel"


def test_folder_import_aliases_and_latin1(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "tourism_listings.csv"), EXTERNAL)
    _write(os.path.join(tmpdir_path, "old_feed.csv"), "Title,Avg_Price,City\nCafé Hôtel,55,Nîmes\n",
           encoding="latin-1")
    _write(os.path.join(tmpdir_path, "notes.txt"), "ignored")
    out = {r.name: r for r in FD.load_folder(spark, tmpdir_path).collect()}
    assert set(out) == {"Grand Plaza", "City Inn", "Café Hôtel"}
    assert out["Grand Plaza"].source == "external:tourism_listings" and out["Grand Plaza"].type == "offer"
    assert out["City Inn"].price == 1.0                      # thousands separator splits the number
    assert out["Café Hôtel"].location == "Nîmes" and out["Café Hôtel"].source == "external:old_feed"
    assert out["Grand Plaza"].review_text == "Amazing stay!"


def test_external_import_distinct(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "a.csv"), EXTERNAL)
    _write(os.path.join(tmpdir_path, "b.csv"), EXTERNAL)
    f = os.path.join(tmpdir_path, "a.csv")
    out = FD.external_import(spark, [SourceSpec("x", f, {"name": "hotel_name", "price": "price"})],
                             frames=[])
    assert out.count() == 2
    twice = FD.external_import(spark, [SourceSpec("x", f, {"name": "hotel_name"})] * 2)
    assert twice.count() == 2


def test_booking_demand_layout(spark):
    rows = [("City Hotel", "PRT", "75.5", "1", "2"), ("Resort Hotel", None, None, None, "0"),
            (" City Hotel ", "GBR", "120", None, None)]
    df = spark.createDataFrame(rows, "`Hotel ` string, country string, ADR string, "
                                     "`Stays In Weekend Nights` string, stays_in_week_nights string")
    order = [F.col("adr").desc_nulls_first()]      # text order: NULL, '75.5', '120'
    out = BD.transform_booking_demand(df, order_cols=order).orderBy("name").collect()
    assert [r.name for r in out] == ["City Hotel — booking 2", "City Hotel — booking 3"]
    assert [r.duration for r in out] == [3.0, 1.0]
    assert out[0].location == "PRT" and out[0].source == BD.SOURCE_LABEL
    with pytest.raises(ValueError):
        BD.transform_booking_demand(df.drop("country"))
    assert BD.booking_demand_or_empty(df.drop("country")).count() == 0
    head = BD.transform_booking_demand(df, order_cols=order, max_rows=2).count()
    assert head == 1                                         # limit applies before the price filter


def test_sinks_keep_header_and_columns(spark, tmpdir_path):
    df = spark.createDataFrame([("a", 1.0)], "name string, price double")
    path = os.path.join(tmpdir_path, "out_csv")
    CSV.write_listings(df, path, "csv")
    back = CSV.read_csv_text(spark, path)
    assert back.columns == LISTING_COLUMNS
    empty = spark.createDataFrame([], "name string")
    p2 = os.path.join(tmpdir_path, "empty_csv")
    CSV.write_listings(empty, p2, "csv")
    files = [f for f in os.listdir(p2) if f.endswith(".csv")]
    assert files and open(os.path.join(p2, files[0])).readline().strip().split(",") == LISTING_COLUMNS


def test_read_listing_files_roundtrip(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "raw_a.csv"), ",".join(LISTING_COLUMNS) + "\nX,hotel,Rome,10,2,4,s,ok\n")
    _write(os.path.join(tmpdir_path, "raw_empty.csv"), ",".join(LISTING_COLUMNS) + "\n")
    df = CSV.read_listing_files(spark, os.path.join(tmpdir_path, "raw_*.csv"))
    assert df.count() == 1
    assert C.clean_listings(df).count() == 1


def test_streaming_folder_ingest(spark, tmpdir_path):
    from wayfarer.streaming.folder_ingest import ingest_folder

    inbox = os.path.join(tmpdir_path, "inbox")
    os.makedirs(inbox)
    sink, ckpt = os.path.join(tmpdir_path, "sink"), os.path.join(tmpdir_path, "ckpt")
    header = ["hotel_name", "price", "rating", "location", "review"]
    _write(os.path.join(inbox, "first.csv"), EXTERNAL)
    ingest_folder(spark, inbox, header, sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    _write(os.path.join(inbox, "second.csv"), ",".join(header) + "\nNew Place,80,4.1,Oslo,Fine\n")
    ingest_folder(spark, inbox, header, sink, ckpt)        # only the new file is read
    out = spark.read.parquet(sink)
    assert out.count() == 3
    assert out.where(F.col("name") == "New Place").first().source == "external:second"


def test_folder_with_odd_names_and_encodings(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "my feeds")
    os.makedirs(folder)
    _write(os.path.join(folder, "plain.csv"), "name,price\nCafé A,10\nB,20\n")
    with open(os.path.join(folder, "latin one.csv"), "wb") as f:
        f.write("name,price\nCafé L,30\n".encode("latin-1"))
    with open(os.path.join(folder, "empty.csv"), "wb"):
        pass
    for given in (folder, os.path.join(folder, "*.csv")):
        rows = CSV.read_csv_text(spark, [os.path.join(folder, "plain.csv"), os.path.join(folder, "latin one.csv")]).collect()
        assert sorted((r.name, r.price) for r in rows) == [("B", "20"), ("Café A", "10"), ("Café L", "30")]
        got = CSV.read_listing_files(spark, given).collect()
        assert sorted((r.name, r.price) for r in got) == [("B", 20.0), ("Café A", 10.0), ("Café L", 30.0)]
    out = FD.external_import(spark, folder=folder).collect()
    assert sorted((r.name, r.source) for r in out) == [
        ("B", "external:plain"), ("Café A", "external:plain"), ("Café L", "external:latin one")]
    assert FD.external_import(spark, folder=os.path.join(tmpdir_path, "nowhere")).count() == 0


def test_listing_files_are_read_by_name(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "raw_a.csv"), "price,name,location,extra\n20,Inn,Rome,x\n")
    _write(os.path.join(tmpdir_path, "raw_b.csv"), ",".join(LISTING_COLUMNS) + "\nHut,cabin,Oslo,5,1,4.5,s,good\n")
    got = {r.name: r for r in CSV.read_listing_files(spark, os.path.join(tmpdir_path, "raw_*.csv")).collect()}
    assert got["Inn"].price == 20.0 and got["Inn"].location == "Rome" and got["Inn"].type is None
    assert got["Hut"].rating == 4.5 and got["Hut"].type == "cabin" and list(got["Hut"].asDict()) == LISTING_COLUMNS


def test_na_type_cells_take_the_default(spark):
    from wayfarer.operators.mapping import map_to_listing_schema

    df = spark.createDataFrame([(t,) for t in ("NA", "None", "NULL", "nan", "N/A", None, " Villa ")], "t string")
    got = [r.type for r in map_to_listing_schema(df, {"type": "t"}, "s", "hotel").collect()]
    assert got == ["hotel"] * 6 + ["villa"]


def test_stage_layout_skips_row_groups(spark, tmpdir_path):
    import pyarrow.parquet as pq

    from wayfarer.operators.filters import explorer_filter

    n = 40_000
    df = spark.range(n, numPartitions=8).select(
        F.md5(F.col("id").cast("string")).alias("listing_key"), F.lit("x").alias("name"), F.lit("t").alias("type"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("L"), F.col("id") % 500)).alias("location"),
        F.when(F.col("id") % 3 > 0, F.lit("big")).when(F.col("id") % 17 > 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.when(F.col("id") % 19 > 0, F.pmod(F.hash("id"), F.lit(3000)).cast("double")).alias("price"),
        F.when(F.col("id") % 23 > 0, F.pmod(F.xxhash64("id"), F.lit(51)) / 10).alias("rating"))
    path = os.path.join(tmpdir_path, "stage")
    # small ranges, so that there is something to skip
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        CSV.write_stage(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    back = spark.read.parquet(path)
    assert back.columns == df.columns and back.exceptAll(df).count() == 0 and back.count() == n
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 8

    def kept(column, low, high):
        hit = 0
        for f in files:
            meta = pq.ParquetFile(f).metadata
            i = meta.schema.names.index(column)
            stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
            hit += any(s.has_min_max and s.min <= high and s.max >= low for s in stats)
        return hit

    assert kept("source", "s1", "s1") <= 4 and kept("price", 0.0, 20.0) <= 5
    got = explorer_filter(back, (5.0, 900.0), (1.0, 4.0), ["L5", "nan"], ["big", "nan"], ["T"])
    want = [r for r in df.collect() if r.price is not None and 5 <= r.price <= 900 and r.rating is not None and 1 <= r.rating <= 4
            and r.location in ("L5", None) and r.source in ("big", None)]
    assert got.count() == len(want) > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("\n")[0]
    assert "price" in pushed and "rating" in pushed and "location" in pushed and "source" in pushed


def test_import_report(spark, tmpdir_path):
    good, bad, empty = (os.path.join(tmpdir_path, f) for f in ("good.csv", "bad.csv", "empty.csv"))
    _write(good, BOOKING)
    _write(bad, BOOKING + "Short,Rome\nCaf\xe9,Rome,hotel,n/a,1,4,fine,more,still more\n,Rome,hotel,5,1,4,fine\n", "latin-1")
    _write(empty, "")
    specs = [SourceSpec(n, p, booking_spec(good).mapping, "hotel")
             for n, p in (("good", good), ("bad", bad), ("empty", empty), ("gone", os.path.join(tmpdir_path, "none.csv")))]
    got = {r.source: (r.state, r.n_rows, r.n_malformed, r.n_without_name, r.n_without_price)
           for r in FD.import_report(spark, specs).collect()}
    assert got == {"good": ("read", 2, 0, 0, 0), "bad": ("read", 5, 2, 1, 2), "empty": ("no header", 0, 0, 0, 0),
                   "gone": ("missing", 0, 0, 0, 0)}
    assert FD.import_report(spark, []).count() == 0
    assert FD.import_sources(spark, [specs[0], specs[3]]).count() == 2


def test_a_header_is_looked_at_once_however_many_files_have_it(spark, tmp_path):
    from wayfarer.sources.csv import catalogue, expand, read_by_header

    for i in range(500):
        head = ("name,price", "price,name,city", '"na\nme",price')[0 if i < 400 else 1 if i < 499 else 2]
        (tmp_path / f"f{i:03}.csv").write_bytes(f"{head}\nx{i},{i},c\n".encode() if 400 <= i < 499 else f"{head}\nx{i},{i}\n".encode())
    (tmp_path / "latin +%20.csv").write_bytes("name,price\ncafé,1\n".encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b"\nname,price\ny,2\n")
    (tmp_path / "head.csv").write_bytes(b"name,price\n")
    files = expand(spark, str(tmp_path))
    sc = spark.sparkContext
    sc.setJobGroup("catalogue", "headers")
    try:
        listed = catalogue(spark, files)
        assert len(sc.statusTracker().getJobIdsForGroup("catalogue")) <= 3     # listing of paths, map stage, result
        found = read_by_header(spark, files, with_file_name=True)
        jobs = len(sc.statusTracker().getJobIdsForGroup("catalogue"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {f for f, _, _ in listed} == {f for f in files if not f.endswith("empty.csv")}
    assert [f for f, bad, _ in listed if bad] == [f for f in files if "latin" in f]
    assert jobs < 40                                                           # not one a file
    by = {}
    for header, df in found:
        by.setdefault(tuple(header), set()).update(r[0] for r in df.select("_source_file").distinct().collect())
    assert by[("name", "price")] == {f"f{i:03}.csv" for i in range(400)} | {"latin +%20.csv", "blank.csv"}
    assert by[("price", "name", "city")] == {f"f{i:03}.csv" for i in range(400, 499)}
    assert by[("na\nme", "price")] == {"f499.csv"}
    latin = next(df for h, df in found if h == ["name", "price"] and df.where("_source_file like 'latin%'").count())
    assert latin.select("name").first()[0] == "café"
