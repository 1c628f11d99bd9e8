"""CSV, Parquet and archive scans, and what the sinks leave behind."""

import csv
import os
import zipfile

import pytest
from panels import as_spark, edge_panel
from pyspark.sql import functions as F

from barsignal import session
from barsignal.operators import clean
from barsignal.plans.flows import clean_news, clean_prices, ingest_news
from barsignal.session import work_dir
from barsignal.sources import archive, dims, files, quoted_csv, sinks
from barsignal.sources import paths as paths_of

NEWS = [
    ["1", "2023-12-16 23:00:00 UTC", 'He said "buy", twice', "AAPL", "u", "p", "a", "line one\nline two\n\n\"end\"", "sum", "", "", ""],
    ["2.0", "2023-12-17 00:00:00 UTC", "plain", "MSFT", "u", "p", "a", "text, with comma", "s", "l", "t", "x"],
    ["x", "2023-12-17 00:00:00 UTC", "bad number", "AAPL", "u", "p", "a", "t", "s", "l", "t", "x"],
    ["4", "soon", "bad date", "AAPL", "u", "p", "a", "t", "s", "l", "t", "x"],
    ["5", "2023-12-17 00:00:00 UTC", "no url", "AAPL", "", "p", "a", "t", "s", "l", "t", "x"],
    ["6", "2023-12-17 00:00:00 UTC", "outside", "ZZZ", "u", "p", "a", "t", "s", "l", "t", "x"],
]


def write_news(path, rows=NEWS, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=newline)
        writer.writerow(files.NEWS_COLUMNS)
        writer.writerows(rows)


@pytest.fixture
def news_csv(tmp_path):
    path = tmp_path / "news.csv"
    write_news(path)
    return str(path)


def test_news_fields_span_lines_and_hold_quotes(spark, news_csv):
    row = files.scan_news_csv(spark, news_csv).where("No = '1'").collect()[0]
    assert row.Article_title == 'He said "buy", twice'
    assert row.Article == 'line one\nline two\n\n"end"'


@pytest.mark.parametrize("split_bytes", [40, 150, 1_000_000])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_split_scan_equals_multiline_scan(spark, tmp_path, split_bytes, newline):
    rows = [[f"{i}", "d", f't "{i}"', "S", "", "p", "a", "\n".join(["body, \"x\""] * (i % 9)), "s", "l", "t", "x"] for i in range(60)]
    for name in ("a.csv", "b.csv"):
        write_news(tmp_path / name, rows, newline)
    path, schema = str(tmp_path), files.strings(files.NEWS_COLUMNS)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = sorted(map(str, quoted_csv.scan_quoted_csv(spark, path, schema).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted(map(str, files.scan_news_csv(spark, path, split=False).collect()))
    assert len(got) == 120
    assert got == want


STRAY = {
    "stray quotes": ['a,b,c', '1,he said "no,x', '2,"two\nlines",y', '3,mid"dle"d,"z, z"', '4,"tail"after,"q"', '5,"a ""b"" c","multi\n""line""\nend"', '6,x"y,last'],
    "open in the middle": ['a,b,c', '1,"x" y,z', '2,"open\n3,fine,row\n4,"closes here",w', '5,"",""', '6,"""",""""""'],
    "ends in a quote": ['a,b,c', '1,2,"3', '4,5,6"', '7,"8""\n9",10', '11,"x"\t,12'],
}


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("kind", sorted(STRAY))
@pytest.mark.parametrize("size", ["40b", "1m"])
def test_any_quotes_are_read_as_the_multi_line_scan_reads_them(spark, tmp_path, kind, newline, size):
    path = str(tmp_path / "stray.csv")
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write("".join(record.replace("\n", newline) + newline for record in STRAY[kind] * 3))
    schema = files.strings(("a", "b", "c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted(map(str, quoted_csv.scan_quoted_csv(spark, path, schema, header=False).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted(map(str, spark.read.schema(schema).options(multiLine=True, escape='"').csv(path).collect()))
    assert got == want


def test_no_record_swallows_a_file(spark, tmp_path):
    rows = [f"{i},plain text {i}" for i in range(200)]
    rows[50] = '50,"never closed'
    rows[120] = '120,"two\nlines",and "more'
    rows[121] = '121,"x\ny","open again'
    for part in ("a", "b"):
        (tmp_path / f"{part}.csv").write_text("\n".join(rows) + "\n")
    schema = files.strings(("no", "text"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        found, refused = quoted_csv.read_quoted_csv(spark, str(tmp_path), schema, header=False, max_record=400)
        kept = sorted(int(r.no) for r in found.collect())
        lost = sorted((r.file[-5:], r.line, r.n_lines) for r in refused.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert kept == sorted([i for i in range(200) if i not in (50, 121)] * 2)
    assert lost == [("a.csv", 51, 1), ("a.csv", 123, 2), ("b.csv", 51, 1), ("b.csv", 123, 2)]


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    write_news(tmp_path / "news.csv", NEWS * 50)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines = quoted_csv._lines(spark, str(tmp_path / "news.csv"))
        assert lines.select("_split").distinct().count() > 10
        articles, refused = ingest_news(spark, str(tmp_path / "news.csv"), spark.createDataFrame([("AAPL",)], "Stock_symbol string"))
        assert (articles.count(), refused.count()) == (50, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_clean_news_drops_what_does_not_parse(spark, news_csv):
    universe = spark.createDataFrame([("AAPL",), ("MSFT",)], "Stock_symbol string")
    rows = clean_news(files.scan_news_csv(spark, news_csv), universe).orderBy("No").collect()
    assert [(r.No, str(r.Date)) for r in rows] == [(1, "2023-12-16"), (2, "2023-12-17")]
    assert set(rows[0].asDict()) == {"No", "Date", "Article_title", "Stock_symbol", "Url", "Article", "Lsa_summary"}


def test_price_files_with_different_headers(spark, tmp_path):
    (tmp_path / "aapl.csv").write_text("date,open,high,low,close,adj close,volume\n2020-01-02,1,2,0.5,1.5,1.4,100\nbad,x,2,,1.5,1.4,7.0\n")
    (tmp_path / "NOW.csv").write_text("Date ,Open,High,Low,Close, Adj Close,Volume\n2020-01-03,1,2,0.5,1.5,nan,9007199254740993\n")
    rows = clean_prices(files.scan_price_csv(spark, f"{tmp_path}/*.csv")).orderBy("Stock_symbol", F.asc_nulls_last("Date")).collect()
    assert [r.Stock_symbol for r in rows] == ["AAPL", "AAPL", "NOW"]
    assert (rows[1].Date, rows[1].Open, rows[1].Low, rows[1].Volume) == (None, None, None, 7)
    assert rows[2]["Adj Close"] is None and rows[2].Volume == 9007199254740993


def test_partitions_by_symbol_stay_strings_and_prune(spark, tmp_path):
    df = spark.createDataFrame([("NOW", 1), ("ALL", 2), ("1", 3), ("1", 4)], "Stock_symbol string, Volume int")
    sinks.write_by_symbol(df, str(tmp_path / "p"))
    back = files.scan_parquet(spark, str(tmp_path / "p"))
    assert dict(back.dtypes)["Stock_symbol"] == "string"
    assert sorted(map(tuple, back.select("Stock_symbol", "Volume").collect())) == sorted(map(tuple, df.collect()))
    plan = back.where("Stock_symbol = 'ALL'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Stock_symbol" in plan


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Adaptive execution splits the hot key; without it one file would hold it."""
    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 50).cast("string"))).alias("Stock_symbol"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sinks.write_by_symbol(hot, str(tmp_path / "p"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(list((tmp_path / "p" / "Stock_symbol=HOT").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "p")).count() == 300_000


def test_model_set_files_hold_date_ranges(spark, tmp_path):
    panel = as_spark(spark, edge_panel((300, 300, 300)))
    sinks.write_model_set(panel, str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).select("category", "Date", F.input_file_name().alias("f"))
    spans = rows.groupBy("category", "f").agg(F.min("Date").alias("a"), F.max("Date").alias("b")).orderBy("category", "a").collect()
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]) if x.category == y.category)


def test_date_filter_and_columns_reach_the_scan(spark, tmp_path):
    sinks.write_parquet(as_spark(spark, edge_panel((20,))), str(tmp_path / "p"))
    df = clean.date_range(files.scan_parquet(spark, str(tmp_path / "p")), "2019-01-10", "2019-02-01").select("Close")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2019-01-10)" in plan and "ReadSchema: struct<Date:date,Close:double>" in plan


def test_sector_csv_round_trip(spark, tmp_path):
    panel = as_spark(spark, edge_panel((20, 30))).withColumn("has_news", F.lit(True))
    path = str(tmp_path / "csv")
    sinks.export_sector_csv(panel, path)
    back = files.scan_sector_csv(spark, f"{path}/*", panel.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, panel.collect()))
    names = spark.read.option("header", True).csv(path)
    assert names.where("sector <> category").count() == 0


def test_archives_give_rows_of_the_universe_only(spark, tmp_path):
    header = "Date,Open,High,Low,Close,Adj Close,Volume\n"
    with zipfile.ZipFile(tmp_path / "full.zip", "w") as z:
        z.writestr("full/aapl.csv", header + "2020-01-02,1,2,0.5,1.5,1.4,100\n2020-01-03,1,2,0.5,1.6,1.4,100\n")
        z.writestr("__MACOSX/full/aapl.csv", "junk")
        z.writestr("full/zzz.csv", header + "2020-01-02,1,2,0.5,1.5,1.4,100\n")
        z.writestr("full/msft.txt", header)
    with zipfile.ZipFile(tmp_path / "more.zip", "w") as z:
        z.writestr("msft.csv", header + "\n".join(f"2020-01-02,1,2,0.5,1.5,1.4,{i}" for i in range(25_000)))
    universe = spark.createDataFrame([("AAPL",), ("MSFT",)], "Stock_symbol string")
    rows = archive.archive_ingest(spark, f"{tmp_path}/*.zip", universe)
    assert {r.Stock_symbol: r["count"] for r in rows.groupBy("Stock_symbol").count().collect()} == {"AAPL": 2, "MSFT": 25_000}
    assert rows.where("Stock_symbol = 'MSFT'").select("Volume").distinct().count() == 25_000


def test_sector_dim(spark):
    df = dims.sector_dim(spark, {"Technology": ["AAPL", "NOW"], "Energy": ["XOM"]})
    assert sorted(map(tuple, df.collect())) == [("AAPL", "Technology"), ("NOW", "Technology"), ("XOM", "Energy")]
    assert not df.schema["category"].nullable


def test_results_csv_has_iso_dates(spark, tmp_path):
    df = spark.sql("select 'A' as category, 0 as fold, date'2020-01-02' as test_start")
    sinks.export_results_csv(df, str(tmp_path / "r"))
    assert "".join(f.read_text() for f in (tmp_path / "r").glob("*.csv")).split() == ["category,fold,test_start", "A,0,2020-01-02"]


class Session:
    """The two things of a session that ``work_dir`` asks for."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_work_dir_follows_the_cluster_setting():
    assert work_dir(Session("yarn", "s3a://lake/tmp/"), "x").startswith("s3a://lake/tmp/x-")
    bare = Session("yarn")
    bare.conf = {"spark.sql.warehouse.dir": "hdfs://lake/warehouse/"}
    paths = [work_dir(bare, "x") for _ in range(2)]
    assert paths[0] != paths[1] and all(p.startswith("hdfs://lake/warehouse/x-") for p in paths)


def test_staged_tables_are_removed(spark, tmp_path):
    staged = session.materialize(spark.range(5), "staged")
    folder = staged.inputFiles()[0].rpartition("/")[0].removeprefix("file:").replace("///", "/")
    assert os.path.isdir(folder)
    session.remove(staged)
    assert not os.path.exists(folder)


def test_paths_for_python():
    fs, name = paths_of.arrow_path("file:///a b/c%20d.zip")
    assert fs.type_name == "local" and name == "/a b/c%20d.zip"
    assert paths_of.arrow_path("/x/y")[1] == "/x/y"


def test_article_day_is_that_of_utc(spark):
    raw = spark.createDataFrame([("3000000000", "2023-12-16 03:00:00 UTC")], "No string, Date string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = clean.typed_news(raw).selectExpr("No", "cast(Date as string) d").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.No, row.d) == (3_000_000_000, "2023-12-16")


def test_archive_members_are_spread(spark, tmp_path):
    folder = tmp_path / "with space"
    folder.mkdir()
    with zipfile.ZipFile(folder / "all.zip", "w") as z:
        for k in range(40):
            z.writestr(f"s{k}.csv", "Date,Open\n2020-01-01,1\n")
    symbols = spark.createDataFrame([(f"S{k}",) for k in range(40)], "Stock_symbol string")
    got = archive.archive_ingest(spark, str(folder), symbols, ("Date", "Open"), parallelism=4)
    tasks = got.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert got.count() == 40 and tasks > 1


@pytest.mark.parametrize("lines", [1, 3, 1000])
def test_pieces_of_a_split_read_alike(spark, tmp_path, monkeypatch, lines):
    """No window group holds more than a piece, and records that span pieces, splits and files' ends are whole."""
    monkeypatch.setattr(quoted_csv, "PIECE_LINES", lines)
    for part in ("a", "b"):
        text = "".join(record + "\n" for record in STRAY["ends in a quote"] * 9 + STRAY["stray quotes"] * 9)
        (tmp_path / f"{part}.csv").write_text(text)
    held = quoted_csv._lines(spark, str(tmp_path)).groupBy("_file", "_split").count().agg({"count": "max"}).first()[0]
    assert held <= lines
    schema = files.strings(("a", "b", "c"))
    got = sorted(map(str, quoted_csv.scan_quoted_csv(spark, str(tmp_path), schema, header=False).collect()))
    want = sorted(map(str, spark.read.schema(schema).options(multiLine=True, escape='"').csv(str(tmp_path)).collect()))
    assert got == want
