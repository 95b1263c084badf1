import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from spendecho.plans.views import catalog_lines, catalog_pages, catalog_text, slice_rows
from spendecho.schemas import CACHE_SCHEMA
from spendecho.sources import cache as cache_files
from spendecho.sources import files, landing, tables

AD_HEADER = ("currency,date,channel,campaign_id,campaign_name,objective,ad_set_id,ad_set_name,"
             "impressions,clicks,spend,conversions,conversion_value,cpc,extra\n")
FB_HEADER = "feedback_id,posted_at,source,rating,review_text,author,true_campaign_id\n"


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_ads_bind_by_name_and_cast(spark, tmp_path):
    path = write(tmp_path, "ads.csv", AD_HEADER + (
        'USD,2024-01-02,meta,M1,"Sale — a, b",traffic,A1,"x ""q"" & y",1000,10,12.34,NULL,99.90,1.2340,z\n'
        "USD,2024-01-03,meta,M1,Sale,traffic,A1,s,,10,0.00,0,0.00,0.0000,\n"
    ))
    a, b = landing.read_csv(spark, path, landing.DATASETS["meta_ads"]).orderBy("date").collect()
    assert (a.date, a.campaign_name, a.ad_set_name) == (dt.date(2024, 1, 2), "Sale — a, b", 'x "q" & y')
    assert (a.impressions, a.spend, a.conversions, a.cpc) == (1000, Decimal("12.34"), None, Decimal("1.2340"))
    assert b.impressions is None and b.conversions == 0


def test_bad_number_and_short_row_abort(spark, tmp_path):
    row = "USD,2024-01-02,meta,M1,S,traffic,A1,s,{},10,12.34,1,99.90,1.2340,\n"
    bad = write(tmp_path, "bad.csv", AD_HEADER + row.format("many"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landing.read_csv(spark, bad, landing.DATASETS["meta_ads"]).collect()
    short = write(tmp_path, "short.csv", AD_HEADER + "USD,2024-01-02,meta\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.read_csv(spark, short, landing.DATASETS["meta_ads"]).collect()


def test_feedback_stays_text(spark, tmp_path):
    path = write(tmp_path, "fb.csv", FB_HEADER + (
        'FB_1,  2024-03-05 ,FB,4.0,"line one\nline ""two"", é 🙂",,\n'
        "FB_2,,NULL,★★★☆☆,007,—,mt-c1\n"
    ))
    a, b = landing.read_csv(spark, path, landing.DATASETS["customer_feedback"]).orderBy("feedback_id").collect()
    assert a.posted_at == "  2024-03-05 " and a.rating == "4.0"
    assert a.review_text == 'line one\nline "two", é 🙂' and a.author is None
    assert b.source is None and b.review_text == "007" and b.rating == "★★★☆☆"


def test_missing_input_fails_before_any_write(spark, tmp_path):
    for name in ("meta_ads.csv", "google_ads.csv", "tiktok_ads.csv"):
        write(tmp_path, name, AD_HEADER)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        landing.read_all(spark, str(tmp_path))


def test_append_and_truncate(spark, tmp_path):
    path = write(tmp_path, "fb.csv", FB_HEADER + "FB_1,,,,t,,\nFB_2,,,,t,,\n")
    df = landing.read_csv(spark, path, landing.DATASETS["customer_feedback"])
    bucket = (4, "feedback_id")
    assert landing.land(df, "landed", bucket=bucket) == 2
    assert landing.land(df, "landed", bucket=bucket) == 2
    assert spark.table("landed").count() == 4
    landing.land(df, "landed", truncate=True, bucket=bucket)
    assert spark.table("landed").count() == 2
    assert dict(spark.table("landed").dtypes)["_loaded_at"] == "timestamp_ntz"


def record(h, model, sentiment):
    return (h, model, sentiment, 0.5, ["price"], [], [], "en", "", "", 0.0)


def test_cache_files(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert cache_files.read_cache(spark, path).count() == 0
    cache_files.append_cache(spark.createDataFrame(
        [record("h2", "m1", "neutral"), record("h1", "m1", "neutral")], CACHE_SCHEMA), path)
    cache_files.append_cache(spark.createDataFrame([record("h1", "m1", "mixed")], CACHE_SCHEMA), path)
    got = {r.content_hash: r.sentiment for r in cache_files.read_cache(spark, path).collect()}
    assert got == {"h1": "mixed", "h2": "neutral"}

    sorted_path = str(tmp_path / "sorted")
    cache_files.write_cache(cache_files.read_cache(spark, path), sorted_path)
    lines = [r.value for r in spark.read.text(sorted_path).orderBy("value").collect()]
    assert len(lines) == 2 and lines[0].startswith('{"campaign_reference":"","competitor_mentions":[]')


def test_last_line_of_one_file_wins(spark, tmp_path):
    line = '{{"content_hash":"h","model_version":"m","sentiment":"{}"}}\n'
    path = write(tmp_path, "c.jsonl", line.format("neutral") + "\n  \n" + line.format("mixed"))
    assert [r.sentiment for r in cache_files.read_cache(spark, path).collect()] == ["mixed"]


def test_catalog_text(spark):
    catalog = spark.createDataFrame(
        [("B", "b", "meta", "traffic"), ("A", "a", "tiktok", "awareness")],
        "campaign_id string, campaign_name string, channel string, objective string",
    )
    assert catalog_text(catalog).head().catalog_text == (
        "  - A | a | tiktok | awareness\n  - B | b | meta | traffic"
    )
    assert catalog_lines(catalog).count() == 2
    pages = sorted(catalog_pages(catalog.union(catalog), lines_per_page=3).collect())
    assert [(r.page, r.n_lines) for r in pages] == [(0, 3), (1, 1)]
    assert "\n".join(r.page_text for r in pages).count("  - A | a") == 2


def test_catalog_text_is_whole(spark):
    """More lines than a page has: the plain call still gives all of them, in order."""
    rows = [(f"{i:03d}", "n", "meta", "traffic") for i in range(25)]
    catalog = spark.createDataFrame(rows, "campaign_id string, campaign_name string, channel string, objective string")
    (got,) = catalog_text(catalog, lines_per_page=2).collect()
    assert got.catalog_text == "\n".join(f"  - {r[0]} | n | meta | traffic" for r in rows)
    assert catalog_text(catalog, 1, 2).head().catalog_text.split("\n")[0] == "  - 002 | n | meta | traffic"
    assert [r.catalog_text for r in catalog_text(catalog.limit(0)).collect()] == [None]


def test_header_orders_of_one_folder(spark, tmp_path):
    """Files with their columns in another order bind by name."""
    folder = tmp_path / "ads"
    folder.mkdir()
    (folder / "a.csv").write_text(AD_HEADER + "USD,2024-01-02,meta,M1,S,traffic,A1,s,1000,10,1.00,3,9.90,1.2340,z\n")
    swapped = AD_HEADER.replace("clicks,spend,conversions", "conversions,spend,clicks")
    (folder / "b.csv").write_text(swapped + "USD,2024-01-03,meta,M1,S,traffic,A1,s,1000,3,1.00,10,9.90,1.2340,z\n")
    got = landing.read_csv(spark, str(folder), landing.DATASETS["meta_ads"]).orderBy("date").collect()
    assert [(r.clicks, r.conversions) for r in got] == [(10, 3), (10, 3)]
    notes = tmp_path / "notes"
    notes.mkdir()
    (notes / "a.csv").write_text(FB_HEADER + 'F1,2024-01-02,FB,5,"two\nlines, here",x,\n')
    (notes / "b.csv").write_text("feedback_id,source,posted_at,rating,review_text,author,true_campaign_id\nF2,IG,2024-01-03,4,t,x,\n")
    got = landing.read_csv(spark, str(notes), landing.DATASETS["customer_feedback"]).orderBy("feedback_id").collect()
    assert [(r.source, r.posted_at) for r in got] == [("FB", "2024-01-02"), ("IG", "2024-01-03")]


def test_write_sequence_decides(spark, tmp_path):
    """Neither file times nor names: the later sequence wins, and compacting keeps it."""
    path = str(tmp_path / "cache")
    for sequence, sentiment in ((7, "mixed"), (5, "neutral"), (6, "negative")):
        cache_files.append_cache(spark.createDataFrame([record("h1", "m1", sentiment)], CACHE_SCHEMA), path, sequence)
    for f in (tmp_path / "cache").glob("part-*"):
        os.utime(f, (10**9, 10**9))
    assert [r.sentiment for r in cache_files.read_cache(spark, path).collect()] == ["mixed"]
    assert len(cache_files.delta_files(spark, path, None)) >= 3
    cache_files.fold(spark, path)
    assert [r.sentiment for r in cache_files.read_cache(spark, path).collect()] == ["mixed"]
    cache_files.append_cache(spark.createDataFrame([record("h1", "m1", "neutral")], CACHE_SCHEMA), path, 6)
    assert [r.sentiment for r in cache_files.read_cache(spark, path).collect()] == ["mixed"]


def test_slices_prune_month_partitions(spark, tmp_path):
    rows = spark.sql(
        "select explode(sequence(date'2024-01-01', date'2024-06-30')) as date, 'meta' as channel, 'c' as campaign_id"
    ).selectExpr("*", "date_format(date, 'yyyy-MM') as month")
    path = str(tmp_path / "spend")
    rows.write.partitionBy("month").parquet(path)
    got = slice_rows(spark.read.parquet(path), dt.date(2024, 2, 10), dt.date(2024, 3, 5), channels=["meta"])
    assert got.count() == 25
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    filters = next(l for l in plan.splitlines() if "PartitionFilters" in l)
    assert "2024-02" in filters and "2024-03" in filters


class Counted:
    """A file of any size that notes what is read of it."""

    def __init__(self, head, size):
        self.head, self.size, self.seen = head, size, 0

    def read(self, n):
        out = self.head[self.seen : self.seen + n] if self.seen < len(self.head) else b"x" * min(n, self.size - self.seen)
        self.seen += len(out)
        return out


def test_header_probe_reads_a_prefix():
    for size in (10**6, 10**9):
        file = Counted(b"\xef\xbb\xbf\r\n  \na,b\r\n1,2\n", size)
        assert landing.first_line(file) == "a,b\r" and file.seen <= landing.PREFIX
    long = Counted(b"c" * 200_000 + b",d\n", 10**9)
    assert len(landing.first_line(long)) == 200_002 and long.seen <= 4 * landing.PREFIX
    assert landing.first_line(Counted(b"only", 0)) == "only"
    assert landing.first_line(Counted(b"\n \n", 0)) is None


def test_header_groups(spark, tmp_path):
    """One order is one group, whatever the files; several are told apart. Odd names and packed files work."""
    import gzip

    folder = tmp_path / "in put"
    folder.mkdir()
    (folder / "a b%20.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("\n\ufeffx,\"y\"\r\n3,4\n")
    (folder / "empty.csv").write_text("")
    assert landing.header_groups(spark, str(folder)) == {("x", "y"): [str(folder)]}
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write("y,x\n6,5\n")
    groups = landing.header_groups(spark, str(folder))
    assert {k: sorted(f.rsplit("/", 1)[1] for f in v) for k, v in groups.items()} == {("x", "y"): ["a b%20.csv", "b.csv"], ("y", "x"): ["c.csv.gz"]}
    got = [sorted(map(tuple, spark.read.csv(v, header=True).select("x", "y").collect())) for _, v in sorted(groups.items())]
    assert got[1] == [("5", "6")] and ("1", "2") in got[0]


def test_export_is_one_set(spark, tmp_path, monkeypatch):
    """A third mart that fails leaves the set before whole; two drivers cannot mix."""
    db, folder = "export_db", str(tmp_path / "export")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    names = ["a", "b", "c"]

    def build(n):
        for name in names:
            spark.range(n).withColumn("month", F.lit("m")).write.mode("overwrite").saveAsTable(f"{db}.{name}")

    def seen():
        return {n: spark.read.parquet(p).count() for n, p in tables.exported(spark, folder).items()}

    assert tables.exported(spark, folder) == {}
    build(3)
    assert tables.export_marts(spark, db, folder, names) == dict.fromkeys(names, 3) == seen()
    build(5)
    broken = tables.served
    calls = []

    def served(df):
        calls.append(1)
        return broken(df).withColumn("x", F.raise_error(F.lit("disk full"))) if len(calls) == 3 else broken(df)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "served", served)
        with pytest.raises(Exception, match="disk full"):
            tables.export_marts(spark, db, folder, names)
    assert seen() == dict.fromkeys(names, 3)
    before = tables.exported(spark, folder)
    tables.export_marts(spark, db, folder, names)
    assert seen() == dict.fromkeys(names, 5)
    assert spark.read.parquet(before["a"]).count() == 3  # for a reader who has opened it
    build(0)
    assert tables.export_marts(spark, db, folder, names) == dict.fromkeys(names, 0) == seen()
    assert len([n for n in files.names(spark, folder) if n.startswith("version-")]) == 2
