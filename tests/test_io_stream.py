"""Sources and sinks: CSV round trip, round files, resume log, pages, stream."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import SF0001, catalogue
from skulink.operators.consolidate import consolidate_by_left, consolidate_by_pair
from skulink.plans import cascade as cz
from skulink.sources import catalogue as ct
from skulink.sources import fixture as fx
from skulink.sources import pages as pg
from skulink.sources import resume as rs
from skulink.streaming.incremental import match_batch, match_stream


def test_csv_roundtrip_with_quotes_and_newlines(spark, tmp_path):
    rows = [(1, 'Beaker, "Pyrex" 250 mL', "line one\nline two"), (2, "Plain", ""), (3, "Ünïcode", None)]
    df = catalogue(spark, rows)
    path = str(tmp_path / "cat")
    ct.write_catalogue(df, path, "Alpha")
    back = ct.read_catalogue(spark, path, "Alpha", "Alpha", multi_line=True).orderBy("pos").collect()
    assert [r.product_name for r in back] == [r[1] for r in rows]
    assert [r.product_desc for r in back] == ["line one\nline two", "", ""]  # empty -> ''
    # no ordinal column: taken from the scan of one file
    single = str(tmp_path / "single")
    df.drop("pos").coalesce(1).select(*[F.col(c).alias(f"Alpha_{c}") for c in ct.CATALOGUE_FIELDS]) \
        .write.option("header", True).option("escape", '"').csv(single)
    back2 = ct.read_catalogue(spark, single, "Alpha", "Alpha", pos_column=None,
                              multi_line=True).orderBy("pos").collect()
    assert [r.pos for r in back2] == [0, 1, 2]
    parquet = str(tmp_path / "parquet")
    ct.write_catalogue(df, parquet, "Alpha", fmt="parquet")
    back3 = ct.read_catalogue(spark, parquet, "Alpha", "Alpha", fmt="parquet").orderBy("pos").collect()
    assert [r.product_desc for r in back3] == ["line one\nline two", "", ""]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    names = [f"Alpha_{c}" for c in ct.CATALOGUE_FIELDS]
    order = ["extra", *reversed(names), "row"]
    one = tmp_path / "one.csv"
    one.write_text(",".join(order) + "\n" + ",".join(f"v {c}" for c in order[:-1]) + ",7\n")
    got = ct.read_catalogue(spark, str(one), "Alpha", "Alpha", pos_column="row").first()
    assert got.pos == 7 and got.vendor == "Alpha"
    assert all(got[c] == f"v Alpha_{c}" for c in ct.CATALOGUE_FIELDS)
    with pytest.raises(ValueError, match="no column pos"):
        ct.read_catalogue(spark, str(one), "Alpha", "Alpha")
    bad = tmp_path / "bad.csv"
    bad.write_text("row,Alpha_product_id\n1,x\n")
    with pytest.raises(ValueError, match="Alpha_product_name"):
        ct.read_catalogue(spark, str(bad), "Alpha", "Alpha", pos_column="row")
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.csv").write_text(one.read_text())
    both = ct.read_catalogue(spark, str(folder), "Alpha", "Alpha", pos_column=None).collect()
    assert sorted(r.pos for r in both) == [0, 1]
    ct.read_catalogue(spark, str(one), "Alpha", "Alpha", pos_column="row").write.parquet(str(tmp_path / "pq"))
    with pytest.raises(ValueError, match="no column"):
        ct.read_catalogue(spark, str(tmp_path / "pq"), "Alpha", "Alpha", pos_column=None, fmt="parquet")


def test_round_files_merge_and_consolidation(spark, tmp_path):
    L, R = fx.fixture_left(spark, SF0001), fx.fixture_right(spark, SF0001)
    out = cz.attach_rows(cz.match_none(L, R, band="direct"), R)
    rnd = cz.round_output(out)
    path = str(tmp_path / "rounds")
    ct.write_rounds(rnd, path, "Base")
    back = ct.read_rounds(spark, path, "Base", multi_line=True)
    assert ct.count_files(back).first()[0] == len(cz.Grid().ks)
    merged = consolidate_by_left(back.drop("source_file"))
    direct = consolidate_by_left(rnd.drop("k", "match_pos"))
    cols = ["left_product_id", "threshold", "right_product_id"]
    assert sorted(map(tuple, merged.select(*cols).collect())) == \
        sorted(map(tuple, direct.select(*cols).collect()))
    # consolidated by left = the match row of every left row
    m = {r.left_product_id: r.threshold for r in merged.collect()}
    assert all(m[r.left_product_id] == r.threshold for r in out.collect())
    pairs = consolidate_by_pair(out)
    assert pairs.count() == out.select("left_product_id", "right_product_id").distinct().count()


def test_final_sink_is_vendor_partitioned(spark, tmp_path):
    L = fx.fixture_left(spark, SF0001)
    R = fx.fixture_right(spark, SF0001, n_vendors=3)
    out = cz.attach_rows(cz.match_none(L, R, band="off"), R)
    path = str(tmp_path / "final")
    ct.write_final(out, path, "Base")
    assert sorted(d for d in os.listdir(path) if d.startswith("vendor=")) == \
        ["vendor=Alpha", "vendor=Beta", "vendor=Gamma"]
    v = ct.vendor_view(out, "Beta", "Base")
    assert "Beta_Match_Score" in v.columns and "Base_product_name" in v.columns


def test_resume_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert rs.read_log(spark, path).count() == 0
    left = catalogue(spark, [(0, "a b"), (2, "c d"), (4, "e f")], vendor="Base")
    log = spark.createDataFrame([("Alpha", "id", "P0"), ("Alpha", "name", "e f"),
                                 ("Alpha", "threshold", "0.80"), ("Beta", "id", "P2")], rs.LOG_SCHEMA)
    rs.append_log(log, path)
    got = rs.read_log(spark, path)
    assert [tuple(r) for r in rs.done_thresholds(got).collect()] == [("Alpha", "0.80")]
    # what Alpha has matched stays in Beta's run, and the other way round
    right = catalogue(spark, [(1, "a b")]).unionByName(catalogue(spark, [(3, "c d")], vendor="Beta"))
    rows = cz.match_none(left, right, band="off", done=got).collect()
    assert sorted((r.vendor, r.pos) for r in rows) == [("Alpha", 2), ("Beta", 0), ("Beta", 4)]


def test_listing_rules(spark):
    html = ('<p class="c-total">Item # (AB-12) </p><p class="c-total">none</p>'
            '<div class="x search_num y">Catalog No.: (77-1)</div>'
            '<div class="product_SKU">SKU: 5-5 &amp; co</div><a href="/one">1</a>')
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    r1 = pg.extract_listing_ids(pages, pg.ListingRule("p", "c-total", contains="Item",
                                                      delimiter="#", strip_parens=True)).collect()
    assert [(r.rank, r.product_id) for r in r1] == [(1, "AB-12")]
    r2 = pg.extract_listing_ids(pages, pg.ListingRule("div", "search_num", delimiter=":",
                                                      strip_parens=True)).collect()
    assert [r.product_id for r in r2] == ["77-1"]
    r3 = pg.extract_listing_ids(pages, pg.ListingRule("div", "product_SKU", delimiter=": ")).collect()
    assert [r.product_id for r in r3] == ["5-5 & co"]
    assert [r.href for r in pg.extract_links(pages).collect()] == ["/one"]


def test_nested_and_odd_listings(spark):
    html = ("<DIV Class='x ad y'><div>x</div> Item # <b>77</b></DIV><div class=ad>88</div>"
            '<div class="ad"><div class="ad">in</div>out</div><div class="ad"/><div class="ads">no</div>'
            '<div data-class="ad">no</div><divx class="ad">no</divx><div class="ad">open')
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "")],
                                  "page_id long, url string, html string")
    got = pg.extract_listing_ids(pages, pg.ListingRule("div", "ad")).collect()
    assert [(r.rank, r.product_id) for r in got] == [
        (1, "x Item # 77"), (2, "88"), (3, "inout"), (4, "in"), (5, ""), (6, "open")]
    got = pg.extract_listing_ids(pages, pg.ListingRule("div", "ad", delimiter="#")).collect()
    assert got[0].product_id == "77"


def test_rules_with_attributes_inside_elements(spark):
    listing = '<p class="hit"><a class="l" href=\'/d1\'>one</a></p><a href="/d2">two</a>'
    detail = ('<p class="other"><span itemprop="sku">no</span></p><p class="cat"><span>no</span>'
              "<SPAN title='t' itemprop='sku'>S-1</SPAN></p>")
    pages = spark.createDataFrame([(1, "https://x/list", listing), (2, "https://x/d1", detail),
                                   (3, "https://x/d2", detail)], "page_id long, url string, html string")
    rule = pg.ListingRule("span", attrs={"itemprop": "sku"}, within=pg.ListingRule("p", "cat"))
    both = pg.two_hop_ids(pages, rule, base_url="https://x", key="url").collect()
    assert sorted((r.href, r.detail_page_id, r.product_id) for r in both) == [
        ("/d1", 2, "S-1"), ("/d2", 3, "S-1")]
    hit = pg.two_hop_ids(pages, rule, base_url="https://x", key="url",
                         links_in=pg.ListingRule("p", "hit")).collect()
    assert [(r.page_id, r.rank, r.href, r.product_id) for r in hit] == [(1, 1, "/d1", "S-1")]
    has = pg.ListingRule("span", attrs={"title": None})
    assert [r.page_id for r in pg.extract_listing_ids(pages, has).collect()] == [2, 3]


def test_replayed_batch_gives_its_rows_again(spark, tmp_path):
    L, R = fx.fixture_left(spark, SF0001), fx.fixture_right(spark, SF0001, n_vendors=2)
    first, out = L.where("pos <= 20"), str(tmp_path / "out")
    n = first.count()
    for _ in range(2):                       # the second run replays batch 0
        match_batch(first, R, out, 0, band="off")
        assert spark.read.parquet(out).count() == 2 * n
    match_batch(L.where("pos <= 30"), R, out, 1, band="off")
    both = spark.read.parquet(out)
    assert both.count() == 2 * L.where("pos <= 30").count()
    assert both.select("vendor", "left_pos").distinct().count() == both.count()
    # what one vendor has matched is still new to another
    S = R.where("vendor = 'Alpha'").unionByName(R.where("vendor = 'Beta'").withColumn("vendor", F.lit("Gamma")))
    match_batch(first, S, out, 2, band="off")
    third = spark.read.parquet(out).where("batch_id = 2")
    assert {r.vendor for r in third.collect()} == {"Gamma"} and third.count() == n


def test_stream_matches_batches_and_skips_done(spark, tmp_path):
    L, R = fx.fixture_left(spark, SF0001), fx.fixture_right(spark, SF0001)
    src = str(tmp_path / "left_in")
    L.where("pos < 100").write.parquet(src + "/part1")
    L.where("pos >= 100").write.parquet(src + "/part2")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    q = match_stream(spark, src + "/*", R, out, cp, band="off")
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    n0 = got.count()
    want = cz.attach_rows(cz.match_none(L, R, band="off"), R)
    key = ["left_pos", "match_pos", "match_k"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    # a re-run over the same files adds nothing; new files with done ids are skipped
    L.where("pos < 20").write.parquet(src + "/part3")
    q = match_stream(spark, src + "/*", R, out, cp, band="off")
    q.awaitTermination(300)
    assert n0 == want.count() and spark.read.parquet(out).count() == n0


def test_scan_ordinal_is_consecutive_in_order(spark):
    df = spark.range(0, 1000, 1, numPartitions=7).withColumn("v", F.col("id") * 3)
    got = ct.with_scan_ordinal(df).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1000))
    assert [r.id for r in got] == list(range(1000))
