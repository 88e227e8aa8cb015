"""Split CSV files with line breaks in cells; the round journal."""

import csv
import io
import random

import pytest

import model
from helpers import SF0001, catalogue
from skulink.plans import cascade as cz
from skulink.plans.exclusion import match_excluding
from skulink.plans.journal import RoundJournal
from skulink.session import cut
from skulink.sources import fixture as fx
from skulink.sources.catalogue import write_final
from skulink.sources.records import read_csv

CELLS = ["plain", "", "two\nlines", 'say ""quoted""'.replace('""', '"'), "a,b", "crlf\r\ninside", "\n\n", '"', " edge ",
         "x" * 300, "é\n日本"]


def rows(n, seed):
    r = random.Random(seed)
    return [[f"P{i}", r.choice(CELLS), r.choice(CELLS)] for i in range(n)]


def text(header, body, end):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    w.writerow(header)
    w.writerows(body)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_files_give_the_rows_in_order(spark, tmp_path, end):
    bodies = [rows(120, 1), rows(1, 2), [], rows(70, 3)]
    for i, body in enumerate(bodies):
        (tmp_path / f"f{i}.csv").write_bytes(text(["id", "a", "b"], body, end).encode())
    want = [tuple(x) for body in bodies for x in body]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("97b", "1000b", "128m"):
            spark.conf.set(key, size)
            got = sorted(tuple(r) for r in read_csv(spark, str(tmp_path), ["id", "a", "b"]).collect())
            assert [r[0] for r in got] == list(range(len(want)))
            assert [r[1:] for r in got] == want, size
    finally:
        spark.conf.set(key, before)


def test_one_big_file_is_read_by_many_tasks(spark, tmp_path):
    body = rows(3000, 5)
    (tmp_path / "big.csv").write_bytes(text(["id", "a", "b"], body, "\n").encode())
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "20000b")
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = sorted(tuple(r) for r in read_csv(spark, str(tmp_path), ["id", "a", "b"]).collect())
    finally:
        spark.conf.set(key, before)
    unsplit = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path)).fillna("")
    # the unsplit reader turns a cell's CRLF into a line feed; here cells stay as they are
    assert sorted(tuple(c.replace("\r\n", "\n") for c in r[1:]) for r in got) == sorted(
        tuple(c.replace("\r\n", "\n") for c in r) for r in unsplit.collect())


def test_headers_of_other_order_and_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,price\n1,"x\ny",2\n')
    (tmp_path / "b.csv").write_text('price,id,extra\n3,4,"e"\n\n5,6,\n')
    got = sorted(tuple(r) for r in read_csv(spark, str(tmp_path), ["id", "name", "price"]).collect())
    assert got == [(0, "1", "x\ny", "2"), (1, "4", "", "3"), (2, "6", "", "5")]
    with pytest.raises(ValueError, match="nowhere"):
        read_csv(spark, str(tmp_path), ["id", "nowhere"])


class Broken(Exception):
    pass


@pytest.mark.parametrize("policy,stops", [("matched", (1, 4, 7)), ("last_scanned", (3,))])
def test_broken_run_goes_on_behind_its_last_round(spark, tmp_path, monkeypatch, policy, stops):
    L, R = cut(fx.fixture_left(spark, SF0001)), cut(fx.fixture_right(spark, SF0001))
    grid = cz.Grid(step=0.05)
    want = model.run([r.asDict() for r in L.collect()], [r.asDict() for r in R.collect()], step=5, mode="direct",
                     policy=policy)
    folder = str(tmp_path / "journal")
    publish = RoundJournal.publish
    for stop in stops:
        def broken(self, manifest, stop=stop):
            # the round's rows are written, its manifest is not
            if manifest["number"] >= stop:
                raise Broken
            publish(self, manifest)
        monkeypatch.setattr(RoundJournal, "publish", broken)
        with pytest.raises(Broken):
            match_excluding(L, R, policy, grid=grid, band="direct", journal=folder)
    monkeypatch.setattr(RoundJournal, "publish", publish)
    got = match_excluding(L, R, policy, grid=grid, band="direct", journal=folder)
    got = {r.pos: (r.match_k, r.match_pos) for r in got.collect() if r.match_k is not None}
    assert got == {p: (k, m) for p, (k, m, _) in want.items()}
    with pytest.raises(ValueError, match="journal"):
        match_excluding(L, R, policy, grid=cz.Grid(step=0.1), band="direct", journal=folder)


def test_a_vendors_rerun_keeps_the_other_vendors(spark, tmp_path):
    left = catalogue(spark, [(0, "one two")], vendor="Base")
    right = catalogue(spark, [(1, "one two")], "Alpha").unionByName(catalogue(spark, [(3, "one two")], "Beta"))
    out = cz.attach_rows(cz.match_none(left, right, band="off"), right)
    path = str(tmp_path / "final")
    write_final(out, path, "Base")
    write_final(out.where("vendor = 'Alpha'"), path, "Base")
    assert {r.vendor for r in spark.read.parquet(path).collect()} == {"Alpha", "Beta"}
