"""CSV landings on files written for each test."""

from __future__ import annotations

import csv
import datetime as dt
import random
from collections import Counter

import pytest

from martwright.sources import landing
from martwright.sources.quoted_csv import read_quoted_csv

AT = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture
def write(tmp_path):
    def to(name: str, content: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode())
        return str(path)

    return to


def test_table_name_and_column_names(spark):
    assert landing.raw_table_name("customers_dataset.CSV") == "RAW_CUSTOMERS_DATASET"
    df = spark.createDataFrame([(1, 2, 3)], ["customer id", " zip-code ", "City"])
    assert landing.standardize_columns(df).columns == ["CUSTOMER_ID", "ZIP_CODE", "CITY"]


def test_listing_takes_csv_files_of_any_case_and_folder(spark, tmp_path, write):
    for name in ("a.csv", "B.CSV", "sub folder/a.csv", "note.txt", "c.csv.gz"):
        write(name, "x\n1\n")
    found = landing.landing_files(spark, str(tmp_path))
    assert {table: len(paths) for table, paths in found.items()} == {"RAW_A": 2, "RAW_B": 1}


def test_rows_are_text_with_load_metadata(spark, write):
    path = write("items+one two.csv", 'order id,item-name,price\n01046,"a, ""b""",1.50\n2,,NA\n')
    df = landing.read_landing(spark, [path], AT)
    assert df.schema.simpleString() == (
        "struct<ORDER_ID:string,ITEM_NAME:string,PRICE:string,_REJECTED:string,_LOADED_AT:timestamp_ntz,_SOURCE_FILE:string>"
    )
    assert [tuple(r) for r in df.collect()] == [
        ("01046", 'a, "b"', "1.50", None, AT, "items+one two.csv"),
        ("2", None, "NA", None, AT, "items+one two.csv"),
    ]


def test_plain_files_are_split_and_headers_must_agree(spark, tmp_path, write):
    first = write("a/t.csv", "x,y\n1,2\n")
    other = write("b/t.csv", "y,x\n1,2\n")
    with pytest.raises(Exception, match="header"):
        landing.read_landing(spark, [first, other], AT).collect()
    with pytest.raises(Exception, match="header"):
        landing.read_landing(spark, [first, other], AT, multi_line=True).collect()


@pytest.fixture
def tiny_splits(spark):
    """Cut files into splits of about 100 bytes, so that records cross them."""
    conf = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_quoted_line_breaks_across_splits(spark, tmp_path, tiny_splits, line_end):
    rng = random.Random(5)
    pieces = ["a", "é", "\n", "\n\n", '"', ",", "some longer text ", "x" * 150]
    paths, expected = [], Counter()
    for k in range(2):
        paths.append(str(tmp_path / f"f{k}.csv"))
        with open(paths[-1], "w", newline="") as f:
            writer = csv.writer(f, lineterminator=line_end)
            writer.writerow(["id", "my text", "last"])
            for i in range(60):
                body = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
                writer.writerow([f"{k}-{i}", body, "end"])
                expected[(f"{k}-{i}", body or None, "end", f"f{k}.csv")] += 1
    df = read_quoted_csv(spark, paths)
    assert df.columns == ["id", "my text", "last", "_REJECTED", "_SOURCE_PATH"]
    assert Counter((*r[:3], r[4].split("/")[-1]) for r in df.where("_REJECTED IS NULL").collect()) == expected
    # that there are line breaks inside quotes is found without being told
    named = landing.read_landing(spark, paths, AT)
    assert named.columns == ["ID", "MY_TEXT", "LAST", "_REJECTED", "_LOADED_AT", "_SOURCE_FILE"]
    assert named.where("_SOURCE_FILE = 'f1.csv'").count() == 60


def test_ingest_appends_and_audits(spark, tmp_path, write):
    write("in/people.csv", "id,name\n1,a\n2,b\n")
    write("in/deep/people.csv", "id,name\n3,c\n")
    write("in/reviews.CSV", 'id,msg\n1,"two\nlines"\n')
    spark.sql("CREATE SCHEMA IF NOT EXISTS ingest_test")
    results = []
    for _ in range(2):
        results.append(
            landing.ingest(spark, str(tmp_path / "in"), lambda t: f"ingest_test.{t}", loaded_at=AT)
        )
    assert [(r.table, r.files, r.rows_loaded, r.rows_total) for r in results[1]] == [
        ("ingest_test.RAW_PEOPLE", 2, 3, 6),
        ("ingest_test.RAW_REVIEWS", 1, 1, 2),
    ]
    assert spark.table("ingest_test.raw_reviews").first()["MSG"] == "two\nlines"


@pytest.mark.parametrize("seed", range(4))
def test_quotes_inside_unquoted_fields_equal_the_multi_line_reader(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    free = ["a", 'b"', '"', '""', "é", " ", "long text " * 5]
    quoted = ["a", '""', ",", "\n", "\r\n", '"",""', ", ", "x" * 40]
    path = tmp_path / "t.csv"
    with open(path, "w", newline="") as f:
        f.write("id,msg,last\n")
        for i in range(120):
            fields = [str(i)]
            for _ in range(2):
                if rng.random() < 0.4:
                    fields.append('"' + "".join(rng.choice(quoted) for _ in range(rng.randint(0, 6))) + '"')
                else:
                    fields.append("x" + "".join(rng.choice(free) for _ in range(rng.randint(0, 5))))
            f.write(",".join(fields) + "\n")
    theirs = spark.read.csv(str(path), header=True, escape='"', multiLine=True)
    ours = read_quoted_csv(spark, [str(path)])
    assert ours.where("_REJECTED IS NOT NULL").count() == 0
    assert Counter(map(tuple, ours.select("id", "msg", "last").collect())) == Counter(map(tuple, theirs.collect()))
    assert ours.count() == 120


def test_no_row_is_lost_after_a_stray_quote(spark, write):
    path = write("t.csv", 'id,msg\n1,5" pipe\n2,ok\n3,6" pipe\n4,ok\n')
    for multi_line in (None, True, False):
        rows = landing.read_landing(spark, [path], AT, multi_line=multi_line).select("ID", "MSG").collect()
        assert sorted(map(tuple, rows)) == [("1", '5" pipe'), ("2", "ok"), ("3", '6" pipe'), ("4", "ok")]


def test_a_file_that_ends_inside_quotes_is_an_error(spark, write):
    path = write("t.csv", 'id,msg\n1,"open\n2,x\n' + "3,y\n" * 100)
    with pytest.raises(Exception, match="ends inside a quoted field"):
        landing.read_landing(spark, [path], AT).collect()


@pytest.mark.parametrize("breaks", [False, True])
def test_records_with_other_field_counts_are_kept_apart(spark, tmp_path, write, breaks):
    last = '5,"two\nlines"\n' if breaks else "5,e\n"
    write(f"in/odd{breaks}.csv", "id,msg\n1,a,b,c\n2\n3,c\n" + last)
    spark.sql("CREATE SCHEMA IF NOT EXISTS odd_test")
    (load,) = landing.ingest(spark, str(tmp_path / "in"), lambda t: f"`odd_test`.`{t}`", loaded_at=AT)
    assert (load.rows_loaded, load.rows_total, load.rows_rejected) == (2, 2, 2)
    assert sorted(r["ID"] for r in spark.table(f"odd_test.raw_odd{breaks}").collect()) == ["3", "5"]
    kept = spark.table(f"odd_test.raw_odd{breaks}_rejects").collect()
    assert sorted(r["record"] for r in kept) == ["1,a,b,c", "2"] and kept[0]["_SOURCE_FILE"] == f"odd{breaks}.csv"
