import csv
import io
import random

import pytest

from murmur.sources import csv as C
from murmur.sources.tables import load_export_csv

SCHEMA = "post_id string, data string, n int, title string"


def whole(spark, path, schema=SCHEMA):
    """Spark's own reader, which takes a file in one task."""
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def export(path, seed, n=120, end="\n"):
    rng = random.Random(seed)
    cells = ["", "plain", 'say ""', '{"a": 1, "b": [",", "\n"]}', "two\nlines", "\n", '"', '""', "é日本😀", "a,b", " x ",
             "tail\\", "long " * 30, '\n"\n",\n', "crlf\r\nin", "'"]
    buffer = io.StringIO()
    writer = csv.writer(buffer, lineterminator=end)
    writer.writerow(["post_id", "data", "n", "title"])
    for i in range(n):
        writer.writerow([f"p{i}", rng.choice(cells) + rng.choice(cells), rng.choice(["", i]), rng.choice(cells)])
    path.write_bytes(buffer.getvalue().encode())


def plain(path):
    """The same by Python's reader, which keeps the line breaks of cells as they are."""
    with open(path, encoding="utf-8", newline="") as f:
        found = list(csv.reader(f))[1:]
    return sorted(((a, b or None, int(n) if n else None, t or None) for a, b, n, t in found), key=str)


@pytest.mark.parametrize("range_bytes", [11, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_ranges_read_what_one_task_reads(spark, tmp_path, range_bytes, end):
    path = tmp_path / "e.csv"
    export(path, range_bytes, range_bytes // 4 if range_bytes < 100 else 150, end)
    got = rows(load_export_csv(spark, str(path), SCHEMA, range_bytes=range_bytes))
    assert got == plain(path)
    if end == "\n":  # Spark's reader makes line feeds of the others inside cells
        assert got == rows(whole(spark, str(path)))


def test_a_large_file_is_many_tasks(spark, tmp_path):
    path = tmp_path / "e.csv"
    export(path, 1, 4000)
    size = path.stat().st_size
    records = C.csv_records(spark, str(path), size // 20)
    assert records.rdd.getNumPartitions() >= 20
    assert records.count() == 4001 and records.where("first").count() == 1


def test_several_files_each_with_a_header(spark, tmp_path):
    for i in range(4):
        export(tmp_path / f"{i}.csv", i, 30)
    (tmp_path / "4.csv").write_text("post_id,data,n,title\n")
    (tmp_path / "5.csv").write_text("")
    got = load_export_csv(spark, str(tmp_path), SCHEMA, ["title", "post_id"], range_bytes=90)
    assert got.columns == ["title", "post_id"]
    assert rows(got) == rows(whole(spark, str(tmp_path)).select("title", "post_id"))


def test_a_cell_longer_than_many_ranges(spark, tmp_path):
    path = tmp_path / "e.csv"
    cell = "line\nand ""quote"" " * 500
    path.write_text(f'post_id,data,n,title\na,"{cell}",1,x\nb,,2,y\n')
    got = rows(load_export_csv(spark, str(path), SCHEMA, range_bytes=100))
    assert got == [("a", cell.replace('""', '"'), 1, "x"), ("b", None, 2, "y")]


def test_blank_lines_no_last_line_break_and_a_mark(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_bytes('\n\npost_id,data,n,title\n\na,"x\n\ny",1,t\n\n\nb,,2,"last\n"'.encode())
    want = [("a", "x\n\ny", 1, "t"), ("b", None, 2, "last\n")]
    for size in (5, 20, 1000):
        assert rows(load_export_csv(spark, str(path), SCHEMA, range_bytes=size)) == want
    path.write_bytes("﻿k,v\n1,2\n".encode())
    assert rows(C.read_csv(spark, str(path), "k string, v string", header=False)) == [("1", "2"), ("k", "v")]


def test_bad_rows_fail(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("post_id,data,n,title\na,b,notanumber,t\n")
    with pytest.raises(Exception, match="MALFORMED|notanumber"):
        load_export_csv(spark, str(path), SCHEMA).collect()


def test_pieces_are_read_from_crossing_ranges_only(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("post_id,data,n,title\n" + "".join(f"p{i},x,{i},y\n" for i in range(500)))
    lines = C._lines(spark, str(path), 100)
    assert not any(any(e) for starts in C.range_parities(lines).values() for e in starts.values())
    assert load_export_csv(spark, str(path), SCHEMA, range_bytes=100).count() == 500
