import pytest
from pyspark.sql import functions as F

from spheremeans.operators.filters import decimal_shaped, nonzero
from spheremeans.plans import cleaning
from spheremeans.sources import lines


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_first_line_skipped_in_every_file(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.txt").write_text(f"head {i}\nrow {i}\n")
    got = sorted(rows(lines.read_lines(spark, str(folder), skip_first=True)))
    assert got == [("row 0",), ("row 1",), ("row 2",)]
    assert lines.read_lines(spark, str(folder)).count() == 6


@pytest.mark.parametrize("skip", [False, True])
def test_last_line_without_newline_and_blank_lines(spark, tmp_path, skip):
    path = write(tmp_path, "a.txt", 'head\nx "q" \\ , y\n\n lead\nlast')
    got = rows(lines.read_lines(spark, path, skip))
    want = [('x "q" \\ , y',), (" lead",), ("last",)]
    assert got == (want if skip else [("head",), *want])


def test_uri_path(spark, tmp_path):
    path = write(tmp_path, "p.csv", "latitude|longitude\n1.5|2.5\n")
    assert rows(lines.read_pipe_points(spark, "file://" + path)) == [(1.5, 2.5)]


def test_pipe_points(spark, tmp_path):
    text = 'latitute|longitude\n1.5|2.5\n3|4|extra\nbad|6\n7\n"8"|9\r\n10|11\r\n'
    got = rows(lines.read_pipe_points(spark, write(tmp_path, "p.csv", text)))
    assert got[:4] == [(1.5, 2.5), (3.0, 4.0), (None, 6.0), (7.0, None)]
    assert got[4][0] is None and got[5][0] == 10.0


def test_space_lines(spark, tmp_path):
    text = "skipped x y\n34.5  -1.25   http://a\n 34.5 -1 u\n1 2\n1 2 3 4\n5 6 \n"
    got = rows(cleaning.clean_place_lines(spark, write(tmp_path, "s.txt", text)))
    assert got == [(34.5, -1.25), (5.0, 6.0)]


def test_zero_places_stay_unless_asked(spark, tmp_path):
    path = write(tmp_path, "s.txt", "h h h\n0 5 a\n0.5 5 b\n2 5 c\n")
    assert [r[0] for r in rows(cleaning.clean_place_lines(spark, path))] == [0.0, 0.5, 2.0]
    kept = cleaning.clean_place_lines(spark, path, zero_filter="truncate")
    assert [r[0] for r in rows(kept)] == [2.0]


def test_device_lines(spark, tmp_path):
    middle = "a,b|c/d,e|f/g,h|i"
    text = (
        f"2014-03-15:10:10:20,Maker M1,id-1,{middle},33.6,-117.5\n"
        f"2014-03-15:10:10:21|Solo|id-2|{middle}|33.7|-117.6|more|fields\n"
        f"2014-03-15:10:10:22/Other M2 X/id-3/{middle}/0/0\n"
        "too,short\n"
    )
    got = rows(cleaning.device_records(spark, write(tmp_path, "d.txt", text)))
    assert got == [
        ("2014-03-15:10:10:20", "id-1", 33.6, -117.5, "Maker", "M1"),
        ("2014-03-15:10:10:21", "id-2", 33.7, -117.6, "Solo", None),
    ]


def test_tab_lines(spark, tmp_path):
    text = "lat\tlon\tid\n1.5\t2.5\t1\n0\t3\t2\n\t4\t3\n0.25\t5\t4\n6.5\n"
    path = write(tmp_path, "t.txt", text)
    assert rows(cleaning.clean_tab_lines(spark, path)) == [(1.5, 2.5), (0.25, 5.0), (6.5, None)]
    assert rows(cleaning.clean_tab_lines(spark, path, zero_filter="truncate")) == [
        (1.5, 2.5),
        (6.5, None),
    ]


def test_comma_lines(spark, tmp_path):
    text = 'lat,lon,x\n33.5,-84.25,"a, b"\n40,-80.5\n12.5abc,1.5\n-1.25,\n-1.25,2.5\n7.5\n'
    got = rows(cleaning.clean_comma_lines(spark, write(tmp_path, "c.txt", text)))
    assert got == [(33.5, -84.25), (-1.25, 2.5)]


ZERO = {
    "33.6": (True, True), "1.0": (True, True), "-1": (True, True),
    "0.5": (True, False), "-0.9": (True, False), "0.9999": (True, False),
    "0": (False, False), "0.0": (False, False), "-0": (False, False),
    "bad": (None, None), "": (None, None),
}


def test_zero_filter_modes(spark):
    df = spark.createDataFrame([(t,) for t in ZERO], "t string")
    got = df.select("t", nonzero("t"), nonzero("t", "truncate")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == ZERO
    with pytest.raises(ValueError, match="unknown mode"):
        nonzero(F.col("t"), "other")


def test_decimal_shape(spark):
    want = {"1.5": True, "-1.5": True, "40": False, ".5": False, "12.5abc": False,
            "x1.5": False, "1.": False, "": False, "1.5e2": True}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert {r[0]: r[1] for r in df.select("t", decimal_shaped("t")).collect()} == want
