import csv
import io
import random

import pytest

from veilspark.sources.records import block_starts, csv_records, lines_of
from veilspark.sources.tables import (
    InputError, has_quoted_newlines, load_csv, read_table, validate_input, write_masked,
)


@pytest.fixture
def csv_file(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_text(content)
        return str(path)

    return write


def test_csv_rules(spark, csv_file):
    path = csv_file(
        "a.csv",
        'a,b,c,d,e,f\n'
        ' x ,1,True,2020-01-01,,True\n'
        '"q ""in"" line\nnext",2.5e3,False,NA,null,\n'
        'short,inf\n'
        '"",-.5,TRUE,x,None,False\n',
    )
    assert has_quoted_newlines(spark, path)
    df, key, text = load_csv(spark, path)
    rows = df.orderBy("row_id").collect()
    assert key == "row_id" and [r.row_id for r in rows] == [0, 1, 2, 3]
    assert [r.a for r in rows] == [" x ", 'q "in" line\nnext', "short", None]
    assert [r.d for r in rows] == ["2020-01-01", None, None, "x"]
    assert [r.e for r in rows] == [None] * 4
    # numbers are not text, an all-missing column neither; booleans with gaps are
    assert text == ["a", "c", "d", "f"]
    info = validate_input(spark, path)
    assert (info.n_rows, info.n_columns) == (4, 6)


def test_digit_only_column_is_not_text(spark, csv_file):
    path = csv_file("d.csv", "ssn,day,flag\n123456789,2024-01-01,true\n987654321,2024-01-02,False\n")
    assert load_csv(spark, path)[2] == ["day"]
    assert not has_quoted_newlines(spark, path)


def test_own_key(spark, csv_file):
    path = csv_file("k.csv", "id,t\n7,John Doe\n9,NA\n")
    df, key, text = load_csv(spark, path, key="id")
    assert key == "id" and text == ["t"] and {r.id for r in df.collect()} == {"7", "9"}


def test_bad_input(spark, csv_file, tmp_path):
    ragged = csv_file("r.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(InputError, match="more fields"):
        validate_input(spark, ragged)
    with pytest.raises(Exception, match="more fields"):
        read_table(spark, ragged).collect()
    with pytest.raises(InputError, match="not found"):
        validate_input(spark, str(tmp_path / "nope.csv"))
    with pytest.raises(InputError, match="empty"):
        validate_input(spark, csv_file("h.csv", "a,b\n"))
    with pytest.raises(InputError, match="empty"):
        validate_input(spark, csv_file("e.csv", ""))
    with pytest.raises(InputError, match="too large"):
        validate_input(spark, csv_file("big.csv", "a\n1\n"), max_mb=1e-9)
    with pytest.raises(InputError, match="Only CSV"):
        validate_input(spark, csv_file("x.txt", "a\n1\n"), csv_only=True)


def test_row_ids_follow_the_file_over_many_splits(spark, csv_file):
    path = csv_file("many.csv", "a,b\n" + "".join(f"v{i},{i}\n" for i in range(60000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df, _, _ = load_csv(spark, path)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 60000
        assert df.filter("row_id != cast(b as long)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_written_csv_keeps_cells(spark, tmp_path):
    rows = [(1, " spaced ", 'q "x", y\nz', None), (2, "", "a", "b")]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string")
    path = str(tmp_path / "out.csv")
    write_masked(df, path)
    back, _, _ = load_csv(spark, path, key="id")
    got = {r.id: (r.a, r.b, r.c) for r in back.collect()}
    assert got == {"1": (" spaced ", 'q "x", y\nz', None), "2": (None, "a", "b")}


def test_other_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "id long, t string")
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / f"t.{fmt}")
        write_masked(df, path, fmt)
        assert read_table(spark, path).select("id", "t").collect() == [(1, "x")]


def random_table(seed, n):
    """Rows whose cells hold quotes, commas, line breaks of both kinds, blanks and long runs."""
    rng = random.Random(seed)
    parts = ["a", "é", ",", '"', "\n", "\r\n", " ", "東", "word", '""', "\n\n", "x" * 40]
    rows = [
        [str(i), *["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 8, 30]))) for _ in range(2)]]
        for i in range(n)
    ]
    rows[n // 2][1] = "begin\n" + "line, with \"quotes\"\n" * 300 + "end"  # longer than many blocks
    return rows


@pytest.mark.parametrize("size", [64, 700, 100_000])
def test_quoted_breaks_across_block_borders(spark, csv_file, size):
    rows = random_table(size, 400)
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows([["id", "a", "b"], *rows])
    path = csv_file("breaks.csv", "")
    with open(path, "w", newline="") as f:
        f.write(out.getvalue())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        assert block_starts(lines_of(spark, path)).count() > (1 if size < 10_000 else 0)
        found = csv_records(spark, path).orderBy("file", "block", "place").collect()
        parsed = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in found]
        assert parsed == rows
        df, key, _ = load_csv(spark, path)
        got = {r[key]: (r.id, r.a, r.b) for r in df.collect()}
        want = {i: (r[0], *[c if c != "" else None for c in r[1:]]) for i, r in enumerate(rows)}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        same = [k for k in want if tuple((x or "").replace("\r\n", "\n") for x in got[k]) == tuple((x or "").replace("\r\n", "\n") for x in want[k])]
        assert len(same) == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_several_files_keep_their_headers_out(spark, tmp_path):
    home = tmp_path / "many.csv"
    home.mkdir()
    (home / "1.csv").write_text('a,b\n1,"x\ny"\n\n2,z\n')
    (home / "2.csv").write_text('a,b\r\n3,"p\nq"\r\n4,r\r\n')
    df, key, _ = load_csv(spark, str(home))
    assert [(r[key], r.a, r.b) for r in df.orderBy(key).collect()] == [(0, "1", "x\ny"), (1, "2", "z"), (2, "3", "p\nq"), (3, "4", "r")]


def test_a_column_called_like_the_key(spark, csv_file):
    path = csv_file("own.csv", 'row_id,file,block,place,t\n5,f,b,p,"x\ny"\n6,f,b,p,John Doe\n')
    df, key, text = load_csv(spark, path)
    assert key == "_row_id" and text == ["file", "block", "place", "t"]
    assert [tuple(r) for r in df.orderBy(key).collect()] == [(0, "5", "f", "b", "p", "x\ny"), (1, "6", "f", "b", "p", "John Doe")]
    plain = csv_file("plain.csv", "row_id,t\n5,x\n")
    assert load_csv(spark, plain)[1] == "_row_id"


def test_mistyped_key_is_an_error(spark, csv_file):
    with pytest.raises(InputError, match="unknown key"):
        load_csv(spark, csv_file("m.csv", "id,t\n1,x\n"), key="idd")
