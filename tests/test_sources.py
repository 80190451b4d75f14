import pytest

from riskframe.sources import (conform, frame_from_records, read_table, scratch_path, trim_headers,
                               write_table)
from conftest import rows


def test_csv_round_trip_with_padded_headers_and_markers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(" a ,b\n1,?\n2,x\n-9,y\n")
    df = trim_headers(read_table(spark, str(path), null_values=["?"]))
    assert df.columns == ["a", "b"] and rows(df) == [(1, None), (2, "x"), (-9, "y")]
    typed = read_table(spark, str(path), schema="a int, b string", null_values=["?", "-9"])
    assert rows(typed) == [(1, None), (2, "x"), (None, "y")]


def test_write_refuses_its_own_input(spark, tmp_path):
    path = write_table(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="choose another path"):
        write_table(spark.read.parquet(path), path)
    assert write_table(spark.read.parquet(path), path + "-new", "csv")
    assert read_table(spark, path + "-new").count() == 3


def test_records_and_conform(spark):
    df = frame_from_records(spark, [{"a": 1}, {"b": "x"}], "a int, b string")
    assert rows(df) == [(1, None), (None, "x")]
    assert rows(conform(df, "b string, c double, a long")) == [(None, None, 1), ("x", None, None)]


def test_scratch_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and (not base or first.startswith(base))
