import os

import pytest

from datamove.sources import read_delimited, read_json_flat, select_files
from datamove.sources.files import FILE_TYPES, delimited_options, file_type, name_pattern


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def names(df):
    return sorted(os.path.basename(r.path) for r in df.collect())


def test_selection_by_prefix_type_and_depth(spark, tmp_path):
    for name in ("sales_1.csv", "deep/er/sales_2.csv", "sales_3.json", "other_sales.csv", "sales_4.CSV"):
        put(f"{tmp_path}/{name}", "a\n1\n")
    assert names(select_files(spark, str(tmp_path), "sales", "CSV")) == ["sales_1.csv", "sales_2.csv"]
    assert names(select_files(spark, str(tmp_path), "sales", "JS")) == ["sales_3.json"]
    assert select_files(spark, str(tmp_path), "nothing", "CSV").isEmpty()
    assert read_delimited(spark, str(tmp_path), "sales", "CSV").count() == 2


def test_prefix_is_literal(spark, tmp_path):
    put(f"{tmp_path}/a[1]_x.csv", "a\n1\n")
    put(f"{tmp_path}/a1_x.csv", "a\n1\n")
    assert len(select_files(spark, str(tmp_path), "a[1]", "CSV").collect()) == 1
    assert name_pattern("a*", "csv") == "a\\**csv"


def test_no_files_is_no_rows(spark, tmp_path):
    put(f"{tmp_path}/x.json", "{}")
    assert read_delimited(spark, str(tmp_path), "none", "CSV").isEmpty()
    assert read_json_flat(spark, str(tmp_path), "none").isEmpty()


def test_delimiters_and_headers(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "id,name\n1,x\n")
    put(f"{tmp_path}/a.tsv", "1\tx\n2\ty\n")
    put(f"{tmp_path}/a.txt", "id~~name\n1~~x\n")
    csv = read_delimited(spark, str(tmp_path), "a", "CS")
    assert csv.dtypes == [("id", "int"), ("name", "string")] and csv.count() == 1
    tsv = read_delimited(spark, str(tmp_path), "a", "TS", header=False)
    assert tsv.columns == ["_c0", "_c1"] and tsv.count() == 2
    txt = read_delimited(spark, str(tmp_path), "a", "TX", delimiter="~~")
    assert tuple(txt.first()) == (1, "x")


def test_given_delimiter_wins():
    assert delimited_options("CSV", "|", True)["sep"] == "|"
    assert delimited_options("CSV", None, True)["sep"] == ","
    assert delimited_options("TS", None, False) == {"sep": "\t", "header": "false"}


def test_file_types():
    assert [FILE_TYPES[c].name for c in ("JS", "CS", "TS", "TX")] == ["JSON", "CSV", "TSV", "TXT"]
    with pytest.raises(ValueError, match="unknown file type"):
        file_type("XML")
    with pytest.raises(ValueError, match="not delimited"):
        delimited_options("JSON", None, True)


def test_json_timestamps_stay_text_and_schema_is_used(spark, tmp_path):
    put(f"{tmp_path}/a.json", '{"at": "2020-01-01T00:00:00",\n "s": {"n": 1}}')
    df = read_json_flat(spark, str(tmp_path))
    assert df.dtypes == [("at", "string"), ("n", "bigint")]
    given = read_json_flat(spark, str(tmp_path), schema="s struct<n: int>")
    assert given.dtypes == [("n", "int")] and given.first().n == 1
