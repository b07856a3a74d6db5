import pytest

from riskloom.sources import registry


def _write(tmp_path, header, rows):
    (tmp_path / "bureau_balance.csv").write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]))


def test_columns_by_header_and_markers(spark, tmp_path):
    _write(tmp_path, ["STATUS", "MONTHS_BALANCE", "EXTRA", "SK_ID_BUREAU"],
           [["C", "-2.0", "x", "5001"], ["NA", "NaN", "y", "5002"], ["", "-3", "", "nan"]])
    df = registry.load_raw_table(spark, str(tmp_path), "bureau_balance")
    assert df.columns == ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"]
    assert [tuple(r) for r in df.collect()] == [(5001, -2, "C"), (5002, None, None), (None, -3, None)]
    assert registry.load_raw_table(spark, f"file://{tmp_path}", "bureau_balance").count() == 3


def test_bad_values_and_missing_columns_raise(spark, tmp_path):
    _write(tmp_path, ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"], [["1", "x", "C"], ["2", "1.5", "0"], ["3", "1", "0"]])
    with pytest.raises(ValueError, match="'MONTHS_BALANCE': 2"):
        registry.load_raw_table(spark, str(tmp_path), "bureau_balance")
    _write(tmp_path, ["SK_ID_BUREAU", "STATUS"], [["1", "C"]])
    with pytest.raises(ValueError, match="MONTHS_BALANCE"):
        registry.load_raw_table(spark, str(tmp_path), "bureau_balance")
    with pytest.raises(FileNotFoundError):
        registry.load_raw_table(spark, str(tmp_path), "bureau")


def test_nan_days_do_not_poison(spark):
    from pyspark.sql import functions as F

    from riskloom.functions.nulls import clamp_positive

    df = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (2.0,)], "d double")
    assert [r[0] for r in df.select(clamp_positive(F.col("d"))).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_quotes_line_breaks_and_encodings(spark, tmp_path):
    head, rows = "Unnamed: 0,Table,Row,Description,Special\n", '1,t,r,"say ""hi"", ok",s\n2,t,r,"two\nlines, é",\n'
    want = [(1, "t", "r", 'say "hi", ok', "s"), (2, "t", "r", "two\nlines, é", None)]
    for name in ("utf-8", "latin-1"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "bureau_balance.csv").write_bytes('SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,2,"é, ""x"""\n3,4,"a\nb"\n'.encode(name))
        got = registry.load_raw_table(spark, str(folder), "bureau_balance").collect()
        assert sorted(tuple(r) for r in got) == [(1, 2, 'é, "x"'), (3, 4, "a\nb")]
        assert set(registry.text_format(spark, str(folder))) == {"multiLine", *(["encoding"] if name == "latin-1" else [])}
    (tmp_path / registry.RAW_TABLES["columns_description"].file_name).write_bytes((head + rows).encode("latin-1"))
    assert sorted(tuple(r) for r in registry.load_raw_table(spark, str(tmp_path), "columns_description").collect()) == want


def test_plain_files_stay_splittable(spark, tmp_path):
    _write(tmp_path, ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"], [["1", "2", '"quoted, text"'], ["2", "3", "é"]])
    assert registry.text_format(spark, str(tmp_path)) == {}
    assert sorted(tuple(r) for r in registry.load_raw_table(spark, str(tmp_path), "bureau_balance").collect()) == [
        (1, 2, "quoted, text"), (2, 3, "é")]
