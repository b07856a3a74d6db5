from riskloom.session import ensure_checkpoint_dir, input_fingerprint, stage_table


def test_stage_reuse_and_fingerprint(spark, tmp_path):
    import uuid

    name = f"t_stage_{uuid.uuid4().hex[:8]}"
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumnRenamed("id", "x")

    a = stage_table(spark, name, "fp1", build)
    b = stage_table(spark, name, "fp1", build)
    assert a.count() == b.count() == 5 and len(calls) == 1      # reused
    stage_table(spark, name, "fp2", build)
    assert len(calls) == 2                                        # new inputs -> rebuilt


def test_input_fingerprint_covers_files_in_folders(spark, tmp_path):
    folder = tmp_path / "x.parquet"
    folder.mkdir()
    (folder / "a").write_bytes(b"1")
    (folder / "b").write_bytes(b"1")
    one = input_fingerprint(spark, [str(folder)])
    assert input_fingerprint(spark, [str(folder)]) == one
    (folder / "b").write_bytes(b"22")
    assert input_fingerprint(spark, [f"file://{folder}"]) != one
    assert input_fingerprint(spark, [str(folder)]) != one


def test_checkpoint_dir_given_to_the_builder_or_in_the_warehouse(spark):
    root = ensure_checkpoint_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir", None) in (None, root, root + "/")
