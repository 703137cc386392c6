import pathlib

import __spark_entry__ as driver


def test_entry_returns_rows(spark):
    df = driver.entry(spark)
    assert df.columns == ["hour", "jour_ferie", "n", "mean_value"] and df.count() > 0


def test_sql_belongs_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 150


def test_no_local_checkpoints_or_products():
    root = pathlib.Path(driver.__file__).parent / "meterwise"
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    for banned in ("local" + "Checkpoint", "cross" + "Join(", ".rdd"):
        assert banned not in text


def test_checkpoint_folder_comes_from_the_session(spark):
    from meterwise.session import ensure_checkpoint_dir

    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") in ensure_checkpoint_dir(spark)
