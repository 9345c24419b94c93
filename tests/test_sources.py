import datetime

import time

import pytest
from pyspark.sql import functions as F

from weekloom.shared import materialise, shared_folder
from weekloom.sinks import export_cleaned, export_features, export_version
from weekloom.sources import load_data, read_folder, read_latest
from weekloom.sources import versions
from weekloom.sources.versions import list_versions, next_version, reserve_version
from weekloom.streaming import ingest_new_files

SCHEMA = "day date, city string, sales decimal(18,4)"


def frame(spark, n=3):
    return spark.range(n).select(F.col("id").alias("a"), F.concat(F.lit("x"), "id").alias("b"))


def test_csv_infers_types_and_passes_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n;d\n1;2024-01-05\n2;2024-01-06\n")
    df = load_data(spark, str(tmp_path / "a.csv"), sep=";")
    assert dict(df.dtypes) == {"n": "int", "d": "date"}
    assert df.count() == 2


def test_csv_with_schema_is_not_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,d\n1,x\n")
    assert load_data(spark, str(tmp_path / "a.csv"), schema="n string, d string").dtypes[0] == ("n", "string")


def test_missing_path_and_unknown_type(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_data(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="json"):
        load_data(spark, str(tmp_path), "json")


def test_folder_is_read_whatever_its_nesting(spark, tmp_path):
    for day in ("2024/01/05", "2024/02/06"):
        folder = tmp_path / day
        folder.mkdir(parents=True)
        (folder / "sales.csv").write_text(f"day,city,sales\n{day.replace('/', '-')},a,1.5\n")
    rows = read_folder(spark, str(tmp_path), schema=SCHEMA).orderBy("day").collect()
    assert [r.day for r in rows] == [datetime.date(2024, 1, 5), datetime.date(2024, 2, 6)]


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    arriving = tmp_path / "in"
    arriving.mkdir()

    def arrive(name):
        (arriving / name).write_text(f"day,city,sales\n2024-01-05,{name},1\n")

    def ingest():
        return ingest_new_files(
            spark, str(arriving), str(tmp_path / "out"), str(tmp_path / "state"), SCHEMA
        )

    arrive("a.csv")
    assert ingest().count() == 1
    arrive("b.csv")
    assert sorted(r.city for r in ingest().collect()) == ["a.csv", "b.csv"]
    assert ingest().count() == 2


def test_versions_compare_as_numbers_and_names_exactly(spark, tmp_path):
    folder = str(tmp_path)
    for name in ("x_v1", "x_v2", "x_v10", "x_features_v99"):
        frame(spark, int(name.rpartition("v")[2])).write.parquet(f"{folder}/{name}.parquet")
    assert [v.number for v in list_versions(spark, folder, "x")] == [1, 2, 10]
    assert read_latest(spark, folder, "x").count() == 10
    assert next_version(spark, folder, "x") == 11
    with pytest.raises(FileNotFoundError):
        read_latest(spark, folder, "y")
    assert next_version(spark, f"{folder}/absent", "x") == 1


def test_a_gap_is_not_filled_again(spark, tmp_path):
    folder = str(tmp_path)
    frame(spark).write.parquet(f"{folder}/x_v3.parquet")
    assert export_version(frame(spark), folder, "x").endswith("x_v4.parquet")


def test_unfinished_version_is_skipped_but_keeps_its_number(spark, tmp_path):
    folder = str(tmp_path)
    export_version(frame(spark, 1), folder, "x")
    (tmp_path / "x_v2.parquet" / "_temporary").mkdir(parents=True)
    with pytest.warns(UserWarning, match="x_v2.parquet is being written"):
        assert read_latest(spark, folder, "x").count() == 1
    assert next_version(spark, folder, "x") == 3
    # Nothing says that its writer is alive once it has taken too long.
    with pytest.raises(RuntimeError, match="x_v2"):
        read_latest(spark, folder, "x", patience=0)


def test_version_without_marker_is_an_error_and_no_older_one(spark, tmp_path):
    folder = str(tmp_path)
    export_version(frame(spark, 1), folder, "x")
    (tmp_path / "x_v2.parquet").mkdir()
    with pytest.raises(RuntimeError, match="_SUCCESS"):
        read_latest(spark, folder, "x")


def test_number_is_taken_whatever_the_file_type(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    export_version(frame(spark), folder, "x", "csv")
    monkeypatch.setattr("weekloom.sources.versions.next_version", lambda *_: 1)
    assert export_version(frame(spark), folder, "x", "parquet").endswith("x_v2.parquet")
    monkeypatch.setattr("weekloom.sources.versions.ATTEMPTS", 2)
    with pytest.raises(FileExistsError, match="taken 2 numbers"):
        export_version(frame(spark), folder, "x", "parquet")


def test_two_writers_never_win_one_number(spark, tmp_path, monkeypatch):
    """The other writer's claim appears between any two steps of this one, on a store without exclusive create."""
    folder, write = str(tmp_path), versions._Folder.write
    other = {"owner": "other", "started": time.time(), "state": "writing"}

    def beaten_before(self, name, content):
        if "_v1." in name and "other" not in name:
            write(self, ".x_v1.claim-other", other)
        write(self, name, content)

    monkeypatch.setattr(versions._Folder, "write", beaten_before)
    assert reserve_version(spark, folder, "x").number == 2
    monkeypatch.setattr(versions._Folder, "write", write)
    # Both claims were written before either writer looked: both withdraw.
    claims = versions.list_claims
    seen = []

    def with_rival(*args):
        if not seen:
            seen.append(write(versions._Folder(spark, folder), ".x_v3.claim-rival", other))
        return claims(*args)

    monkeypatch.setattr(versions, "list_claims", with_rival)
    assert reserve_version(spark, folder, "x").number == 4
    assert not [c for c in claims(spark, folder, "x") if c.number == 3 and "rival" not in c.path]


def test_killed_writer_is_noticed(spark, tmp_path):
    folder = str(tmp_path)
    export_version(frame(spark, 1), folder, "x")
    assert [(c.number, c.state) for c in versions.list_claims(spark, folder, "x")] == [(1, "published")]
    claim = reserve_version(spark, folder, "x")  # and then nothing
    with pytest.warns(UserWarning, match="is being written by"):
        assert read_latest(spark, folder, "x").count() == 1
    with pytest.raises(RuntimeError, match="seconds ago"):
        read_latest(spark, folder, "x", patience=0)
    (tmp_path / "x_v2.parquet" / "_temporary").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="x_v2.parquet, begun by"):
        read_latest(spark, folder, "x", patience=0)
    versions.settle(spark, claim, "failed")
    with pytest.raises(RuntimeError, match="_SUCCESS"):
        read_latest(spark, folder, "x")
    export_version(frame(spark, 2), folder, "x")
    assert read_latest(spark, folder, "x").count() == 2


def test_failed_write_says_so(spark, tmp_path):
    folder = str(tmp_path)
    broken = frame(spark).selectExpr("raise_error('no') AS n")
    with pytest.raises(Exception, match="no"):
        export_version(broken, folder, "x")
    assert [(c.number, c.state) for c in versions.list_claims(spark, folder, "x")] == [(1, "failed")]
    assert export_version(frame(spark), folder, "x").endswith("x_v2.parquet")


def test_single_csv_file_is_a_version(spark, tmp_path):
    (tmp_path / "main_data_v7.csv").write_text("n\n1\n")
    assert read_latest(spark, str(tmp_path), "main_data").collect()[0].n == 1


def test_exports(spark, tmp_path):
    folder = str(tmp_path)
    weekly = spark.sql("SELECT 'a' AS k, DATE '2024-01-01' AS `Week Start`, 1.0D AS s")
    written = export_cleaned(folder, frame(spark), weekly, weekly, file_type="csv")
    assert sorted(written) == ["category_sales_weekly", "city_sales_weekly", "main_data"]
    assert read_latest(spark, folder, "city_sales_weekly").collect()[0].k == "a"
    assert list(export_features(folder, category=weekly)) == ["category_sales_weekly_features"]
    with pytest.raises(ValueError):
        export_version(weekly, folder, "x", "orc")


def test_export_refuses_to_overwrite(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    export_version(frame(spark), folder, "x")
    monkeypatch.setattr("weekloom.sinks.export.reserve_version", lambda *_: versions.list_claims(spark, folder, "x")[0])
    with pytest.raises(Exception, match="already exists"):
        export_version(frame(spark), folder, "x")


def test_intermediate_tables_go_to_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "t").startswith(base)
    kept = materialise(frame(spark), "t")
    assert kept.count() == 3
    assert all(base in path for path in kept.inputFiles())
