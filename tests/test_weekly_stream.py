"""Weekly tables kept up to date as files arrive."""

import pytest
from pyspark.sql import functions as F

from weekloom.operators.aggregate import forecast_tables
from weekloom.operators.schema import coerce_types
from weekloom.sources import load_data
from weekloom.streaming import weekly

SCHEMA = "`Invoice Date` string, City string, `Product Category` string, `Total Sales` string, extra int"


def _drop(folder, day, rows):
    lines = ["Invoice Date,City,Product Category,Total Sales,extra"] + [f"01/{day:02d}/2024,{c},{k},{s},1" for c, k, s in rows]
    (folder / f"{day:02d}.csv").write_text("\n".join(lines) + "\n")


def _tables(made):
    return [sorted(map(str, t.collect())) for t in (made.city_weekly, made.category_weekly, made.city_summary, made.category_summary)]


def _once(spark, folder, grain="week"):
    return _tables(forecast_tables(coerce_types(load_data(spark, str(folder), "csv", SCHEMA)), grain=grain))


@pytest.mark.parametrize("grain", ["week", "month"])
def test_three_drops_a_replay_and_folds_equal_the_whole(spark, tmp_path, grain):
    files, cells, state = tmp_path / "in", str(tmp_path / "cells"), str(tmp_path / "state")
    files.mkdir()
    update = lambda: weekly.update_cells(spark, str(files), cells, state, SCHEMA, grain=grain)
    stored = lambda: _tables(weekly.stored_tables(spark, cells, grain=grain))
    _drop(files, 1, [("a", "x", "1.25"), ("b", "x", "2"), ("a", "y", "no number")])
    assert update() == 1 and stored() == _once(spark, files, grain)
    _drop(files, 3, [("a", "x", "4.5"), ("c", "", "1")])
    _drop(files, 9, [("a", "x", "0.3333")])
    assert update() == 1 and stored() == _once(spark, files, grain)
    before = stored()
    assert update() == 0 and stored() == before
    weekly.compact(spark, cells)
    assert stored() == before
    _drop(files, 10, [("b", "x", "7"), ("b", "x", "7")])
    assert update() == 1 and stored() == _once(spark, files, grain)
    weekly.compact(spark, cells)
    weekly.compact(spark, cells)
    assert stored() == _once(spark, files, grain)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    cells = str(tmp_path / "cells")
    rows = [("01/02/2024", "a", "x", "1.5", 1), ("01/09/2024", "a", "x", "2.5", 1)]
    batch = spark.createDataFrame(rows, SCHEMA)
    for batch_id in (0, 0, 1):
        weekly.store_batch(batch, batch_id, cells)
    once = weekly.stored_cells(spark, cells)
    assert sorted((str(r["__sum"]), r["__n"]) for r in once.collect()) == [("3.0000", 2), ("5.0000", 2)]
    weekly.compact(spark, cells)
    # A batch that comes again after it was folded is left out.
    weekly.store_batch(batch, 1, cells)
    weekly.store_batch(batch.where("`Invoice Date` = '01/02/2024'"), 2, cells)
    assert sorted((str(r["__sum"]), r["__n"]) for r in weekly.stored_cells(spark, cells).collect()) == [("4.5000", 3), ("5.0000", 2)]


def test_an_unfinished_part_is_not_read(spark, tmp_path):
    cells = tmp_path / "cells"
    batch = spark.createDataFrame([("01/02/2024", "a", "x", "1.5", 1)], SCHEMA)
    weekly.store_batch(batch, 0, str(cells))
    weekly.store_batch(batch, 1, str(cells))
    (cells / "batch-1" / "_SUCCESS").unlink()
    assert weekly.stored_cells(spark, str(cells)).agg(F.sum("__n")).first()[0] == 1
    (cells / "upto-1").mkdir()
    assert weekly.stored_cells(spark, str(cells)).agg(F.sum("__n")).first()[0] == 1


def test_no_cells(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        weekly.stored_cells(spark, str(tmp_path / "none"))
