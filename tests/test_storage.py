"""Tables in the shared folder: what goes, and when."""

from __future__ import annotations

import os
import time

from gleaner.plans.storage import delete, materialize, recorded, scratch, written_after


def _there(df):
    return all(os.path.exists(f.removeprefix("file://")) for f in df.inputFiles())


def test_scratch_keeps_what_is_named(spark):
    with recorded() as written:
        with scratch(spark) as keep:
            first = materialize(spark.range(5), "first")
            with scratch(spark) as inner:
                second = materialize(first.where("id > 1"), "second")
                third = materialize(second.where("id > 2"), "third")
                inner.append(third)
            assert _there(first) and not _there(second) and _there(third)
            keep.append(third)
        assert not _there(first) and third.count() == 2
    assert len(written) == 3
    delete(spark, written)
    assert not _there(third)
    delete(spark, written)


def test_tables_stay_after_an_error(spark):
    made = []
    try:
        with scratch(spark):
            made.append(materialize(spark.range(3), "made"))
            raise ValueError
    except ValueError:
        pass
    assert made[0].count() == 3


def test_written_after(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "old"))
    time.sleep(1.1)
    with recorded() as written:
        table = materialize(spark.range(3), "table")
    table.write.parquet(str(tmp_path / "new"))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    assert written_after(new, written) and not written_after(old, written)
    assert not written_after(table, written) and not written_after(new.union(old), written) and not written_after(spark.range(3), written)
