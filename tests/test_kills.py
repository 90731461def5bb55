"""The process is ended before and after each rename of two units, and resumed: no row is lost or stands twice."""

from __future__ import annotations

import gc
import os

import pytest
from pyspark.sql import functions as F

from siltstone.plans import units

#: Each unit renames its marker, then its folder.
RENAMES = 4


def both_units(spark, root):
    """Rows of two archives, identified by archive and ordinal, as units; and which were made now."""
    made = []
    for name, start in (("a", 0), ("b", 1000)):
        rows, now = units.run_unit(spark, root, "rows", name, lambda name=name, start=start: spark.range(start, start + 1000, 1, 3).select(F.lit(name).alias("archive"), F.col("id").alias("ordinal")))
        made.append((rows, now))
    return made


def ended_at(monkeypatch, point: int, after: bool) -> None:
    """From now on the process ends at the ``point``-th rename, before or after it is done."""
    calls = [0]

    def ending(rename):
        def renamed(*paths):
            calls[0] += 1
            if calls[0] == point and not after:
                os._exit(9)
            rename(*paths)
            if calls[0] == point:
                os._exit(9)

        return renamed

    monkeypatch.setattr(os, "rename", ending(os.rename))
    monkeypatch.setattr(os, "replace", ending(os.replace))


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("point", range(1, RENAMES + 1))
def test_an_ended_process_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, point, after):
    root = str(tmp_path)
    child = os.fork()
    if child == 0:
        # the child has the parent's session for itself until it ends; it must not free the parent's objects
        gc.disable()
        try:
            ended_at(monkeypatch, point, after)
            both_units(spark, root)
        finally:
            os._exit(1)
    assert os.waitstatus_to_exitcode(os.waitpid(child, 0)[1]) == 9
    before = {n for n in ("a", "b") if units.complete(os.path.join(root, "rows", n))}
    assert before == {1: set(), 2: {"a"} if after else set(), 3: {"a"}, 4: {"a", "b"} if after else {"a"}}[point]
    made = both_units(spark, root)
    assert [now for _, now in made] == [n not in before for n in ("a", "b")]
    rows = made[0][0].unionByName(made[1][0])
    assert sorted((r["archive"], r["ordinal"]) for r in rows.collect()) == [("a", k) for k in range(1000)] + [("b", k) for k in range(1000, 2000)]
    assert sorted(os.listdir(os.path.join(root, "rows"))) == ["a", "b"]
    again = both_units(spark, root)
    assert not any(now for _, now in again)
    assert units.unit_record(root, "rows", "b")["rows"] == 1000
