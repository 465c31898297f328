"""Day tables: a publish shows as a whole or not at all."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from paytrail.sources.snapshots import DayTable, NoSnapshot

ONE, TWO = dt.date(2024, 3, 5), dt.date(2024, 3, 6)


@pytest.fixture
def table(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "table"))


@pytest.fixture
def rows(spark):
    return lambda *pairs: spark.createDataFrame(pairs or [], "transaction_date date, n long")


def held(df):
    return sorted((r.transaction_date, r.n) for r in df.collect())


def test_staged_files_are_not_read(table, rows):
    with pytest.raises(NoSnapshot):
        table.read()
    table.publish(rows((ONE, 1), (TWO, 2)))
    staged = table.stage(rows((ONE, 10), (ONE, 11)), ONE)
    assert held(table.read()) == [(ONE, 1), (TWO, 2)] and table.sequence() == 1
    table.commit(staged)
    assert held(table.read()) == [(ONE, 10), (ONE, 11), (TWO, 2)]


def test_a_commit_file_cut_off_is_no_commit(table, rows):
    table.publish(rows((ONE, 1)))
    staged = table.stage(rows((ONE, 2)), ONE)
    unfinished = f"{table.root}/commits/000000000002-x/_temporary/0/part-0.json"
    os.makedirs(os.path.dirname(unfinished))
    open(unfinished, "w").write('{"sequence":2,"day":"2024-03-05","version":"%s","row' % staged.version)
    assert held(table.read()) == [(ONE, 1)] and table.sequence() == 1


def test_several_days_become_current_at_once_and_old_commits_stay_readable(table, rows):
    table.publish(rows((ONE, 1), (TWO, 2)))
    table.publish(rows((ONE, 3), (TWO, 4)))
    table.publish(rows(), TWO)
    assert held(table.read()) == [(ONE, 3)]
    assert held(table.read(as_of=2)) == [(ONE, 3), (TWO, 4)]
    assert held(table.read(as_of=1)) == [(ONE, 1), (TWO, 2)]
    assert table.has(TWO) and not table.has(dt.date(2024, 3, 7))
    assert table.read([TWO]).columns == ["n", "transaction_date"] and table.read([TWO]).isEmpty()


def test_only_the_chosen_days_are_listed(table, rows):
    table.publish(rows((ONE, 1), (TWO, 2)))
    assert all("2024-03-06" in f for f in table.read([TWO]).inputFiles())
    pruned = table.read().where(F.col("transaction_date") == F.lit(TWO))
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().toString() and held(pruned) == [(TWO, 2)]


def test_of_two_publishers_the_later_commit_has_the_whole_day(table, rows):
    first, second = table.stage(rows((ONE, 1), (ONE, 2)), ONE), table.stage(rows((ONE, 7)), ONE)
    table.commit(second)
    table.commit(first)
    assert held(table.read()) == [(ONE, 1), (ONE, 2)]


def test_new_columns_are_null_in_older_days(table, rows):
    table.publish(rows((ONE, 1)))
    table.publish(rows((TWO, 2)).withColumn("more", F.lit("x")))
    assert sorted((r.n, r.more) for r in table.read().collect()) == [(1, None), (2, "x")]


def test_rows_without_a_day_are_refused(table, rows):
    with pytest.raises(ValueError, match="transaction_date"):
        table.publish(rows((ONE, 1), (None, 2)))
    with pytest.raises(NoSnapshot):
        table.read()


def test_vacuum_keeps_what_is_needed(table, rows):
    for n in range(4):
        table.publish(rows((ONE, n)), ONE)
    table.publish(rows((TWO, 9)))
    waiting = table.stage(rows((TWO, 10)), TWO)
    assert table.vacuum(keep=2) == 3 and table.vacuum(keep=2) == 0
    assert held(table.read()) == [(ONE, 3), (TWO, 9)] and held(table.read(as_of=4)) == [(ONE, 3)]
    table.commit(waiting)
    assert held(table.read()) == [(ONE, 3), (TWO, 10)] and table.sequence() == 6
    assert table.vacuum(keep=1) == 1 and held(table.read()) == [(ONE, 3), (TWO, 10)]
