"""Tables replaced by a switch: failures, readers of old versions, replays."""

import os
import tempfile

import pytest

from tests.test_sources import _row, _write
from tillroll.plans import materialize as M
from tillroll.plans.versions import Store
from tillroll.sources.sinks import write_raw_table


def _folder():
    return tempfile.mkdtemp(prefix="tillroll-test-")


def test_a_load_that_fails_half_way_leaves_the_old_tables(spark, monkeypatch):
    store, d = _folder(), _folder()
    _write(d, "sales_2026_06_22.csv", [_row("A"), _row("B")])
    M.load_drop(spark, d, store)
    _write(d, "sales_2026_06_23.csv", [_row("C", day="2026-06-23")])
    monkeypatch.setattr(M, "targets_dim", lambda raw, target: 1 / 0)       # sales and firsts are written by then
    with pytest.raises(ZeroDivisionError):
        M.load_drop(spark, d, store)
    old = M.open_drop(spark, store)
    assert (old.raw.count(), old.clean.count(), old.targets.count()) == (2, 2, 1)
    monkeypatch.undo()
    assert M.load_drop(spark, d, store).raw.count() == 3


def test_a_replayed_commit_changes_nothing(spark):
    store, d = _folder(), _folder()
    _write(d, "sales_2026_06_22.csv", [_row("A")])
    first = M.load_drop(spark, d, store, commit="monday")
    again = M.load_drop(spark, d, store, commit="monday")
    assert again.store == first.store and Store(spark, store).numbers() == [1]
    assert M.load_drop(spark, d, store, commit="tuesday").store != first.store


def test_readers_hold_their_version_and_clean_keeps_it(spark):
    folder = _folder()
    store = Store(spark, folder)
    assert store.version() == {"number": 0, "commit": None, "tables": {}} and store.numbers() == []
    store.replace("t", spark.range(3))
    held = store.read("t")
    store.replace("t", spark.range(5))
    assert (held.count(), store.read("t").count(), store.read("t", 1).count()) == (3, 5, 3)
    store.replace("t", spark.range(7))
    open(os.path.join(folder, "_versions", ".half-written"), "w").write("{")       # a crashed commit is not seen
    store.clean(keep=2)
    assert store.numbers() == [2, 3] and len(os.listdir(os.path.join(folder, "t"))) == 2
    assert (store.read("t", 2).count(), store.read("t").count()) == (5, 7)


def test_two_writers_cannot_commit_the_same_number(spark):
    store = Store(spark, _folder())
    store.commit({"t": "a"})
    other = Store(spark, store.folder)
    stale = other.version()
    store.commit({"t": "b"})
    other.version = lambda number=None: stale
    with pytest.raises(Exception, match="[Ee]xist"):
        other.commit({"t": "c"})
    assert store.version()["tables"] == {"t": "b"}


def test_the_raw_table_is_replaced_by_a_switch(spark):
    from tests.fixtures import make_raw
    path = _folder()
    first = write_raw_table(make_raw(spark, [dict(order_id="A")]), path)
    second = write_raw_table(make_raw(spark, [dict(order_id="B"), dict(order_id="C")]), path)
    assert spark.read.parquet(first).count() == 1 and spark.read.parquet(second).count() == 2
    assert Store(spark, path).read("sales").count() == 2
