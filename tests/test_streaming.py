"""availableNow ingestion keeps the drop's first copies whatever the batch order."""

import os
import tempfile
import time

from tests.test_sources import _row, _write
from tillroll.operators import clean as C
from tillroll.streaming.increments import ingest_available, read_ingested


def test_first_copy_independent_of_arrival_order(spark):
    base = tempfile.mkdtemp(prefix="tillroll-stream-")
    drop = os.path.join(base, "drop")
    os.makedirs(drop)
    _write(drop, "sales_2026_06_22.csv", [_row("A", qty=1), _row("B", qty=2)])
    _write(drop, "sales_2026_06_23.csv", [_row("A", qty=10, day="2026-06-23"),
                                          _row("C", qty=3, day="2026-06-23")])
    _write(drop, "sales_2026_06_24.csv", [_row("B", qty=20, day="2026-06-24"),
                                          _row("A", qty=30, day="2026-06-24")])
    # The file holding the first copies arrives last.
    now = time.time()
    for i, name in enumerate(["sales_2026_06_24.csv", "sales_2026_06_23.csv",
                              "sales_2026_06_22.csv"]):
        os.utime(os.path.join(drop, name), (now - 300 + 100 * i, now - 300 + 100 * i))
    table = os.path.join(base, "table")
    q = ingest_available(spark, drop, table, os.path.join(base, "ckpt"), files_per_batch=1)
    q.awaitTermination()
    batches = [d for d in os.listdir(table) if d.startswith("batch=")]
    assert len(batches) == 3
    firsts = {r.order_id: r.quantity for r in C.keep_first(read_ingested(spark, table)).collect()}
    assert firsts == {"A": 1, "B": 2, "C": 3}

    # A new file after the run is picked up by the next run, old ones are not re-read.
    _write(drop, "sales_2026_06_25.csv", [_row("D", qty=4, day="2026-06-25")])
    q = ingest_available(spark, drop, table, os.path.join(base, "ckpt"), files_per_batch=1)
    q.awaitTermination()
    rows = read_ingested(spark, table)
    assert rows.count() == 7
    assert {r.order_id for r in C.keep_first(rows).collect()} == {"A", "B", "C", "D"}


def test_stream_aligns_columns_by_name(spark):
    from tests.test_sources import _mixed_drop
    base = tempfile.mkdtemp(prefix="tillroll-stream-")
    table = os.path.join(base, "table")
    ingest_available(spark, _mixed_drop(), table, os.path.join(base, "ckpt")).awaitTermination()
    got = {r.order_id: (r.quantity, r.customer_name, r.channel) for r in read_ingested(spark, table).collect()}
    assert got == {"A": (1, "Shop", "Online"), "B": (2, "Bob", "Online"), "C": (3, "Shop", None)}
