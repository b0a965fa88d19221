"""Event-time totals against one pass over all rows, for any split into files."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from millrace.streaming.event_time import LATE, RAW_EVENTS, EventTables, add_batch, event_totals, ingest_events, watermark

START = datetime(2024, 1, 1)
HEADER = ",".join(RAW_EVENTS.names)


def some_events(seed, size=120):
    rng = random.Random(seed)
    rows = [(f"e{i}", f"u{i % 5}", rng.choice(["view", "buy"]), START + timedelta(minutes=rng.randrange(2000)), Decimal(i % 7)) for i in range(size)]
    return rows + rng.sample(rows, size // 4)


def write(path, rows):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([HEADER, *[f"{e},{u},{k},{t:%Y-%m-%dT%H:%M:%SZ},{v}" for e, u, k, t, v in rows]]) + "\n")


def expected(rows):
    out = defaultdict(lambda: [0, Decimal(0)])
    for _, _, kind, t, v in set(rows):
        cell = out[t.replace(minute=0), kind]
        cell[0] += 1
        cell[1] += v
    return sorted((t, k, n, v) for (t, k), (n, v) in out.items())


def found(spark, tables, **options):
    return sorted((r.window_start, r.event_type, r.events, r.value) for r in event_totals(spark, tables, **options).collect())


@pytest.mark.parametrize("order", ["by time", "shuffled", "backwards"])
def test_any_split(spark, tmp_path, order):
    rows = some_events(1)
    rows.sort(key=lambda r: r[3], reverse=order == "backwards")
    if order == "shuffled":
        random.Random(2).shuffle(rows)
    tables = EventTables(str(tmp_path / "t"), delay="2 hours")
    cut = len(rows) // 3
    for i in range(3):
        write(tmp_path / "in" / f"events_{i}.csv", rows[i * cut : (i + 1) * cut if i < 2 else None])
        ingest_events(spark, str(tmp_path / "in"), tables)
    assert found(spark, tables, with_late=True) == expected(rows)
    late = spark.read.schema(LATE).parquet(tables.late).count()
    assert (late == 0) == (order == "by time")
    assert spark.read.parquet(tables.accepted).groupBy("event_id").count().filter("count > 1").count() == 0
    assert watermark(spark, tables) == max(r[3] for r in rows) - timedelta(hours=2)


def test_a_batch_again_and_unusable_rows(spark, tmp_path):
    rows = some_events(3, 40)
    raw = lambda part: spark.createDataFrame([(e, u, k, f"{t:%Y-%m-%dT%H:%M:%SZ}", str(v)) for e, u, k, t, v in part] + [(None, "u", "view", "2024-01-01T00:00:00Z", "1"), ("x", "u", "view", "soon", "1")], RAW_EVENTS)
    tables = EventTables(str(tmp_path / "t"), delay="100 days")
    for number, part in ((0, rows[:25]), (1, rows[25:]), (0, rows[:25]), (1, rows[25:])):
        add_batch(raw(part), number, tables)
    assert found(spark, tables) == found(spark, tables, with_late=True) == expected(rows)
    assert spark.read.parquet(tables.late).filter("reason = 'unusable'").count() == 4


def test_nothing_yet(spark, tmp_path):
    tables = EventTables(str(tmp_path / "t"))
    assert found(spark, tables, with_late=True) == [] and watermark(spark, tables) is None
