"""Ordering operators on groups that span range partitions, against plain Python."""

import random
from collections import defaultdict

import pytest

from trellis import session
from trellis.operators import ordering


@pytest.fixture(params=["mixed", "one hot group", "empty"])
def rows(request):
    draw = random.Random(11)
    if request.param == "empty":
        return []
    share = 0.3 if request.param == "mixed" else 0.95
    return [("hot" if draw.random() < share else f"g{draw.randrange(30)}", i, draw.randrange(5) or None) for i in range(500)]


def groups(rows):
    out = defaultdict(list)
    for g, t, v in sorted(rows, key=lambda r: (r[0], r[1])):
        out[g].append((t, v))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, t int, v int").repartition(6)


def test_numbers_within_groups(spark, rows):
    got = {(r["g"], r["t"]): r["rn"] for r in ordering.row_number_within(frame(spark, rows), ["g"], ["t"]).collect()}
    assert got == {(g, t): i for g, items in groups(rows).items() for i, (t, _) in enumerate(items, 1)}


def test_next_rows(spark, rows):
    got = {(r["g"], r["t"]): (r["next_t"], r["next_v"]) for r in ordering.next_row_pairs(frame(spark, rows), ["g"], ["t"], ["t", "v"]).collect()}
    assert got == {(g, a[0]): b for g, items in groups(rows).items() for a, b in zip(items, items[1:])}


def test_last_value_so_far(spark, rows):
    got = {(r["g"], r["t"]): r["last"] for r in ordering.running_last(frame(spark, rows), ["g"], ["t"], "v", "last").collect()}
    want = {}
    for g, items in groups(rows).items():
        last = None
        for t, v in items:
            last = v if v is not None else last
            want[g, t] = last
    assert got == want


def test_positions_pages_and_ranges(spark, rows):
    df = frame(spark, rows).select("g", "t")
    order = sorted((g, t) for g, t, _ in rows)
    got = {(r["g"], r["t"]): (r["page"], r["row_in_page"]) for r in ordering.paginate(df, ["g", "t"], 70).collect()}
    assert got == {x: (i // 70, i % 70) for i, x in enumerate(order)}
    assert sorted(map(tuple, ordering.row_range(df, ["g", "t"], 100, 130).collect())) == order[100:130]
    every_second = sorted(map(tuple, ordering.drop_every_second(df, ["g", "t"]).collect()))
    assert every_second == order[::2]


def test_far_ranges_by_position(spark, rows, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_ROWS", 10)
    df = frame(spark, rows).select("g", "t")
    order = sorted((g, t) for g, t, _ in rows)
    assert sorted(map(tuple, ordering.row_range(df, ["g", "t"], 100, 130).collect())) == order[100:130]


def test_next_rows_shuffle_once(spark, rows):
    """Rows go into ranges in one shuffle; what is read back is not shuffled by key again. Null groups and values are kept."""
    some = [*rows, (None, 1, 2), (None, 2, None), (None, 3, 1)]
    df = frame(spark, some)
    pairs = ordering.next_row_pairs(df, ["g"], ["t"], ["v"])
    assert "hashpartitioning" not in pairs._jdf.queryExecution().toString()
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    order = sorted(some, key=key)
    want = [(*a, b[2]) for a, b in zip(order, order[1:]) if a[0] == b[0]]
    assert sorted(map(tuple, pairs.collect()), key=key) == want


def test_shuffles_start_with_pieces_of_bounded_size(spark):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(setting, None)
    try:
        session.size_shuffles(spark, 100 * session.PIECE_ROWS + 1)
        assert spark.conf.get(setting) == "101"
        session.size_shuffles(spark, 5)
        assert spark.conf.get(setting) == "101"
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def test_next_rows_are_written_once_and_narrow(spark, monkeypatch):
    """What is written has the next row's carried columns only, not its group's, and rows without a next one only at the ends of ranges."""
    written, put = [], session.Scratch.put

    def seen(self, df, slot="state"):
        written.append(put(self, df, slot))
        return written[-1]

    monkeypatch.setattr(session.Scratch, "put", seen)
    some = [(float(g), t, t) for g in range(50) for t in range(4)]
    df = spark.createDataFrame(some, "g double, t int, v int")
    assert ordering.next_row_pairs(df, ["g"], ["t"], ["v"]).count() == 150
    (stored,) = written
    assert [c for c in stored.columns if c.startswith("_next_")] == ["_next_v"]
    assert stored.filter("not _same and not _starts and not _ends").count() == 0
