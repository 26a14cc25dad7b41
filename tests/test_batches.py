import random

import pytest

from tallyloom.operators import rows, sequence


def plain(data, most, count, alone=lambda r: False):
    out = {}
    for g in {r[0] for r in data}:
        batch, total, n, last_alone = -1, 0, 0, True
        for r in sorted((r for r in data if r[0] == g), key=lambda r: r[1]):
            w = r[2] or 0
            if last_alone or alone(r) or total + w > most or n >= count:
                batch, total, n = batch + 1, 0, 0
            total, n, last_alone = total + w, n + 1, alone(r)
            out[(g, r[1])] = batch
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(1)
    return [(rng.choice(["hot", "hot", "hot", "b", "c", None]), k, rng.choice([None, 0, *range(30)])) for k in range(2500)] + [("z", 1, 500), ("y", 1, 500), ("y", 2, 1)]


def batches(frame, *how, **more):
    return {(r.g, r.ord): r.batch for r in sequence.greedy_batches(frame, "g", "ord", "w", *how, **more).collect()}


def test_a_hot_group_in_many_blocks_and_levels(spark, data):
    frame = spark.createDataFrame(data, "g string, ord long, w long").repartition(5)
    for most, count, block, fan in ((50, 7, 64, 3), (100, 25, 8192, 512), (20, 300, 16, 4)):
        assert batches(frame, most, count, block_rows=block, fan_in=fan) == plain(data, most, count)


def test_rows_alone_extra_columns_and_empty_tables(spark, data):
    frame = spark.createDataFrame([(*r, r[1] % 11 == 0, 1, 2, "x") for r in data], "g string, ord long, w long, alone boolean, _g int, _at int, `a.b` string")
    assert batches(frame, 60, 9, "alone", block_rows=32, fan_in=4) == plain(data, 60, 9, lambda r: r[1] % 11 == 0)
    assert sequence.greedy_batches(frame, "g", "ord", "w", 60, 9).columns == [*frame.columns, "batch"]
    assert sequence.greedy_batches(frame.limit(0), "g", "ord", "w", 60, 9).collect() == []
    with pytest.raises(ValueError, match="batch"):
        sequence.greedy_batches(frame.withColumnRenamed("_at", "batch"), "g", "ord", "w", 60, 9)


def test_large_fields_are_cut_into_batches_of_their_own(spark):
    fields = [("g", 1, "a", "x" * 30), ("g", 2, "b", "y" * 30), ("g", 3, "c", "\n".join("z" * 50 for _ in range(8))), ("g", 4, "d", None), ("g", 5, "e", "w" * 36)]
    got = rows.field_batches(spark.createDataFrame(fields, "g string, ord int, id string, v string"), "g", "ord", "id", "v", most_tokens=30, cut_over=50).collect()
    got = sorted((r.ord, r.part, r.n_parts, r.id, r.weight, r.batch) for r in got)
    parts = [x for x in got if x[0] == 3]
    assert len(parts) > 2 and [x[5] for x in parts] == list(range(1, 1 + len(parts))) and [x[3] for x in parts] == [f"c:chunk_{k}" for k in range(len(parts))]
    after = 1 + len(parts)
    assert [x for x in got if x[0] != 3] == [(1, 0, 1, "a", 15, 0), (2, 0, 1, "b", 15, 0), (4, 0, 1, "d", 6, after), (5, 0, 1, "e", 17, after)]
