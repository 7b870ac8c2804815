"""Order-dependent operators: exact inside one hot group, whatever the block width."""

import random

import pytest
from pyspark.sql import functions as F

from tallygraph.operators import positions


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), p, rng.randrange(-5, 50)) for p in rng.sample(range(5000), 1500)]
    return rows, spark.createDataFrame(rows, "g string, p bigint, v int").repartition(6)


@pytest.mark.parametrize("width", [1, 7, 64, 100_000])
def test_running_total(skewed, width):
    rows, df = skewed
    got = {(r.g, r.p): r.t for r in positions.running_total(df, ["g"], "p", F.col("v"), "t", width).collect()}
    want, sums = {}, {}
    for g, p, v in sorted(rows, key=lambda r: r[1]):
        sums[g] = sums.get(g, 0) + v
        want[(g, p)] = sums[g]
    assert got == want


def test_dense_index_without_group(skewed):
    rows, df = skewed
    got = {r.p: r.n for r in positions.dense_index(df, [], "p", "n", 50).collect()}
    assert got == {p: i for i, p in enumerate(sorted(p for _, p, _ in rows))}


@pytest.mark.parametrize("cap", [0, 3, 500, 1200])
def test_first_per_group(skewed, cap, monkeypatch):
    monkeypatch.setattr(positions, "PRUNED_LIMIT", 400)
    rows, df = skewed
    got = sorted((str(r.g), r.p) for r in positions.first_per_group(df, ["g"], ["p"], cap).collect())
    by = {}
    for g, p, _ in sorted(rows, key=lambda r: r[1]):
        by.setdefault(str(g), []).append(p)
    assert got == sorted((g, p) for g, ps in by.items() for p in (ps[:cap] if cap else ps))


def test_small_caps_are_trimmed_before_the_shuffle(skewed):
    _, df = skewed
    plan = positions.first_per_group(df, ["g"], ["p"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning")


def closed_one_by_one(sizes, limit):
    batch, filled, out = 0, 0, []
    for n in sizes:
        if filled >= limit:
            batch, filled = batch + 1, 0
        out.append(batch)
        filled += n
    return out


@pytest.mark.parametrize("limit", [1, 350, 1000, 10 ** 9])
def test_batches_equal_closing_one_after_the_other(spark, limit):
    rng = random.Random(limit)
    sizes = {"s": [rng.randrange(1, 400) for _ in range(700)], None: [rng.choice([0, 1, 3, 5000]) for _ in range(150)], "one": [7],
             "big": [2000] * 9, "tail": [1] * 40}
    df = spark.createDataFrame([(g, i, n) for g, all_ in sizes.items() for i, n in enumerate(all_)], "g string, p bigint, n int")
    got = {}
    for r in sorted(positions.bounded_batches(df, ["g"], "p", F.col("n"), limit).collect(), key=lambda r: r.p):
        got.setdefault(r.g, []).append((r.batch, r.op_bytes))
    assert got == {g: list(zip(closed_one_by_one(all_, limit), all_)) for g, all_ in sizes.items()}


def test_ranked(skewed):
    rows, df = skewed
    got = sorted(((str(r.g), r.place), (r.v, r.p)) for r in positions.ranked(df, ["g"], ["v", "p"], "place").collect())
    by = {}
    for g, p, v in rows:
        by.setdefault(str(g), []).append((v, p))
    assert got == sorted(((g, i), x) for g, xs in by.items() for i, x in enumerate(sorted(xs)))


def test_batches_of_a_whole_op_stream(spark):
    """Sizes and cuts of every kind of op, over the whole stream of the base."""
    from tallygraph.operators import plan
    from tallygraph.plans.star import star_base
    rows = plan.batches(star_base(spark, "/root/testdata/sf0.001").op_stream(), 20_000)
    by, totals = {}, {r.op: (r.n, r.batches, r.largest_batch) for r in plan.batch_totals(rows).collect()}
    for r in sorted(rows.collect(), key=lambda r: r.place):
        by.setdefault(r.op, []).append(r)
    assert len(by) == 5
    for op, ops in by.items():
        assert [r.place for r in ops] == list(range(len(ops)))
        assert [r.batch for r in ops] == closed_one_by_one([len(r.op_json) for r in ops], 20_000)
        filled = {}
        for r in ops:
            filled[r.batch] = filled.get(r.batch, 0) + len(r.op_json)
        assert totals[op] == (len(ops), len(filled), max(filled.values()))


def test_grid(spark):
    x, y = positions.grid_place(F.col("id"))
    assert [tuple(r) for r in spark.range(15).select(x, y).collect()][::14] == [(150, 150), (150, 245)]


def test_walks(spark):
    from tallygraph.operators import chains
    rng, rows, want = random.Random(3), [], set()
    for g, n in (("a", 200), (None, 57), ("b", 1), ("c", 3)):
        to = [rng.choice([None, *range(p + 1, min(p + 9, n + 2))]) if rng.random() < 0.05 else min(p + rng.randrange(1, 6), n + 1) for p in range(n)]
        rows += [(g, p, to[p]) for p in range(n)]
        p = 0
        while p is not None and p < n:
            want.add((g, p))
            p = to[p]
    got = chains.reached(spark.createDataFrame(rows, "g string, p bigint, t bigint"), ["g"], "p", "t").collect()
    assert len(got) == len(want) and {(r.g, r.p) for r in got} == want
    assert chains.reached(spark.createDataFrame([], "p bigint, t bigint"), [], "p", "t").count() == 0


def test_later_slots_are_found_over_blocks(spark, monkeypatch):
    """The next slot with a start, also where it lies blocks away; no frame is read to its last row."""
    monkeypatch.setattr(positions, "BLOCK", 4)
    own = {0: 0, 1: None, 2: 7, 3: None, 9: None, 30: 8, 31: None, 40: 9, 41: None}
    rows = [((g,), s, None if v is None else (v, s)) for g in ("a", None) for s, v in own.items()]
    df = spark.createDataFrame(rows, "grp struct<g:string>, slot bigint, own struct<to:bigint,to_place:bigint>")
    found = positions._later_slots(df)
    assert "unboundedfollowing" not in found._jdf.queryExecution().analyzed().toString().lower()
    got = {(r.grp.g, r.slot): r.later and r.later.to for r in found.collect()}
    assert got == {(g, s): next((own[t] for t in sorted(own) if t > s and own[t] is not None), None)
                   for g in ("a", None) for s in own}


def test_batches_over_many_blocks_take_two_passes(spark, monkeypatch):
    """Batches that span blocks, ops without a size and ops larger than a batch; the number of rounds does not grow."""
    from tallygraph import session
    folders, work_dir = [], session.work_dir
    monkeypatch.setattr(session, "work_dir", lambda s, name: folders.append(name) or work_dir(s, name))
    monkeypatch.setattr(positions, "BLOCK", 16)
    rng = random.Random(5)
    sizes = {"s": [rng.choice([0, 1, 30, 90]) for _ in range(900)], None: [rng.randrange(60) for _ in range(300)], "big": [700] * 50}
    df = spark.createDataFrame([(g, i, n) for g, all_ in sizes.items() for i, n in enumerate(all_)], "g string, p int, n bigint")
    for limit in (1, 100, 2500):
        folders.clear()
        got = {}
        for r in sorted(positions.bounded_batches(df, ["g"], "p", F.col("n"), limit).collect(), key=lambda r: r.p):
            got.setdefault(r.g, []).append(r.batch)
        assert got == {g: closed_one_by_one(all_, limit) for g, all_ in sizes.items()}
        assert len(folders) == 2
    odd = spark.createDataFrame([(0, None), (1, 5), (2, None), (3, 5), (4, 1)], "p bigint, n bigint")
    assert sorted((r.p, r.op_bytes, r.batch) for r in positions.bounded_batches(odd, [], "p", F.col("n"), 5).collect()) == [
        (0, None, -1), (1, 5, 0), (2, None, 0), (3, 5, 1), (4, 1, 2)]
    assert positions.bounded_batches(df.filter("p < 0"), ["g"], "p", F.col("n"), 5).count() == 0


def test_places_without_the_columns_that_gave_them(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 1, 6), ("b", 3, 7)], "g string, v int, n int")
    found = positions.ranked(df, ["g"], ["v"], "place", keep_order=False)
    assert sorted(map(tuple, found.select("g", "n", "place").collect())) == [("a", 5, 1), ("a", 6, 0), ("b", 7, 0)] and "v" not in found.columns
