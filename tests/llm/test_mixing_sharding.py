import math
from collections import Counter

import pytest
from kerbside.llm import mixing, sharding
from pyspark.sql import functions as F


def water_level(sizes, weights):
    """Targets by bisection of the common level."""
    total, low, high = sum(sizes.values()), 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * sizes[s], weights[s] * level) for s in sizes) < total else (low, level)
    return {s: min(3 * sizes[s], weights[s] * low) for s in sizes}


def test_targets():
    sizes = {"a": 10_000, "b": 50, "c": 3, "d": 0, None: 700}
    weights = mixing.rotating_weights(sizes)
    assert weights == {"a": 1.0, "b": 2.0, "c": 3.0, "d": 1.0, None: 2.0}
    got, want = mixing.targets(sizes, weights), water_level(sizes, weights)
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in sizes)
    assert mixing.targets({}, {}) == {} and mixing.targets({"a": 0}, {"a": 1.0}) == {"a": 0.0}


def cheapest(capacity, quota):
    """Most words, then least cost, over all ways to share small patterns among their sources."""
    best = None
    patterns = list(capacity)

    def go(i, left, taken, cost):
        nonlocal best
        if i == len(patterns):
            key = (sum(taken), -cost)
            best = max(best or key, key)
            return
        p, c = patterns[i], capacity[patterns[i]]

        def split(j, rest, used):
            if j == len(p):
                extra = sum((k // c) * (k // c + 1) // 2 for k in range(used)) if c else 0
                go(i + 1, rest, [*taken, used], cost + extra)
                return
            for x in range(min(rest[p[j]], 3 * c - used) + 1):
                split(j + 1, rest | {p[j]: rest[p[j]] - x}, used + x)

        split(0, left, 0)

    go(0, quota, [], 0)
    return best


@pytest.mark.parametrize("capacity, quota", [
    ({("a",): 2, ("b",): 3, ("a", "b"): 2}, {"a": 5, "b": 4}),
    ({("a", "b"): 2, ("b", "c"): 1, ("c",): 2}, {"a": 3, "b": 3, "c": 4}),
    ({("a",): 0, ("a", "b"): 3}, {"a": 4, "b": 9}),
])
def test_flow_is_cheapest(capacity, quota):
    flow = mixing.min_cost_flow(capacity, quota)
    cost = sum(sum((k // capacity[p]) * (k // capacity[p] + 1) // 2 for k in range(f)) for p, f in flow.items() if capacity[p])
    assert (sum(flow.values()), -cost) == cheapest(capacity, quota)
    assert all(f <= 3 * capacity[p] for p, f in flow.items())


def test_mix(docs, corpus, nothing):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(corpus)
    of = {(r[0], len((r[1] or "").split())): r[3] for r in corpus}
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        source = of[r.doc_id, r.size]
        taken[source] += r.taken
        size[source] += r.size
        target[source] = r.target
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert r.source_size == sum(len((t or "").split()) for _, t, _, s in corpus if s == source)
    want = water_level(dict(size), mixing.rotating_weights(size))
    assert all(math.isclose(target[s], want[s], rel_tol=1e-9) for s in want)
    largest = {s: max(len((t or "").split()) for _, t, _, of_s in corpus if of_s == s) for s in target}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 or largest[s] > target[s] for s in target)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mixing.mix(nothing).count() == 0


def test_mixed_documents(docs, corpus, nothing):
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +copies
    assert mixing.mixed_documents(nothing).count() == 0
    # Texts stay where they are read: what is looked up are broadcast cut points.
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_lookup_table():
    for shards, slots in ((("a",), 2), (("a", "b", "c"), 13), (sharding.SHARDS, sharding.SLOTS)):
        table = sharding.lookup_table(shards, slots)
        order = {i: [(sharding._number(s, "offset") + j * (sharding._number(s, "skip") % (slots - 1) + 1 if slots > 2 else j and 1)) % slots for j in range(slots)] for i, s in enumerate(shards)}
        want, turn = {}, 0
        while len(want) < slots:
            slot = next(x for x in order[turn] if x not in want)
            want[slot] = turn
            turn = (turn + 1) % len(shards)
        assert table == [want[i] for i in range(slots)]
        counts = Counter(table)
        assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a < len(sharding.SHARDS) - 1)
    assert moved < 0.1 * len(table)
    for shards, slots in (((), 13), (("a", "a"), 13), (("a", "b"), 12), (("a", "b", "c"), 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_place(docs, corpus, nothing, tmp_path):
    placed = sharding.place(docs)
    assert sorted(placed.columns) == sorted({*docs.columns, "shard"})
    rows = placed.collect()
    table = sharding.lookup_table()
    assert len(rows) == len(corpus)
    assert all(r.shard == sharding.SHARDS[table[r.slot]] for r in rows)
    assert len({r.slot for r in rows if r.doc_id == corpus[0][0]}) == 1
    assert sharding.place(nothing).count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"), files=2)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(corpus)
    assert back.select("shard").distinct().count() == placed.select("shard").distinct().count()
    assert placed.groupBy("shard").agg(F.count("*")).count() <= 64
