"""Pfair schedules against their definition, and the placement of rows."""
import math
import random
from collections import Counter
from fractions import Fraction

import pytest

from starledger.llm import mixing as mx
from starledger.llm import queries


def brute_slots(blocks, weights, resolution):
    """Slot by slot, from the segments' parts: earliest deadline first."""
    left, out = list(blocks), []
    while any(left):
        live = [s for s in range(len(left)) if left[s]]
        parts = mx.whole_parts([weights[s] for s in live], max(resolution, 2 * len(live)))
        total, taken, t = sum(parts), [0] * len(live), 0
        while True:
            ready = [(mx.windows(parts[i], total, taken[i])[1], i) for i in range(len(live))
                     if mx.windows(parts[i], total, taken[i])[0] <= t]
            due, i = min(ready)
            assert t < due
            if not left[live[i]]:
                break
            out.append((live[i], blocks[live[i]] - left[live[i]]))
            left[live[i]] -= 1
            taken[i] += 1
            t += 1
            for j in range(len(live)):  # less than one block from the target, at every moment
                assert abs(taken[j] - t * parts[j] / total) < 1
            if not any(left):
                break
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_matches_slot_by_slot_schedule(seed):
    rnd = random.Random(seed)
    n = rnd.randrange(1, 7)
    blocks = [rnd.choice([0, 1, 7, 60, 400]) for _ in range(n)]
    weights = [rnd.random() + 0.01 for _ in range(n)]
    want = brute_slots(blocks, weights, 50)
    got = {}
    for seg in mx.plan(blocks, weights, 50):
        size = len(seg["order"])
        seen = Counter()
        for t in range(seg["slots"]):
            i = seg["order"][t % size]
            got[seg["phase"] + t] = (seg["live"][i], seg["began"][seg["live"][i]] + seen[i])
            seen[i] += 1
    assert [got[t] for t in range(len(want))] == want and len(got) == len(want)


@pytest.mark.parametrize("weights, blocks", [
    ([*queries.SOURCE_WEIGHTS.values(), 0.01], [2400, *[400] * 19, 100]),
    ([*queries.SOURCE_WEIGHTS.values(), 0.01], [9000, *[900] * 18, 150, 7]),
    ([0.5, *[0.5 / 499] * 499], [5000, *[10] * 499]),
    ([1 / 3, 0.1, 2**-0.5, 1e-300], [4000, 900, 8000, 2])])
def test_less_than_one_block_from_the_given_weights(weights, blocks):
    taken, t = [0] * len(blocks), 0
    for seg in mx.plan(blocks, weights):
        assert (seg["phase"], seg["began"]) == (t, taken)
        exact = [Fraction(str(weights[s])) for s in seg["live"]]
        shares, got = [e / sum(exact) for e in exact], [0] * len(exact)
        due = [float(x) for x in shares]
        for k in range(seg["slots"]):
            got[seg["order"][k % len(seg["order"])]] += 1
            assert max(abs(g - (k + 1) * w) for g, w in zip(got, due)) < 1 + 1e-9
        assert all(abs(g - seg["slots"] * w) < 1 for g, w in zip(got, shares))
        for s, g in zip(seg["live"], got):
            taken[s] += g
        t += seg["slots"]
    assert taken == blocks and t == sum(blocks)


def test_windows_of_placed_rows_follow_the_given_weights(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'a', 'b') source")
    weights = {"a": 1 / 3, "b": 0.7071067811865476}
    mixed, (block, _, slot, release, deadline) = mx.interleave(docs, weights, block_rows=2)
    share = {k: Fraction(str(w)) / sum(Fraction(str(x)) for x in weights.values()) for k, w in weights.items()}
    first = {}
    for seg in mx.plan([500, 1000], [*weights.values()])[:1]:
        first = {"a": seg["order"].count(0), "b": seg["order"].count(1)}
    rows = mixed.collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    for r in rows:
        assert r[release] <= r[slot] < r[deadline]
        if r[block] < first[r.source]:
            w = share[r.source]
            assert (r[release], r[deadline]) == (math.floor(r[block] / w), math.ceil((r[block] + 1) / w))


def test_whole_parts():
    assert sum(mx.whole_parts([0.5, 0.3, 0.2], 1000)) == 1000
    assert min(mx.whole_parts([1e-9, 1.0], 10)) == 1


def test_rows_are_placed_once_and_in_schedule_order(spark):
    rows = [(i, "a" if i % 3 else "b", "x") for i in range(500)] + [(1000 + i, None, "y") for i in range(9)]
    rows += [(2000 + i, "unknown", None) for i in range(20)] + [(None, "b", "z"), (1, "a", "x"), (1, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, slot string")
    weights = {"a": 0.5, "b": 0.4, "never": 0.1}
    mixed, (block, place, slot, release, deadline) = mx.interleave(docs, weights, block_rows=8, resolution=20)
    got = mixed.collect()
    assert slot == "slot_" and mixed.columns[:3] == docs.columns
    assert sorted(map(str, ((r.doc_id, r.source, r.slot) for r in got))) == sorted(map(str, rows))
    queue = {"a": 0, "b": 1}
    blocks = Counter()
    for r in got:
        blocks[queue.get(r.source, 3), r[block]] += 1
        assert r[release] <= r[slot] < r[deadline] and 0 <= r[place] < 8
    sizes = Counter(queue.get(s, 3) for _, s, _ in rows)
    want = brute_slots([-(-sizes[q] // 8) for q in range(4)], [*weights.values(), 0.01], 20)
    assert {(r[slot], queue.get(r.source, 3), r[block]) for r in got} == {(t, q, b) for t, (q, b) in enumerate(want)}
    assert all(n == 8 or b == -(-sizes[q] // 8) - 1 for (q, b), n in blocks.items())
    assert len({(r[slot], r[place]) for r in got}) == len(rows)

    ordered = mx.in_mixed_order(docs, weights, block_rows=8, resolution=20)
    assert ordered.columns == docs.columns
    place_of = {}
    for r in got:
        place_of.setdefault((r.doc_id, r.source), []).append(r[slot])
    seen = [min(place_of[r.doc_id, r.source]) for r in ordered.collect() if r.doc_id != 1]
    assert seen == sorted(seen) and len(seen) == len(rows) - sum(r[0] == 1 for r in rows)


def test_empty_table_and_bad_weights(spark):
    docs = spark.createDataFrame([], "doc_id long, source string")
    assert mx.interleave(docs, {"a": 1.0})[0].count() == 0
    assert mx.interleave(spark.createDataFrame([(1, "q")], "doc_id long, source string"), {})[0].count() == 1
    with pytest.raises(ValueError):
        mx.interleave(docs, {"a": 0.0})
