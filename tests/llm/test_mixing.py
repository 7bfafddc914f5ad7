import collections
import math
import random
import re

import pytest

from contentloom.llm.mixing import Mix, MixSettings, schedule


def aimed(sizes, weights, most=3):
    """Targets by going round: what lies above a cap is shared anew until nothing does."""
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        weight = sum(weights[s] for s in sizes if s not in capped)
        out = {s: most * sizes[s] if s in capped else left * weights[s] / weight for s in sizes}
        above = {s for s in sizes if s not in capped and out[s] > most * sizes[s]}
        if not above:
            return out
        capped |= above


def sources(spark, quotas):
    rows = [(i, q) for i, q in enumerate(quotas)]
    return spark.createDataFrame(rows, "source_no int, quota long")


@pytest.mark.parametrize("quotas", [[40, 9000, 700, 3], [1] * 30, [5], [0, 12, 0, 8000], list(range(1, 120))])
def test_every_stretch_of_slots_has_the_shares(spark, quotas):
    found = sorted(schedule(spark, sources(spark, quotas)).collect())
    total = sum(quotas)
    ranks = collections.defaultdict(list)
    for r in found:
        ranks[r.source_no].append(r["rank"])
        if r.slot < total:
            done = r.slot + 1
            assert abs(len(ranks[r.source_no]) - done * quotas[r.source_no] / total) <= 3 + math.log2(total)
    assert {s: len(own) for s, own in ranks.items()} == {s: q for s, q in enumerate(quotas) if q}
    assert all(own == list(range(len(own))) for own in ranks.values())
    assert len({r.slot for r in found}) == total
    # Few slots had to be put behind or left out.
    assert sum(r.slot >= total for r in found) <= 2 * len(quotas)


def test_points_are_parts_of_the_golden_ratio(spark):
    """Exact points of slots beyond 32 bits, against whole numbers of any size."""
    from contentloom.llm.mixing import POINT_BITS, STEP

    assert abs(STEP / 2**POINT_BITS - (5**0.5 - 1) / 2) < 1e-12
    for slot in (0, 1, 65535, 65536, 2**31 + 12345, 2**43 + 987654321):
        upper = (slot >> 16) * (STEP % (1 << 28)) % (1 << 28)
        assert (slot >> 16) * (STEP % (1 << 28)) < 2**63 and (slot & 0xFFFF) * STEP + upper * 65536 < 2**63
        assert ((slot & 0xFFFF) * STEP + upper * 65536) % 2**POINT_BITS == slot * STEP % 2**POINT_BITS


def many(spark):
    pick = random.Random(4)
    rows = []
    for i in range(600):
        source = pick.choice(["b", "a", None, "é", "hot", "hot", "hot", "B"])
        n = pick.choice([0, 1, 7, 60, 300])
        rows.append((i, " \n".join(f"w{i}_{j}" for j in range(n)), source, "x"))
    rows.append((600, " ".join(f"v{j}" for j in range(9000)), "a", "x"))
    rows += [(7, "again and again", "b", "x")] * 3
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, SIZE string")


@pytest.mark.parametrize("block", [16, 1024])
def test_words_of_the_mix(spark, block):
    rows, docs = many(spark)
    mix = Mix(docs, MixSettings(block=block))
    counts = mix.counts().collect()
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert sorted((r.doc_id, r.size) for r in counts) == sorted((i, size(t)) for i, t, *_ in rows)
    sizes = collections.Counter()
    for _, text, source, _ in rows:
        sizes[source] += size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = aimed(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    taken = collections.Counter()
    for r in counts:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source])
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in sizes)

    texts = collections.defaultdict(set)
    for i, t, *_ in rows:
        texts[i].add(tuple(re.findall(r"[^\x20\x09-\x0D]+", t)))
    slots = collections.defaultdict(list)
    pieces = mix.pieces().collect()
    got = collections.Counter()
    for p in pieces:
        words = tuple(p.text.split(" "))
        assert len(words) == p.upto - p["from"] and any(t[p["from"] : p.upto] == words for t in texts[p.doc_id])
        slots[p.slot].append(p)
        got[p.doc_id] += len(words)
    assert got == +collections.Counter({i: sum(r.taken for r in counts if r.doc_id == i) for i in texts})
    for own in slots.values():
        own.sort(key=lambda p: p.place)
        assert len({(p.source, p.epoch) for p in own}) == 1
        ends = [0]
        for p in own:
            assert p.place == ends[-1]
            ends.append(p.place + p.upto - p["from"])
        assert ends[-1] <= block
    if block == 16:
        # An early stretch of the mix has the sources in their shares.
        early = collections.Counter(own[0].source for slot, own in slots.items() if slot < len(slots) // 4)
        for s in sizes:
            assert abs(early[s] / sum(early.values()) - goal[s] / sum(goal.values())) < 0.02


def test_mix_does_not_depend_on_partitions(spark):
    _, docs = many(spark)
    once = Mix(docs.repartition(7), MixSettings(block=32)).pieces().collect()
    again = Mix(docs.coalesce(1), MixSettings(block=32)).pieces().collect()
    assert sorted(map(repr, once)) == sorted(map(repr, again))


def test_given_weights(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(400)] + [(400, "c c c", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    mix = Mix(docs, MixSettings(block=8), weights)
    taken = collections.Counter()
    for r in mix.counts().collect():
        taken[r.source] += r.taken
    assert taken == {"a": round(4003 * 3 / 4), "b": round(4003 / 4), "c": 0}


def test_mixing_odd_rows(odd_docs, no_docs):
    counts = Mix(odd_docs).counts().collect()
    assert len(counts) == odd_docs.count()
    assert {r.source for r in counts} == {None}
    assert all(r.taken == r.size and r.target == r.source_size == 40_035 for r in counts if r.source_size)
    assert sum(r.size for r in counts) == counts[0].source_size
    mix = Mix(no_docs)
    assert mix.counts().count() == 0 and mix.slots().count() == 0 and mix.pieces().count() == 0
    empty = odd_docs.where("doc_id in (2, 3, 4)")
    assert [(r.size, r.taken, r.target) for r in Mix(empty).counts().collect()] == [(0, 0, 0.0)] * 3
