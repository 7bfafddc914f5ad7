"""Near-duplicate documents, repeated lines and benchmark passages against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from contentloom.llm import near_dedup
from contentloom.llm.decontaminate import find_contamination, without_contaminated, without_spans
from contentloom.llm.graph import components
from contentloom.llm.line_dedup import LineSettings, dedup_lines, without_repeats
from contentloom.llm.near_dedup import ForestSettings, near_duplicates, one_of_each
from tests.llm.test_words import LOWER

SPACED = r"[^\x20\x09-\x0D]+"
LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def shingles(text, k):
    words = re.findall(SPACED, (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def linked(texts, k, percent):
    """Components by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: (len(sets[i]), top(i)) for i in sets}


def varied(seed, families=12, members=25, words=120):
    """Families of texts that differ in a few words, with exact copies and chains."""
    pick = random.Random(seed)
    out = {}
    for family in range(families):
        base = [f"v{pick.randrange(5000)}" for _ in range(words)]
        for member in range(members):
            text = list(base)
            for _ in range(pick.randrange(6)):
                text[pick.randrange(words)] = f"x{pick.randrange(10**6)}"
            out[family * 100 + member] = " ".join(text)
            if member % 5 == 0:
                base = text
    return out


@pytest.mark.parametrize("crowd", [200, 8])
def test_components_of_varied_families(spark, crowd):
    texts = varied(7)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_duplicates(docs, ForestSettings(words=3, percent=85, crowd=crowd)).collect()
    expected = linked(texts, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len({c for _, c in expected.values()}) < len(texts) / 2


def test_variants_linked_only_through_their_base(spark):
    pick = random.Random(3)
    base = [f"v{n}" for n in range(300)]
    texts = {0: " ".join(base)}
    for i in range(1, 1301):
        text = list(base)
        for k in pick.sample(range(300), 8):
            text[k] = f"x{i}y{k}"
        texts[i] = " ".join(text)
    sets = {i: shingles(t, 3) for i, t in texts.items()}
    assert all(100 * len(s & sets[0]) >= 85 * len(s | sets[0]) for s in sets.values())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = near_duplicates(docs, ForestSettings(words=3, percent=85)).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 1301


def test_trees_follow_the_threshold():
    for percent in range(50, 101):
        s = ForestSettings(percent=percent)
        assert (1 - (percent / 100) ** s.first_depth) ** s.trees <= 1 / s.missed
    assert ForestSettings(percent=85).trees == 12 and ForestSettings().trees == 17


def test_pairs_near_the_threshold_in_crowded_regions(spark):
    passage = [f"p{n}" for n in range(120)]
    texts = {}
    for i in range(400):
        text = passage + [f"d{i}w{n}" for n in range(80)]
        texts[2 * i] = " ".join(text)
        for k in range(125, 195, 10):
            text[k] = f"x{i}y{k}"
        texts[2 * i + 1] = " ".join(text)
    a, b = (shingles(texts[i], 3) for i in (0, 1))
    assert 0.8 <= len(a & b) / len(a | b) < 0.81
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = near_duplicates(docs, ForestSettings(words=3, crowd=20)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - i % 2 for i in texts}


def sorted_order(seed, rows=600, s=ForestSettings(percent=85)):
    """Rows of an order with runs of all sizes, as trees and keys."""
    pick = np.random.default_rng(seed)
    keys = pick.integers(0, 2, (rows, s.last_depth)).astype(np.uint16)
    keys[: rows // 3] = keys[0]
    trees = pick.integers(0, 3, rows).astype(np.int32)
    order = sorted(range(rows), key=lambda i: (trees[i], keys[i].tobytes()))
    return trees[order], keys[order]


@pytest.mark.parametrize("cuts", [[], [1], [300], [10, 11, 12, 400], list(range(1, 600)), [150, 160, 590]])
@pytest.mark.parametrize("crowd", [4, 30, 200])
def test_regions_do_not_depend_on_cuts(cuts, crowd):
    s = ForestSettings(percent=85, crowd=crowd)
    trees, keys = sorted_order(crowd)
    depths = range(s.first_depth, s.last_depth + 1)
    zero = [0] * len(depths)

    def regions(rows, names, wide, start):
        """Members of regions; windows are those whose rows all share a crowded run."""
        return {(int(n), int(r) + start) for r, n in zip(rows, names)}, {start + int(i) for i in np.flatnonzero(wide)}

    whole, wide = regions(*near_dedup.candidates(trees, keys, zero, zero, 0, s), 0)
    parts = [slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(trees)])]
    edges = {}
    for p, c in enumerate(parts):
        prefix = near_dedup.common_prefix(trees[c], keys[c])
        sizes = [near_dedup.run_sizes(prefix, d)[1] for d in depths]
        ends = [(int(trees[c][i]), keys[c][i].tobytes()) for i in (0, -1)]
        edges[p] = near_dedup._Edge(len(trees[c]), *ends, [int(x[0]) for x in sizes], [int(x[-1]) for x in sizes])
    over = near_dedup.carried(edges, depths)
    found, crowded = set(), set()
    for p, c in enumerate(parts):
        own, far = regions(*near_dedup.candidates(trees[c], keys[c], *over[p], p, s), c.start)
        found |= own
        crowded |= far
    assert crowded == wide
    # Regions by hand: the least depth at which a row's run has few enough rows.
    names = collections.defaultdict(set)
    for name, row in found:
        names[name].add(row)
    groups = {frozenset(rows) for rows in names.values()}
    for i in range(len(trees)):
        for d in depths:
            run = [j for j in range(len(trees)) if trees[j] == trees[i] and (keys[j][:d] == keys[i][:d]).all()]
            if len(run) <= crowd:
                assert len(run) == 1 or frozenset(run) in groups
                break
        else:
            assert i in crowded and any(i in rows for rows in names.values())
    assert all(len(rows) <= max(crowd, 2) for rows in names.values())


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_similar_sets_share_a_rarest_shingle(percent):
    pick = np.random.default_rng(percent)
    for _ in range(300):
        n = int(pick.integers(1, 60))
        x = np.unique(pick.integers(0, 1 << 20, n, np.uint64))
        gone = int(pick.integers(0, max(1, len(x) // 4) + 1))
        y = np.unique(np.r_[x[gone:], pick.integers(0, 1 << 20, gone // 2, np.uint64)])
        counts = pick.integers(0, 50, near_dedup._COUNTERS).astype(np.int32)
        both = len(np.intersect1d(x, y))
        if both and 100 * both >= percent * (len(x) + len(y) - both):
            shared = np.intersect1d(near_dedup.rarest(x, counts, percent), near_dedup.rarest(y, counts, percent))
            assert len(shared)


def test_a_shared_passage_brings_nobody_together(spark, monkeypatch):
    """Work on documents that only share a passage does not grow with their pairs."""
    passage = " ".join(f"p{n}" for n in range(150))
    rows = [(i, passage + " " + " ".join(f"d{i}w{n}" for n in range(60))) for i in range(3000)]
    rows += [(5000 + i, rows[i][1].replace(f"d{i}w30", "new")) for i in range(0, 3000, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(near_dedup, "_separated", None)
    seen = []
    plain = near_dedup._open_lists
    monkeypatch.setattr(near_dedup, "_open_lists", lambda *a: seen.append(plain(*a)) or seen[-1])
    found = near_duplicates(docs, ForestSettings(words=3, percent=85, crowd=50)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    assert seen and sum(x.count() for x in seen) <= 60 * 300


@pytest.mark.parametrize("crowded", [True, False])
@pytest.mark.parametrize("percent, changed", [(80, 7), (85, 5), (90, 3)])
def test_recall_near_the_threshold(spark, crowded, percent, changed):
    texts = {}
    for i in range(150):
        text = [f"p{n}" if crowded and n < 120 else f"d{i}w{n}" for n in range(200)]
        texts[2 * i] = " ".join(text)
        for k in range(125, 125 + 10 * changed, 10):
            text[k] = f"x{i}y{k}"
        texts[2 * i + 1] = " ".join(text)
    a, b = (shingles(texts[i], 3) for i in (0, 1))
    assert percent <= 100 * len(a & b) / len(a | b) < percent + 3
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = near_duplicates(docs, ForestSettings(words=3, percent=percent, crowd=20)).collect()
    assert sum(r.component_id == r.doc_id - r.doc_id % 2 for r in found) >= len(texts) - (0 if crowded else 1)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = near_duplicates(odd_docs, ForestSettings(words=3, percent=85)).collect()
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r.doc_id].append((r.component_id, r.kept))
    assert by_id[1] == [(1, True)] * 2 and by_id[None] == [(None, True)]
    assert by_id[5] == [(5, True)] and by_id[6] == [(5, False)]
    assert sorted(by_id[7]) == [(1, False), (7, True)]
    assert all(by_id[i] == [(i, True)] for i in (2, 3, 4, 8))
    assert near_duplicates(no_docs).count() == 0


def test_one_of_each(odd_docs, no_docs):
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    left = sorted((r.doc_id, (r[1] or "")[:3]) for r in kept.where("doc_id IS NOT NULL").collect())
    assert left == [(1, "a b"), (2, ""), (3, ""), (4, " \t\n"), (5, left[4][1]), (7, "som"), (8, "İßé")]
    assert kept.where("doc_id IS NULL").count() == 1
    assert one_of_each(no_docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {i: 1 for i in range(1, 61)} | {1000 + i: 1000 for i in range(300)}


def line_rule(texts, least=40, docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = collections.defaultdict(set)
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    keeper = {k: max(h) for k, h in holders.items() if len(h) >= docs}
    out = {}
    for i, text in texts.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("bits", [1 << 28, 1 << 10])
def test_repeated_lines(spark, bits):
    pick = random.Random(5)
    common = [f"{'Shared line of some length é ' * 2}{n}" for n in range(12)] + ["short", "", "é" * 39, "é" * 40]
    texts = {}
    for i in range(60):
        lines = [pick.choice(common) for _ in range(pick.randrange(6))] + [f"own line of document number {i} and more words"]
        pick.shuffle(lines)
        texts[i] = "\n".join(x.upper() + "  " if pick.random() < 0.3 else x for x in lines)
    texts |= {100: "", 101: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = dedup_lines(docs, LineSettings(most_bits=bits)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in found} == line_rule(texts)
    assert sum(r.n_dropped for r in found) > 50


def test_a_repeated_document_counts_once(spark):
    line = "this line is long enough to be compared with others of its kind"
    rows = [(1, line), (1, line), (1, line + "\nx"), (2, line), (2, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dedup_lines(docs).agg(F.sum("n_dropped")).first()[0] == 0
    more = docs.unionByName(spark.createDataFrame([(i, line) for i in (3, 4, 5)], "doc_id long, text string"))
    lost = {(r.doc_id, r.n_dropped) for r in dedup_lines(more).collect()}
    assert lost == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 0)}


def test_repeated_lines_of_odd_rows(odd_docs, no_docs):
    found = dedup_lines(odd_docs).collect()
    assert len(found) == odd_docs.count() and not any(r.n_dropped for r in found)
    assert {r.text for r in found if r.doc_id == 2} == {None}
    assert without_repeats(odd_docs).columns == odd_docs.columns
    assert without_repeats(no_docs).count() == 0


def test_lengths_follow_the_lines(spark):
    line = "This line stands in every one of the documents."
    docs = spark.createDataFrame([(i, f"{line}\nown {i}", 53) for i in range(6)], "doc_id long, text string, n_chars long")
    found = {r.doc_id: (r.text, r.n_chars) for r in without_repeats(docs).collect()}
    assert found[5] == (f"{line}\nown 5", 53) and found[2] == ("own 2", 5)


def hit_rule(texts, items, window=13):
    windows = collections.defaultdict(set)
    for item, text in items.items():
        words = re.findall(LETTERED, (text or "").translate(LOWER))
        size = min(window, len(words))
        for j in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[j : j + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in texts.items():
        words = re.findall(LETTERED, (text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for j in range(len(words) - size + 1):
                if of := windows.get(tuple(words[j : j + size])):
                    hit.update(range(j, j + size))
                    found |= of
        out[i] = (len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words))
    return out


@pytest.mark.parametrize("block_words", [10**6, 60, 15])
def test_hits_of_items(spark, block_words):
    from contentloom.llm.decontaminate import Limits

    pick = random.Random(9)
    small = [f"w{n}" for n in range(6)]
    items = {n: " ".join(pick.choices(small, k=pick.choice([1, 3, 5, 13, 14, 20, 40]))) for n in range(12)}
    items[3] = "w1 only once here"
    items |= {90: "", 91: None, 92: "..."}
    texts = {}
    for i in range(150):
        words = pick.choices(small + ["zz"], k=pick.randrange(60))
        if i % 3 == 0:
            words += items[pick.randrange(12)].split() + pick.choices(["yy", "zz"], k=100)
        texts[i] = " ".join(words).upper() if i % 5 == 0 else ", ".join(words)
    texts |= {500: None, 501: ""}
    # One-word items would hit everything.
    items = {n: t for n, t in items.items() if t is None or len(t.split()) != 1}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = find_contamination(docs, bench, Limits(block_words=block_words)).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in found} == hit_rule(texts, items)
    assert {r.contaminated for r in found} == {True, False}


def test_spans_are_cut(spark):
    item = " ".join(f"q{n}" for n in range(15))
    own = " ".join(f"own{n}" for n in range(400))
    docs = spark.createDataFrame(
        [(1, f"{own}, {item}! End.", "x"), (2, f"a {item} b", "y"), (3, own, "z"), (None, None, None)],
        "doc_id long, text string, items string",
    )
    bench = spark.createDataFrame([(1, item), (None, own), (2, None)], "item_id long, text string")
    left = {r.doc_id: r.text for r in without_spans(docs, bench).collect()}
    assert left == {1: f"{own}, ! End.", 3: own, None: None}
    assert {r.doc_id for r in without_contaminated(docs, bench).collect()} == {1, 3, None}
    nothing = find_contamination(docs, bench.limit(0)).collect()
    assert not any(r.n_hit for r in nothing) and len(nothing) == 4
    assert find_contamination(docs.limit(0), bench).count() == 0


def test_odd_rows_pass_decontamination(odd_docs, tables):
    found = without_contaminated(odd_docs, tables("benchmark"))
    assert found.columns == odd_docs.columns and found.count() == odd_docs.count()
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    row = find_contamination(odd_docs, tables("benchmark")).select(digest.alias("d")).first()
    assert row.d == hashlib.sha256(b"").hexdigest()
