import collections
import random
import re

import numpy as np
import pytest

from contentloom.llm import phrases
from contentloom.llm.phrases import PhraseSettings, borders, carried, collocations, merged


def plain(rows, most=3, least=10, top=2000, percent=50, scale=1_000_000):
    """rows of (text, lang) by the definition, with dictionaries."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        good = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in good.items():
            inside = any(
                len(q) > len(p)
                and 100 * c >= percent * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, c in good.items()
            )
            if inside:
                continue
            cuts = [(scale * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(seed, n=150):
    pick = random.Random(seed)
    common = ["the", "New", "york", "city", "of", "\x01", "a", "a\x01", "é", "漢字", "x-y", "'"]
    rows = []
    for _ in range(n):
        words = [pick.choice(common) if pick.random() < 0.8 else f"r{pick.randrange(300)}" for _ in range(pick.randrange(80))]
        signs = [pick.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!? "]) for _ in words]
        rows.append(("".join(w + s for w, s in zip(words, signs)), pick.choice(["en", "en", None, "de", "und"])))
    return rows


def frame(spark, rows, parts=3):
    rows = [(i % 50, t, lang, "x") for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, N string").repartition(parts)


@pytest.mark.parametrize(
    "settings",
    [
        PhraseSettings(),
        PhraseSettings(per_part=9, per_merge=2),
        PhraseSettings(most_words=4, least=5, per_part=25),
        PhraseSettings(most_words=2, least=3, top=7, per_part=40, per_merge=1),
        PhraseSettings(inside_percent=80, top=30, per_part=15),
    ],
)
def test_phrases_by_definition(spark, settings):
    s = settings
    rows = texts(1)
    found = sorted(map(tuple, collocations(frame(spark, rows), s).collect()))
    assert found == plain(rows, s.most_words, s.least, s.top, s.inside_percent)
    assert found


def test_texts_counted_in_parts(spark, monkeypatch):
    rows = texts(2, 60)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 7)
    monkeypatch.setattr(phrases, "CUT_BYTES", 16)
    monkeypatch.setattr(phrases, "TEXT_BYTES", 100)
    found = sorted(map(tuple, collocations(frame(spark, rows)).collect()))
    assert found == plain(rows)


def test_one_frequent_word_over_many_tasks(spark):
    """Phrases that begin or end with one word fill several tasks; a cut inside them loses nothing."""
    rows = [(f"hot {i % 40} hot hot x{i % 30}", "en") for i in range(1200)]
    s = PhraseSettings(per_part=6, per_merge=3)
    assert sorted(map(tuple, collocations(frame(spark, rows), s).collect())) == plain(rows)


def test_scores_are_exact_beyond_64_bits():
    """Counts of 10^13 as the lockstep pass hands them on."""
    length, n = np.array([0, 1, 2, 3, 1]), np.array([10**14, 10**13, 10**13 - 1, 10**12, 5])
    shorter, longer = merged(length, n, 3, [0] * 4, [0, 0, 0, 0])
    assert shorter[3].tolist() == [10**14, 10**13, 10**13 - 1]
    assert longer.tolist()[:3] == [10**13, 10**13 - 1, 10**12]


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = texts(5)
    small = PhraseSettings(most_words=4, least=4, filter_bytes=phrases.SEGMENT)
    monkeypatch.setattr(phrases.Filter, "may_have", lambda self, hashes: hashes == hashes)
    assert sorted(map(tuple, collocations(frame(spark, rows), small).collect())) == plain(rows, 4, 4)


def test_a_filter_has_all_that_went_in(spark):
    words = [(b"w%d x%d " % (i, i % 7),) for i in range(3000)]
    counts = spark.createDataFrame([*words, (b"single ",), (b"",)], "phrase binary").repartition(5)
    known = phrases.Filter.of(counts, 2, PhraseSettings())

    def sums(pairs):
        first, second = zip(*[[w + b" " for w in p.split()] for p in pairs])
        return phrases.chained_on(phrases.hashed_words(first), phrases.hashed_words(second))

    assert known.may_have(sums([w for w, in words])).all()
    assert known.may_have(sums([b"y%d x " % i for i in range(3000)])).mean() < 0.1


@pytest.mark.parametrize("cuts", [[], [1], [2, 3, 4], [5, 9], list(range(1, 12))])
def test_cuts_change_nothing(cuts):
    length = np.array([0, 1, 2, 3, 3, 2, 3, 1, 2, 0, 1, 2])
    n = np.array([99, 50, 30, 7, 20, 19, 11, 12, 10, 40, 40, 13])
    whole = merged(length, n, 3, [0] * 4, [0] * 4)
    parts = [slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(n)])]
    over = carried({p: borders(length[c], n[c], 3) for p, c in enumerate(parts)}, 3)
    got = [merged(length[c], n[c], 3, *over[p]) for p, c in enumerate(parts)]
    assert np.concatenate([g[1] for g in got]).tolist() == whole[1].tolist()
    for k in range(3):
        own = length > k
        assert np.concatenate([g[0] for g in got])[own, k].tolist() == whole[0][own, k].tolist()


def test_phrases_of_odd_rows(odd_docs, no_docs, spark):
    assert collocations(odd_docs).count() == 0
    assert collocations(no_docs).count() == 0
    few = PhraseSettings(least=2)
    found = {r.phrase for r in collocations(odd_docs, few).where("lang = 'und'").collect()}
    assert {"a b c", "c d e"} <= found and "a b" not in found
    long = " ".join(["tick tock"] * 200_000)
    rows = [(1, long, None), (1, None, "en"), (None, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, collocations(docs).collect())) == plain([(long, None)])
