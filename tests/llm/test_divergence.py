"""The audit of sources against a plain version."""

import random
import re
from collections import Counter, defaultdict

import pytest

from viewloom.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, prefix binary, blob string, value double, n int"


def plain(rows, least):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        per = {s: Counter({t: counts[lang, s][t] for t in kept}) for s in sources}
        whole = sum(per.values(), Counter())
        rates = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: rates(c) for s, c in per.items()}, rates(whole)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if per[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = ["the", "then", "thé", "日本", "日", "a", "ab", "abc", "Zoo", "zoo", "x", "naïve", "𝒳", *("w" * i for i in range(1, 9))]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))) + rng.choice(["", "!", "9x_y"]), rng.choice(["en", "en", "en", "de", None]), rng.choice(["s1", "s1", "s2", "é", None])) for _ in range(160)]
    return [*rows, *rows[:20], (None, "en", "s9"), ("", "fr", "only"), ("", "fr", "two"), (None, None, None)]


def table(spark, rows):
    return spark.createDataFrame([(i, *r, b"p", "b", 0.5, 7) for i, r in enumerate(rows)], SCHEMA).repartition(5)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least, entries, mb", [(3, 400_000, 16.0), (10, 60, 16.0), (3, 60, 0.0001)])
def test_source_audit(spark, monkeypatch, least, entries, mb):
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    rows = corpus()
    assert got(divergence.source_audit(table(spark, rows), least_docs=least, subtrie_mb=mb)) == plain(rows, least)


def test_nulls_empty_and_no_terms(spark):
    none = table(spark, [(None, None, None)])
    assert got(divergence.source_audit(none)) == []
    assert got(divergence.source_audit(none.limit(0))) == []
    rows = [("", "en", "a"), (None, "en", "b"), ("x", "en", "b")]
    assert got(divergence.source_audit(table(spark, rows))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_long_texts_in_pieces(monkeypatch):
    text = "Ab é12 xyzxyzxyz日日日 Q".encode() * 50
    whole = [w for x in divergence.terms_of(text) for w in x]
    for size in (1, 2, 7, 40):
        monkeypatch.setattr(divergence, "PIECE", size)
        assert [w for x in divergence.terms_of(text) for w in x] == whole
    assert b"xyzxyzxyz\xe6\x97\xa5\xe6\x97\xa5\xe6\x97\xa5" in whole


def test_tries_round_trip_and_merge():
    words = [b"a", b"ab", b"abc", b"abd", b"b", b"ba", b"\xc3\xa9"]
    rng = random.Random(1)
    parts = []
    for _ in range(4):
        sources = {s: Counter(rng.choices(words, k=5)) for s in (b"s", b"t")}
        parts.append(divergence.Trie.of(Counter(set().union(*sources.values())), sources))
    merged = divergence.Trie.merge([divergence.Trie.load(t.dump()) for t in parts])
    cut = [t for _, t in merged.cut(1)]
    again = divergence.Trie.merge([divergence.Trie.load(t.dump()) for t in cut])
    for trie in (merged, again):
        counts = {(trie.terms[i], trie.names[s]): n for i, s, n in zip(trie.leaf.tolist(), trie.source.tolist(), trie.count.tolist())}
        expected = Counter()
        for t in parts:
            for i, s, n in zip(t.leaf.tolist(), t.source.tolist(), t.count.tolist()):
                expected[t.terms[i], t.names[s]] += n
        assert counts == expected and trie.terms == sorted(trie.terms)
    assert merged.docs.sum() == sum(t.docs.sum() for t in parts)


def test_rates_of_large_counts():
    import numpy as np

    for count, whole in ((0, 3), (8_999_999_999_999_998, 9_000_000_000_000_000), (123_456_789_012_345, 8_765_432_109_876_543), (5, 7)):
        assert int(divergence.rate(np.array([count]), np.array([whole]))[0]) == 1 + 10**9 * (count + 2) // whole
