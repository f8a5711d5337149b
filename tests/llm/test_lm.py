"""Scores of the language model against a brute-force model of word pairs."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark import SparkContext

from viewloom.llm import lm

from . import brute

ROWS = brute.corpus(5, 90) + [(2000 + i, "red fox runs past a red fox " * (1 + i % 3)) for i in range(12)]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def scores(rows, least, base=1.5, mu=20.0):
    """(id, score) with counts of pairs seen least times or more, each as the middle of its level."""
    held = [lm.held_out(i) for i, _ in rows]
    toks = [[*brute.WORD.findall(brute.lower(t or "")), None] for _, t in rows]
    pairs = [list(zip([None, *some[:-1]], some)) for some in toks]  # None: the end
    count = Counter(x for h, some in zip(held, toks) if not h for x in some)
    seen = Counter(x for h, some in zip(held, pairs) if not h for x in some)
    n, v = sum(count.values()), len(count)

    def c(a, b):
        c = float(seen[a, b]) if seen[a, b] >= least else 0.0
        return min(float(lm.count_of(lm.level_of(np.array([c]), base), base)[0]) if c else 0.0, count[a], count[b])

    after = Counter()
    for a, b in seen:
        after[a] += c(a, b)

    def p(a, b):
        return (c(a, b) + mu * (count[b] + 0.5) / (n + 0.5 * (v + 1))) / (after[a] + mu)

    for a in [*list(count)[:20], "never seen"]:
        assert abs(sum(p(a, b) for b in [*count, "unknown"]) - 1) < 1e-9
    return [(i, sum(math.log10(p(a, b)) for a, b in some)) for (i, _), some in zip(rows, pairs)]


def near(found, want):
    order = lambda rows: sorted(((i is None, i or 0), round(s, 6)) for i, s in rows)
    return order(found) == order(want)


@pytest.mark.parametrize("rows_per_chunk", [8, 1024])
def test_score_keeps_every_level_and_gathers_no_model(spark, monkeypatch, rows_per_chunk):
    def broadcast(*_):
        raise AssertionError("the filter is gathered in one place")

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    found = lm.lm_scores(table(spark, ROWS), least_count=2, bits_per_item=80, rows_per_chunk=rows_per_chunk).collect()
    assert near([(r.doc_id, r.score) for r in found], scores(ROWS, 2))


def test_pairs_seen_once_count(spark):
    found = lm.lm_scores(table(spark, ROWS), bits_per_item=80).collect()
    assert near([(r.doc_id, r.score) for r in found], scores(ROWS, 1))
    assert not near([(r.doc_id, r.score) for r in found], scores(ROWS, 2))
