"""Forms: texts of slots that each have one of a few words, so that unlinked texts share many shingles."""

import random

import pytest

from viewloom.llm import jaccard

from . import brute


def forms(n, slots=60, fillers=2, seed=1):
    rng = random.Random(seed)
    words = [[f"s{i}f{k}" for k in range(fillers)] for i in range(slots)]
    return [(i, " ".join(rng.choice(w) for w in words)) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 2])
def test_forms_against_brute_force(spark, rounds):
    """Forms, copies of some with a slot or two changed, and chains of these."""
    rng = random.Random(3)
    rows = forms(60, 40)
    for i in range(60, 110):
        words = rows[rng.randrange(i)][1].split()
        words[rng.randrange(40)] = rng.choice(["x", "y"])
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard.jaccard_components(docs, k=1, percent=85, paired=3, rounds=rounds)
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute.jaccard(rows, 1, 85))
