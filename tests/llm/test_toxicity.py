"""The grammar against its transducers one after another, and held-out accuracy."""

import itertools
import random

import pytest

from viewloom.llm import toxicity

SF = "/root/testdata/sf0.01"
LEXICON = {"idiot$": 5.0, "schuf": 4.0, "schufter$": 0.5}


def test_composition_is_the_cascade():
    """The table of the composed machine and the transducers run one after another write the same."""
    events = {"insult": 0.1, "aimed": 0.7, "denied": -2.0, "reported": -1.0, "threat": 3.0}
    machine = toxicity.Machine({}, events)
    reported = {"insult": "reported", "aimed": "reported", "threat": "reported"}
    rng = random.Random(2)
    for _ in range(400):
        symbols = rng.choices(toxicity.SYMBOLS, k=rng.randint(1, 14))
        after = lambda at, opens, words: any(s == opens for s in symbols[max(0, at - words) : at])
        expected, said, quoted = [], False, False
        for at, s in enumerate(symbols):
            if s == "verb":
                s = "threat" if after(at, "will", 4) else "word"
            if s == "insult" and after(at, "target", 4):
                s = "aimed"
            if s in ("insult", "aimed", "threat") and after(at, "not", 3):
                s = "denied"
            if s in reported and (said or quoted):
                s = "reported"
            said, quoted = said or s == "say", quoted != (s == "quote")
            expected.append((s, events[s]) if s in events else (None, 0.0))
        state, got = 0, []
        for s in symbols:
            state, event, weight = machine.arcs[state][toxicity.SYMBOLS.index(s)]
            got.append((event, weight))
        assert got == expected
    pairs = itertools.pairwise((toxicity.weights({"a": 1.0}), toxicity.weights({"a": 2.0}), toxicity.weights({"b": 4.0})))
    assert [a.then(b).step((0, 0), "a")[2] for a, b in pairs] == [3.0, 2.0]


def test_clauses():
    machine = toxicity.Machine(LEXICON, {"insult": 0.0, "aimed": 1.0, "denied": -9.0, "reported": -1.0, "threat": 3.0})
    text = "You IDIOT. Nobody here. He is not an idiot; she said you are a Schufte!\nI will hurt them? Schufter hurt"
    words, found, kinds = machine.match(text)
    assert words == 21
    assert [(text[a:b], w) for a, b, w in found] == [("You IDIOT", 6.0), ("she said you are a Schufte", 3.0), ("I will hurt them", 3.0)]
    assert kinds == {"aimed": 1, "denied": 1, "reported": 1, "threat": 1}


def test_long_texts_in_pieces(monkeypatch):
    machine = toxicity.Machine(LEXICON, {})
    text = "The idiot went. " * 20 + "word " * 50 + "an idiot " * 30 + "x" * 300 + " idiot. end"
    whole = machine.match(text)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    words, found, kinds = machine.match(text)
    assert (words, kinds) == (whole[0], whole[2])
    assert sum(w for *_, w in found) == pytest.approx(sum(w for *_, w in whole[1]))


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in toxicity.op12_toxicity(spark, SF).collect()}
    assert len(found) == docs.count()
    held = [(found[r.doc_id], r.toxic) for r in labels.collect() if found[r.doc_id].held_out]
    toxic, clean = ([f for f, y in held if y == z] for z in (1, 0))
    assert len(toxic) > 10 and sum(f.predicted for f in toxic) >= 0.9 * len(toxic)
    assert sum(f.predicted for f in clean) <= 0.06 * len(clean)
    assert all(0 <= f.score <= 1 and f.predicted == (f.score >= 0.3) for f in found.values())


def test_labels_held_out_are_not_learned_from(spark, tmp_path):
    """Turning the held-out labels changes nothing."""
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs.limit(300).write.parquet(f"{tmp_path}/documents.parquet")
    score = lambda: {r.doc_id: r.score for r in toxicity.op12_toxicity(spark, str(tmp_path)).collect()}
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    before = score()
    labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    assert score() == before


def test_nulls_repeats_empty_and_clashes(spark):
    rows = [(1, "you idiot", 9, "k"), (1, "you idiot", 9, "k"), (None, None, 9, "k"), (2, "", 9, None), (3, "fine words", 9, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, k0 string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        found = toxicity.toxicity(docs, given, keep=["doc_id", "score", "k0"], spans=True).collect()
        assert sorted((r.doc_id or 0, r.k0 or "", r.n_words) for r in found) == sorted([(1, "k", 2), (1, "k", 2), (0, "k", 0), (2, "", 0), (3, "k", 2)])
        assert all(0 <= r.score <= 1 for r in found) and {len(r.clauses) for r in found if r.n_words == 0} == {0}
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.05}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
