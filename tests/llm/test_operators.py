"""The operators against brute force, and their edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.llm import blocks, bpe, jaccard, lm, media, mixing, suffix, warc

from . import brute

ROWS = brute.corpus()
order = lambda rows: sorted(rows, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS)


def table(spark, rows):
    extra = [(i, t, "en", f"s{(i or 0) % 3}" if (i or 0) % 5 else None, 1, 2, "x") for i, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, size int, node long, chunk string").repartition(3)


def got(df, *names):
    return order([tuple(r[n] for n in names) for r in df.collect()])


@pytest.mark.parametrize("rows_per_chunk", [8, 1024])
def test_suffix_dedup(docs, rows_per_chunk):
    found = suffix.suffix_dedup(docs, rows_per_chunk=rows_per_chunk)
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == order(brute.dedup(ROWS))


def test_text_key(spark):
    values = ["", "a", "É日本", "x" * 1000, "a b c d e f g h i j k l"]
    said = spark.createDataFrame([(v,) for v in values], "t string").select(F.xxhash64("t").alias("k")).collect()
    assert [r.k for r in said] == [jaccard.text_key(v.encode()) for v in values]


def test_suffix_dedup_spans(docs):
    found = suffix.suffix_dedup(docs, texts=True, rows_per_chunk=16).collect()
    for r in found:
        assert r.n_removed == sum(b - a for a, b in zip(r.span_starts, r.span_ends))
        assert len(r.kept) + r.n_removed == r.n_bytes


def test_previous_factors():
    """Against common prefixes with every suffix of every earlier document."""
    rng, size = np.random.default_rng(7), 13
    for _ in range(20):
        texts = [bytes(rng.integers(97, 99, rng.integers(size, 60), dtype=np.uint8)) for _ in range(rng.integers(1, 6))]
        data = b"".join(texts)
        at = np.cumsum([0, *map(len, texts)])
        starts = np.concatenate([np.arange(at[i], at[i + 1] - size + 1) for i in range(len(texts))])
        owner = np.searchsorted(at, starts, "right") - 1
        order, common = suffix.suffix_order(np.frombuffer(data, np.uint8), starts, size)
        strings = [data[s : s + size] for s in starts]
        assert [strings[i] for i in order] == sorted(strings)
        shared = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), size)
        want = [max((shared(s, t) for t, o in zip(strings, owner) if o < mine), default=0) for s, mine in zip(strings, owner)]
        for least in (1, 6, size):
            found = np.zeros(len(starts), int)
            found[order] = suffix.previous_factors(owner[order], common, least)
            assert found.tolist() == [w if w >= least else 0 for w in want]


def test_suffix_pieces(monkeypatch):
    text = bytes(np.random.default_rng(1).integers(97, 100, 5000, dtype=np.uint8))
    whole = [x.tolist() for x in suffix.runs([text, text[:70]], 50)]
    monkeypatch.setattr(suffix, "_PIECE", 300)
    cut = suffix.runs([text, text[:70]], 50)
    spread = lambda r: {(t, s + k): a for t, s, n, a in zip(*r) for k in range(n)}
    assert spread(whole) == spread([x.tolist() for x in cut])


@pytest.mark.parametrize("rows_per_chunk", [8, 1024])
def test_jaccard(docs, rows_per_chunk):
    for k, percent in ((4, 85), (5, 80)):
        found = jaccard.jaccard_components(docs, k=k, percent=percent, rows_per_chunk=rows_per_chunk)
        assert got(found, "doc_id", "n_shingles", "component_id") == order(brute.jaccard(ROWS, k, percent))


def near_copies(n=150, seed=4):
    """One text of 60 words n times, with up to six words changed or left out, and a chain of growing changes."""
    rng = random.Random(seed)
    first = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = list(first)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(words))
            words[at : at + 1] = [] if rng.random() < 0.3 else [rng.choice(["x", "y", f"new{i}", f"w{rng.randrange(60)}"])]
        rows.append((i, " ".join(words)))
    for i in range(40):
        rows.append((1000 + i, " ".join([f"z{j}" for j in range(i)] + first[i:])))
    return rows


@pytest.mark.parametrize("rounds,k,percent", [(2, 4, 85), (1, 2, 60)])
def test_jaccard_large_group(spark, rounds, k, percent):
    rows = near_copies()
    found = jaccard.jaccard_components(table(spark, rows), k=k, percent=percent, paired=2, rounds=rounds)
    assert got(found, "doc_id", "n_shingles", "component_id") == order(brute.jaccard(rows, k, percent))


def test_difference_prefix_keeps_links():
    """Two sets that are similar, not both to the head, share a prefix token of their differences with it."""
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        s = set(range(80)) - set(rng.integers(0, 80, rng.integers(0, 12)).tolist()) | set(rng.integers(80, 110, rng.integers(0, 10)).tolist())
        sets.append(np.array(sorted(s), np.uint64))
    levels = [np.ones(len(s), np.uint8) for s in sets]
    seen = 0
    for percent in (60, 80, 85, 95):
        for h in range(6):
            made = [jaccard.difference_prefix((sets[h], levels[h]), (s, v), percent) for s, v in zip(sets, levels)]
            assert [m[1] for m in made] == [jaccard.similar(sets[h], s, percent) for s in sets]
            for i, a in enumerate(made):
                for j, b in enumerate(made[:i]):
                    if not (a[1] and b[1]) and jaccard.similar(sets[i], sets[j], percent):
                        seen += 1
                        assert len(np.intersect1d(a[2], b[2]))
    assert seen > 100


@pytest.mark.parametrize("rows_per_chunk", [8, 1024])
def test_lm_base(docs, rows_per_chunk):
    found = lm.lm_scores(docs, rows_per_chunk=rows_per_chunk).collect()
    rounded = lambda r: (*r[:5], round(r[5], 6))
    assert order(rounded(r) for r in found) == order(rounded(r) for r in brute.lm_base(ROWS))
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_filter_tells_levels():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2))
    levels = rng.integers(1, 6, len(pairs))
    parts = {}
    for b in range(16):
        some = pairs >> np.uint64(60) == b
        parts[b] = lm.build_filter(pairs[some], levels[some], 8).tobytes()
    model = lm.Filter(parts, 16, 1.5, 1)
    said = model.levels(pairs)
    assert (said >= levels).all() and (said == levels).mean() > 0.95
    assert (model.levels(pairs + np.uint64(1)) > 0).mean() < 0.05


def test_long_texts_of_words(monkeypatch):
    texts = [b"one two three " * 50, b"", b"x" * 900 + b" end", b"Two words"]
    words, n = blocks.word_hashes(texts)
    monkeypatch.setattr(blocks, "_PIECE", 100)
    again, m = blocks.word_hashes(texts)
    assert (words == again).all() and (n == m).all() and n.tolist() == [150, 0, 2, 2]


@pytest.mark.parametrize("lexicon_words", [0, 50, 5000])
def test_bpe(spark, lexicon_words):
    odd = ["<|endoftext|>x<|startoftext|> <|end", "I'll we've ΑΣ İstanbul é é ﬁ ½ ٣ x y\u0085z​　ı", "a" * 500 + "b", "日本語" * 40, "it's 'S 't''d 12,34"]
    rows = [*ROWS, *[(9000 + i, t) for i, t in enumerate(odd)]]
    found = bpe.bpe_tokens(table(spark, rows), lexicon_words=lexicon_words)
    assert got(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == order(brute.bpe(rows, bpe.default_path()))


def test_bpe_encodes_distinct_pieces(monkeypatch):
    """Words are looked for once in each distinct piece between white space, and rare ones merged together."""
    v = bpe.Vocabulary(open(bpe.default_path(), encoding="utf-8").read())
    words = [b"e" * n for n in range(1, 90)] + ["größte".encode(), b"unfathomableness", b"x", b"!?!", b"\x1c\x1d"]
    assert v.merge_all(words) == [v.merge(w) for w in words] and v.merge_all([]) == []
    asked = []
    encoder = bpe.Encoder(v, bpe.Lexicon.build([], []))
    monkeypatch.setattr(v, "pattern", type("P", (), {"findall": lambda self, t, found=v.pattern.findall: asked.append(t) or found(t)})())
    texts = ["Same thing, again\u2003and again,\x1cand\x85 AGAIN  " * 50, "", " \n", "same<|endoftext|> thing<|STARTOFTEXT|>", "ΑΣ Ας é é"]
    encoder.encode(texts)
    assert len(asked) == len(set(asked)) < 20


def test_lexicon_shares_suffixes(tmp_path):
    words = sorted([b"walking", b"talking", b"walk", b"talk", b"", b"king"])
    made = bpe.Lexicon.build(words, [[i, i] for i in range(len(words))])
    made.save(f"file://{tmp_path}/x")
    back = bpe.Lexicon.open(f"file://{tmp_path}/x")
    assert back.find([*words, b"wal", b"walkings", b"z"]).tolist() == [*range(len(words)), -1, -1, -1]
    assert len(back.final) == 9  # the root, both stems merged from their second letter on, and king's own


def test_media(docs):
    found = media.media_columns(docs)
    assert got(found, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == order(brute.media(ROWS))
    by = {}
    for r in found.collect():
        assert r.width * r.height == r.payload_bytes and r.bit_depth == 8
        assert by.setdefault(r.payload_sha256, (r.media_bytes, r.media_sha256, r.feature, r.shard, r.offset)) == (r.media_bytes, r.media_sha256, r.feature, r.shard, r.offset)


def test_warc(spark):
    rows = [(i, None if t is None else f"<p>{t}</p>" if i and i % 3 else t) for i, t in ROWS]
    pages = spark.createDataFrame([(i, f"http://x/{i}", h, 1) for i, h in rows], "page_id long, url string, html string, archive int")
    for options in ({}, {"file_bytes": 3000, "sample_bytes": 2000}):
        found = warc.read_warc(*warc.write_warc(pages, **options))
        assert got(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == order(brute.warc(rows))


def test_mix(docs):
    found = mixing.mix_sources(docs, keep=["doc_id", "source", "size"]).collect()
    size = sum(r.size for r in found)
    by = {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        s = by.setdefault(r.source, [0, r.source_size, r.target, 0, 0])
        s[0], s[3], s[4] = s[0] + r.size, s[3] + r.taken, max(s[4], r.size)
    assert abs(sum(s[2] for s in by.values()) - 1.5 * size) < 1e-6 * size
    for own, source_size, target, taken, largest in by.values():
        assert own == source_size and target <= 2 * own + 1e-9 and abs(taken - target) <= largest
    again = mixing.mix_sources(docs.repartition(7), keep=["doc_id", "source"]).collect()
    assert order((r.doc_id, r.size, r.taken) for r in found) == order((r.doc_id, r.size, r.taken) for r in again)


def test_mix_weights(spark):
    """A column of weights decides what the last epoch takes; bad weights count as 1."""
    d = spark.createDataFrame([(i, "a b c", "s", [100.0, 1e-3, None, -1.0, float("nan")][i % 5]) for i in range(500)], "doc_id long, text string, source string, u double")
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(d, quality="u", share=0.3).collect()}
    rate = [sum(taken[i] > 0 for i in range(k, 500, 5)) / 100 for k in range(5)]
    assert abs(sum(taken.values()) - 0.3 * 1500) <= 3 and rate[0] > 0.95 and rate[1] < 0.05 and 0.05 < min(rate[2:])


def test_warc_reads_archives_apart(spark):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(40)], "page_id long, url string, html string")
    found = warc.read_warc(*warc.write_warc(pages.repartition(8, "page_id"), file_bytes=200, sample_bytes=100))
    assert found.select("archive").distinct().count() > 10 and found.rdd.getNumPartitions() > 10


@pytest.mark.parametrize("run", [
    lambda d: suffix.suffix_dedup(d), lambda d: jaccard.jaccard_components(d), lambda d: lm.lm_scores(d), lambda d: bpe.bpe_tokens(d),
    lambda d: media.media_columns(d), lambda d: mixing.mix_sources(d),
    lambda d: warc.read_warc(*warc.write_warc(d.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html")))),
])
def test_empty(spark, run):
    assert run(table(spark, ROWS).limit(0)).collect() == []


@pytest.mark.parametrize("run", [
    lambda d: suffix.suffix_dedup(d), lambda d: jaccard.jaccard_components(d), lambda d: lm.lm_scores(d), lambda d: bpe.bpe_tokens(d),
    lambda d: media.media_columns(d), lambda d: mixing.mix_sources(d),
])
def test_all_null(spark, run):
    d = spark.createDataFrame([(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    assert len(run(d).collect()) == 3
