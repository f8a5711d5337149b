"""Divergence of sources: how far the term rates of each source are from those of the others and of its language.

Tasks count terms in byte tries: per language a radix trie whose leaves hold the documents that have the term and a
counter for each source.  A trie is cut by its first bytes; the subtries of a prefix meet in one task and merge.  A
prefix whose subtries are too large together is cut by longer prefixes first, so no task holds more than a bounded
range of terms, whatever the vocabulary.  Leaves of too few documents fall away there.  The merged subtries are walked
in the order of UTF-8: their leaves give the sums for pairs of sources, and each source's best terms so far.

All arithmetic is on whole numbers.  Rates are digits of a long division, so counts up to 9 * 10^15 are exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .blocks import LOWER, dump, load, record

TERM = re.compile(rb"[a-z\x80-\xff]+")
OTHER = re.compile(rb"[^A-Za-z\x80-\xff]")
PIECE = 4 << 20
ENTRIES = 400_000
SUBTRIE = "lang string, prefix binary, size long, blob binary"
KEPT = "lang string, prefix binary, kept long, blob binary"
PARTIAL = "lang string, source string, item string, term boolean, value long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z lower-cased, a list for each piece of a few MB; pieces end where no term goes on."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = OTHER.search(text, end)
            end = cut.start() if cut else len(text)
        yield TERM.findall(text[at:end].translate(LOWER))
        at = end


def shared_bytes(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


class Trie:
    """A radix trie in the order of a walk over its leaves: each leaf branches off the path of the one before.

    terms: sorted; docs: documents of each; leaf, source, count: the counters, ordered by leaf and source; names:
    the sources, sorted.
    """

    def __init__(self, terms: list[bytes], docs: np.ndarray, leaf: np.ndarray, source: np.ndarray, count: np.ndarray, names: list[bytes]):
        self.terms, self.docs, self.leaf, self.source, self.count, self.names = terms, docs, leaf, source, count, names

    @classmethod
    def of(cls, docs: Counter, sources: dict[bytes, Counter]) -> Trie:
        terms, names = sorted(docs), sorted(sources)
        number = {t: i for i, t in enumerate(terms)}
        leaf = [np.fromiter((number[t] for t in sources[s]), np.int64, len(sources[s])) for s in names]
        count = [np.fromiter(sources[s].values(), np.int64, len(sources[s])) for s in names]
        source = [np.full(len(x), i, np.int64) for i, x in enumerate(leaf)]
        leaf, source, count = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (leaf, source, count))
        order = np.lexsort((source, leaf))
        return cls(terms, np.fromiter((docs[t] for t in terms), np.int64, len(terms)), leaf[order], source[order], count[order], names)

    def subtrie(self, a: int, b: int) -> Trie:
        """The leaves a to b - 1."""
        i, j = np.searchsorted(self.leaf, [a, b])
        return Trie(self.terms[a:b], self.docs[a:b], self.leaf[i:j] - a, self.source[i:j], self.count[i:j], self.names)

    def cut(self, depth: int) -> Iterator[tuple[bytes, Trie]]:
        """Subtries by the first depth bytes of their terms."""
        at = 0
        while at < len(self.terms):
            prefix, end = self.terms[at][:depth], at + 1
            while end < len(self.terms) and self.terms[end].startswith(prefix) and len(prefix) == depth:
                end += 1
            yield prefix, self.subtrie(at, end)
            at = end

    def dump(self) -> bytes:
        shared = np.array([0, *map(shared_bytes, self.terms, self.terms[1:])][: len(self.terms)], np.int64)
        edges = [t[n:] for t, n in zip(self.terms, shared.tolist())]
        bodies = [np.frombuffer(b"".join(x), np.uint8) for x in (edges, self.names)]
        sizes = [np.array([len(x) for x in xs], np.int64) for xs in (edges, self.names)]
        return dump(shared, sizes[0], bodies[0], self.docs, np.diff(self.leaf, prepend=0), self.source, self.count, sizes[1], bodies[1])

    @classmethod
    def load(cls, blob: bytes) -> Trie:
        shared, sizes, body, docs, steps, source, count, name_sizes, name_body = load(blob)
        terms, path, ends = [], b"", np.cumsum(sizes).tolist()
        body = body.tobytes()
        for keep, n, end in zip(shared.tolist(), sizes.tolist(), ends):
            path = path[:keep] + body[end - n : end]
            terms.append(path)
        ends, name_body = np.cumsum(name_sizes).tolist(), name_body.tobytes()
        names = [name_body[e - n : e] for e, n in zip(ends, name_sizes.tolist())]
        return cls(terms, docs, np.cumsum(steps), source, count, names)

    @classmethod
    def merge(cls, tries: list[Trie], least: int = 0) -> Trie:
        """One trie of several; leaves of fewer than least documents fall away."""
        docs: Counter = Counter()
        for t in tries:
            for term, n in zip(t.terms, t.docs.tolist()):
                docs[term] += n
        terms = sorted(t for t, n in docs.items() if n >= least)
        names = sorted(set().union(*(t.names for t in tries)))
        number, place = {t: i for i, t in enumerate(terms)}, {s: i for i, s in enumerate(names)}
        parts = []
        for t in tries:
            to = np.array([number.get(x, -1) for x in t.terms], np.int64)[t.leaf]
            source = np.array([place[s] for s in t.names], np.int64)[t.source]
            parts.append((to[to >= 0] * len(names) + source[to >= 0], t.count[to >= 0]))
        key, count = (np.concatenate(x) for x in zip(*parts))
        key, back = np.unique(key, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, count)
        wide = max(1, len(names))
        return cls(terms, np.array([docs[t] for t in terms], np.int64), key // wide, key % wide, total, names)


def _counted(depth: int):
    """Subtries of what a task counts, at each ENTRIES counters or when the task ends."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, dict[bytes, Counter]]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (docs, sources) in held.items():
                rows = [(lang, p, t.dump()) for p, t in Trie.of(docs, sources).cut(depth)]
                if rows:
                    langs, prefixes, blobs = zip(*rows)
                    yield from record(SUBTRIE, langs, prefixes, [len(b) for b in blobs], blobs).to_batches()
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), common.binary_values(batch.column(1)), common.binary_values(batch.column(2))):
                docs, sources = held.setdefault(lang, (Counter(), {}))
                count, seen = sources.setdefault(source, Counter()), set()
                for terms in terms_of(text):
                    count.update(terms)
                    seen.update(terms)
                docs.update(seen)
            if sum(len(d) + sum(map(len, s.values())) for d, s in held.values()) > ENTRIES:
                yield from out()
        yield from out()

    return counted


def _deeper(depth: int):
    def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
                prefixes, blobs = zip(*[(p, t.dump()) for p, t in Trie.load(blob).cut(depth)])
                yield from record(SUBTRIE, [lang] * len(blobs), prefixes, [len(b) for b in blobs], blobs).to_batches()

    return deeper


def _merged(least: int):
    """The merged subtrie of each (lang, prefix); its rows follow one another."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            trie = Trie.merge(held, least) if held else None
            if trie and trie.terms:
                yield from record(KEPT, [key[0]], [key[1]], [len(trie.terms)], [trie.dump()]).to_batches()

        for batch in batches:
            for lang, prefix, blob in zip(*(batch.column(c).to_pylist() for c in ("lang", "prefix", "blob"))):
                if (lang, prefix) != key:
                    yield from out()
                    key, held, size = (lang, prefix), [], 0
                held.append(Trie.load(blob))
                size += len(held[-1].terms)
                if len(held) > 1 and size > ENTRIES:
                    held = [Trie.merge(held)]
                    size = len(held[0].terms)
        yield from out()

    return merged


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist()):
            trie = Trie.load(blob)
            for i, name in enumerate(trie.names):
                total[lang, name.decode()] += int(trie.count[trie.source == i].sum())
    langs, sources = zip(*total) if total else ([], [])
    yield from record("lang string, source string, n long", langs, sources, list(total.values())).to_batches()


def rate(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / whole), for count + 2 <= whole, by three digits of base 1000."""
    rest, out = count + 2, 0
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return 1 + out


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


CELLS = 1 << 20


def pair_sums(p: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each column of rates, its gaps to the later columns, summed over the rows."""
    rows = max(1, CELLS // max(1, p.shape[1]))
    for a in range(p.shape[1] - 1):
        yield a, sum(gap(p[i : i + rows, a : a + 1], p[i : i + rows, a + 1 :]).sum(axis=0) for i in range(0, len(p), rows))


def _audited(best: int):
    """Sums of pairs of sources, and each source's best terms, of the subtries of a task."""

    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: Counter = Counter()
        top: dict[tuple[str, str], list[tuple[int, bytes]]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            if pairs:
                langs, a, b = zip(*pairs)
                yield from record(PARTIAL, langs, a, b, [False] * len(pairs), list(pairs.values())).to_batches()
                pairs.clear()

        for batch in batches:
            for lang, kept, whole, sources, sizes, blob in zip(*(batch.column(c).to_pylist() for c in ("lang", "v", "n", "sources", "sizes", "blob"))):
                trie = Trie.load(blob)
                place = {s.encode(): i for i, s in enumerate(sources)}
                column = np.array([place[s] for s in trie.names], np.int64)[trie.source]
                under = np.array(sizes, np.int64) + 2 * kept
                rows = max(1, CELLS // len(sources))
                for first in range(0, len(trie.terms), rows):
                    last = min(len(trie.terms), first + rows)
                    i, j = np.searchsorted(trie.leaf, [first, last])
                    count = np.zeros((last - first, len(sources)), np.int64)
                    count[trie.leaf[i:j] - first, column[i:j]] = trie.count[i:j]
                    p, q = rate(count, under), rate(count.sum(axis=1), np.int64(whole + 2 * kept))[:, None]
                    for a, values in pair_sums(p):
                        for b, value in enumerate(values.tolist(), a + 1):
                            pairs[lang, sources[a], sources[b]] += value
                        if len(pairs) > CELLS:
                            yield from out()
                    value = np.where((count > 0) & (p > q), gap(p, q), -1)
                    for a in np.flatnonzero(value.max(axis=0, initial=-1) >= 0).tolist():
                        # leaves come in the order of UTF-8 and the sort is stable, so ties stay in it
                        order = np.argsort(-value[:, a], kind="stable")[:best]
                        found = [(-int(value[x, a]), trie.terms[first + x]) for x in order.tolist() if value[x, a] >= 0]
                        top[lang, sources[a]] = sorted(top.get((lang, sources[a]), []) + found)[:best]
        yield from out()
        rows = [(lang, source, term.decode(), True, -value) for (lang, source), found in top.items() for value, term in found]
        if rows:
            yield from record(PARTIAL, *zip(*rows)).to_batches()

    return audited


def source_audit(docs: DataFrame, *, text_col="text", lang_col="lang", source_col="source", least_docs: int = 10, best: int = 10, subtrie_mb: float = 16.0) -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs.

    A term is a run of letters and characters beyond ASCII, A-Z lower-cased; a language keeps those of least_docs of
    its documents.  A source's rate of a term is 1 + floor(10^9 (count + 2) / (N + 2 V)), for N occurrences of the V
    kept terms, a language's likewise; the gap of two rates is floor((p - q)^2 / (p + q)).  part pair: item is each
    other source of the language, value the gaps summed over the kept terms.  part term: the ``best`` terms of the
    source whose rate is above the language's, by the gap to that.  rank counts from 1 by falling value, ties by item
    in the order of UTF-8.

    Null texts, languages and sources are empty ones.  A source without kept terms has pairs, with value 0 where its
    language keeps none; a language of one source has no pairs.  Repeated rows count each, texts of any length are
    read in pieces, an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    depth = 2
    tries = common.stash(rows.mapInArrow(_counted(depth), SUBTRIE), "tries")
    whole = tries.limit(0)
    while True:
        sizes = tries.groupBy("lang", "prefix").agg(F.sum("size").alias("all")).where((F.col("all") > subtrie_mb * 1e6) & (F.length("prefix") == depth))
        sizes = common.stash(sizes.select("lang", "prefix"), "large-prefixes")
        if sizes.isEmpty():
            break
        whole = whole.unionByName(tries.join(sizes, ["lang", "prefix"], "left_anti"))
        depth += 2
        tries = common.stash(tries.join(sizes, ["lang", "prefix"], "left_semi").mapInArrow(_deeper(depth), SUBTRIE), "tries")
    tries = whole.unionByName(tries)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), common.parts(tries, 16.0))
    dealt = tries.repartition(n, "lang", "prefix").sortWithinPartitions("lang", "prefix")
    kept = common.stash(dealt.mapInArrow(_merged(least_docs), KEPT), "kept")

    counted = kept.mapInArrow(_sums, "lang string, source string, n long").groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = rows.select("lang", "source").distinct().join(counted, ["lang", "source"], "left").fillna(0, ["n"])
    listed = F.sort_array(F.collect_list(F.struct("source", "n")))
    langs = groups.groupBy("lang").agg(listed.alias("all"), F.sum("n").alias("n"))
    langs = langs.join(kept.groupBy("lang").agg(F.sum("kept").alias("v")), "lang", "left")
    langs = common.stash(langs.select("lang", "n", "v", F.col("all.source").alias("sources"), F.col("all.n").alias("sizes")), "languages")
    # a language's sources go to several places, so that its subtries do
    spread = langs.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    walked = kept.withColumn("at", F.pmod(F.xxhash64("prefix"), F.lit(n)).cast("int")).join(spread, ["lang", "at"])
    found = common.stash(walked.select("lang", "v", "n", "sources", "sizes", "blob").mapInArrow(_audited(best), PARTIAL), "gaps")

    sums = found.where(~F.col("term")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = langs.select("lang", "sources", F.explode("sources").alias("source")).select("lang", "source", F.explode("sources").alias("item")).where("source <> item")
    pairs = pairs.join(turned, ["lang", "source", "item"], "left").fillna(0, ["value"]).withColumn("part", F.lit("pair"))
    terms = found.where("term").select("lang", "source", "item", "value", F.lit("term").alias("part"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.select(terms.columns).unionByName(terms).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= best)).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return source_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS all_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*) AS v, sum(all_n) AS n FROM kept GROUP BY lang),
sizes AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
rates AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * z.v) AS p,
    1 + (1000000000::HUGEINT * (k.all_n + 2)) // (z.n + 2 * z.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN size z USING (lang) LEFT JOIN sizes s USING (lang, source)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM rates WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10"""
