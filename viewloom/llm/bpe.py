"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The frequent words of the corpus are encoded once and compiled into a shared-suffix automaton, numbered by the words
before them; the number leads to the word's ids.  The automaton is one file in the shared folder, mapped by the
workers.  Words that it does not have are merged pair by pair, lowest rank first, all words of a slice together.  No
word crosses white space, so what stands between is encoded and decoded once and remembered for a while.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .blocks import record

OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
LEXICON_WORDS = 32768
MEMO_WORDS = 400_000
#: Longest word, in bytes, that is merged together with others.
TOGETHER = 40


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as it is, the others from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merges, pattern and special tokens of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {str(i): t for t, i in [*self.ids.items(), *self.special.items()]}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.base = max(self.ids.values()) + 1
        keys = np.array([a * self.base + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_key = keys[order]
        self.pair_rank = np.array([r for r, _ in self.merges.values()], np.int32)[order]
        self.made = np.zeros(len(model["merges"]), np.int32)
        self.made[self.pair_rank] = np.array([i for _, i in self.merges.values()], np.int32)[order]
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.suffix] for c in letters]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"], regex.V0)
        self.blank = regex.compile(r"[^\S\x00-\x7F]", regex.V0)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))

    def merge(self, word: bytes) -> list[int]:
        """The word's ids: merges the lowest-ranked neighbouring pair, the leftmost of equals, until none is known."""
        ids = [self.inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        merges = self.merges
        if len(ids) > TOGETHER:
            return self._merge_long(ids)
        while len(ids) > 1:
            best, at = None, -1
            for i in range(len(ids) - 1):
                m = merges.get((ids[i], ids[i + 1]))
                if m is not None and (best is None or m[0] < best[0]):
                    best, at = m, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for words of any length."""
        n, merges = len(ids), self.merges
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], alive[j], right[i] = new, False, right[j]
            if right[j] < n:
                left[right[j]] = i
            for x in (left[i], i):
                y = right[x] if x >= 0 else n
                if x >= 0 and y < n and (m := merges.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, m[1], ids[x], ids[y]))
        return [x for x, keep in zip(ids, alive) if keep]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, the largest number where it is none."""
        key = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (a >= 0) & (b >= 0), self.pair_rank[at], np.iinfo(np.int32).max)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """merge of each word; those of similar length take each step together, a row each."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero((sizes > TOGETHER) | (not len(self.pair_key))).tolist():
            out[i] = self.merge(words[i])
        least = 0
        for most in (4, 8, 12, 16, 24, TOGETHER) if len(self.pair_key) else ():
            rows = np.flatnonzero((sizes > least) & (sizes <= most))
            least = most
            if not len(rows):
                continue
            n = sizes[rows]
            body = np.frombuffer(b"".join([words[i].ljust(most, b"\0") for i in rows.tolist()]), np.uint8).reshape(-1, most)
            ids = np.where(np.arange(most) < n[:, None], np.array(self.inner, np.int32)[body], np.int32(-1))
            ids[np.arange(len(rows)), n - 1] = np.array(self.last, np.int32)[body[np.arange(len(rows)), n - 1]]
            rank = self._ranks(ids[:, :-1], ids[:, 1:])
            while len(rows):
                # the leftmost of equals; a merge shortens every row that is left by one
                best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
                low = rank[np.arange(len(rows)), best] if rank.shape[1] else np.full(len(rows), np.iinfo(np.int32).max)
                more = low < np.iinfo(np.int32).max
                for i, row in zip(rows[~more].tolist(), ids[~more].tolist()):
                    out[i] = row[: row.index(-1)] if row[-1] < 0 else row
                rows, ids, rank, best, low = rows[more], ids[more], rank[more], best[more], low[more]
                if not len(rows):
                    break
                every, width = np.arange(len(rows)), ids.shape[1] - 1
                ids[every, best] = self.made[low]
                at = np.arange(width)
                ids = np.where(at > best[:, None], ids[:, 1:], ids[:, :-1])
                at = np.arange(width - 1)
                rank = np.where(at > best[:, None], rank[:, 1:], rank[:, :-1])
                after = best < width - 1
                rank[every[after], best[after]] = self._ranks(ids[every[after], best[after]], ids[every[after], best[after] + 1])
                before = best > 0
                rank[every[before], best[before] - 1] = self._ranks(ids[every[before], best[before] - 1], ids[every[before], best[before]])
        return out

    def parts(self, text: str) -> list[tuple[bool, str]]:
        """Whether it is a special token, and the text, of each part of a text with such tokens."""
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [(False, text[at : m.start()]), (True, m.group())]
            at = m.end()
        return [*out, (False, text[at:])]

    def pieces(self, texts: list[str]) -> pa.ListArray:
        """What stands between white space in each normalised text, special tokens not looked for; one empty piece if nothing."""
        plain = [t.lower() if t.isascii() else self.blank.sub(" ", unicodedata.normalize("NFC", t).replace("Σ", "σ").lower()) for t in texts]
        return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pa.array(plain, pa.string())))

    def special_at(self, texts: list[str]) -> list[int]:
        return [i for i, t in enumerate(texts) if "<|" in t and self.cut.search(t)]


class Lexicon:
    """A minimal acyclic automaton over sorted byte strings; a word's number is how many words stand before it."""

    FIELDS = (("key", np.uint64), ("target", np.uint32), ("skip", np.uint32), ("final", np.uint8), ("at", np.uint32), ("ids", np.uint32))

    def __init__(self, **arrays):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: list[bytes], ids: list[list[int]]) -> Lexicon:
        """words sorted and distinct.  States with equal finality and transitions are one (Daciuk's incremental rule)."""
        known: dict[tuple, int] = {}
        states: list[tuple] = []

        def settle(node) -> int:
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            return known[key]

        path, last = [[False, []]], b""
        for word in words:
            common_part = 0
            while common_part < min(len(word), len(last)) and word[common_part] == last[common_part]:
                common_part += 1
            while len(path) > common_part + 1:
                done = path.pop()
                path[-1][1][-1] = (path[-1][1][-1][0], settle(done))
            for b in word[common_part:]:
                path[-1][1].append((b, -1))
                path.append([False, []])
            path[-1][0], last = True, word
        while len(path) > 1:
            done = path.pop()
            path[-1][1][-1] = (path[-1][1][-1][0], settle(done))
        settle(path[0])

        below = []
        key, target, skip = [], [], []
        for number, (final, arcs) in enumerate(states):
            n = int(final)
            for b, t in arcs:
                key.append(number << 8 | b)
                target.append(t)
                skip.append(n)
                n += below[t]
            below.append(n)
        sizes = np.array([len(x) for x in ids], np.uint32)
        return cls(key=np.array(key, np.uint64), target=np.array(target, np.uint32), skip=np.array(skip, np.uint32), final=np.array([s[0] for s in states], np.uint8), at=np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint32), ids=np.array([i for x in ids for i in x], np.uint32))

    def save(self, uri: str) -> None:
        fs, path = common.open_fs(uri)
        with fs.open_output_stream(path) as out:
            out.write(np.array([len(getattr(self, n)) for n, _ in self.FIELDS], np.uint64).tobytes())
            for n, kind in self.FIELDS:
                data = np.ascontiguousarray(getattr(self, n), kind).tobytes()
                out.write(data + bytes(-len(data) % 8))

    @classmethod
    def open(cls, uri: str) -> Lexicon:
        """Map the file; where the shared folder is no file system of the machine, read it."""
        from pyarrow import fs as arrow_fs

        fs, path = common.open_fs(uri)
        if isinstance(fs, arrow_fs.LocalFileSystem):
            data = np.asarray(np.memmap(path, np.uint8, "r"))
        else:
            with fs.open_input_file(path) as file:
                data = np.frombuffer(file.read(), np.uint8)
        sizes, at, arrays = data[: 8 * len(cls.FIELDS)].view(np.uint64), 8 * len(cls.FIELDS), {}
        for (n, kind), size in zip(cls.FIELDS, sizes.tolist()):
            width = int(size) * np.dtype(kind).itemsize
            arrays[n] = data[at : at + width].view(kind)
            at += width + -width % 8
        return cls(**arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, or -1; all words walk the automaton together, a byte at a time."""
        n = np.array([len(w) for w in words], np.int64)
        body = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(n) - n
        out = np.full(len(words), -1, np.int64)
        if not len(self.key):
            return out
        live, state, number = np.arange(len(words)), np.full(len(words), len(self.final) - 1, np.int64), np.zeros(len(words), np.int64)
        for step in range(int(n.max(initial=0)) + 1):
            ended = n[live] == step
            done = ended & (self.final[state] > 0)
            out[live[done]] = number[done]
            live, state, number = live[~ended], state[~ended], number[~ended]
            if not len(live):
                break
            want = state.astype(np.uint64) << np.uint64(8) | body[start[live] + step].astype(np.uint64)
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[at] == want
            live, at, number = live[hit], at[hit], number[hit]
            state, number = self.target[at].astype(np.int64), number + self.skip[at]
        return out


class Encoder:
    """Encodes pieces of texts through the lexicon, else by merging; keeps what it has seen, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.memo: dict[str, tuple[str, str]] = {}

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Each text's ids in decimal, joined by a space, and what they decode to."""
        special = self.vocabulary.special_at(texts)
        return self._with_special(texts, set(special)) if special else self._plain(texts)

    def _plain(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        pieces = self.vocabulary.pieces(texts)
        coded = pieces.flatten().dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        whole = []
        for i in (0, 1):
            strings = pa.array([k[i] for k in known], pa.string()).take(coded.indices)
            joined = pc.binary_join(pa.ListArray.from_arrays(pieces.offsets, strings), " ")
            whole.append(joined.cast(pa.binary()).to_pylist())
        return tuple(whole)

    def _with_special(self, texts: list[str], special: set[int]) -> tuple[list[bytes], list[bytes]]:
        """The same where some texts hold special tokens: their parts are encoded as texts."""
        v = self.vocabulary
        cut = [v.parts(t) if i in special else [(False, t)] for i, t in enumerate(texts)]
        plain = zip(*self._plain([t for parts in cut for own, t in parts if not own]))
        rows = [[(b"%d" % v.special[t], t.encode()) if own else next(plain) for own, t in parts] for parts in cut]
        return tuple([b" ".join([p[i] for p in parts if p[0]]) for parts in rows] for i in (0, 1))

    def _known(self, pieces: list[str]) -> list[tuple[str, str]]:
        """Ids and decoded text of each piece."""
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        memo = self.memo
        new = [p for p in pieces if p not in memo]
        split = [self.vocabulary.pattern.findall(p) for p in new]
        known = self._words({w for words in split for w in words})
        for piece, words in zip(new, split):
            ids = " ".join([known[w] for w in words])
            memo[piece] = (ids, self.decode(ids))
        return [memo[p] for p in pieces]

    def _words(self, words: set[str]) -> dict[str, str]:
        """The ids of each word."""
        words = list(words)
        data = [w.encode() for w in words]
        if not words:
            return {}
        at, ids = self.lexicon.at, self.lexicon.ids
        numbers = self.lexicon.find(data).tolist()
        merged = iter(self.vocabulary.merge_all([d for d, i in zip(data, numbers) if i < 0]))
        return {w: " ".join(map(str, ids[at[i] : at[i + 1]].tolist() if i >= 0 else next(merged))) for w, i in zip(words, numbers)}

    def decode(self, ids: str) -> str:
        """The tokens of decimal ids, joined by a space."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in ids.split(" ")]) if ids else ""


def _count(vocabulary):
    schema = pa.schema([("piece", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, seen, held = vocabulary.value, [], 0

        def out():
            words = Counter()
            found = pa.Table.from_batches(seen, schema).group_by("piece").aggregate([("n", "sum")])
            for piece, n in zip(found.column("piece").to_pylist(), found.column("n_sum").to_pylist()):
                for word in v.pattern.findall(piece):
                    words[word] += n
            yield from record("word string, n long", list(words), list(words.values())).to_batches(max_chunksize=50_000)
            seen.clear()

        for batch in batches:
            for part in _slices(batch):
                texts = part.column(0).to_pylist()
                for i in v.special_at(texts):
                    texts[i] = " ".join([t for own, t in v.parts(texts[i]) if not own])
                found = v.pieces(texts).flatten().value_counts()
                seen.append(pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], schema=schema))
                held += len(found)
                if held > 600_000:
                    yield from out()
                    held = 0
        yield from out()

    return count


def frequent(counts: DataFrame, most: int) -> list[str]:
    """The words of counts(word, n) at or above the least count level that at most ``most`` words reach.

    Levels are eighths of powers of two, so that the driver gets a few hundred sums and then the words themselves,
    never more than asked for.
    """
    counts = common.stash(counts.withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "word-counts")
    least, total = None, 0
    for r in counts.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        total += r.words
        if total > most:
            break
        least = r.level
    return [] if least is None else [r.word for r in counts.where(F.col("level") >= least).select("word").collect()]


_OPEN: dict[str, Encoder] = {}


def _slices(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text in the last column."""
    at, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()):
        if held > size:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n or 0
    yield batch.slice(at)


def _encode(vocabulary, uri: str, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if uri not in _OPEN:
            _OPEN.clear()
            _OPEN[uri] = Encoder(vocabulary.value, Lexicon.open(uri))
        encoder = _OPEN[uri]
        for batch in batches:
            for part in _slices(batch):
                ids, decoded = encoder.encode(part.column(1).to_pylist())
                columns = [part.column(0), [x.count(b" ") + 1 if x else 0 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(x).hexdigest() for x in decoded]]
                texts = [[x.decode() for x in c] for c in (ids, decoded)] if with_ids else []
                yield from record(OUT + (", ids string, decoded string" if with_ids else ""), *columns, *texts).to_batches()

    return encode


def bpe_tokens(docs: DataFrame, *, id_col="doc_id", text_col="text", path: str | None = None, lexicon_words: int = LEXICON_WORDS, with_ids: bool = False) -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256; with_ids also the ids and the decoded text.

    path: the tokenizer file, read by the driver.  lexicon_words bounds the automaton: the most frequent words of
    all texts; it changes no result.  A null or empty text has no token.  Repeated rows stay
    repeated; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    with open(path or default_path(), encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(v := Vocabulary(file.read()))
    text = docs.select(common.utf8(text_col).alias("text"))
    counts = text.mapInArrow(_count(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = sorted({w.encode() for w in frequent(counts, lexicon_words)})
    folder = common.new_folder(spark, "lexicon")
    fs, base = common.open_fs(folder)
    fs.create_dir(base, recursive=True)
    uri = f"{folder}/{uuid.uuid4().hex}.automaton"
    Lexicon.build(words, [v.merge(w) for w in words]).save(uri)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.utf8(text_col).alias("text"))
    return out.mapInArrow(_encode(vocabulary, uri, with_ids), OUT + (", ids string, decoded string" if with_ids else "")).withColumnRenamed("doc_id", id_col)


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    return bpe_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
