"""Plain versions of the operators' contracts, for small tables."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def key(i):
    return (i is None, i or 0)


def dedup(rows, length=50):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s not in first or key(i) < key(first[s]):
                first[s] = i
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if key(first[b[p : p + length]]) < key(i):
                gone[p : p + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def cut(rows, length=50):
    """(id, text) without the bytes that dedup removes, and without characters that this cuts."""
    first, out = {}, []
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s not in first or key(i) < key(first[s]):
                first[s] = i
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if key(first[b[p : p + length]]) < key(i):
                gone[p : p + length] = b"\x01" * length
        out.append((i, bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets of sources by water-filling, one excess after another; the null source is last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    out, left = {}, share * sum(sizes.values())
    while len(out) < len(names):
        open_ = [s for s in names if s not in out]
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > cap * sizes[s]]
        for s in full or open_:
            out[s] = cap * sizes[s] if full else level * weight[s]
            left -= out[s] if full else 0
    return out


def warc(rows):
    largest = defaultdict(list)
    for i, h in rows:
        largest[h or ""].append(i)
    out = []
    for i, h in rows:
        body = (h or "").encode()
        ids = [x for x in largest[h or ""] if x is not None]
        top = max(ids) if ids else None
        ref = top if i is not None and i < top else None
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if ref is not None else "response", ref))
    return out


def media(rows):
    out = []
    for i, t in rows:
        b = (t or "").encode()
        p = b + bytes(-len(b) % 64 or (0 if b else 64))
        out.append((i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    return out


def shingles(text, k):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            by[x].append(n)
    common = Counter()
    for some in by.values():
        for a in range(len(some)):
            for b in range(a):
                common[some[b], some[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[x] = y
    least = {}
    for n, (i, _) in enumerate(rows):
        r = find(n)
        if r not in least or key(i) < key(least[r]):
            least[r] = i
    return [(i, len(sets[n]), least[find(n)]) for n, (i, _) in enumerate(rows)]


def lm_base(rows):
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    toks = [[*WORD.findall(lower(t or "")), None] for _, t in rows]
    count = Counter(x for h, some in zip(held, toks) if not h for x in some)
    n, v = sum(count.values()), len(count)
    return [(i, h, len(some), sum(count[x] > 0 for x in some), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in some)) for (i, _), h, some in zip(rows, held, toks)]


def bpe(rows, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def corpus(seed=0, n=120):
    """Documents with exact and near copies, shared passages, empty, null, short and long texts, and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["tha", "on", "er", "É", "ion", "xx", "β", "日", "1", "'s", "M"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passages, texts = [prose(30) for _ in range(4)], []
    for i in range(n):
        kind = rng.random()
        if kind < 0.1 and texts:
            text = rng.choice(texts)
        elif kind < 0.4 and texts:
            words = (rng.choice(texts) or "a").split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        elif kind < 0.55:
            text = prose(rng.randint(0, 40)) + " " + rng.choice(passages) + "\n" + prose(rng.randint(0, 60))
        elif kind < 0.6:
            text = rng.choice([None, "", " \t\n", "one", "Two words", "abc abc abc", "be " * 400, "x" * 300, "x" * 299 + "y"])
        else:
            text = prose(rng.randint(1, 200))
        texts.append(text)
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts)]
    rows += [rows[3], rows[10], (None, texts[5]), (None, "a null id"), (rows[20][0], "another text of the same id " + (texts[8] or ""))]
    rng.shuffle(rows)
    return rows
