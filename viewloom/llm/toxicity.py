"""Toxicity by a grammar of weighted transducers over the clauses of a text.

A lexicon transducer reads the letters of a word.  It is a trie of words and beginnings of words whose nodes hold
log odds, learned from labelled documents: how much more often words that pass a node occur in toxic ones, shrunk
towards the node above.  It writes a class for each word: insult (with its log odds), verb of a threat, will, target,
not, say, quote or other word.  Four transducers read the classes of a clause, one the output of the other:

* threat: a verb of harm soon after ``will``;
* target: an insult soon after a word for a person or thing;
* negation: what comes soon after ``not`` is denied;
* report: what comes after ``say`` or in quotes is reported.

A fifth gives each event its weight, learned as well.  Their composition is one machine; a clause's weight is that of
its path, and clauses without an event have none.  The score is a logistic function of the logarithm of the weight of
matched clauses by the text's words, so a long text needs more of them than a short one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .blocks import record

SAMPLE_ROWS, LEAST_PAIRS, LEAST_WEIGHT, SHRINK = 20_000, 3, 2.5, 4.0
PIECE = 1 << 20
CACHE = 300_000
TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"“”„«»]")
END = re.compile(r"[.!?;\n]")
GAP = re.compile(r"[\W\d_]")

# Function words, verbs and insults that the grammar knows before it has seen labels.
CLASSES = {
    "not": "not no never neither nor without nicht kein keine keinen nie niemals ohne ne pas jamais aucun sans nunca jamás ninguno sin",
    "say": "say says said write writes wrote written call calls called quote quoted quotes claim claims claimed sagt sagte schrieb nannte zitiert dit disait écrit appelle cite dice dijo escribe escribió llama llamó cita",
    "target": "you your yours he him she her they them these those this that people person du dich dir ihr euch er ihn sie diese dieser tu toi vous il lui elle ils eux ces cette ce tú usted ustedes él ella ellos esos esa ese este esta",
    "will": "will shall gonna going ll must should werde wirst wird werden muss vais va vas allons dois voy vas vamos debo",
    "verb": "kill murder hurt destroy stab shoot beat strangle burn hang töten umbringen schlagen verletzen tuer frapper détruire brûler matar golpear destruir quemar",
}
INSULTS = "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown imbecile dumb vermin dummkopf abschaum versager crétin abruti ordure imbécile estúpido basura escoria"
#: Log odds that an event of this kind begins with, against events as a whole; as much as SHRINK events weigh.
PRIOR = {"insult": 0.0, "aimed": 0.5, "denied": -1.5, "reported": -1.0, "threat": 0.0}
SYMBOLS = ("word", "insult", "verb", "will", "target", "not", "say", "quote")
Step = Callable[[object, str], tuple[object, str, float]]


class Transducer:
    """A start state, and a step from a state and a symbol to a state, a symbol and a weight."""

    def __init__(self, start, step: Step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """The composition: other reads what this one writes; weights add up."""

        def step(state, symbol):
            mine, between, a = self.step(state[0], symbol)
            theirs, out, b = other.step(state[1], between)
            return (mine, theirs), out, a + b

        return Transducer((self.start, other.start), step)


def window(opens: str, turns: dict[str, str], words: int, misses: str | None = None) -> Transducer:
    """Symbols in turns become others for a number of words after the symbol ``opens``; misses: what becomes an
    ordinary word outside."""

    def step(left, symbol):
        out = turns.get(symbol, symbol) if left else "word" if symbol == misses else symbol
        return (words if symbol == opens else max(0, left - 1)), out, 0.0

    return Transducer(0, step)


def report() -> Transducer:
    """After ``say`` all is reported to the clause's end, and in quotes to the closing one."""

    def step(state, symbol):
        said, quoted = state
        out = "reported" if (said or quoted) and symbol in ("insult", "aimed", "threat") else symbol
        return (said or symbol == "say", quoted != (symbol == "quote")), out, 0.0

    return Transducer((False, False), step)


def weights(events: dict[str, float]) -> Transducer:
    return Transducer(0, lambda state, symbol: (state, symbol, events.get(symbol, 0.0)))


def grammar(events: dict[str, float]) -> Transducer:
    threat = window("will", {"verb": "threat"}, 4, misses="verb")
    target = window("target", {"insult": "aimed"}, 4)
    negation = window("not", {"insult": "denied", "aimed": "denied", "threat": "denied"}, 3)
    return threat.then(target).then(negation).then(report()).then(weights(events))


class Machine:
    """The composed grammar as a table over its reachable states, and the lexicon."""

    def __init__(self, lexicon: dict[str, float], events: dict[str, float], bias: float = 0.0, slope: float = 0.0):
        self.lexicon, self.bias, self.slope = lexicon, bias, slope
        self.depth = max(map(len, lexicon), default=0)
        g = grammar(events)
        number, todo, self.arcs = {g.start: 0}, [g.start], []
        for state in todo:
            row = []
            for symbol in SYMBOLS:
                to, out, weight = g.step(state, symbol)
                if to not in number:
                    number[to] = len(todo)
                    todo.append(to)
                row.append((number[to], out if out in PRIOR else None, weight))
            self.arcs.append(row)
        self.fixed = {w: SYMBOLS.index(c) for c, words in CLASSES.items() for w in words.split()}
        self.cache: dict[str, tuple[int, float]] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def read(self, word: str) -> tuple[int, float]:
        """The word's class (-1: end of the clause) and log odds, by the deepest node that the lexicon has for it."""
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) > CACHE:
                self.cache.clear()
            found = self._read(word)
            self.cache[word] = found
        return found

    def _read(self, word: str) -> tuple[int, float]:
        if not word[0].isalpha():
            return (-1, 0.0) if END.match(word) else (SYMBOLS.index("quote"), 0.0)
        odds = self.lexicon.get(word + "$")
        for n in range(min(len(word), self.depth), 0, -1) if odds is None else ():
            if (odds := self.lexicon.get(word[:n])) is not None:
                break
        if odds is not None and odds >= LEAST_WEIGHT:
            return SYMBOLS.index("insult"), odds
        return self.fixed.get(word, 0), 0.0

    def clauses(self, text: str) -> Iterator[tuple[int, int, int, list[tuple[str, float]]]]:
        """Matched clauses of a lower-case text: words before, first and last token, events with their weights."""
        tokens = TOKEN.findall(text)
        read = list(map(self.read, tokens))
        classes = np.fromiter((c for c, _ in read), np.int8, len(read))
        ends = np.flatnonzero(classes == -1)
        hits = np.flatnonzero((classes == 1) | (classes == 2))
        for at in np.unique(np.searchsorted(ends, hits)).tolist():
            first = int(ends[at - 1]) + 1 if at else 0
            last = int(ends[at]) if at < len(ends) else len(tokens)
            state, events = 0, []
            for c, odds in read[first:last]:
                state, event, weight = self.arcs[state][c]
                if event:
                    events.append((event, odds + weight))
            if events:
                yield first, last, events
        self.words = int(((classes >= 0) & (classes != SYMBOLS.index("quote"))).sum())

    def match(self, text: str) -> tuple[int, list[tuple[int, int, float]], Counter]:
        """Words of a text, its matched clauses as (first character, end, weight), and events by kind."""
        words, found, kinds, at = 0, [], Counter(), 0
        while at < len(text):
            end = at + PIECE
            if end < len(text):
                # a clause goes on over the cut only where there is no end of one in as much text again
                cut = END.search(text, end, end + PIECE) or GAP.search(text, end)
                end = cut.end() if cut else len(text)
            piece = text[at:end].lower()
            clauses = list(self.clauses(piece))
            words += self.words
            if clauses:
                spans = [m.span() for m in TOKEN.finditer(piece)]
                for first, last, events in clauses:
                    kinds.update(e for e, _ in events)
                    weight = sum(w for _, w in events)
                    if weight > 0:
                        found.append((at + spans[first][0], at + spans[last - 1][1], weight))
            at = end
        return words, found, kinds

    def evidence(self, words: int, weight: float) -> float:
        return math.log((weight + 0.5) / (words + 25))

    def score(self, words: int, weight: float) -> float:
        z = self.bias + self.slope * self.evidence(words, weight)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logit(p: float) -> float:
    return math.log(p / (1 - p))


def fit_line(x: np.ndarray, y: np.ndarray, rounds: int = 50, l2: float = 0.05) -> tuple[float, float]:
    """Bias and slope of a logistic model of one variable, by Newton steps; the slope is held by l2."""
    rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    w, wide = np.array([logit(rate), 0.0]), np.column_stack([np.ones(len(x)), x - x.mean()])
    held = np.diag([1e-6, l2])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
        step = np.linalg.solve((wide * (p * (1 - p))[:, None]).T @ wide + held, wide.T @ (y - p) - held @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(0.0, float(w[1]))
    return (float(w[0]) - slope * float(x.mean()), slope) if slope else (logit(rate), 0.0)


WORDS = "word string, toxic long, clean long, pairs long"
MEASURED = "toxic int, words long, weight double, " + ", ".join(f"{e} long" for e in PRIOR)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each word in toxic and clean texts, five a text at most, and toxic texts that have it."""
    total: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic"))):
            for word, n in Counter(w for w in TOKEN.findall(text.lower()) if w[0].isalpha()).items():
                row = total.setdefault(word, [0, 0, 0])
                row[1 - toxic] += min(n, 5)
                row[2] += toxic
        if len(total) > CACHE:
            yield from record(WORDS, list(total), *zip(*total.values())).to_batches()
            total.clear()
    if total:
        yield from record(WORDS, list(total), *zip(*total.values())).to_batches()


def _measured(machine):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic"))):
                words, found, kinds = machine.value.match(text)
                rows.append((toxic, words, sum(w for *_, w in found), *(kinds[e] for e in PRIOR)))
            if rows:
                yield from record(MEASURED, *zip(*rows)).to_batches()

    return measured


def lexicon_of(words: DataFrame, depth: int = 24) -> dict[str, float]:
    """Nodes with log odds: whole words (marked $) and beginnings of up to depth letters.

    A node is kept if its words are e times likelier in toxic texts than words are at all and LEAST_PAIRS pairs of
    word and toxic text have it, or if a node above it would speak for eight of its occurrences or more otherwise.
    """
    seeds = words.sparkSession.createDataFrame([(w, 20, 1, LEAST_PAIRS) for w in INSULTS.split()], WORDS)
    words = words.unionByName(seeds).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "pairs")])
    words = common.stash(words, "words")
    toxic, clean = (float(x or 0) + 1 for x in words.agg(F.sum("toxic"), F.sum("clean")).first())
    starts = F.transform(F.sequence(F.lit(1), F.least(F.length("word"), F.lit(depth))), lambda n: F.substring("word", 1, n))
    nodes = words.withColumn("node", F.explode(F.array_append(starts, F.concat("word", F.lit("$")))))
    nodes = nodes.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "pairs")])
    nodes = common.stash(nodes, "nodes")
    top = toxic / (toxic + clean)
    above = nodes.select(F.col("node").alias("up"), F.col("toxic").alias("up_toxic"), (F.col("toxic") + F.col("clean")).alias("up_all"))
    both = nodes.withColumn("up", F.expr("substring(node, 1, length(node) - 1)")).join(above, "up", "left").fillna(0, ["up_toxic", "up_all"])
    odds = lambda c, n: F.log((c + F.lit(top)) / (n + 1 - c - F.lit(top))) - F.lit(logit(top))
    own, parent = odds(F.col("toxic"), F.col("toxic") + F.col("clean")), odds(F.col("up_toxic"), F.col("up_all"))
    kept = ((own > 1) & (F.col("pairs") >= LEAST_PAIRS)) | ((F.col("toxic") + F.col("clean") >= 8) & (parent > 1))
    rows = both.where(kept).select("node", "toxic", "clean", "up_toxic", "up_all").collect()
    out = {}
    for r in rows:
        rate = (r.up_toxic + SHRINK * top) / (r.up_all + SHRINK)
        p = (r.toxic + SHRINK * rate) / (r.toxic + r.clean + SHRINK)
        out[r.node] = logit(p) - logit(top)
    return out


def fit(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on sample_rows labelled documents at most, those of the smallest hash of the id.

    Of labels that repeat an id a toxic one counts; of documents that repeat it, the first text in order.
    """
    spark = docs.sparkSession
    sample = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col(id_col).alias("key")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = sample.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("key"), common.utf8(text_col).alias("text")).join(F.broadcast(sample), "key")
    rows = common.stash(rows.groupBy("key").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")), "labelled")
    lexicon = lexicon_of(rows.mapInArrow(_word_counts, WORDS))

    def measure(events: dict[str, float]) -> list:
        machine = spark.sparkContext.broadcast(Machine(lexicon, events))
        return rows.mapInArrow(_measured(machine), MEASURED).collect()

    counts = np.zeros((2, len(PRIOR)))
    for r in measure({}):
        counts[r.toxic] += [r[e] for e in PRIOR]
    p = (counts[1].sum() + 1) / (counts.sum() + 2)
    events = {}
    for i, (event, prior) in enumerate(PRIOR.items()):
        begins = 1 / (1 + math.exp(-(logit(p) + prior)))
        events[event] = logit((counts[1, i] + SHRINK * begins) / (counts[:, i].sum() + SHRINK)) - logit(p)
    # a verb of harm has no log odds of its own
    events["threat"] += LEAST_WEIGHT
    machine = Machine(lexicon, events)
    data = measure(events)
    if data:
        x = np.array([machine.evidence(r.words, r.weight) for r in data])
        machine.bias, machine.slope = fit_line(x, np.array([r.toxic for r in data], float))
    else:
        machine.bias, machine.slope = logit(0.05), 0.0
    return machine


def _scored(machine, spans: bool):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m: Machine = machine.value
            rows = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words, found, _ = m.match(text)
                rows.append((m.score(words, sum(w for *_, w in found)), words, len(found), found))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.float64(), pa.int64(), pa.int64()))]
            names = [*batch.schema.names[:-1], "score", "n_words", "n_clauses"]
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("weight", pa.float64())]))
                columns.append(pa.array([[dict(zip(("start", "end", "weight"), f)) for f in r[3]] for r in rows], kind))
                names.append("clauses")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    return scored


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", keep=None, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, spans: bool = False, model: Machine | None = None) -> DataFrame:
    """The columns ``keep`` of docs (default: the id), score, predicted (1 where score >= threshold), n_words and
    n_clauses, the matched clauses; with spans also ``clauses``: first character, end and weight of each.

    Only the text decides a score.  A null text is an empty one, and scored.  Without labels all scores are 0.05.
    Repeated rows stay repeated, texts of any length are read in pieces, an empty table gives an empty result.  Kept
    columns that bear a result's name are replaced by the result.
    """
    model = model or fit(docs, labels, id_col=id_col, text_col=text_col, sample_rows=sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    results = ["score", "predicted", "n_words", "n_clauses", *(["clauses"] if spans else [])]
    keep = [c for c in (keep or [id_col]) if c not in results]
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], common.utf8(text_col).alias("text"))
    fields = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    more = ["clauses array<struct<start: bigint, end: bigint, weight: double>>"] if spans else []
    rows = rows.mapInArrow(_scored(shared, spans), ", ".join([*fields, "score double", "n_words long", "n_clauses long", *more]))
    rows = rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *results)


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """Labels of documents whose crc32(doc_id as text) leaves 2 modulo 4 are not learned from; a null id is none of them."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = toxicity(docs, labels.where(~held))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted", "n_words", "n_clauses")
