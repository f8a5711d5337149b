"""Quality classifier with hierarchical empirical Bayes.

Two heads, low quality and toxic, each a logistic model over presence of words and shape features, fitted on a
bounded sample of labelled rows.  A head gives each document a log-likelihood ratio.  Grouped sums of the
documents' posteriors give each host a rate that is shrunk towards the global one, and each path of a host a rate
shrunk towards the host's.  The strength of shrinking is estimated by moments: from the spread of hosts around the
global rate, and from that of paths around their host's.  The prior that a document's evidence is combined with is
its path's rate as the other documents tell it: its own posterior is left out of all three sums.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .blocks import record

HEADS = ("low", "toxic")
SAMPLE_ROWS = 20_000
LEAST_DOCS, LEAST_GAP = 4, 4.0
WORDS = regex.compile(r"[\p{L}]+")
SYMBOLS = regex.compile(r"[!#$%&*|<>{}=_^~\\]")


def shape(text: str, words: list[str]) -> list[str]:
    """Binned properties of the whole text."""
    n, size = len(words), max(1, len(text))
    counts = Counter(words)
    bins = lambda x, edges: sum(x >= e for e in edges)
    upper = sum(w.isupper() and len(w) > 1 for w in words) / max(1, n)
    lines = text.split("\n")
    return [
        f"\x01symbols {bins(len(SYMBOLS.findall(text)) / max(1, n), (0.01, 0.05, 0.1, 0.2, 0.4, 0.8, 1.5))}",
        f"\x01pipes {bins(text.count('|') / max(1, n), (0.01, 0.05, 0.1, 0.2, 0.4))}",
        f"\x01upper {bins(upper, (0.02, 0.1, 0.25, 0.5, 0.8))}",
        f"\x01top {bins(max(counts.values(), default=0) / max(1, n), (0.05, 0.1, 0.15, 0.2, 0.3, 0.5))}",
        f"\x01kinds {bins(len(counts) / max(1, n), (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8))}",
        f"\x01same {bins(sum(a == b for a, b in zip(words, words[1:])) / max(1, n), (0.01, 0.03, 0.1, 0.3))}",
        f"\x01lines {bins(1 - len(set(lines)) / len(lines), (0.05, 0.2, 0.4, 0.6, 0.8))}",
        f"\x01letters {bins(sum(map(len, words)) / size, (0.3, 0.5, 0.6, 0.7, 0.75, 0.8))}",
        f"\x01length {bins(n, (1, 5, 20, 50, 100, 200, 500, 1000, 3000))}",
    ]


def features(text: str) -> list[int]:
    """Distinct hashed features of a text: lower-case words and shapes."""
    words = WORDS.findall(text)
    names = {w.lower() for w in words}
    names.update(shape(text, words))
    return [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in names]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[int]] = {}
    for batch in batches:
        for text, low, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            for f in features(text or ""):
                row = total.setdefault(f, [0, 0, 0])
                row[0] += 1
                row[1] += low
                row[2] += toxic
    yield from record("feature long, n long, low long, toxic long", list(total), *(zip(*total.values()) if total else [[]] * 3)).to_batches()


def _active(wanted: dict[int, int]):
    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [([wanted[f] for f in features(t or "") if f in wanted], a, b) for t, a, b in zip(*(c.to_pylist() for c in batch.columns))]
            yield from record("at array<long>, low long, toxic long", *(zip(*rows) if rows else [[]] * 3)).to_batches()

    return active


def fit_logistic(at: list[list[int]], y: np.ndarray, size: int, rounds: int = 300, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model over binary features, by gradient steps scaled per feature (Adagrad)."""
    row = np.repeat(np.arange(len(at)), [len(x) for x in at])
    column = np.array([f for x in at for f in x], np.int64)
    w, seen = np.zeros(size), np.full(size, 1e-8)
    rate = min(max(y.mean(), 1e-4), 1 - 1e-4)
    bias = math.log(rate / (1 - rate))
    for _ in range(rounds):
        z = np.bincount(row, weights=w[column], minlength=len(at)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(column, weights=error[row], minlength=size) / len(at) + l2 * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
        bias -= 0.5 * error.mean()
    return w, bias


class Model:
    """Feature numbers, weights of each head, and the sample's rates."""

    def __init__(self, wanted: dict[int, int], weights: np.ndarray, bias: list[float], rates: list[float]):
        self.wanted, self.weights, self.bias, self.rates = wanted, weights, bias, rates

    def evidence(self, text: str) -> np.ndarray:
        """Log-likelihood ratios: the logit of each head less that of the sample's rate."""
        at = [self.wanted[f] for f in features(text) if f in self.wanted]
        return self.weights[:, at].sum(axis=1) + self.bias - np.log(np.array(self.rates) / (1 - np.array(self.rates)))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on sample_rows labelled rows at most, those of smallest id hash; rows without both labels are not used.

    Features: those of LEAST_DOCS sampled rows or more whose rate of a label is LEAST_GAP standard errors or more
    from the sample's.  Their number is bounded by the sample, so they are gathered.
    """
    sample = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    sample = sample.select(F.col(id_col).alias("key"), (F.col("quality") == 0).cast("long").alias("low"), (F.col("toxic") == 1).cast("long").alias("toxic")).dropDuplicates(["key"])
    sample = sample.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    # one row per sampled id: rows of docs that repeat it do not enlarge the sample
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(sample), "key")
    rows = rows.groupBy("key").agg(F.min_by(F.struct("text", "low", "toxic"), F.coalesce("text", F.lit(""))).alias("r")).select("r.*")
    rows = common.stash(rows.repartition(24), "labelled")
    counts = rows.mapInArrow(_counted, "feature long, n long, low long, toxic long").groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", *HEADS)]).where(F.col("n") >= LEAST_DOCS)
    total = rows.agg(F.count("*"), F.sum("low"), F.sum("toxic")).first()
    size = max(1, total[0])
    rates = [min(max((x or 0) / size, 0.5 / (size + 1)), 1 - 0.5 / (size + 1)) for x in total[1:]]
    far = F.lit(False)
    for head, rate in zip(HEADS, rates):
        gap = F.abs(F.col(head) - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate) + 1e-9)
        far = far | (gap > LEAST_GAP)
    wanted = [r.feature for r in counts.where(far).select("feature").collect()]
    number = {f: i for i, f in enumerate(sorted(wanted))}
    data = rows.mapInArrow(_active(number), "at array<long>, low long, toxic long").collect()
    at = [r.at for r in data]
    fitted = [fit_logistic(at, np.array([r[h] for r in data], float), len(number)) for h in HEADS] if data else [(np.zeros(len(number)), math.log(r / (1 - r))) for r in rates]
    return Model(number, np.array([w for w, _ in fitted]).reshape(2, len(number)), [b for _, b in fitted], rates)


def _evidence(model):
    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m: Model = model.value
            ratios = [m.evidence(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array([r[i] for r in ratios], pa.float64()) for i in range(2)]
            names = [*batch.schema.names[:-1], "llr_low", "llr_toxic"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    return evidence


def shrunk(total, docs, above, strength: float):
    """The rate of docs documents whose posteriors sum to total, with ``strength`` documents at the rate above it."""
    return (total + F.lit(strength) * above) / (docs + F.lit(strength))


#: Documents that the rate above counts as where groups spread no more than sampling does: all is the rate above.
POOLED = 1e12


def strength_of(groups: DataFrame, head: str, within: str | None) -> float:
    """Prior documents by moments: how much more than sampling the rates of groups spread around that of what they
    are within (one column of groups; None: the whole).  1 at least.

    Over groups of n documents at rate p, within one of N at rate m: sum n (p - m)^2 is (k - 1) m (1 - m) by
    sampling, and (N - sum n^2 / N) times the variance between groups more.
    """
    n, total = F.col("docs"), F.col(f"sum_{head}")
    keys = [] if within is None else [within]
    sums = groups.groupBy(*keys).agg(F.sum(n).alias("big"), F.count("*").alias("k"), F.sum(total).alias("t"), F.sum(total * total / n).alias("s"), F.sum(n.cast("double") * n).alias("q"))
    m = F.col("t") / F.col("big")
    noise = m * (1 - m)
    r = sums.agg(
        F.sum(F.col("s") - F.col("t") * m).alias("spread"), F.sum((F.col("k") - 1) * noise).alias("sampled"),
        F.sum(F.col("big") - F.col("q") / F.col("big")).alias("weight"), F.sum(F.col("big") * noise).alias("noise"), F.sum("big").alias("n"),
    ).first()
    if not r.n or not r.weight or r.weight < 1e-9:
        return POOLED
    between = (r.spread - r.sampled) / r.weight
    return max(1.0, min(POOLED, r.noise / r.n / between - 1)) if between > 0 else POOLED


def classify(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", host_col="source", path_cols=("lang",), keep=None, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS, model: Model | None = None) -> DataFrame:
    """The columns ``keep`` of docs (default: the id) and low_p, toxic_p, host_low, host_toxic, path_low, path_toxic,
    prior_low, prior_toxic, score and kept.

    score = (1 - low_p) (1 - toxic_p); kept where it is at least threshold.  A null or empty text, host or path is a
    value of its own.  Without labels the rates are even and everything rests on the evidence, which then is none,
    so all rows are kept.  Repeated rows stay repeated; an empty table gives an empty result.  Kept columns that
    bear a result's name are replaced by the result.
    """
    spark = docs.sparkSession
    model = model or fit(spark, docs, labels, id_col=id_col, text_col=text_col, sample_rows=sample_rows)
    shared = spark.sparkContext.broadcast(model)
    results = ["low_p", "toxic_p", "host_low", "host_toxic", "path_low", "path_toxic", "prior_low", "prior_toxic", "score", "kept"]
    keep = [c for c in (keep or [id_col]) if c not in results]
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("null"))
    path = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in path_cols])
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], host.alias("host"), path.alias("path"), common.utf8(text_col).alias("text"))
    fields = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    rows = rows.mapInArrow(_evidence(shared), ", ".join([*fields, "host string", "path string", "llr_low double", "llr_toxic double"]))
    logit = {h: math.log(r / (1 - r)) for h, r in zip(HEADS, model.rates)}
    rows = common.stash(rows.withColumns({f"own_{h}": 1 / (1 + F.exp(-(F.col(f"llr_{h}") + logit[h]))) for h in HEADS}), "evidence")
    sums = ("docs", "sum_low", "sum_toxic")
    paths = common.stash(rows.groupBy("host", "path").agg(F.count("*").alias("docs"), *[F.sum(f"own_{h}").alias(f"sum_{h}") for h in HEADS]), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in sums])
    whole = hosts.agg(*[F.sum(c).alias(c) for c in sums]).first()
    strength = {h: (strength_of(hosts, h, None), strength_of(paths, h, "host")) for h in HEADS}
    paths = paths.join(hosts.select("host", *[F.col(c).alias(f"host_{c}") for c in sums]), "host")
    out = rows.join(paths, ["host", "path"])
    added = {}
    for h, rate in zip(HEADS, model.rates):
        n, total = float(whole[0] or 0), float(whole[f"sum_{h}"] or 0)
        of_all, of_host = strength[h]
        for name, own, one in (("group", F.lit(0.0), 0.0), ("prior", F.col(f"own_{h}"), 1.0)):
            # the whole keeps one document at the sample's rate, so it is never without any
            top = (F.lit(total + rate) - own) / F.lit(n + 1.0 - one)
            mid = shrunk(F.col(f"host_sum_{h}") - own, F.col("host_docs") - one, top, of_all)
            low = shrunk(F.col(f"sum_{h}") - own, F.col("docs") - one, mid, of_host)
            kept_off = lambda x: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), x))
            added |= {f"host_{h}": kept_off(mid), f"path_{h}": kept_off(low)} if name == "group" else {f"prior_{h}": kept_off(low)}
    out = out.withColumns(added)
    out = out.withColumns({f"{h}_p": 1 / (1 + F.exp(-(F.col(f"llr_{h}") + F.log(F.col(f"prior_{h}") / (1 - F.col(f"prior_{h}")))))) for h in HEADS})
    out = out.withColumn("score", (1 - F.col("low_p")) * (1 - F.col("toxic_p"))).withColumn("kept", F.col("score") >= threshold)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *results)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
