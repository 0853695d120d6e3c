"""Toxicity by maximal-scoring segments over token log-odds.

Training counts, per term, the labelled documents of each class that hold it. A term is a word or its
first four to six letters followed by ``*``, which covers unseen forms. A term's weight is its log-odds
ratio between the classes under an informative Dirichlet prior (``prior`` documents spread like all
documents). Only terms are kept whose excess among toxic documents is significant: the signed root of
their log-likelihood ratio is at least ``least_z`` (a normal deviate, sound for rare terms too). A text's tokens score the weight
of their longest known term, other tokens ``-drift``. A linear scan finds all maximal-scoring segments
(disjoint, none extendable). Karlin-Altschul statistics calibrate them: lambda solves E[exp(lambda s)] = 1
over tokens of clean documents, K is fitted to their segments, and a segment's E-value is
K m exp(-lambda S) in a text of m tokens. Segments with E < 1 are significant; a document's evidence is
log(1 + sum of -log E) over them, and a logistic curve of that evidence, fitted on the training rows as scanned by the other
fold's terms, gives the score.

Scale: the classifier is fitted on at most about ``sample`` labelled documents (a documented bound; all
while there are fewer), chosen by a hash of their id; the chosen labels are the only thing broadcast besides
the terms, which need several of the chosen toxic documents each, so that the bound on rows bounds them too. Counting is a partially aggregated group-by, scoring one pass over
all documents without a shuffle.

Defined cases: null and empty texts have no tokens and get the score of no evidence. Repeated or conflicting labels
of a document count as toxic if any does; null labels are ignored. Without labels of both classes there are no terms, and
every score is the share of toxic labels (0 without any). Rows are scored one by one. A null doc_id is not held out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, carried, whole_row, written

SAMPLE = 200_000
PRIOR, LEAST_Z, DRIFT, MIN_SCORE = 10.0, 4.5, 0.5, 0.3
#: Least log-odds of a term that are tried; training rows choose one.
FLOORS = (1.0, 1.5, 2.0, 3.0)
HELD_OUT = 2
REMEMBERED = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (6, 5, 4)
_COUNTS = {"clean0": (0, 0), "toxic0": (0, 1), "clean1": (1, 0), "toxic1": (1, 1)}


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


def terms_of(word: str) -> tuple[str, ...]:
    """The terms of a word, longest first."""
    return (word, *(word[:k] + "*" for k in _PREFIXES if len(word) > k))


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    lam: float
    k: float
    intercept: float
    slope: float
    drift: float


class _Weights(dict):
    """Weight of a word by its longest known term; remembers up to ``most`` words."""

    def __init__(self, weights: dict[str, float], drift: float, most: int = REMEMBERED):
        super().__init__()
        self.weights, self.drift, self.most = weights, drift, most

    def __missing__(self, word: str) -> float:
        value = next((self.weights[t] for t in terms_of(word) if t in self.weights), -self.drift)
        if len(self) >= self.most:
            self.clear()
        self[word] = value
        return value


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(first, stop, score) of all maximal-scoring segments, in linear time.

    A list of candidates is kept with the running totals before (left) and after (right) each. A new positive score
    joins the nearest candidate whose left total is smaller, together with all candidates between, as long as that
    makes the right total larger than that candidate's."""
    total, found = 0.0, []  # first, stop, left, right
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, left = i, before
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= total:
                found.append((first, i + 1, left, total))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right in found]


def _scan(tokens: list[str], weight: _Weights) -> list[tuple[int, int, float]]:
    """The maximal segments of a text, by token position. Only the tokens of known terms are scanned one by one; the stretches between them count as one."""
    scores = np.fromiter(map(weight.__getitem__, tokens), np.float64)
    hits = np.flatnonzero(scores > 0)
    if not len(hits):
        return []
    gaps = -weight.drift * (np.diff(hits) - 1)
    folded = np.empty(2 * len(hits) - 1)
    folded[::2], folded[1::2] = scores[hits], gaps
    return [(int(hits[a // 2]), int(hits[(b - 1) // 2]) + 1, s) for a, b, s in maximal_segments(folded.tolist())]


def segments(text: str | None, weight: _Weights) -> tuple[int, list[tuple[int, int, float]]]:
    """(tokens, maximal segments by token position) of a text."""
    tokens = _WORD.findall(text.lower()) if text else []
    return len(tokens), _scan(tokens, weight)


def evidence(m: int, found: list[tuple[int, int, float]], lam: float, k: float) -> float:
    return math.log1p(sum(max(0.0, lam * s - math.log(k * m)) for *_, s in found)) if found else 0.0


def _lambda(clean: dict[float, float], drift: float) -> float:
    """Solves sum of p exp(lambda s) = 1; clean: share of clean tokens by positive weight."""
    rest = 1 - sum(clean.values())
    mean = sum(p * s for s, p in clean.items()) - rest * drift
    if not clean or mean >= 0:
        return 1.0
    low, high = 0.0, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        value = sum(p * math.exp(min(700.0, mid * s)) for s, p in clean.items()) + rest * math.exp(-mid * drift)
        low, high = (mid, high) if value < 1 else (low, mid)
    return max(low, 1e-3)


def _logistic(counts: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a weak ridge, from (evidence, rows, toxic rows)."""
    x, n, y = (np.array(c, float) for c in zip(*counts, strict=True))
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - n * p) - 1e-2 * beta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def _weights(sums: dict[str, int], toxic: Column, clean: Column, prior: float) -> tuple[Column, Column]:
    """Log-odds weight and signed root of the log-likelihood ratio of a term that ``toxic`` and ``clean`` documents hold."""
    toxic_n, clean_n = sums["toxic"], sums["clean"]
    a = F.lit(prior) * (clean + toxic) / (clean_n + toxic_n)
    odds = lambda own, size: F.log((own + a) / (F.lit(size + prior) - own - a))
    both = toxic + clean
    part = lambda own, size: F.when(own > 0, own * F.log(own * (clean_n + toxic_n) / (both * size))).otherwise(0.0)
    excess = toxic * clean_n > clean * toxic_n  # then no term is in all documents, and nothing divides by zero
    z = F.sqrt(F.greatest(F.lit(0.0), 2 * (part(toxic, toxic_n) + part(clean, clean_n))))
    return F.when(excess, odds(toxic, toxic_n) - odds(clean, clean_n)), F.when(excess, z)


def count_terms(batch: pa.RecordBatch) -> Iterator[dict]:
    """Documents that hold each term, by fold and class, of a batch (y, fold, text); ``#rows`` and ``#tokens`` count all."""
    by: dict[tuple[int, int], list[Counter]] = {(f, c): [Counter() for _ in range(len(_PREFIXES) + 1)] for f in (0, 1) for c in (0, 1)}
    rows, tokens = Counter(), Counter()
    for y, fold, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        found = _WORD.findall((t or "").lower())
        key = fold, int(y > 0)
        rows[key] += 1
        tokens[key] += len(found)
        words = set(found)
        by[key][0].update(words)
        for counter, k in zip(by[key][1:], _PREFIXES, strict=True):
            counter.update({w[:k] for w in words if len(w) > k})
    for j, end in enumerate(("", *["*"] * len(_PREFIXES))):
        keys = [*set().union(*(counters[j] for counters in by.values()))]
        yield {"term": [k + end for k in keys]} | {name: [by[key][j][k] for k in keys] for name, key in _COUNTS.items()}
    yield {"term": ["#rows", "#tokens"]} | {name: [rows[key], tokens[key]] for name, key in _COUNTS.items()}


def _loss(counts: list[tuple[float, int, int]], intercept: float, slope: float) -> float:
    """Log-loss of the curve over (evidence, rows, toxic rows)."""
    x, n, y = (np.array(c, float) for c in zip(*counts, strict=True))
    p = np.clip(1 / (1 + np.exp(-np.clip(intercept + slope * x, -40, 40))), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (n - y) * np.log(1 - p)).sum())


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, prior: float = PRIOR, least_z: float = LEAST_Z, floors: tuple[float, ...] = FLOORS, drift: float = DRIFT) -> Model:
    ids = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    ids = ids.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    n = ids.count()
    if n > sample:
        ids = ids.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    chosen = F.broadcast(ids)  # at most about ``sample`` rows of two numbers
    train = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).join(chosen, "id")
    train = train.select("y", F.pmod(F.xxhash64("t"), F.lit(2)).cast("int").alias("fold"), "t")

    types = [("term", pa.string()), *((c, pa.int64()) for c in _COUNTS)]
    ddl = ", ".join(["term string", *(f"{c} long" for c in _COUNTS)])
    counted = train.mapInArrow(by_batch(count_terms, types), ddl).groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    counted = written(counted.where("toxic0 + toxic1 > 1 or term like '#%'"), "terms")
    sums = {r.term: r.asDict() for r in counted.where("term like '#%'").collect()}
    size = {c: sums.get("#rows", {}).get(c, 0) for c in _COUNTS}
    toxic_n, clean_n = size["toxic0"] + size["toxic1"], size["clean0"] + size["clean1"]
    if not clean_n or not toxic_n:
        return Model({}, 1.0, 1.0, 40.0 if toxic_n else -40.0, 0.0, drift)
    # The weights of all training rows and of either fold alone; a term is learnt where both its effect and its significance are large enough.
    fits = {"all": ("toxic0 + toxic1", "clean0 + clean1", toxic_n, clean_n), **{f: (f"toxic{f}", f"clean{f}", size[f"toxic{f}"], size[f"clean{f}"]) for f in (0, 1)}}
    cols = []
    for name, (toxic, clean, a, b) in fits.items():
        w, z = _weights({"toxic": a, "clean": b}, F.expr(toxic), F.expr(clean), prior)
        cols.append((F.when((z >= least_z) & (w >= min(floors)), w) if a and b else F.lit(None).cast("double")).alias(f"w_{name}"))
    kept = counted.where("term not like '#%'").select("term", F.expr("clean0 + clean1").alias("clean"), *cols)
    kept = kept.where("w_all is not null or w_0 is not null or w_1 is not null").collect()
    learnt = {name: {r.term: r[f"w_{name}"] for r in kept if r[f"w_{name}"] is not None} for name in fits}
    clean_tokens = max(1, sums["#tokens"]["clean0"] + sums["#tokens"]["clean1"])
    models = []
    for floor in floors:
        weights = {t: w for t, w in learnt["all"].items() if w >= floor}
        clean: dict[float, float] = {}
        for r in kept:
            if r.term in weights and not r.term.endswith("*"):
                clean[r.w_all] = clean.get(r.w_all, 0.0) + (r.clean + 0.5) / clean_tokens
        models.append((weights, _lambda(clean, drift), float(np.median(list(weights.values()))) / 2 if weights else 1.0))

    # Each training row is scanned with the weights of the other fold, once per floor.
    other = docs.sparkSession.sparkContext.broadcast({f: learnt[1 - f] for f in (0, 1)})
    known: dict[int, _Weights] = {}

    def scan(batch: pa.RecordBatch) -> Iterator[dict]:
        m, s = [], []
        for fold, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            tokens = _WORD.findall(t.lower()) if t else []
            m.append(len(tokens))
            of = []
            for k, floor in enumerate(floors):
                if (fold, k) not in known:
                    known[fold, k] = _Weights({x: w for x, w in other.value[fold].items() if w >= floor}, drift, REMEMBERED // len(floors))
                of.append([x[2] for x in _scan(tokens, known[fold, k])])
            s.append(of)
        yield {"y": batch.column(0), "m": m, "s": s}

    types = [("y", pa.int32()), ("m", pa.int64()), ("s", pa.list_(pa.list_(pa.float64())))]
    scanned = written(train.mapInArrow(by_batch(scan, types), "y int, m long, s array<array<double>>"), "scanned").select("y", "m", F.posexplode("s").alias("floor", "s"))
    at = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("floor") + 1)
    # K makes the clean rows' expected number of segments above half a typical weight what it is.
    bars, lams = [bar for *_, bar in models], [lam for _, lam, _ in models]
    found = {r.floor: r for r in scanned.where("y = 0").groupBy("floor").agg(F.sum("m").alias("m"), F.sum(F.size(F.filter("s", lambda s: s >= at(bars)))).alias("n")).collect()}
    ks = [((found[k].n if k in found else 0) + 0.5) / (max(1, found[k].m if k in found else 1) * math.exp(-lam * bar)) for k, (_, lam, bar) in enumerate(models)]
    gain = F.aggregate("s", F.lit(0.0), lambda total, s: total + F.greatest(F.lit(0.0), s * at(lams) - F.log(F.col("m") * at(ks))))
    bins = scanned.select("floor", "y", F.round(F.log1p(gain), 2).alias("x")).groupBy("floor", "x").agg(F.count("*").alias("n"), F.sum(F.when(F.col("y") > 0, 1).otherwise(0)).alias("toxic"))
    curves: list[list] = [[] for _ in floors]
    for r in bins.where("x is not null").collect():
        curves[r.floor].append((r.x, r.n, r.toxic))
    best = None
    for (weights, lam, _), k, counts in zip(models, ks, curves, strict=True):
        intercept, slope = _logistic(counts)
        loss = round(_loss(counts, intercept, slope) / (clean_n + toxic_n), 5)
        if best is None or loss < best[0]:
            best = loss, Model(weights, lam, k, intercept, slope, drift)
    return best[1]


_SEGMENTS = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: Model, keep: list[str | Column], text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row with score and segments: the significant toxic passages by token position."""
    arrow, schema = carried(docs, keep, "score double, segments array<struct<first:long,stop:long,score:double>>")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    remembered: dict[str, _Weights] = {}

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        m = shared.value
        weight = remembered.setdefault("w", _Weights(m.weights, m.drift))
        scores, passages = [], []
        for t in batch.column(batch.num_columns - 1).to_pylist():
            size, found = segments(t, weight)
            found = [x for x in found if m.lam * x[2] > math.log(m.k * size)]
            scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, m.intercept + m.slope * evidence(size, found, m.lam, m.k))))))
            passages.append([{"first": a, "stop": b, "score": s} for a, b, s in found])
        yield {f: batch.column(k) for k, (f, _) in enumerate(arrow)} | {"score": scores, "segments": passages}

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(by_batch(rows, [*arrow, ("score", pa.float64()), ("segments", _SEGMENTS)]), schema)


def reject(docs: DataFrame, labels: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that score under ``least``."""
    cols = docs.columns
    scored = score(docs.select(whole_row(docs), "text"), fit(docs, labels), ["row"])
    return scored.where(F.col("score") < least).select(*[F.col("row").getField(c).alias(c) for c in cols])
