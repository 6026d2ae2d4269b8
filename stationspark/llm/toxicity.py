"""Toxicity by weak supervision.

Cues of a text are its words (lower case, letters only) and the first 3, 4, 5
and 6 letters of longer ones.

1. ``cue_counts``: over all labelled rows that may be learned from, the
   documents and the toxic documents of each cue (grouped counts; tasks add
   up their own rows first).
2. Voters.  A lexicon voter votes "toxic" where its word occurs, a pattern
   voter where a word begins with its letters; they are the cues whose counts
   speak for the label by at least ``LEAST_EVIDENCE``, as many as there are.
   Two more vote on the number of different cues: "toxic"
   for several, "clean" for none.
3. ``LabelModel``: a generative model of the votes given the unseen true
   label.  Expectation maximisation estimates how often each voter votes in
   toxic and in clean texts; voters that are correlated beyond what the label
   explains share one voice, by the sum of their correlations.
4. ``fit``: a logistic regression on the cues with that evidence for or
   against the label, trained on the model's posterior labels; it begins with
   part of the voters' log odds and is drawn to them.
5. ``score``: the regression over every whole text.

The label model and the regression are fitted on a sample of at most
``FIT_ROWS`` labelled rows, those of the smallest hashes, and on cues that
occur in it, which bounds what the driver holds; counts and scores cover all
rows.  Rows whose ``crc32(doc_id as text) mod 4`` is 2 are held out:
their labels are never read.

Defined results: a null text counts as empty; a text without cues gets the
regression's base score; a null id is not held out and has no label; of
several labels of a document the highest counts; a repeated row gets the same
score; without any label, or with one kind only, every score is the share of
toxic labels (0 if there are none).  An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationspark.llm.shared import packed, stored, unpacked, whole_text

HELD_OUT = 2
THRESHOLD = 0.3
#: Labelled rows that the label model and the regression are fitted on.
FIT_ROWS = 20_000
#: Evidence of a cue (twice the log likelihood ratio of its own share of toxic
#: documents against that of all), and its smoothed share as a voter.
LEAST_EVIDENCE = 12.0
LEAST_PRECISION = 0.7
PREFIXES = (3, 4, 5, 6)
#: Rows, or voters, that the label model works on at a time.
PART = 512
#: Shares of toxic documents that count as alike.
SAME_PRECISION = 0.05
#: Of a voter's log odds, what the regression starts from and is drawn to.
TRUST = 0.5
EM_ROUNDS = 20
#: Correlation from which two voters are taken as dependent.
DEPENDENT = 0.25

_LETTERS = re.compile(r"[^\W\d_]+")


def cues(text: str) -> set[str]:
    """Words as they are; patterns end in ``*``."""
    words = set(_LETTERS.findall(text.lower()))
    found = set(words)
    for n in PREFIXES:
        found.update(w[:n] + "*" for w in words if len(w) > n)
    return found


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    return known.groupBy(F.col("doc_id").alias("of")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every, toxic = Counter(), Counter()
        for text, label in zip(unpacked(batch.column("packed")), batch.column("toxic").to_pylist()):
            found = cues(text.decode())
            every.update(found)
            if label:
                toxic.update(found)
        yield pa.RecordBatch.from_pydict({
            "cue": pa.array(list(every), pa.string()), "n": pa.array(list(every.values()), pa.int64()),
            "toxic": pa.array([toxic[c] for c in every], pa.int64())})


def cue_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    # by shuffle at any size: labels grow with the documents
    texts = packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")))
    rows = texts.join(labels.hint("merge"), texts["doc_id"] == labels["of"])
    counts = rows.select("packed", "toxic").mapInArrow(_count, "cue string, n long, toxic long")
    return counts.groupBy("cue").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def evidence(counts: DataFrame, prior: float) -> DataFrame:
    """Counts with the cue's smoothed ``share`` of toxic documents and its ``evidence``."""
    n, toxic, own = F.col("n"), F.col("toxic"), F.col("toxic") / F.col("n")
    said = F.when(toxic > 0, toxic * F.log(own / prior)).otherwise(0.0)
    other = F.when(toxic < n, (n - toxic) * F.log((1 - own) / (1 - prior))).otherwise(0.0)
    return counts.withColumns({"share": (toxic + prior) / (n + 1), "evidence": 2 * (said + other)})


def _cues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: set[str] = set()
        for text in batch.column("text"):
            found |= cues(text.as_py())
        yield pa.RecordBatch.from_pydict({"cue": pa.array(list(found), pa.string())})


def distinct_voters(precise: list[tuple[str, float]]) -> list[int]:
    """Places of the voters that say something of their own: a word, or a longer
    beginning, is left to a shorter beginning that votes as precisely."""
    share = dict(precise)
    out = []
    for i, (cue, own) in enumerate(precise):
        word = cue.removesuffix("*")
        shorter = [word[:n] + "*" for n in PREFIXES if n < len(word)]
        if not any(share.get(s, 0.0) >= own - SAME_PRECISION for s in shorter):
            out.append(i)
    return out


def _parts(votes: np.ndarray) -> Iterator[np.ndarray]:
    """The votes as numbers, some rows at a time."""
    for i in range(0, len(votes), PART):
        yield votes[i:i + PART].astype(np.float32)


def _sums(votes: np.ndarray, p: np.ndarray) -> np.ndarray:
    weight = p.astype(np.float32)
    return sum((weight[i * PART:(i + 1) * PART] @ part).astype(np.float64) for i, part in enumerate(_parts(votes)))


def once(votes: np.ndarray) -> np.ndarray:
    """Places of the columns that are not the same as an earlier one: voters that
    vote alike on every row are one voter."""
    names = np.random.default_rng(0).integers(0, 1 << 63, len(votes), dtype=np.uint64)
    sums = np.zeros(votes.shape[1], dtype=np.uint64)
    for i in range(0, len(votes), PART):
        sums += (votes[i:i + PART].astype(np.uint64) * names[i:i + PART, None]).sum(axis=0, dtype=np.uint64)
    return np.sort(np.unique(sums, return_index=True)[1])


class LabelModel:
    """Votes are 0 (abstains) or 1; each voter has a polarity."""

    def __init__(self, prior: float, precision: np.ndarray):
        self.prior = prior
        self._precision = precision

    def fit(self, votes: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
        """The posterior of "toxic" for every row of the votes."""
        together = sum(part.T @ part for part in _parts(votes)) / np.float32(len(votes))
        rate = np.clip(np.diag(together).astype(np.float64), 1e-4, 1 - 1e-4)
        # at first, as precise as the label counts say
        self.toxic = np.clip(rate * self._precision / self.prior, 1e-4, 1 - 1e-4)
        self.clean = np.clip(rate * (1 - self._precision) / (1 - self.prior), 1e-4, 1 - 1e-4)
        self.voice = np.ones(votes.shape[1])
        for _ in range(rounds):
            p = self.posterior(votes)
            of_toxic, of_clean = _sums(votes, p), _sums(votes, 1 - p)
            self.voice = 1 / self._dependence(together, p, of_toxic / len(p), of_clean / len(p))
            n = p.sum()
            self.toxic = np.clip((of_toxic + 1) / (n + 2), 1e-4, 1 - 1e-4)
            self.clean = np.clip((of_clean + 0.1) / (len(p) - n + 2), 1e-4, 1 - 1e-4)
        return self.posterior(votes)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        said = np.log(self.toxic) - np.log(self.clean)
        kept = np.log1p(-self.toxic) - np.log1p(-self.clean)
        weight = (self.voice * (said - kept)).astype(np.float32)
        logit = np.log(self.prior) - np.log1p(-self.prior) + (self.voice * kept).sum() + np.concatenate(
            [part @ weight for part in _parts(votes)]).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _dependence(self, together: np.ndarray, p: np.ndarray, of_toxic: np.ndarray, of_clean: np.ndarray) -> np.ndarray:
        """For each voter the sum of its correlations with all voters, given
        the label; from the voters' common rates, without a table of rests."""
        both = np.mean(p * (1 - p))
        toxic_only, clean_only = np.mean(p ** 2), np.mean((1 - p) ** 2)
        # row by row of the covariance: what a voter's rest has in common with all
        column = lambda x, y: np.outer(x, y)
        variance = (np.diag(together) - 2 * of_toxic * self.toxic - 2 * of_clean * self.clean
                    + toxic_only * self.toxic ** 2 + 2 * both * self.toxic * self.clean + clean_only * self.clean ** 2)
        scale = np.sqrt(np.maximum(variance, 1e-12))
        out = np.empty(len(scale))
        for i in range(0, len(scale), PART):
            at = slice(i, i + PART)
            t, c = self.toxic[at], self.clean[at]
            cov = (together[at] - column(of_toxic[at], self.toxic) - column(t, of_toxic)
                   - column(of_clean[at], self.clean) - column(c, of_clean) + toxic_only * column(t, self.toxic)
                   + both * (column(t, self.clean) + column(c, self.toxic)) + clean_only * column(c, self.clean))
            corr = cov / column(scale[at], scale)
            corr[np.arange(len(t)), np.arange(i, i + len(t))] = 1.0
            out[at] = np.where(corr >= DEPENDENT, corr, 0).sum(axis=1)
        return out


@dataclass(frozen=True)
class Classifier:
    """A logistic regression on the presence of cues."""

    weights: dict[str, float]
    base: float

    def score(self, text: str) -> float:
        logit = self.base + sum(map(self.weights.__getitem__, self.weights.keys() & cues(text)))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def _regression(rows: list[np.ndarray], target: np.ndarray, begin: np.ndarray, penalty: float = 1.0,
                rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and base by gradient descent with momentum, steps by column;
    weights are drawn to those that they begin with."""
    n = len(begin)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cue = np.concatenate(rows) if len(owner) else np.zeros(0, dtype=np.int64)
    weights, base = begin.copy(), float(np.log(target.mean() + 1e-6) - np.log(1 - target.mean() + 1e-6))
    # the curvature of the loss is at most a quarter of the count, shared out
    # among the cues of a row
    share = np.array([len(r) + 1 for r in rows], dtype=np.float64)
    step = 1 / (np.bincount(cue, weights=share[owner], minlength=n) / 4 + penalty)
    base_step = 4 / share.sum()
    speed, base_speed = np.zeros(n), 0.0
    for _ in range(rounds):
        ahead, base_ahead = weights + 0.9 * speed, base + 0.9 * base_speed
        logit = base_ahead + np.bincount(owner, weights=ahead[cue], minlength=len(rows))
        error = target - 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        speed = 0.9 * speed + step * (np.bincount(cue, weights=error[owner], minlength=n) - penalty * (ahead - begin))
        base_speed = 0.9 * base_speed + base_step * error.sum()
        weights, base = weights + speed, base + base_speed
    return weights, base


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    labels = stored(training_labels(labels), "toxic-labels")
    n, n_toxic = labels.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        return Classifier({}, float(np.log(n_toxic + 1e-9) - np.log(n - n_toxic + 1e-9)) if n else -30.0)
    prior = n_toxic / n
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    chosen = labels.orderBy(F.xxhash64("of"), "of").limit(FIT_ROWS).select("of")
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).orderBy("doc_id", "text").limit(FIT_ROWS)
    sample = stored(sample.select("doc_id", "text"), "toxic-sample")

    counts = evidence(cue_counts(docs, labels), prior).filter(F.col("evidence") >= LEAST_EVIDENCE)
    # cues of the sample: as many as its rows can have, whatever there are in all
    inside = sample.mapInArrow(_cues, "cue string").distinct()
    top = counts.join(inside, "cue", "left_semi").orderBy(F.col("evidence").desc(), "cue").collect()
    names = [r["cue"] for r in top]
    precise = [r for r in top if r["share"] >= LEAST_PRECISION]
    precise = [precise[i] for i in distinct_voters([(r["cue"], r["share"]) for r in precise])]
    voters = [r["cue"] for r in precise]
    known = {c: i for i, c in enumerate(names)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(known[c] for c in known.keys() & cues(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "cues": pa.array(rows, pa.list_(pa.int32()))})

    # FIT_ROWS rows at most
    some = sample.mapInArrow(found, "doc_id long, cues array<int>").orderBy("doc_id", "cues").toArrow()
    found_cues = some.column("cues").combine_chunks()
    ends = np.cumsum(np.concatenate([[0], found_cues.value_lengths().to_numpy()])) if len(some) else [0]
    every = found_cues.flatten().to_numpy().astype(np.int64)
    rows = [every[a:b] for a, b in zip(ends, ends[1:])]
    if not rows:
        return Classifier({}, float(np.log(prior) - np.log1p(-prior)))

    place = np.full(len(names), -1)
    place[[known[v] for v in voters]] = np.arange(len(voters))
    votes = np.zeros((len(rows), len(voters) + 2), dtype=np.uint8)
    for i, r in enumerate(rows):
        votes[i, place[r][place[r] >= 0]] = 1
    many = votes[:, :-2].sum(axis=1)
    votes[:, -2], votes[:, -1] = many >= 3, many == 0
    precision = np.array([r["share"] for r in precise] + [0.95, prior / 2])
    own = once(votes)
    posterior = LabelModel(prior, precision[own]).fit(votes[:, own])
    begin = np.zeros(len(names))
    for r in precise:
        begin[known[r["cue"]]] = TRUST * (np.log(r["share"] / (1 - r["share"])) - np.log(prior / (1 - prior)))
    weights, base = _regression(rows, posterior, begin)
    return Classifier({c: float(w) for c, w in zip(names, weights) if abs(w) > 1e-3}, base)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = texts.mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
