"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other text is unlabelled, not clean.  With the share pi
of toxic text (the class prior, estimated from labelled rows that may teach) the risk of a classifier
is corrected for the positives hidden among the unlabelled, and its clean part is kept from turning
negative (it would reward memorising):

    R = pi * E_pos[loss(+)] + max(0, E_unl[loss(-)] - pi * E_pos[loss(-)])

A few linear classifiers over hashed words and word beginnings are trained with numpy, each leaving out
another part of a bounded sample (`MAX_POSITIVE`, `MAX_UNLABELLED` texts, chosen by hash); the score is the
mean of their probabilities.  Scoring reads every text whole, in vectorised slices.

Null and empty texts have no features and get the score of the intercept.  Without confirmed toxic
texts every score is 0.  Repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .frames import TEACHING, arrow_stage

MAX_POSITIVE, MAX_UNLABELLED = 2000, 6000
HASH_BITS = 20
BEGINNINGS = (4, 5, 6)  # bytes
FEATURES = 4000
SIGNIFICANT, RATIO = 3.0, 3.0  # standard deviations; share among positives to share among all
CLASSIFIERS = 3
STEPS, RATE, DECAY = 300, 0.1, 5e-5

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0x80:] = True


class Model(NamedTuple):
    column: np.ndarray  # feature hash -> row of weights, or -1
    weights: np.ndarray  # [features, classifiers]
    intercepts: np.ndarray


def features(t: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning; repeats are left in."""
    w = W.words(t, _LETTER)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = W.owners(w.first)
    sums = W.byte_sums(t.data, fold=True)
    size = w.end - w.start
    texts, ids = [own], [W.range_hash(sums, w.start, w.end)]
    for n in BEGINNINGS:
        long = size > n
        texts.append(own[long])
        ids.append(W.mix(W.range_hash(sums, w.start[long], w.start[long] + n), n))
    return np.concatenate(texts), (np.concatenate(ids) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _feature_sets(rows: DataFrame) -> list[np.ndarray]:
    """Distinct features of texts, collected in an order of their own: the caller bounds the rows."""

    def take(batch: pa.RecordBatch) -> Iterator[dict]:
        for _, _, t in W.slices(batch.column(0)):
            text, ids = features(t)
            both = np.unique(text << HASH_BITS | ids)
            cut = np.searchsorted(both >> HASH_BITS, np.arange(len(t.bounds)))
            values = pa.array((both & ((1 << HASH_BITS) - 1)).astype(np.int32))
            yield {"ids": pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), values)}

    table = arrow_stage(rows, "ids array<int>", take).toArrow()
    sets = [np.asarray(x.values) for x in table.column(0).combine_chunks()] if table.num_rows else []
    return sorted(sets, key=lambda s: s.tobytes())


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Train on texts whose id may teach; None without a confirmed toxic text."""
    may_teach = F.expr(TEACHING.format(id="k"))
    known = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").alias("y")).where(may_teach & F.col("y").isNotNull())
    pos, seen = known.agg(F.count_if(F.col("y") == 1), F.count("y")).first()
    if not pos:
        return None
    prior = pos / seen
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where(may_teach)
    order = F.xxhash64("k", F.lit(9))
    # bounded by MAX_POSITIVE ids of 8 bytes
    toxic = known.where("y = 1").select("k").distinct().orderBy(order, "k").limit(MAX_POSITIVE)
    toxic = rows.join(F.broadcast(toxic), "k").select("t")
    # the smallest hashes among all ids that may teach, labelled or not
    some = rows.select("k").orderBy(order, "k").limit(MAX_UNLABELLED).distinct()
    some = rows.join(F.broadcast(some), "k").select("t")
    # an id may name many rows: equal texts have one vote, and the bounds hold for texts too
    toxic, some = toxic.dropDuplicates().limit(MAX_POSITIVE), some.dropDuplicates().limit(MAX_UNLABELLED)
    return train(_feature_sets(toxic), _feature_sets(some), prior)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model | None:
    if not positive or not unlabelled:
        return None
    size = 1 << HASH_BITS
    positive = _unlike(positive)
    in_pos = np.bincount(np.concatenate(positive), minlength=size)
    in_unl = np.bincount(np.concatenate(unlabelled), minlength=size)
    # evidence: features that are beyond chance and several times commoner among the positives.  Words
    # that merely go with a language or a topic would say nothing, and rare ones could only be memorised
    p, u = in_pos / len(positive), in_unl / len(unlabelled)
    pooled = (in_pos + in_unl + 1) / (len(positive) + len(unlabelled) + 2)
    z = (p - u) / np.sqrt(pooled * (1 - pooled) * (1 / len(positive) + 1 / len(unlabelled)))
    z[(in_pos < min(3, len(positive))) | (p < RATIO * u)] = 0
    chosen = np.argsort(-z, kind="stable")[:FEATURES]
    chosen = np.sort(chosen[(z[chosen] >= SIGNIFICANT) & (z[chosen] > 0)])
    column = np.full(size, -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    parts = [_fit_one(_without(positive, k), _without(unlabelled, k), column, len(chosen), prior) for k in range(CLASSIFIERS)]
    return Model(column, np.stack([w for w, _ in parts], 1), np.array([b for _, b in parts]))


def _unlike(sets: list[np.ndarray], buckets: int = 8192) -> list[np.ndarray]:
    """Sets that share less than half with each set kept before: copies would vouch for their own words."""
    incidence = np.zeros((len(sets), buckets), np.float32)
    for i, s in enumerate(sets):
        incidence[i, s % buckets] = 1
    size = incidence.sum(1)
    both = incidence @ incidence.T
    alike = 2 * both >= size[:, None] + size[None, :] - both
    kept: list[int] = []
    for i in range(len(sets)):
        if not alike[i, kept].any():
            kept.append(i)
    return [sets[i] for i in kept]


def _without(sets: list[np.ndarray], k: int) -> list[np.ndarray]:
    """All but every CLASSIFIERS-th set, from k on."""
    return [s for i, s in enumerate(sets) if i % CLASSIFIERS != k] or sets


def _fit_one(positive: list, unlabelled: list, column: np.ndarray, size: int, prior: float) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the non-negative risk with the logistic loss."""
    sets = [*positive, *unlabelled]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    col = column[np.concatenate(sets)]
    row, col = row[col >= 0], col[col >= 0]
    n_pos, n = len(positive), len(sets)
    w, b = np.zeros(size), np.log(prior / (1 - prior)) if prior < 1 else 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[col], n) + b
        chance = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        clean = np.logaddexp(0, z[n_pos:]).mean() - prior * np.logaddexp(0, z[:n_pos]).mean()
        slope = np.zeros(n)
        if clean >= 0:
            slope[:n_pos] = prior * (chance[:n_pos] - 1) / n_pos - prior * chance[:n_pos] / n_pos
            slope[n_pos:] = chance[n_pos:] / (n - n_pos)
        else:  # step back from the overfitted part alone
            slope[:n_pos] = prior * chance[:n_pos] / n_pos
            slope[n_pos:] = -chance[n_pos:] / (n - n_pos)
        grad = np.append(np.bincount(col, slope[row], size) + DECAY * w, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Probability of toxic content of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size

    def rate(batch: pa.RecordBatch) -> Iterator[dict]:
        m: Model | None = shared.value
        keys, texts = batch.columns
        for lo, hi, t in W.slices(texts):
            n = hi - lo
            chance = np.zeros(n)
            if m is not None:
                text, ids = features(t)
                at = m.column[ids]
                both = np.unique(text[at >= 0] * len(m.weights) + at[at >= 0])
                own, at = both // len(m.weights), both % len(m.weights)
                for k, b in enumerate(m.intercepts):
                    z = np.bincount(own, m.weights[at, k], n) + b
                    chance += 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                chance /= len(m.intercepts)
            yield {"doc_id": keys.slice(lo, n), "score": chance}

    columns = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return arrow_stage(columns, "doc_id long, score double", rate)
