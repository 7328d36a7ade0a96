"""Toxicity scores by non-negative positive-unlabelled learning.

Learned from: confirmed toxic rows (the positives) and rows of the corpus as they come (unlabelled; some
of them toxic). With the class prior p, the risk of a classifier f under logistic loss is

    p * E_pos[loss(f, 1)] + max(0, E_unl[loss(f, 0)] - p * E_pos[loss(f, 0)])

where the second term is the loss on negatives, estimated without any. If a mini-batch drives it below
zero, the step goes back up instead. The classifiers are linear in the set of a text's words and word
stems (hashed into ``BUCKETS``), trained in numpy with Adam from several seeds; the score is the sigmoid of their mean.

Bounds: the sample is at most ``MAX_POSITIVES`` positives and ``MAX_UNLABELLED`` unlabelled rows, those with the
smallest hash of the id, one row of each id. Spark counts its buckets by class; buckets that fewer than ``MIN_ROWS``
of those rows hold, and those beyond the ``MAX_BUCKETS`` whose shares in the classes differ most (in standard
errors), keep the weight zero. A row comes to the driver as ``MAX_BUCKETS`` bits, whatever its text's length: at
most 18 MB. Every row is scored, on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.sample import sample_ids
from acctlens.llm.store import written

BUCKETS = 1 << 18
MAX_POSITIVES = 6_000
MAX_UNLABELLED = 12_000
MIN_ROWS = 5
MAX_BUCKETS = 1 << 13
FOLDS = 5
STEMS = (4, 5, 6)
SEEDS = (1, 2, 3)
#: The L1 penalty for one positive; it falls with the root of their number, as chance differences do.
PENALTY = 0.1
_EDGES = b"\"'`.,;:!?()[]{}<>*_-#$%&|/\\~^=+@0123456789"


class _Buckets(dict):
    """word -> its buckets: of the word, and of its first 4, 5 and 6 letters; starts again when it is full."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        core = word.strip(_EDGES)
        letters = core.decode()
        stems = {letters[:n] for n in STEMS if len(letters) > n}
        found = tuple(xxhash.xxh3_64_intdigest(x) % BUCKETS for x in (core, *(b"^" + x.encode() for x in stems))) if core else ()
        self[word] = found
        return found


_BUCKETS = _Buckets()


def buckets(text: str | None) -> np.ndarray:
    """The sorted distinct buckets of a text's words and stems, A-Z as a-z, without what stands at a word's ends."""
    words = set((text or "").encode().lower().split())
    return np.unique(np.fromiter(chain.from_iterable(map(_BUCKETS.__getitem__, words)), np.int64))


@dataclass
class Model:
    weights: np.ndarray  # one per bucket
    bias: float

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[buckets(text)].sum() + self.bias, -40, 40))))


def _batch(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.repeat(np.arange(len(rows)), lengths)


def _train(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, size: int, seed: int, steps: int, rate: float, penalty: float) -> np.ndarray:
    """Weights (the bias last) that minimise the non-negative risk."""
    rng = np.random.default_rng(seed)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    n_pos, n_unl = min(256, len(pos)), min(512, len(unl))
    for step in range(1, steps + 1):
        some = [unl[i] for i in rng.integers(0, len(unl), n_unl)]
        some_pos = [pos[i] for i in rng.integers(0, len(pos), n_pos)]
        (iu, ru), (ip, rp) = _batch(some), _batch(some_pos)
        fu = np.bincount(ru, w[iu], n_unl) + w[-1]
        fp = np.bincount(rp, w[ip], n_pos) + w[-1]
        su, sp = 1 / (1 + np.exp(-np.clip(fu, -40, 40))), 1 / (1 + np.exp(-np.clip(fp, -40, 40)))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        gu, gp = su / n_unl, -prior * sp / n_pos  # slope of the negative part
        if negative >= 0:
            gp = gp - prior * (1 - sp) / n_pos
        else:
            gu, gp = -gu, -gp
        g = np.bincount(iu, gu[ru], size + 1) + np.bincount(ip, gp[rp], size + 1)
        g[-1] = gu.sum() + gp.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        scale = rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-4)
        w -= scale * m / (1 - 0.9**step)
        # the L1 penalty's step: a word without clear evidence has weight zero, so length adds no noise
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - penalty * scale[:-1], 0)
    return w


def fit(
    pos: list[np.ndarray], unl: list[np.ndarray], prior: float, seeds: tuple[int, ...] = SEEDS,
    steps: int = 400, rate: float = 0.02, penalty: float = PENALTY, min_rows: int = MIN_ROWS,
) -> Model:
    """Train on the bucket sets of positives and unlabelled rows, with ``prior`` set to 0.001 to 0.9. Without either, every score is it."""
    prior = float(np.clip(prior, 1e-3, 0.9))
    weights = np.zeros(BUCKETS)
    if not pos or not unl:
        return Model(weights, float(np.log(prior / (1 - prior))))
    rows = np.zeros(BUCKETS, np.int64)
    for r in (*pos, *unl):
        rows[r] += 1  # a row's buckets are distinct
    used = np.flatnonzero(rows >= min_rows)

    def narrowed(sets: list[np.ndarray], kept: np.ndarray, size: int) -> list[np.ndarray]:
        """The sets in the numbers of the kept buckets."""
        number = np.full(size, -1, np.int32)
        number[kept] = np.arange(len(kept))
        new = (number[r] for r in sets)
        return [n[n >= 0] for n in new]

    def trained(steps: int, rate: float, penalty: float) -> np.ndarray:
        return np.mean([_train(pos, unl, prior, len(used), s, steps, rate, penalty) for s in seeds], axis=0)

    pos, unl = narrowed(pos, used, BUCKETS), narrowed(unl, used, BUCKETS)
    penalty = penalty / np.sqrt(len(pos))
    # the penalised round picks the buckets, the second one sets their weights free of the penalty's pull
    w = trained(steps, rate, penalty)
    clear = np.flatnonzero(np.abs(w[:-1]) > 0.02)
    pos, unl, used = narrowed(pos, clear, len(used)), narrowed(unl, clear, len(used)), used[clear]
    w = trained(2 * steps, 2 * rate, penalty / 50)
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]))


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = pa.array([buckets(t.as_py()).astype(np.int32) for t in batch.column("text")], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("positive"), sets], names=["_id", "positive", "buckets"])


def _telling_buckets(sets: DataFrame, n_pos: int, n_unl: int, min_rows: int, max_buckets: int) -> np.ndarray:
    """The sorted buckets whose shares in the two classes of ``sets(positive, buckets)`` differ most, in standard errors."""
    held = sets.select("positive", F.explode("buckets").alias("bucket")).groupBy("bucket")
    counts = held.agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("n_pos")).filter(F.col("n") >= min_rows)
    share = F.col("n") / F.lit(n_pos + n_unl)
    error = F.sqrt(share * (1 - share) * F.lit(1 / n_pos + 1 / n_unl))
    apart = F.abs(F.col("n_pos") / F.lit(n_pos) - (F.col("n") - F.col("n_pos")) / F.lit(n_unl))
    ranked = counts.select("bucket", F.when(error > 0, apart / error).otherwise(0.0).alias("z"))
    top = ranked.orderBy(F.col("z").desc(), "bucket").limit(max_buckets)
    return np.sort(np.array([r[0] for r in top.select("bucket").collect()], np.int64))  # at most max_buckets


def _as_bits(kept: np.ndarray):
    """Every set as one bit for each of the kept buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            bits = [np.packbits(np.isin(kept, np.asarray(lists[i].values), assume_unique=True)).tobytes() for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(bits, pa.binary())], names=["positive", "bits"])

    return run


def held_out(doc_id, folds: int = FOLDS):
    """Whether a row's label is never learned from: crc32 of the id as text falls in fold 0. A null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None,
    max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED, max_buckets: int = MAX_BUCKETS,
) -> Model:
    """Fit on ``docs(doc_id, text)`` and the rows of ``labels(doc_id, <label>)`` outside the held-out fold.

    A document with several labels is positive if one is. ``prior`` is the share of positives among the
    labelled rows if it is not given; the risk uses it within 0.001 to 0.9. Null ids and labels are no labels.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    ids = texts.select("_id")
    n_known = known.agg(F.count(F.lit(1)), F.sum("_label")).first()
    if prior is None:
        prior = (n_known[1] or 0) / n_known[0] if n_known[0] else 0.0
    positive = sample_ids(known.filter("_label = 1").select("_id").join(ids, "_id", "left_semi"), max_positives)
    unlabelled = sample_ids(ids, max_unlabelled, 7)
    # at most max_positives + max_unlabelled ids
    chosen = positive.withColumn("positive", F.lit(True)).unionByName(unlabelled.withColumn("positive", F.lit(False)))
    sample = texts.join(F.broadcast(chosen), "_id").select("_id", "positive", "text")
    sets = sample.mapInArrow(_bucket_rows, "_id bigint, positive boolean, buckets array<int>")
    # rows that share an id count once in each class, by their smallest set: no more rows than chosen ids
    sets = written(sets.groupBy("_id", "positive").agg(F.min("buckets").alias("buckets")), "toxicity-sample")
    n_pos, n_unl = sets.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_pos or not n_unl:
        return fit([], [], prior)
    kept = _telling_buckets(sets, n_pos, n_unl, MIN_ROWS, max_buckets)
    bits = sets.mapInArrow(_as_bits(kept), "positive boolean, bits binary").orderBy("positive", "bits")
    rows = [(r[0], kept[np.unpackbits(np.frombuffer(r[1], np.uint8), count=len(kept)).astype(bool)].astype(np.int32)) for r in bits.toLocalIterator()]
    return fit([a for p, a in rows if p], [a for p, a in rows if not p], prior)


def score(docs: DataFrame, model: Model, output: str = "score") -> DataFrame:
    """``docs`` with the score in ``output`` as last column (one so named before is replaced); a null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    kept = [F.col(f"`{c}`") for c in docs.columns if c != output]
    return docs.select(*kept, scores(F.coalesce(F.col("text"), F.lit(""))).alias(output))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **parameters) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay."""
    return score(docs, train(docs, labels, **parameters), "_tx_score").filter(F.col("_tx_score") < threshold).drop("_tx_score")


def toxicity(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``: trained by ``train``, scored on whole texts.

    Repeated rows get equal scores, an empty text the score of the bias; without positives every score is
    the prior. An empty table gives no rows; other columns (labels, language, source, ids) are never inputs.
    """
    scored = score(docs.select("doc_id", "text"), train(docs, labels, **parameters))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
