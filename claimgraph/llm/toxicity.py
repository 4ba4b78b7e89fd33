"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posterior labels.

Voters are words of a fixed seed lexicon and words and word beginnings that the labelled rows single out; a voter fires
or abstains, and the given label is one more voter of unknown accuracy. Expectation maximisation estimates the prior and
each voter's rates in the two classes; correlations of voters beyond what the class explains are estimated from the
residuals, and a voter's vote is discounted by them. A logistic regression over hashed words and word beginnings is then
trained on the posteriors and scores every whole text.

Fitting uses at most ``SAMPLE`` labelled rows, the first in the order of a hash of doc_id; everything else covers all rows.
Scores read nothing but the text.

Defined cases: null and empty texts get the score of the prior; with no labelled rows, or none of one class, only the
seed lexicon votes; conflicting labels of a document are each a row; of the rows that repeat an id one (that of the
smallest text hash) is used for fitting, so that no more than ``SAMPLE`` reach the driver, and all are scored; a null
doc_id has no label and is not held out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import words as w
from .common import cut

#: Most labelled rows that are used for fitting.
SAMPLE = 10_000
SPACE = 1 << 20
#: Most hashed features that the classifier keeps, and most voters that the label model learns.
FEATURES, VOTERS = 1024, 160
#: Least log odds and z score of a feature that the classifier keeps.
PURE, STRONG = 2.0, 4.5
#: Fixed seed words of the lexicon.
SEED_LEXICON = "idiot stupid moron loser scum trash pathetic worthless disgusting clown dumb jerk fool garbage vermin filth imbecile creep".split()
_EDGE = np.zeros(256, bool)
_EDGE[list(b".,;:!?()[]{}\"'`|*#$%&@^~<>-_")] = True
#: Bytes of the word beginnings used as patterns.
BEGINNINGS = (4, 5, 6, 7, 8)


def _features(column: pa.Array, strong: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, rows, features): the distinct hashed words and word beginnings of whole texts, or of those the nonzero in ``strong``."""
    for first, end, data, offsets in w.text_chunks(column):
        data = w._LOWER[data]
        _, starts, stops, at = w.hash_words(data, offsets, lower=False)
        rows = np.repeat(np.arange(end - first), np.diff(at))
        starts, stops = starts.copy(), stops.copy()
        for _ in range(3):  # punctuation at either end of a word
            inner = stops - starts > 1
            starts += inner & _EDGE[data[starts]] if len(starts) else 0
            inner = stops - starts > 1
            stops -= inner & _EDGE[data[stops - 1]] if len(starts) else 0
        up, down = w.powers(max(len(data), 1))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
        got_rows, got = [], []
        for size in (0, *BEGINNINGS):
            long = slice(None) if not size else np.flatnonzero(stops - starts > size)
            a = starts[long]
            b = stops[long] if not size else a + size
            h = w.mix((sums[b] - sums[a]) * down[a] + np.uint64(size * 1_000_003 + 17))
            f = (h % np.uint64(SPACE)).astype(np.int64)
            r = rows[long]
            if strong is not None:
                keep = strong[f]
                f, r = f[keep], r[keep]
            got.append(f)
            got_rows.append(r)
        keys = np.unique(np.concatenate(got_rows) * SPACE + np.concatenate(got))
        yield first, end, keys // SPACE, keys % SPACE


def _seed_features() -> np.ndarray:
    return np.array([next(_features(pa.array([x])))[3][_word_at(x)] for x in SEED_LEXICON])


def _word_at(word: str) -> int:
    """The place of the whole-word feature among a one-word text's features."""
    _, _, _, all_ = next(_features(pa.array([word])))
    raw = np.frombuffer(word.encode(), np.uint8)
    up, _ = w.powers(len(raw))
    h = w.mix(np.array([((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)]).sum(dtype=np.uint64)], np.uint64) + np.uint64(17))
    return int(np.flatnonzero(all_ == int(h[0] % np.uint64(SPACE)))[0])


def label_model(votes: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for 0/1 ``votes`` (rows, voters); the voters' rates in each class; their weights after discounting correlation.

    Column 0 is the given label; it seeds the posterior and is then a voter like the others.
    """
    n, m = votes.shape
    post = np.clip(votes[:, 0] * 0.9 + 0.05 * (votes[:, 1:].any(1)), 0.02, 0.98) if m else np.full(n, 0.5)
    weight = np.ones(m)
    for step in range(rounds):
        total1, total0 = post.sum() + 2, (1 - post).sum() + 2
        p1 = np.clip((post @ votes + 0.2) / total1, 1e-4, 1 - 1e-4)
        p0 = np.clip(((1 - post) @ votes + 0.2) / total0, 1e-4, 1 - 1e-4)
        if step == 10:  # what the class leaves unexplained; the given label is no copy of any voter
            left = votes - (post[:, None] * p1 + (1 - post)[:, None] * p0)
            spread = np.sqrt((left**2).mean(0)) + 1e-9
            rho = np.abs((left / spread).T @ (left / spread)) / n
            np.fill_diagonal(rho, 0)
            rho[0], rho[:, 0] = 0, 0
            weight = 1 / (1 + np.where(rho > 0.1, rho, 0).sum(1))
        fired, quiet = np.log(p1 / p0), np.log((1 - p1) / (1 - p0))
        logit = np.log(total1 / total0) + votes @ (weight * (fired - quiet)) + (weight * quiet).sum()
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post, np.stack((p0, p1)), weight


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Feature weights and bias, learned from rows whose crc32(doc_id as text) mod 5 is not 0.

    The sample's features stay in a written table. What reaches the driver is bounded: a row each of the features that
    pass the thresholds, of at most ``SPACE``, and of each sampled row its voters and its classifier features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, rows, found in _features(batch.column(1)):
                places = np.searchsorted(rows, np.arange(end - first + 1)).astype(np.int32)
                own = [c.slice(first, end - first) for c in (batch.column(0), batch.column(2), batch.column(3))]
                yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(pa.array(places), pa.array(found.astype(np.int32)))], names=["label", "doc_id", "hash", "features"])

    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(SAMPLE)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the sample's ids and labels are SAMPLE rows at most, so they are broadcast and no text is shuffled
    found = texts.join(F.broadcast(known), "doc_id").select("label", "text", "doc_id", F.xxhash64("text").alias("hash"))
    found = found.mapInArrow(run, "label int, doc_id long, hash long, features array<int>")
    # one row of an id and label, however many rows repeat it
    found = found.groupBy("doc_id", "label").agg(F.min(F.struct("hash", "features")).alias("r")).select("label", "r.features")
    found = cut(found.withColumn("row", F.monotonically_increasing_id()), "sample")
    pos, n = (x or 0 for x in found.agg(F.sum("label"), F.count("*")).first())
    neg, weights, seed = n - pos, np.zeros(SPACE, np.float32), _seed_features()
    if pos < 3 or neg < 3:
        weights[seed] = 4.0
        return weights, -2.5

    def signs(rows: DataFrame, share: str, total: float) -> DataFrame:
        """(f, c1, c0, z, odds): how each feature's weight ``share`` in class 1 stands out."""
        rate = (total + 1) / (n + 2)
        by = rows.select(F.explode("features").alias("f"), F.col(share).cast("double").alias("p")).groupBy("f").agg(F.sum("p").alias("c1"), (F.count("*") - F.sum("p")).alias("c0"))
        z = (F.col("c1") - (F.col("c1") + F.col("c0")) * rate) / F.sqrt((F.col("c1") + F.col("c0") + 1) * rate * (1 - rate))
        return by.withColumn("z", z).withColumn("odds", F.log((F.col("c1") + 0.5) / (total + 1)) - F.log((F.col("c0") + 0.5) / (n - total + 1)))

    def strongest(rows: DataFrame, most: int) -> np.ndarray:
        return np.array([r["f"] for r in rows.orderBy(F.desc("z"), "f").limit(most).select("f").collect()], np.int64)

    def picked(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The rows' keys and labels, and (row, column) of those features among ``columns`` that each has."""
        t = found.select("row", "label", F.array_intersect("features", F.lit(columns.tolist()).cast("array<int>")).alias("own")).orderBy("row").toArrow()
        own = [x.values for x in t["own"]]
        place = np.full(SPACE, -1)
        place[columns] = np.arange(len(columns))
        at = np.repeat(np.arange(n), [len(x) for x in own])
        return t["row"].to_numpy(), t["label"].to_numpy().astype(float), at, place[np.concatenate([x.to_numpy() for x in own])]

    learned = strongest(signs(found, "label", pos).filter("c1 >= 2 and odds > 1.2 and z > 3"), VOTERS)
    voters = np.unique(np.concatenate((seed, learned)))
    keys, y, at, col = picked(voters)
    votes = np.zeros((n, len(voters) + 1))
    votes[:, 0] = y
    votes[at, col + 1] = 1
    post, _, _ = label_model(votes)
    # the classifier: features that the posterior labels single out, and their weights
    spark, total = found.sparkSession, float(post.sum())
    posts = F.broadcast(spark.createDataFrame(pa.table({"row": keys, "post": post})))  # a number each of at most SAMPLE rows
    strong = signs(found.join(posts, "row"), "post", total).filter((F.col("c1") + F.col("c0") >= 3) & (F.col("odds") > PURE) & (F.col("z") > STRONG))
    chosen = np.unique(np.concatenate((seed, strongest(strong, FEATURES))))
    _, _, at, col = picked(chosen)
    beta, bias = np.zeros(len(chosen)), float(np.log((total + 1) / (n - total + 1)))
    m1, m2 = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, 301):  # full-batch Adam
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, beta[col], n) + bias, -30, 30)))
        g = np.concatenate((np.bincount(col, (p - post)[at], len(chosen)) / n + 2e-4 * beta, [(p - post).mean()]))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-9)
        beta, bias = beta - move[:-1], bias - move[-1]
    weights[chosen] = beta
    # the bias that tells the posterior labels apart best
    logits = np.bincount(at, beta[col], n)
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(post[order])
    f1 = 2 * hits / (np.arange(1, n + 1) + total)
    ends = np.flatnonzero(np.concatenate((np.diff(logits[order]) < 0, [True])))
    k = ends[np.argmax(f1[ends])]
    after = logits[order[k + 1]] if k + 1 < n else logits[order[k]] - 1
    bias = -float((logits[order[k]] + after) / 2)
    unseen = np.setdiff1d(np.arange(len(chosen)), col)
    weights[np.intersect1d(seed, chosen[unseen])] = max(1.2 * -bias, 0.0)  # seed words that no fitted row has
    return weights, bias


def score_rows(rows: DataFrame, docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``rows`` with a new column ``score_col`` (0 to 1) of their texts, by a classifier fitted on ``docs`` and ``labels``."""
    weights, bias = fit(docs, labels, label_col, id_col, text_col)
    sent = rows.sparkSession.sparkContext.broadcast((weights, bias))  # SPACE floats, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        strong = weights != 0
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col)).cast(pa.string())
            scores = np.empty(batch.num_rows)
            for first, end, own, found in _features(texts, strong):
                logit = np.bincount(own, weights[found], end - first) + bias
                scores[first:end] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(score_col, DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = score_rows(rows, docs, labels, label_col, id_col, text_col) if (id_col, text_col) == ("doc_id", "text") else score_rows(rows, rows, labels.withColumnRenamed(id_col, "doc_id"), label_col)
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
