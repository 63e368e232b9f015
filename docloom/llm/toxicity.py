"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are taken as labels; unlabelled text is drawn from all documents, toxic ones among them. With the
share ``prior`` of toxic documents, the risk of a classifier on clean text is its risk on unlabelled text less ``prior``
times its risk on toxic text taken as clean. That estimate can't be below zero, so where it gets there the step is taken
back instead (Kiryo et al., 2017). The classifier is a logistic one in numpy over the presence of words and of
the first bytes of words, in lower case.

It is fitted on a sample of at most about ``positives`` confirmed and ``unlabelled`` documents, drawn by a hash of the
key: ids of the sample and what it holds of ``features`` selected features are all that reach the driver, and
the fitted model (two numbers per feature) is all that is sent to the tasks. Every document is scored on its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table, uniform
from docloom.llm.words import LOWER, PIECE, Words, in_pieces, mixed, powers
from docloom.session import pinned

PREFIXES = (4, 5, 6)
FILTER_BITS = 20
FOLDS = 5
#: Log-likelihood that a feature must gain: about 6 in 100,000 features without meaning do.
RATIO = 8.0


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and features of all words and of the first bytes of longer ones, repeats included."""
    words = Words(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), words.counts())
    texts, found = [text], [words.hashes()]
    for n in PREFIXES:
        longer = np.flatnonzero(words.ends - words.starts > n)
        at = words.starts[longer]
        up, _ = powers(PIECE + 1)
        value = np.zeros(len(at), np.uint64)
        for i in range(n):
            value += data[at + i].astype(np.uint64) * up[i]
        texts.append(text[longer])
        found.append(mixed(value ^ np.uint64(n << 56)))
    return np.concatenate(texts), np.concatenate(found)


def in_texts(batches, make):
    for batch in batches:
        for rows, data, offsets in in_pieces(batch, "text"):
            yield from make(rows, *word_features(LOWER[data], offsets))


def present(text: np.ndarray, feature: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and positions in the sorted ``keys`` of the features that are keys, each once per text."""
    sieve = np.zeros(1 << FILTER_BITS, bool)
    low = np.uint64((1 << FILTER_BITS) - 1)
    sieve[(keys & low).astype(np.int64)] = True
    maybe = np.flatnonzero(sieve[(feature & low).astype(np.int64)]) if len(keys) else np.empty(0, int)
    at = np.minimum(np.searchsorted(keys, feature[maybe]), max(len(keys) - 1, 0))
    hit = keys[at] == feature[maybe] if len(keys) else np.zeros(0, bool)
    pairs = np.unique(text[maybe][hit] * np.int64(max(len(keys), 1)) + at[hit])
    return pairs // max(len(keys), 1), pairs % max(len(keys), 1)


def select(sample: DataFrame, features: int, least: int = 5) -> np.ndarray:
    """The features that are more frequent in confirmed than in unlabelled texts, beyond chance, sorted.

    Chance is judged by the likelihood ratio of one share for both against a share each; the largest ratios go first.
    """

    def count(batches):
        def each(rows, text, feature):
            marked = rows.column("confirmed").to_numpy(zero_copy_only=False).astype(bool)
            order = np.lexsort((text, feature))
            text, feature = text[order], feature[order]
            first = np.concatenate([[True], (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])])[: len(text)]
            text, feature = text[first], feature[first]
            keys, start = np.unique(feature, return_index=True)
            if len(keys):
                p = np.add.reduceat(marked[text].astype(np.int64), start)
                n = np.diff(np.append(start, len(feature)))
                columns = [pa.array(keys.view(np.int64)), pa.array(p), pa.array(n - p)]
                yield pa.RecordBatch.from_arrays(columns, names=["f", "p", "u"])

        yield from in_texts(batches, each)

    counts = sample.mapInArrow(count, "f bigint, p bigint, u bigint").groupBy("f").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")
    )
    totals = sample.groupBy("confirmed").count().collect()
    n = {r[0]: max(r[1], 1) for r in totals}
    n_p, n_u = float(n.get(True, 1)), float(n.get(False, 1))

    def part(k, n_, p):
        return k * F.log(F.greatest(k, F.lit(0.5)) / (n_ * p)) + (n_ - k) * F.log(F.greatest(n_ - k, F.lit(0.5)) / (n_ * (1 - p)))

    rate = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    ratio = part(F.col("p"), n_p, rate) + part(F.col("u"), n_u, rate)
    more = (F.col("p") / n_p > F.col("u") / n_u) & (ratio >= RATIO)
    top = counts.where((F.col("p") + F.col("u") >= least) & more).orderBy(ratio.desc(), "f").select("f").limit(features)
    return np.sort(np.array([r[0] for r in top.collect()], np.int64).view(np.uint64))


def fit(row: np.ndarray, column: np.ndarray, confirmed: np.ndarray, n_features: int, prior: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias; ``row`` and ``column`` are the ones of a binary matrix. Gradient steps by Adam on the whole sample.

    Weights aren't negative: a text is toxic by what it has, and no amount of clean text around makes up for it.
    """
    n_p, n_u = max(int(confirmed.sum()), 1), max(int((~confirmed).sum()), 1)
    weights = np.zeros(n_features + 1)
    weights[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        margin = np.bincount(row, weights[column], len(confirmed)) + weights[-1]
        p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        clean_loss = np.logaddexp(0, margin)
        clean_risk = clean_loss[~confirmed].sum() / n_u - prior * clean_loss[confirmed].sum() / n_p
        # gradients by margin: of the toxic part, and of the clean part
        toxic = np.where(confirmed, -prior * (1 - p) / n_p, 0.0)
        clean = np.where(confirmed, -prior * p / n_p, p / n_u)
        pull = toxic + clean if clean_risk >= 0 else -clean
        gradient = np.append(np.bincount(column, pull[row], n_features), pull.sum())
        gradient[:-1] += 1e-4 * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights[:-1] = np.maximum(weights[:-1], 0)
    return weights[:-1], float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", positives: int = 8_000, unlabelled: int = 16_000, features: int = 4_096, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted feature keys, their weights and the bias, from all documents and labels given (already without held-out ones).

    Repeated labels of a key count as toxic if one is. Without a single toxic label every score is the prior 0.05.
    """
    known = pinned(labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic")))
    n_known, n_toxic = known.where("toxic IS NOT NULL").agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return np.empty(0, np.uint64), np.empty(0), float(np.log(0.05 / 0.95))
    prior = min(max(n_toxic / n_known, 0.001), 0.9)
    u = uniform(F.col("id"), seed)
    ids = docs.select(F.col(key).alias("id")).where("id IS NOT NULL").distinct()
    n_docs = ids.count()
    sample_ids = pinned(
        known.where("toxic = 1").where(u < positives / n_toxic).select("id", F.lit(True).alias("confirmed")).union(
            ids.where(u < unlabelled / max(n_docs, 1)).select("id", F.lit(False).alias("confirmed"))
        )
    )
    # the sample's expected size is bounded by the two parameters, at 16 bytes a row
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sample = pinned(rows.join(F.broadcast(sample_ids), "id").select("text", "confirmed"))
    keys = select(sample, features)

    def ones(batches):
        def each(rows, text, feature):
            text, at = present(text, feature, keys)
            order = np.searchsorted(text, np.arange(rows.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(order, pa.int32()), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column("confirmed"), lists], names=["confirmed", "ones"])

        yield from in_texts(batches, each)

    got = sample.mapInArrow(ones, "confirmed boolean, ones array<int>").toArrow()
    confirmed = got.column("confirmed").to_numpy().astype(bool)
    lists = got.column("ones").combine_chunks()
    column = lists.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(confirmed)), np.diff(lists.offsets.to_numpy()))
    weights, bias = fit(row, column, confirmed, len(keys), prior)
    return keys, weights, bias


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score (0 to 1) of every row of ``docs``; null and empty texts get the score of no feature."""
    keys, weights, bias = model
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        def each(rows_, text_, feature):
            t, at = present(text_, feature, keys)
            margin = np.bincount(t, weights[at] if len(weights) else None, rows_.num_rows)[: rows_.num_rows] + bias
            scores = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
            yield pa.RecordBatch.from_arrays([rows_.column("key"), pa.array(scores)], names=["key", "score"])

        yield from in_texts(batches, each)

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, score double").withColumnRenamed("key", key)


def without_toxic(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, whole and unchanged."""
    keys, weights, bias = model
    name = docs.schema[text].name
    rows = docs.withColumnRenamed(name, "text") if name != "text" else docs

    def run(batches):
        for batch in batches:
            for part, data, offsets in in_pieces(batch, "text"):
                t, at = present(*word_features(LOWER[data], offsets), keys)
                margin = np.bincount(t, weights[at] if len(weights) else None, part.num_rows)[: part.num_rows] + bias
                yield part.filter(pa.array(margin < 0))

    return rows.mapInArrow(run, rows.schema).withColumnRenamed("text", name)


def held_out(key: str, folds: int = FOLDS):
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(folds)) == 0


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score, predicted.

    Labels, and the unlabelled text, come from rows alone that aren't held out. Null keys have no label; they are held out
    or not as the empty key is. Null and empty texts are scored as texts without words, repeated rows each
    alike. Empty tables are fine: without labels all scores are the same. Other columns are ignored.
    """
    seen = ~held_out(key)
    model = train(docs.where(seen), labels.where(seen), key, text, toxic)
    return score(docs, model, key, text).select(
        key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
