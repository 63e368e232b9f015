"""Language identification by sparse multinomial logistic regression on character n-grams.

Texts are folded first: letters in lower case, everything else one space. Runs of one to three characters are hashed into
``2 ** BITS`` places. The number of documents with each place, in every language, is counted over all learning rows; the
places that tell languages apart best (by the likelihood ratio) are the features, and their inverse document frequencies
come from the same counts. A text's features are weighed by (1 + log count) times that frequency and scaled to length 1.

The classifier is fitted by follow-the-regularised-leader with elastic-net penalties (McMahan et al., 2013), so most
weights are exactly zero, on a sample of at most about ``sample`` rows, as many of each language, drawn by a hash of the
row. The sample's features, at most ``sample`` times ``features`` numbers, are all that reaches the driver. A fifth of it is
kept back to fit one temperature, by which the scores are divided, so that the largest probability says how sure it is.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.llm.words import buffers, mixed
from docloom.session import pinned

BITS = 16
LONGEST = 3
#: Bytes and texts that are worked on at once.
PIECE = 1 << 20
TEXTS = 64
#: Languages whose counts a task holds before it hands them on.
HELD_LANGUAGES = 64
UNDETERMINED = "und"
_folds: list[np.ndarray] = []


def folded() -> np.ndarray:
    """For every code point its lower-case letter (marks stay as they are), or a space; a letter's top bit is set."""
    if not _folds:
        out = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))[0]
            if kind == "L":
                low = chr(i).lower()
                out[i] = (ord(low) if len(low) == 1 else i) | 1 << 31
            elif kind == "M":
                out[i] = i
        _folds.append(out)
    return _folds[0]


def code_points(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The code point that begins at each position; whatever the bytes are, one number per position."""
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    first = wide[heads]
    out = first.copy()
    for n, low, bits in ((1, 0xC0, 0x1F), (2, 0xE0, 0x0F), (3, 0xF0, 0x07)):
        long = np.flatnonzero(first >= low)
        if not len(long):
            break
        value = first[long] & bits
        for i in range(1, n + 1):
            value = value << 6 | wide[heads[long] + i] & 0x3F
        out[long] = value
    return np.minimum(out, 0x10FFFF)


def runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of consecutive texts, a few bytes at a time: the text and the place of every n-gram, and the texts that have a letter.

    Where a text is cut, its last characters go over to the next piece, so no n-gram is lost or seen twice.
    """
    heads = (data & 0xC0) != 0x80
    carry_c, carry_t = np.empty(0, np.uint32), np.empty(0, np.int64)
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not heads[end]:
            end += 1
        begins = np.flatnonzero(heads[at:end])
        text = np.searchsorted(offsets, begins + at, "right") - 1
        codes = folded()[code_points(data[at:end], begins)]
        lettered = np.unique(text[codes >> 31 == 1])
        codes = codes & np.uint32(0x7FFFFFFF)
        fresh = len(carry_c)
        codes, text = np.concatenate([carry_c, codes]), np.concatenate([carry_t, text])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (text[1:] != text[:-1])
        keep[:fresh] = True
        new = np.cumsum(keep)[fresh - 1] if fresh else 0
        codes, text = codes[keep], text[keep]
        texts, places = [], []
        value = np.zeros(len(codes), np.uint64)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            value = value[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
            same = text[n - 1 :] == text[: len(text) - n + 1]
            same[: max(new - n + 1, 0)] = False  # seen with the piece before
            texts.append(text[: len(text) - n + 1][same])
            places.append((mixed(value[same]) >> np.uint64(64 - BITS)).astype(np.int64))
        yield np.concatenate(texts or [text]), np.concatenate(places or [text]), lettered
        carry_c, carry_t = codes[-(LONGEST - 1) :].copy(), text[-(LONGEST - 1) :].copy()
        at = end


def in_groups(batches, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with at most ``TEXTS`` texts and ``PIECE`` bytes (or one longer text), their bytes and offsets."""
    for batch in batches:
        data, offsets = buffers(batch.column(text))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, min(i + TEXTS, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1))
            yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j


@dataclass(frozen=True)
class Model:
    languages: list[str]
    feature: np.ndarray  # of every place its feature, or -1
    idf: np.ndarray
    weights: np.ndarray  # feature, language
    bias: np.ndarray
    temperature: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax((x @ self.weights + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def weighed(data: np.ndarray, offsets: np.ndarray, feature: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row of feature weights per text, of length 1 or 0, and whether the text has a letter."""
    n = len(offsets) - 1
    counts, lettered = np.zeros(n * len(idf)), np.zeros(n, bool)
    for text, place, some in runs(data, offsets):
        at = feature[place]
        known = at >= 0
        counts += np.bincount(text[known] * len(idf) + at[known], minlength=len(counts))
        lettered[some] = True
    x = counts.reshape(n, len(idf))
    seen = x > 0
    x[seen] = 1 + np.log(x[seen])
    x *= idf
    return x / np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-300), lettered


def document_counts(rows: DataFrame) -> DataFrame:
    """lang, place, n: documents of the language with the place; place -1 counts all that have a letter."""

    def count(batches):
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                place = np.flatnonzero(n)
                columns = [pa.array([lang] * len(place)), pa.array(place - 1), pa.array(n[place])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "place", "n"])
            held.clear()

        for part, data, offsets in in_groups(batches, "text"):
            present = np.zeros((part.num_rows, (1 << BITS) + 1), bool)
            for text, place, some in runs(data, offsets):
                present[text, place + 1] = True
                present[some, 0] = True
            present &= present[:, :1]
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in set(langs):
                if lang not in held:
                    held[lang] = np.zeros((1 << BITS) + 1, np.int64)
                held[lang] += present[langs == lang].sum(0)
            if len(held) > HELD_LANGUAGES:
                yield from out()
        yield from out()

    return rows.mapInArrow(count, "lang string, place bigint, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))


def chosen(counts: DataFrame, totals: dict[str, int], features: int, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The places that tell languages apart best, sorted, and their inverse document frequencies."""
    total = float(sum(totals.values()))
    sizes = counts.sparkSession.createDataFrame(sorted(totals.items()), "lang string, size bigint")
    rate = F.col("all_n") / total
    per_place = counts.where("place >= 0").groupBy("place").agg(F.sum("n").alias("all_n"))
    k, size = F.col("n").cast("double"), F.col("size").cast("double")
    # against one share for all languages; languages without the place add -size * log(1 - rate), summed up as a rest
    here = k * F.log(k / (size * rate)) + F.when(k < size, (size - k) * F.log((size - k) / (size * (1 - rate)))).otherwise(0.0)
    parts = counts.where("place >= 0").join(sizes, "lang").join(per_place, "place").where(F.col("all_n") < total)
    ratio = parts.groupBy("place", "all_n").agg(F.sum(here).alias("part"), F.sum(size).alias("covered"))
    ratio = ratio.select("place", "all_n", (F.col("part") - (total - F.col("covered")) * F.log(1 - rate)).alias("ratio"))
    top = ratio.where(F.col("all_n") >= least).orderBy(F.desc("ratio"), "place").limit(features).select("place", "all_n").collect()
    top = sorted((r[0], r[1]) for r in top)
    places, n = np.array([r[0] for r in top], np.int64), np.array([r[1] for r in top], float)
    return places, np.log((1 + total) / (1 + n)) + 1


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_features: int, n_languages: int, rounds: int = 3, rate: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by follow-the-regularised-leader, row after row; ``l1`` makes weights exactly zero.

    The last feature is 1 in every row and carries the biases, without penalties.
    """
    z, n = np.zeros((n_features + 1, n_languages)), np.zeros((n_features + 1, n_languages))

    def weights(at):
        zz, nn = z[at], n[at]
        first = np.where(at == n_features, 0.0, l1)[:, None]
        second = np.where(at == n_features, 0.0, l2)[:, None]
        return -np.sign(zz) * np.maximum(np.abs(zz) - first, 0) / ((beta + np.sqrt(nn)) / rate + second)

    for _ in range(rounds):
        for (at, x), language in zip(rows, y):
            at, x = np.append(at, n_features), np.append(x, 1.0)
            w = weights(at)
            p = softmax((x @ w)[None, :])[0]
            p[language] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / rate * w
            n[at] = more
    w = weights(np.arange(n_features + 1))
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which ``y`` is likeliest, between 1/20 and 20, by golden section (one minimum)."""
    if not len(y):
        return 1.0

    def loss(log_t):
        z = logits / np.exp(log_t)
        return (np.logaddexp.reduce(z, axis=1) - z[np.arange(len(y)), y]).mean()

    low, high = -np.log(20), np.log(20)
    part = (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 6_000, features: int = 8_192) -> Model:
    """A model from all rows of ``docs`` with a language and a letter; rows that repeat a key and a text may be drawn once only."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counts = pinned(document_counts(rows.select("text", "lang")))
    totals = {r.lang: r.n for r in counts.where("place = -1").collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.full(1 << BITS, -1), np.empty(0), np.zeros((0, 0)), np.empty(0), 1.0)
    places, idf = chosen(counts, totals, features)
    feature = np.full(1 << BITS, -1, np.int64)
    feature[places] = np.arange(len(places))
    share = sample / len(languages)
    rates = docs.sparkSession.createDataFrame([(k, min(1.0, share / n)) for k, n in totals.items()], "lang string, rate double")
    unit = F.pmod(F.xxhash64(F.lit("sample"), "row"), F.lit(1 << 30)) / float(1 << 30)
    # a row per language, which the driver holds already; texts must not be dealt by language
    drawn = rows.join(F.broadcast(rates), "lang").where(unit < F.col("rate")).select("row", "lang", "text")

    def lists(batches):
        for part, data, offsets in in_groups(batches, "text"):
            x, lettered = weighed(data, offsets, feature, idf)
            row, at = np.nonzero(x * lettered[:, None])
            edges = np.searchsorted(row, np.arange(part.num_rows + 1))
            of = lambda v, kind: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(v, kind))
            columns = [part.column("row"), part.column("lang"), of(at, pa.int32()), of(x[row, at], pa.float32())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "lang", "at", "x"]).filter(pa.array(lettered))

    got = drawn.mapInArrow(lists, "row bigint, lang string, at array<int>, x array<float>").dropDuplicates(["row", "lang"]).toArrow()
    number = {k: i for i, k in enumerate(languages)}
    ids = np.array(got.column("row").to_pylist(), np.int64)
    names = got.column("lang").to_pylist()
    # in order of a hash, and in that of the languages' names where rows are equal: reruns agree
    order = np.lexsort((np.array([number[k] for k in names]), mixed(ids.view(np.uint64))))
    at, x = got.column("at").combine_chunks(), got.column("x").combine_chunks()
    cut = at.offsets.to_numpy()
    at, x = at.values.to_numpy().astype(np.int64), x.values.to_numpy().astype(float)
    some = [(at[cut[i] : cut[i + 1]], x[cut[i] : cut[i + 1]]) for i in order]
    y = np.array([number[names[i]] for i in order])
    back = np.arange(len(y)) % 5 == 4
    weights, bias = fit([r for r, b in zip(some, back) if not b], y[~back], len(places), len(languages))
    logits = np.array([v @ weights[i] + bias for (i, v), b in zip(some, back) if b]).reshape(-1, len(languages))
    return Model(languages, feature, idf, weights, bias, temperature(logits, y[back]))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score of every row of ``docs``; ``und`` with score 0 for null and texts without a letter, or without a model."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = np.array([*model.languages, UNDETERMINED], object)

    def run(batches):
        for part, data, offsets in in_groups(batches, "text"):
            x, lettered = weighed(data, offsets, model.feature, model.idf)
            if len(model.languages):
                p = model.probabilities(x)
                best, score = p.argmax(1), p.max(1)
            else:
                best, score, lettered = np.zeros(part.num_rows, int), np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
            named = names[np.where(lettered, best, len(model.languages))]
            columns = [part.column("key"), pa.array(named, pa.string()), pa.array(np.where(lettered, score, 0.0))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "lang_pred", "score"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, lang_pred string, score double").withColumnRenamed("key", key)


def held_out(key: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(4)) == 2


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: key, held_out, lang_pred, score.

    Only rows that aren't held out, with a language and a letter in the text, teach. Null keys are held out or not as the empty
    key is. Null texts and texts without a letter are ``und`` with score 0, and so is everything where no row teaches. Repeated
    rows are each predicted alike; of equal scores the first language by name wins. An empty table gives no row. Other
    columns are ignored, whatever their names.
    """
    model = train(docs.where(~held_out(key)), key, text, lang)
    return predict(docs, model, key, text).select(key, held_out(key).alias("held_out"), "lang_pred", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
