"""Language model scores by Katz backoff.

The model has pairs and single tokens. Counts up to ``LIMIT`` are discounted by Good-Turing; what that sets free in a history
goes to the tokens unseen after it, in proportion to the single-token model and exactly: the weight of a history is the
mass set free over the single-token mass of unseen tokens. Single tokens free mass in the same way for unknown words,
which are one type. A history that frees nothing (all its counts large) is given one more occurrence, which is freed. A
token's probability is found recursively: its pair, else the history's weight times its single-token probability, else
that of an unknown word.

Texts are worked on in blocks. A block counts its own words and pairs and asks once for each different one; keys are
dealt out to buckets, which sum the blocks' counts, store them as tables and answer each block with the totals of
its keys. So a word in every text is one entry per block, and tables, questions and answers all grow with the text.
Pairs are dealt by their history, so that a bucket has what a history's weight needs. A history with more than a
quarter of a bucket's share of all tokens is dealt by pair instead, and its sums are added up over buckets; there are at
most four such histories per bucket. What reaches the driver is counts of counts and those sums.

Words are known by a 64-bit hash of their bytes: among 10**7 different words, two share one with a chance of 3 in 10**6.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.llm.packed import pack, unpack
from docloom.llm.toxicity import held_out
from docloom.llm.words import LOWER, Words, in_pieces, mixed
from docloom.session import pinned

#: Largest count that is discounted.
LIMIT = 5
BLOCK = 6 << 20
PER_BUCKET, BUCKETS = 1_000_000, 64
END = np.uint64(0x5EED0E4D)
FOLDS = 10


def cuts_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where equal ranges of hashes begin in sorted hashes, and the end."""
    return np.append(np.searchsorted(hashes, np.array([k * (1 << 64) // buckets for k in range(buckets)], np.uint64)), len(hashes))


def discounts(n: np.ndarray) -> np.ndarray:
    """Factors for counts 0 to LIMIT from ``n[r]``, the number of types with count r (r up to LIMIT + 1).

    Where counts of counts are too few for a factor in (0, 1], that count isn't discounted.
    """
    d = np.ones(LIMIT + 1)
    if not n[1]:
        return d
    common = (LIMIT + 1) * n[LIMIT + 1] / n[1]
    for r in range(1, LIMIT + 1):
        if n[r] and common < 1:
            factor = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            d[r] = factor if 0 < factor <= 1 else 1.0
    return d


def factor(d: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The discount of each count; 1 beyond LIMIT."""
    return np.where(count > LIMIT, 1.0, d[np.minimum(count, LIMIT)])


@dataclass(frozen=True)
class Singles:
    """The single-token model: totals and discounts; counts stay in the tables."""

    tokens: int
    types: int
    d: np.ndarray
    unknown: float
    total: float

    @classmethod
    def of(cls, tokens: int, types: int, n: np.ndarray) -> Singles:
        d = discounts(n)
        freed = sum((1 - d[r]) * r * n[r] for r in range(1, LIMIT + 1))
        total = float(tokens) if freed > 0 else tokens + 1.0
        return cls(tokens, types, d, (freed if freed > 0 else 1.0) / total, total)

    def p(self, count: np.ndarray) -> np.ndarray:
        """Probabilities of tokens by their training counts; of count 0, that of the unknown word."""
        return np.where(count > 0, factor(self.d, count) * count / self.total, self.unknown)


def lay_out(docs: DataFrame, buckets: int) -> DataFrame:
    """Blocks of rows (key, text, train).

    Kind 0, one per block: keys, train, lengths (tokens of each text), a (its tokens as places in the block's words).
    Kind 1, per block and bucket: a (hashes of its different words, sorted), b (their counts in training texts).
    """
    names = ["kind", "block", "bucket", "keys", "train", "lengths", "a", "b"]

    def run(batches):
        from pyspark import TaskContext

        context, number = TaskContext.get(), 0
        for batch in batches:
            for rows, data, offsets in in_pieces(batch, "text", BLOCK):
                block = (context.partitionId() << 32) + number
                number += 1
                words = Words(LOWER[data], offsets)
                lengths = words.counts() + 1
                tokens = np.insert(words.hashes(), words.first[1:], END)
                train = rows.column("train").to_numpy(zero_copy_only=False).astype(bool)
                different, place = np.unique(tokens, return_inverse=True)
                counts = np.bincount(place[np.repeat(train, lengths)], minlength=len(different))
                cut = cuts_of(different, buckets)
                parts = [k for k in range(buckets) if cut[k + 1] > cut[k]]
                n = len(parts)
                columns = [
                    pa.array([0] + [1] * n, pa.int32()),
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([None, *parts], pa.int32()),
                    pa.array([rows.column("key").to_pylist()] + [None] * n, pa.list_(pa.int64())),
                    pa.array([train.tolist()] + [None] * n, pa.list_(pa.bool_())),
                    pa.array([pack(lengths)] + [None] * n, pa.binary()),
                    pa.array([pack(place)] + [pack(different[cut[k] : cut[k + 1]]) for k in parts], pa.binary()),
                    pa.array([None] + [pack(counts[cut[k] : cut[k + 1]]) for k in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(
        run, "kind int, block bigint, bucket int, keys array<bigint>, train array<boolean>, lengths binary, a binary, b binary"
    )


REPLY = "kind int, block bigint, bucket int, a binary, b binary, c binary, counts array<bigint>, sums array<double>"
REPLY_NAMES = ["kind", "block", "bucket", "a", "b", "c", "counts", "sums"]


def replies(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=REPLY_NAMES)


def of_counts(n: np.ndarray) -> list[int]:
    """Number of types with counts 0 to LIMIT + 1."""
    return np.bincount(n[n <= LIMIT + 1], minlength=LIMIT + 2).tolist()


def count_words(asked: DataFrame) -> DataFrame:
    """Per bucket: kind 2, the table (a: words, b: counts; counts: counts of counts, types, tokens); and per question
    kind 3, the answer (a: ranks of its words in the bucket by count, b: their counts)."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        words = [unpack(x).view(np.uint64) for x in group.column("a").to_pylist()]
        counts = [unpack(x) for x in group.column("b").to_pylist()]
        different, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(different)).astype(np.int64)
        out = [(2, None, bucket, pack(different), pack(total), None, [*of_counts(total), int((total > 0).sum()), int(total.sum())], None)]
        # frequent words get small numbers, which pack well
        rank = np.empty(len(total), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        at = np.cumsum([len(w) for w in words])[:-1]
        for block, mine in zip(group.column("block").to_pylist(), np.split(place, at), strict=True):
            out.append((3, block, bucket, pack(rank[mine]), pack(total[mine]), None, None, None))
        return replies(out)

    return asked.groupBy("bucket").applyInArrow(run, REPLY)


class Block:
    """Tokens of a block with the totals of its words, and its different pairs with a known history, by bucket."""

    def __init__(self, block: pa.Table, words: list[tuple], n_train: int, hot: float, buckets: int):
        self.keys = block.column("keys")[0].as_py()
        self.train = np.array(block.column("train")[0].as_py(), bool)
        self.lengths = unpack(block.column("lengths")[0].as_py())
        self.tokens = unpack(block.column("a")[0].as_py())
        self.text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        words = sorted(words, key=lambda w: w[0])
        ids = np.concatenate([unpack(a) * buckets + k + 2 for k, a, _ in words])
        counts = np.concatenate([unpack(b) for *_, b in words])
        # two more entries: the beginning of a text, which is a history only, and any unknown word
        start, unknown = len(ids), len(ids) + 1
        self.counts = counts[self.tokens]
        count, id_ = np.append(counts, [n_train, 0]), np.append(ids, [0, 1])
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = start
        after = np.where(self.counts > 0, self.tokens, unknown)
        self.known = np.flatnonzero(count[before] > 0)
        pairs, self.place = np.unique(before[self.known] * (unknown + 1) + after[self.known], return_inverse=True)
        h, w = pairs // (unknown + 1), pairs % (unknown + 1)
        self.n = np.bincount(self.place[self.train[self.text[self.known]]], minlength=len(pairs))
        self.h, self.w, self.h_count, self.w_count = id_[h], id_[w], count[h], count[w]
        bucket = mixed(self.h.astype(np.uint64))
        is_hot = self.h_count > hot
        bucket = np.where(is_hot, mixed(bucket + self.w.astype(np.uint64)), bucket) % np.uint64(buckets)
        self.order = np.lexsort((self.w, self.h, bucket))
        self.cut = np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        self.is_hot = is_hot

    def parts(self):
        """Per bucket: places of its pairs, and where a new history begins among them."""
        for k in range(len(self.cut) - 1):
            mine = self.order[self.cut[k] : self.cut[k + 1]]
            if len(mine):
                yield k, mine, np.flatnonzero(np.diff(self.h[mine], prepend=-1))


def word_replies(table_: pa.Table) -> list[tuple]:
    return [(r["bucket"], r["a"], r["b"]) for r in table_.select(["kind", "bucket", "a", "b"]).to_pylist() if r["kind"] == 3]


PAIRS = "block bigint, bucket int, h binary, h_count binary, runs binary, w binary, w_count binary, n binary"


def ask_pairs(blocks: DataFrame, answers: DataFrame, n_train, hot, buckets) -> DataFrame:
    def run(block: pa.Table, answers_: pa.Table) -> pa.Table:
        b = Block(block, word_replies(answers_), n_train, hot, buckets)
        id_ = block.column("block")[0].as_py()
        rows = [
            (id_, k, pack(b.h[mine][new]), pack(b.h_count[mine][new]), pack(np.diff(np.append(new, len(mine)))), pack(b.w[mine]), pack(b.w_count[mine]), pack(b.n[mine]))
            for k, mine, new in b.parts()
        ]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["block", "bucket", "h", "h_count", "runs", "w", "w_count", "n"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, PAIRS)


def count_pairs(asked: DataFrame, singles: Singles, hot: float) -> DataFrame:
    """Per bucket: kind 4, the table (a: histories, b: following words, c: counts; counts: counts of counts); kind 6 for each
    hot history, its sums (counts: the history, sums: as b and c below); and per question kind 5, the answer (a: totals of its pairs,
    b: types of counts 1 to LIMIT of its histories, c: single-token mass of their seen words)."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        get = lambda name: [unpack(x) for x in group.column(name).to_pylist()]
        heads, runs, w = get("h"), get("runs"), get("w")
        h = np.concatenate([np.repeat(a, r) for a, r in zip(heads, runs, strict=True)])
        w, w_count, n = np.concatenate(w), np.concatenate(get("w_count")), np.concatenate(get("n"))
        order = np.lexsort((w, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
        place = np.empty(len(h), np.int64)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        total = np.bincount(place, n, len(first)).astype(np.int64)
        history, which = np.unique(h[first], return_inverse=True)
        seen = total > 0
        mass = np.bincount(which[seen], singles.p(w_count[first][seen]), len(history)).astype(float)
        few = np.stack([np.bincount(which[total == r], minlength=len(history)) for r in range(1, LIMIT + 1)], axis=1)
        out = [(4, None, bucket, pack(h[first]), pack(w[first]), pack(total), of_counts(total), None)]
        every, at = np.unique(np.concatenate(heads), return_index=True)
        for i in np.flatnonzero(np.concatenate(get("h_count"))[at] > hot).tolist():
            out.append((6, None, bucket, None, None, None, [int(every[i])], [*few[i].astype(float).tolist(), float(mass[i])]))
        pairs = np.split(place, np.cumsum([int(r.sum()) for r in runs])[:-1])
        for block, mine, head in zip(group.column("block").to_pylist(), pairs, heads, strict=True):
            at = np.searchsorted(history, head)
            out.append((5, block, bucket, pack(total[mine]), pack(few[at].reshape(-1)), pack(mass[at]), None, None))
        return replies(out)

    return asked.groupBy("bucket").applyInArrow(run, REPLY)


def evaluate(blocks: DataFrame, answers: DataFrame, singles: Singles, d, sums, n_train, hot, buckets) -> DataFrame:
    """Score every text of the blocks."""
    names = ["key", "train", "n_tokens", "n_known", "base_score", "score"]

    def run(block: pa.Table, answers_: pa.Table) -> pa.Table:
        b = Block(block, word_replies(answers_), n_train, hot, buckets)
        got = {r["bucket"]: r for r in answers_.select(["kind", "bucket", "a", "b", "c"]).to_pylist() if r["kind"] == 5}
        p = np.zeros(len(b.h))
        for k, mine, new in b.parts():
            total, few, mass = unpack(got[k]["a"]), unpack(got[k]["b"]).reshape(-1, LIMIT).astype(float), unpack(got[k]["c"]).copy()
            for i in np.flatnonzero(b.is_hot[mine][new]).tolist():
                *few[i], mass[i] = sums[int(b.h[mine][new][i])]
            count = b.h_count[mine][new].astype(float)
            freed = (few * np.arange(1, LIMIT + 1) * (1 - d[1:])).sum(axis=1)
            divisor = np.where(freed > 1e-12, count, count + 1)
            weight = np.where(freed > 1e-12, freed, 1.0) / divisor / (1 - mass)
            which = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(mine))))
            own = factor(d, total) * total / divisor[which]
            p[mine] = np.where(total > 0, own, weight[which] * singles.p(b.w_count[mine]))
        probability = singles.p(b.counts)
        probability[b.known] = p[b.place]
        base = np.log10((b.counts + 0.1) / (singles.tokens + 0.1 * (singles.types + 1)))
        n = len(b.lengths)
        known = np.bincount(b.text, b.counts > 0, n).astype(np.int64)
        columns = [
            pa.array(b.keys, pa.int64()), pa.array(b.train), pa.array(b.lengths), pa.array(known),
            pa.array(np.bincount(b.text, base, n)), pa.array(np.bincount(b.text, np.log10(probability), n)),
        ]
        return pa.Table.from_arrays(columns, names=names)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "key bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )


@dataclass(frozen=True)
class Katz:
    """The scores, and the model's tables.

    ``scores``: key, train, n_tokens, n_known, train_tokens, base_score, score. ``words`` and ``pairs`` are stored and
    partitioned by bucket, with number arrays (see `packed`) of a bucket in a row.
    """

    scores: DataFrame
    words: DataFrame
    pairs: DataFrame


def katz(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> Katz:
    """Learn from the rows where ``train`` holds (null: it doesn't) and score all rows, each over its whole text and its end.

    Null and empty texts are one end token. Rows that repeat are counted and scored each. Null keys stay null. Without
    any training row all tokens are unknown and every score is 0, as is the base's. Other columns are ignored.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, -(-volume // (6 * PER_BUCKET)))
    laid = pinned(lay_out(rows, buckets))
    n_train = laid.where("kind = 0").agg(F.sum(F.size(F.filter("train", lambda t: t)))).first()[0] or 0
    blocks = laid.where("kind = 0").select("block", "keys", "train", "lengths", "a")
    word_counts = pinned(count_words(laid.where("kind = 1").select("block", "bucket", "a", "b")))
    per_bucket = word_counts.where("kind = 2").select(*[F.col("counts")[r].alias(f"n{r}") for r in range(LIMIT + 4)])
    *n, types, tokens = [x or 0 for x in per_bucket.agg(*[F.sum(c) for c in per_bucket.columns]).first()]
    singles = Singles.of(tokens, types, np.array(n, np.int64))
    hot = singles.tokens / (4 * buckets)
    answers = word_counts.where("kind = 3").select("block", "kind", "bucket", "a", "b", "c")
    asked = ask_pairs(blocks, answers.select("block", "kind", "bucket", "a", "b"), n_train, hot, buckets)
    pair_counts = pinned(count_pairs(asked, singles, hot))
    tables = pair_counts.where("kind = 4").select(*[F.col("counts")[r].alias(f"n{r}") for r in range(LIMIT + 2)])
    n = np.array([x or 0 for x in tables.agg(*[F.sum(c) for c in tables.columns]).first()], np.int64)
    added = pair_counts.where("kind = 6").groupBy(F.col("counts")[0]).agg(*[F.sum(F.col("sums")[r]) for r in range(LIMIT + 1)])
    sums = {r[0]: tuple(r[1:]) for r in added.collect()}
    both = answers.union(pair_counts.where("kind = 5").select("block", "kind", "bucket", "a", "b", "c"))
    scored = evaluate(blocks, both, singles, discounts(n), sums, n_train, hot, buckets)
    return Katz(
        scored.select("key", "train", "n_tokens", "n_known", F.lit(singles.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"),
        word_counts.where("kind = 2").select("bucket", F.col("a").alias("words"), F.col("b").alias("counts")),
        pair_counts.where("kind = 4").select("bucket", F.col("a").alias("histories"), F.col("b").alias("words"), F.col("c").alias("counts")),
    )


def query(spark, sf_dir: str) -> DataFrame:
    scores = katz(table(spark, sf_dir, "documents"), ~held_out("doc_id", FOLDS)).scores
    return scores.select(
        F.col("key").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
