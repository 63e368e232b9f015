"""Removal of repeated passages by seed and extend.

Seeds are runs of ``SEED`` words. Winnowing keeps, of every window of words, the seed with the smallest hash, so equal
windows keep an equal seed: their anchor. Documents are joined on anchors, and everything that follows looks only at
windows whose anchor stands in another document too. From an anchor a match is extended word by word to both sides as long
as the window that ends there is also in an earlier document; the runs of such windows are the maximal repeats, and only
those of a whole window and more are kept.

Comparing documents pair by pair would grow with the square of a passage's frequency. Instead texts are worked on in
pieces, each of which asks once for every different window it has; the windows' hashes are dealt out to buckets, and a
bucket answers with one bit whether some document before the piece's own has the window. A passage in a
third of all documents thus is one question per piece.

Windows are compared by 96 bits of hash: among 10**12 windows two different ones agree with a chance of about 1 in 10**5.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.llm.words import Words, in_pieces, mixed, single_spaced
from docloom.session import pinned

WINDOW = 50
SEED = 18
#: Words per bucket of questions, and the least number of buckets.
PER_BUCKET, BUCKETS = 1_000_000, 64


def sliding(x: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``n`` neighbours."""
    span = 1
    while 2 * span <= n:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[: len(x) - (n - span)], x[n - span :]) if n > span else x


def anchors(words: Words, hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows inside a text, and the hash of each one's anchor."""
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, int), np.empty(0, np.uint64)
    text = np.repeat(np.arange(len(words.first) - 1), words.counts())
    starts = np.flatnonzero(text[:n] == text[window - 1 :])
    return starts, sliding(words.hashes_of_runs(hashes, seed), window - seed + 1, np.minimum)[starts]


def survey(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """key, n_words, sha (of the single-spaced text) and the different anchors of every row."""

    def run(batches):
        for batch in batches:
            for rows, data, offsets in in_pieces(batch, "text"):
                data, offsets = single_spaced(data, offsets)
                words = Words(data, offsets)
                starts, found = anchors(words, words.hashes(), window, seed)
                text = np.searchsorted(words.first, starts, "right") - 1
                lists = [np.unique(found[a:b]).view(np.int64) for a, b in spans(text, rows.num_rows)]
                whole = data.tobytes()
                sha = [hashlib.sha256(whole[a : max(a, b - 1)]).hexdigest() for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
                columns = [rows.column("key"), pa.array(words.counts()), pa.array(sha), pa.array(lists, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "sha", "anchors"])

    return docs.mapInArrow(run, "key bigint, n_words bigint, sha string, anchors array<bigint>")


def spans(text: np.ndarray, n: int) -> list[tuple[int, int]]:
    at = np.searchsorted(text, np.arange(n + 1)).tolist()
    return list(zip(at, at[1:], strict=False))


def window_keys(hashes: np.ndarray, words: Words, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of hash of the windows that start at ``starts``."""
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    a = words.hashes_of_runs(hashes, window)[starts]
    b = words.hashes_of_runs(mixed(hashes + np.uint64(1)), window)[starts]
    return a, (b >> np.uint64(32)).astype(np.uint32)


def different(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (a, b) stand together, and the number of each entry's value in it."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.cumsum(new) - 1


def questions(docs: DataFrame, buckets: int, window: int, seed: int) -> DataFrame:
    """Of rows (key, text, shared anchors): the texts with their windows in question, and what each piece asks.

    Rows of kind 0 are texts: piece, key, text, asked (a bit per word: a window in question starts there). Rows of
    kind 1 are questions: piece, bucket, a, b (hashes in order), least (the piece's smallest key for each).
    """
    names = ["kind", "piece", "bucket", "key", "text", "asked", "a", "b", "least"]

    def run(batches):
        from pyspark import TaskContext

        context, number = TaskContext.get(), 0
        for batch in batches:
            for rows, data, offsets in in_pieces(batch, "text"):
                piece = (context.partitionId() << 32) + number
                number += 1
                words = Words(data, offsets)
                hashes = words.hashes()
                starts, found = anchors(words, hashes, window, seed)
                text = np.searchsorted(words.first, starts, "right") - 1
                shared = rows.column("shared")
                asked = np.zeros(len(words), bool)
                for i, (s, e) in enumerate(spans(text, rows.num_rows)):
                    ours = np.asarray(shared[i].values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                    asked[starts[s:e][np.isin(found[s:e], ours)]] = True
                at = np.flatnonzero(asked)
                key = rows.column("key").to_numpy()[np.searchsorted(words.first, at, "right") - 1]
                a, b = window_keys(hashes, words, at, window)
                order, value = different(a, b)
                first = np.flatnonzero(np.diff(value, prepend=-1))
                least = np.minimum.reduceat(key[order], first) if len(first) else key[:0]
                a, b = a[order][first], b[order][first]
                cut = cuts_of(a, buckets)
                parts = [(int(k), cut[k], cut[k + 1]) for k in range(buckets) if cut[k + 1] > cut[k]]
                bits = [np.packbits(asked[s:e]).tobytes() for s, e in zip(words.first, words.first[1:], strict=False)]
                n, m = rows.num_rows, len(parts)
                columns = [
                    pa.array([0] * n + [1] * m, pa.int32()),
                    pa.array([piece] * (n + m), pa.int64()),
                    pa.array([None] * n + [k for k, *_ in parts], pa.int32()),
                    pa.concat_arrays([rows.column("key"), pa.nulls(m, pa.int64())]),
                    pa.array(rows.column("text").to_pylist() + [None] * m, pa.string()),
                    pa.array(bits + [None] * m, pa.binary()),
                    *[pa.array([None] * n + [x[s:e].tobytes() for _, s, e in parts], pa.binary()) for x in (a, b, least)],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(
        run,
        "kind int, piece bigint, bucket int, key bigint, text string, asked binary, a binary, b binary, least binary",
    )


def bounds(buckets: int) -> np.ndarray:
    """Where the buckets begin in the range of 64-bit hashes."""
    return np.array([k * (1 << 64) // buckets for k in range(buckets)], np.uint64)


def cuts_of(a: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin in sorted hashes, and the end."""
    return np.append(np.searchsorted(a, bounds(buckets)), len(a))


def answers(asked: DataFrame) -> DataFrame:
    """Of questions (piece, bucket, a, b, least): a bit for each hash, set if a smaller key than ``least`` has it."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        a = np.frombuffer(b"".join(group["a"]), np.uint64)
        b = np.frombuffer(b"".join(group["b"]), np.uint32)
        least = np.frombuffer(b"".join(group["least"]), np.int64)
        order, value = different(a, b)
        first = np.flatnonzero(np.diff(value, prepend=-1))
        smallest = np.minimum.reduceat(least[order], first)
        earlier = np.empty(len(a), bool)
        earlier[order] = smallest[value] < least[order]
        cuts = np.cumsum([len(x) // 8 for x in group["a"]])[:-1]
        return pd.DataFrame(
            {
                "piece": group["piece"],
                "bucket": group["bucket"],
                "bits": [np.packbits(x).tobytes() for x in np.split(earlier, cuts)],
            }
        )

    return asked.groupBy("bucket").applyInPandas(run, "piece bigint, bucket int, bits binary")


def removals(texts: DataFrame, replies: DataFrame, buckets: int, window: int) -> DataFrame:
    """key, sha (of all words), n_removed, kept_sha and removed spans (first word, end) of texts that lose something."""

    def run(docs: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["key", "sha", "n_removed", "kept_sha", "spans"])
        raw = [t.encode() for t in docs["text"]]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        data = np.frombuffer(b"".join(raw), np.uint8)
        words = Words(data, offsets)
        asked = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(docs["asked"], words.counts(), strict=True)]
        at = np.flatnonzero(np.concatenate(asked))
        owner = np.searchsorted(words.first, at, "right") - 1
        key = docs["key"].to_numpy(np.int64)[owner]
        a, b = window_keys(words.hashes(), words, at, window)
        order, value = different(a, b)
        first = np.flatnonzero(np.diff(value, prepend=-1))
        cut = cuts_of(a[order][first], buckets)
        earlier = np.zeros(len(first), bool)
        for k, reply in zip(bits["bucket"], bits["bits"], strict=True):
            earlier[cut[k] : cut[k + 1]] = np.unpackbits(np.frombuffer(reply, np.uint8), count=int(cut[k + 1] - cut[k]))
        least = np.minimum.reduceat(key[order], first) if len(first) else key[:0]
        repeated = np.zeros(len(at), bool)
        repeated[order] = earlier[value] | (least[value] < key[order])
        edge = np.zeros(len(words) + window + 1, np.int64)
        edge[at[repeated]] += 1
        edge[at[repeated] + window] -= 1
        gone = np.cumsum(edge)[: len(words)] > 0
        out = []
        for i, (s, e) in enumerate(zip(words.first.tolist(), words.first[1:].tolist(), strict=False)):
            mine = gone[s:e]
            if not mine.any():
                continue
            step = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
            every = raw[i].split()
            kept = [every[w] for w in np.flatnonzero(~mine)]
            shas = [hashlib.sha256(b" ".join(x)).hexdigest() for x in (every, kept)]
            out.append((docs["key"].iloc[i], shas[0], int(mine.sum()), shas[1], step.tolist()))
        return pd.DataFrame(out, columns=["key", "sha", "n_removed", "kept_sha", "spans"])

    return texts.groupBy("piece").cogroup(replies.groupBy("piece")).applyInPandas(
        run, "key bigint, sha string, n_removed bigint, kept_sha string, spans array<bigint>"
    )


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept_sha256, removed_spans (starts and ends of word numbers).

    A word is removed if a window of ``window`` consecutive words of its document covers it whose words also start in
    a document with a smaller key, as both stood in the input. Null and empty texts, and texts below one window, lose nothing.
    Rows without a key lose nothing and take nothing from others; rows that repeat a key don't take from each other.
    An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    found = pinned(survey(rows, window, seed))
    each = found.where("key IS NOT NULL").select("key", "sha", F.explode("anchors").alias("anchor"))
    shared = pinned(
        each.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("anchor")
    )
    lists = each.join(shared, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("shared"))
    words = found.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(BUCKETS, -(-words // PER_BUCKET))
    texts = rows.join(lists, "key").select("key", F.coalesce("text", F.lit("")).alias("text"), "shared")
    asked = pinned(questions(texts, buckets, window, seed))
    replies = answers(asked.where("kind = 1").select("piece", "bucket", "a", "b", "least"))
    lost = removals(asked.where("kind = 0").select("piece", "key", "text", "asked"), replies, buckets, window)
    once = pinned(lost.dropDuplicates(["key", "sha"]))
    return found.join(once, ["key", "sha"], "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<bigint>")).alias("removed_spans"),
    )


#: Windows as lists of words, compared as such; for small tables.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
), hit AS (
  SELECT doc_id, i FROM win JOIN (SELECT h, min(doc_id) AS least FROM win GROUP BY h) USING (h) WHERE least < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + j AS p FROM hit, range(50) AS r(j)
), word AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT doc_id, array_to_string(list(word ORDER BY p), ' ') AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def query(spark, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents")).drop("removed_spans")
