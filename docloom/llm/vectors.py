"""Near-duplicate vectors by product quantisation.

Vectors are scaled to length 1, so a cosine is a distance. A coarse quantiser deals them out to inverted lists; what is left
after taking off a list's centre is coded by one byte per subspace, and its coding error is kept. Every vector searches the
lists whose centres are nearest to it. How many is measured on the table and its lists: held vectors are compared with all
others, and as many lists are searched as find ``recall`` of their links, of all and on average over the vectors. In a list, distances come from one table per query and subspace
(asymmetric: the query isn't coded). A pair passes if that distance, less the coding error, may be within the
threshold, so the codes lose nothing; what passes is compared by exact cosine in double precision.

A vector and its copies are one entry with a count. Lists are cut into blocks of at most ``BLOCK`` vectors on either side,
and a task compares a block of queries with a block of entries, so a list with a third of all vectors is spread over many
tasks. Each task gives out numbers of links and a spanning forest of them, never the pairs.

Quantisers are fitted on at most about ``sample`` vectors, drawn by a hash of their identifiers; all vectors are coded and
searched. The model has at most ``MOST_LISTS`` centres and 256 code words per subspace, a few MB, whatever the table's size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table, uniform
from docloom.llm.components import components
from docloom.session import pinned

BLOCK = 1024
#: Held vectors by which the number of searched lists is measured; rows compared with them at once.
HELD = 1024
ROWS = 2048
MOST_LISTS = 4096
#: Pairs whose exact cosine is computed at once.
PAIRS = 1 << 16


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :], 0)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centres; a centre without rows moves to a random row."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = squares(x, centres).argmin(1)
        size = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.integers(0, len(x), len(centres))])
    return centres


@dataclass(frozen=True)
class Quantiser:
    centres: np.ndarray
    words: np.ndarray  # subspace, code, dimension of the subspace

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, subspaces: int, seed: int = 3) -> Quantiser:
        rng = np.random.default_rng(seed)
        centres = k_means(x, lists, rng)
        rest = x - centres[squares(x, centres).argmin(1)]
        return cls(centres, np.stack([k_means(part, 256, rng) for part in cls.split(rest, subspaces)]))

    @staticmethod
    def split(x: np.ndarray, subspaces: int) -> np.ndarray:
        """Subspaces first; the last one is filled up with zeros."""
        width = -(-x.shape[1] // subspaces)
        padded = np.pad(x, ((0, 0), (0, width * subspaces - x.shape[1])))
        return padded.reshape(len(x), subspaces, width).transpose(1, 0, 2)

    def code(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A byte per subspace, and the coding error of every row."""
        rest = self.split(x - self.centres[lists], len(self.words))
        codes = np.stack([squares(r, w).argmin(1) for r, w in zip(rest, self.words, strict=True)])
        error = sum(((r - w[c]) ** 2).sum(1) for r, w, c in zip(rest, self.words, codes, strict=True))
        return codes.T.astype(np.uint8), np.sqrt(error)

    def distances(self, queries: np.ndarray, list_: int, codes: np.ndarray) -> np.ndarray:
        """Of all queries to all coded entries of a list, from one table per subspace."""
        rest = self.split(queries - self.centres[list_], len(self.words))
        total = np.zeros((len(queries), len(codes)), np.float32)
        for r, w, c in zip(rest, self.words, codes.T, strict=True):
            total += squares(r, w).astype(np.float32)[:, c]
        return np.sqrt(total)


def unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def usable(vector: Column, width: int) -> Column:
    """Vectors with a direction: ``width`` finite numbers, not all of them zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector) == width) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def indexed(entries: DataFrame, model: Quantiser, probes: int) -> DataFrame:
    """Add list, code, error and the probed lists to (id, n, vector)."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(batch.column("vector"))
            far = squares(x, model.centres)
            nearest = np.argsort(far, axis=1, kind="stable")[:, :probes].astype(np.int32)
            codes, error = model.code(x, nearest[:, 0])
            columns = [
                batch.column("id"),
                batch.column("n"),
                batch.column("vector"),
                pa.array(nearest[:, 0]),
                pa.array([c.tobytes() for c in codes]),
                pa.array(error),
                pa.array(list(nearest), pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "vector", "list", "code", "error", "probes"])

    kind = dict(entries.dtypes)["vector"]
    return entries.mapInArrow(run, f"id bigint, n bigint, vector {kind}, list int, code binary, error double, probes array<int>")


def ranks_of_links(entries: DataFrame, held: pa.Table, model: Quantiser, least: float) -> DataFrame:
    """query, lists, n: how many links of a row of ``held`` (id, vector) are found from that number of searched lists on.

    A link is found if either of its vectors searches the list of the other.
    """
    queries, ids = unit(held.column("vector")), held.column("id").to_numpy()
    far = squares(queries, model.centres)
    home = far.argmin(1)
    rank = far.argsort(1, kind="stable").argsort(1, kind="stable")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                x = unit(part.column("vector"))
                q, y = np.nonzero((queries @ x.T >= least) & (ids[:, None] != part.column("id").to_numpy()[None, :]))
                if not len(q):
                    continue
                hit, at = np.unique(y, return_inverse=True)
                away = squares(x[hit], model.centres)
                order = away.argsort(1, kind="stable").argsort(1, kind="stable")
                lists = 1 + np.minimum(rank[q, away.argmin(1)[at]], order[at, home[q]])
                found, n = np.unique(np.stack([q, lists]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (*found, n)], names=["query", "lists", "n"])

    made = entries.select("id", "vector").mapInArrow(run, "query bigint, lists bigint, n bigint")
    return made.groupBy("query", "lists").agg(F.sum("n").alias("n"))


def recall_of(links: np.ndarray, lists: int) -> float:
    """Of rows (query, lists, n), what that number of lists finds: the smaller of all links' share and the queries' average."""
    found = np.where(links[:, 1] <= lists, links[:, 2], 0)
    _, query = np.unique(links[:, 0], return_inverse=True)
    return float(min(found.sum() / links[:, 2].sum(), (np.bincount(query, found) / np.bincount(query, links[:, 2])).mean()))


def searched(links: np.ndarray, recall: float, fewest: int) -> int:
    """The number of lists, at least ``fewest``, that finds ``recall`` of the links; without links there is nothing to go by."""
    every = [fewest, *np.unique(links[:, 1][links[:, 1] > fewest]).tolist()] if len(links) else [fewest]
    return next((int(n) for n in every if not len(links) or recall_of(links, n) >= recall), int(every[-1]))


FOUND = "a bigint, b bigint, links bigint"


def compare(blocks: DataFrame, model: Quantiser, least: float) -> DataFrame:
    """Of blocks (list, q, e, asks, entry): rows (a, null, links) and the links (a, b, null) of a spanning forest."""
    reach = np.sqrt(2 - 2 * least)

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy().astype(bool)
        queries, entries = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        none = np.empty(0, np.int64)
        ids, links, (a, b) = matches(queries, entries) if queries.num_rows and entries.num_rows else (none, none, (none, none))
        columns = [
            pa.array(np.concatenate([ids, a]), pa.int64()),
            pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(b, pa.int64())]),
            pa.concat_arrays([pa.array(links, pa.int64()), pa.nulls(len(a), pa.int64())]),
        ]
        return pa.Table.from_arrays(columns, names=["a", "b", "links"])

    def matches(queries: pa.Table, entries: pa.Table):
        x, y = unit(queries.column("vector")), unit(entries.column("vector"))
        list_ = entries.column("list")[0].as_py()
        codes = np.frombuffer(b"".join(entries.column("code").to_pylist()), np.uint8).reshape(len(y), -1)
        error = entries.column("error").to_numpy()
        i, j = np.nonzero(model.distances(x, list_, codes) <= reach + error[None, :] + 1e-4)
        x_id, y_id = queries.column("id").to_numpy(), entries.column("id").to_numpy()
        cosine = [np.einsum("ij,ij->i", x[i[k : k + PAIRS]], y[j[k : k + PAIRS]]) for k in range(0, len(i), PAIRS)]
        hit = (np.concatenate([np.empty(0), *cosine]) >= least) & (x_id[i] != y_id[j])
        i, j = i[hit], j[hit]
        # an entry that doesn't search the query's list won't find this link by itself, so it is counted here
        probed = np.array(entries.column("probes").to_pylist())
        home = queries.column("home").to_numpy()
        blind = ~(probed[j] == home[i][:, None]).any(1)
        n_x, n_y = queries.column("n").to_numpy(), entries.column("n").to_numpy()
        ids = np.concatenate([x_id, y_id])
        links = np.concatenate(
            [np.bincount(i, n_y[j], len(x)), np.bincount(j[blind], n_x[i[blind]], len(y))]
        ).astype(np.int64)
        some = links > 0
        return ids[some], links[some], forest(x_id[i], y_id[j])

    return blocks.groupBy("list", "q", "e").applyInArrow(run, FOUND)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what the links a-b connect."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        lowest = label.copy()
        np.minimum.at(lowest, a, label[b])
        np.minimum.at(lowest, b, label[a])
        lowest = lowest[lowest]
        if (lowest == label).all():
            break
        label = lowest
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def in_blocks(index: DataFrame) -> DataFrame:
    """Every list's queries and entries in blocks of at most about BLOCK, each block of queries beside each of entries."""
    columns = ["id", "n", "vector", "list", "code", "error", "probes"]
    queries = index.select("id", F.explode("probes").alias("at"))
    sizes = pinned(
        queries.groupBy("at").agg(F.count("*").alias("asked")).join(
            index.groupBy(F.col("list").alias("at")).agg(F.count("*").alias("held")), "at"
        ).select("at", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("asked", "held")])
    )
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = index.select(*columns, F.explode("probes").alias("at")).join(sizes, "at")
    asking = asking.select(*columns, "at", part("asked").alias("q"), every("held").alias("e"), F.lit(True).alias("asks"))
    held = index.withColumn("at", F.col("list")).join(sizes, "at")
    held = held.select(*columns, "at", every("asked").alias("q"), part("held").alias("e"), F.lit(False).alias("asks"))
    return asking.union(held)


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9,
    lists: int | None = None, subspaces: int = 8, probes: int = 8, sample: int = 20_000, recall: float = 0.999,
) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    ``lists`` defaults to the square root of the number of different vectors, at most MOST_LISTS. ``probes`` is the fewest lists
    that a vector searches; it is raised until links of about HELD held vectors are found to ``recall``. Vectors that are null, zero
    or of another width than most, or that hold a null or a number that isn't finite, link with nothing, not even with
    their like; nor do vectors without a key (their component_id is null). Rows that repeat a vector link with each
    other. An empty table gives an empty result. Other columns are ignored.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    widths = rows.where("vector IS NOT NULL AND size(vector) > 0").groupBy(F.size("vector").alias("width")).count()
    common = widths.orderBy(F.desc("count"), "width").first()
    width = common[0] if common else 0
    good = rows.where(F.col("id").isNotNull() & usable(F.col("vector"), width))
    # adding 0.0 makes one zero of two, so that equal vectors have equal arrays
    same = F.transform("vector", lambda v: v + F.lit(0.0).cast("float"))
    grouped = good.select("id", same.alias("vector")).groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    entries = pinned(grouped.select("id", "n", "vector"))
    n = entries.count()
    found = None
    if n:
        drawn = entries.where(uniform(F.col("id"), 5) < sample / n).select("id", "vector").orderBy("id")
        drawn = drawn if drawn.head() is not None else entries.select("id", "vector").orderBy("id").limit(1)
        count = lists or min(MOST_LISTS, max(1, int(np.sqrt(n))))
        model = Quantiser.fit(unit(drawn.select("vector").toArrow().column("vector")), count, subspaces)
        if probes < len(model.centres):
            held = entries.where(uniform(F.col("id"), 6) < HELD / n).select("id", "vector").orderBy("id").toArrow()
            ranks = ranks_of_links(entries, held, model, least).toPandas().to_numpy() if held.num_rows else np.empty((0, 3))
            probes = searched(ranks, recall, probes)
        index = pinned(indexed(entries, model, min(probes, len(model.centres))))
        blocks = in_blocks(index).withColumnRenamed("list", "home").withColumnRenamed("at", "list")
        found = pinned(compare(blocks, model, least))
    else:
        found = pinned(entries.select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("n").alias("links")))
    links = found.where("links IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL"))
    named = pinned(
        entries.join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
            "id", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("root")
        )
    )
    least_ids = pinned(named.groupBy("root").agg(F.min("id").alias("component")))
    members = pinned(named.join(least_ids, "root").select("vector", "n_links", "component"))
    valid = F.when(F.col("id").isNotNull() & usable(F.col("vector"), width), same)
    joined = rows.select("id", valid.alias("vector")).join(members, "vector", "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
