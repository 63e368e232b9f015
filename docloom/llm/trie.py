"""A z-fast trie over conversations: every distinct prefix of turns with its members, in tables.

A prefix is known by a hash: the sum, in four limbs modulo 2**32, of a hash of every turn and its position; equal hashes of
128 bits count as equal prefixes. Conversations that are the same all through are one sequence with a count, so texts
never move and a conversation that thousands repeat is one path.

A compacted node is an edge: the depths above ``p`` to ``e`` that the same sequences share. Its handle is the prefix at the
two-fattest depth, the one in (p, e] that the largest power of two divides. The table of handles lets a sequence
of length L find the node at which it leaves the trie in log2(L) lookups (fat binary search; Belazzougui, Boldi and others, 2009):
a hit at the two-fattest depth of what is left goes on below that node, a miss above it.

Sequences are inserted in two batches: one of EARLY, drawn by a hash, into the empty trie, then all others, which look up their exit
nodes in the trie of the first. From there on the search alone tells where a sequence leaves: no step walks down from the root. Of those
that leave the trie at one place by the same turn one, drawn by a hash, becomes a new edge; the others go along it until they
leave it or end, and so on, until each has its place. As the drawn one is any of them, few rounds are needed. Edges are cut
where sequences leave or end, once for a batch.

Sums over subtrees come by pointer doubling over the compacted nodes: in round k a node passes its sums to the ancestor 2**k
edges up, so rounds grow with the logarithm of the height. Edges are then expanded to one row per depth. All steps are
joins and sums over rows of single turns, so neither a long conversation nor a much shared one is in one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.operators.numbering import running
from docloom.session import pinned

FAMILY, MOST_SHARED = 100, 6
LIMBS = ("w0", "w1", "w2", "w3")
#: Depths of an edge, and identifiers of a list, that are worked on as one row.
CHUNK = 4096
#: One of that many sequences is in the first batch.
EARLY = 16


def root() -> Column:
    """The hash of the empty prefix."""
    return F.unhex(F.lit("00" * 16))


# --- sequences and the hashes of their prefixes ---------------------------------------------------------------------


def family_head(conv: Column) -> tuple[Column, Column]:
    """The conversation whose first turns are shared, and how many."""
    return conv - conv % FAMILY, F.crc32(conv.cast("string")) % MOST_SHARED


def rebuilt(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, chars) of all turns of the rebuilt conversations, and (conv) of all conversations."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    who, what = clean(role), clean(text)
    turns = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what))).alias("digest"),
        F.char_length(what).cast("bigint").alias("chars"),
        F.lit(1).cast("bigint").alias("i"),
    )
    turns = pinned(running(turns, ["conv"], ["turn", "digest"], ["i"]))
    head, h = family_head(F.col("conv"))
    sizes = pinned(turns.groupBy("conv").agg(F.count("*").alias("n")))
    heads = sizes.select(F.col("conv").alias("head"), F.col("n").alias("n_head"))
    all_convs = pinned(
        sizes.select("conv", head.alias("head"), h.alias("h"))
        .join(heads, "head", "left")
        .select("conv", "head", F.least("h", F.coalesce("n_head", F.lit(0).cast("bigint"))).alias("shared"))
    )
    first = turns.where(F.col("i") < MOST_SHARED).select(F.col("conv").alias("head"), "i", "digest", "chars")
    lent = all_convs.join(first, "head").where("i < shared").select("conv", (F.col("i") + 1).alias("depth"), "digest", "chars")
    own = turns.where(F.col("i") >= h).join(all_convs, "conv")
    own = own.select("conv", (F.col("i") - h + F.col("shared") + 1).alias("depth"), "digest", "chars")
    return lent.unionByName(own), all_convs.select("conv")


def hashed(turns: DataFrame) -> DataFrame:
    """(conv, depth, h, chars, upto): the hash of every prefix, and the characters up to its end."""
    mark = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("digest")))
    limb = lambda i: F.conv(F.substring("mark", 8 * i + 1, 8), 16, 10).cast("bigint")
    own = turns.select("conv", "depth", "chars", mark.alias("mark"))
    own = own.select("conv", "depth", "chars", *[limb(i).alias(w) for i, w in enumerate(LIMBS)])
    values = ["chars", *LIMBS]
    # depths are numbers without gaps, so bins of them deal a long conversation over tasks
    binned = own.withColumn("bin", F.floor(F.col("depth") / CHUNK))
    totals = binned.groupBy("conv", "bin").agg(*[F.sum(v).alias(f"t_{v}") for v in values])
    earlier = Window.partitionBy("conv").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv", "bin", *[F.coalesce(F.sum(f"t_{v}").over(earlier), F.lit(0).cast("bigint")).alias(f"t_{v}") for v in values])
    upto = Window.partitionBy("conv", "bin").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = binned.withColumns({f"sum_{v}": F.sum(v).over(upto) for v in values}).join(carried, ["conv", "bin"])
    up = lambda v: F.col(f"sum_{v}") + F.col(f"t_{v}")
    part = lambda w: F.lpad(F.hex(F.pmod(up(w), F.lit(1 << 32))), 8, "0")
    return summed.select("conv", "depth", F.unhex(F.concat(*map(part, LIMBS))).alias("h"), "chars", up("chars").alias("upto"))


# --- the trie ---------------------------------------------------------------------------------------------------------


def fattest(a: str, b: str) -> Column:
    """The number in (a, b] that the largest power of two divides."""
    return F.expr(f"shiftleft(-1L, length(bin({a} ^ {b})) - 1) & {b}")


def at(paths: DataFrame, conv: str, depth: str, **out: str) -> DataFrame:
    """``paths`` to be joined on ``conv`` and ``depth``, with the columns named in ``out``."""
    return paths.select(F.col("conv").alias(conv), F.col("depth").alias(depth), *[F.col(c).alias(n) for n, c in out.items()])


def edges(made: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes for (conv, p, e): the hashes at the parent, the head, the handle and the end, and characters up to both ends."""
    wanted = F.array(
        *[F.struct(F.lit(kind).alias("kind"), depth.alias("depth")) for kind, depth in (("p", F.col("p")), ("head", F.col("p") + 1), ("handle", F.col("f")), ("e", F.col("e")))]
    )
    asked = made.withColumn("f", fattest("p", "e")).select("conv", "p", "e", "f", F.explode(wanted).alias("w")).select("conv", "p", "e", "f", "w.kind", "w.depth")
    known = asked.join(paths, ["conv", "depth"], "left")
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return known.groupBy("conv", "p", "e", "f").agg(
        F.coalesce(of("p", "h"), root()).alias("parent"),
        of("head", "h").alias("head"),
        of("handle", "h").alias("handle"),
        of("e", "h").alias("node"),
        F.coalesce(of("p", "upto"), F.lit(0).cast("bigint")).alias("upto_p"),
        of("e", "upto").alias("upto_e"),
    )


def search(active: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Fat binary search: ``a`` becomes the depth of the deepest node that each sequence has in full."""
    left, done = active.withColumn("b", F.col("size")), []
    handles = nodes.select("f", F.col("handle").alias("h"), F.col("p").alias("np"), F.col("e").alias("ne"), "node")
    while True:
        asked = left.withColumn("f", fattest("a", "b")).join(at(paths, "conv", "f", h="h"), ["conv", "f"])
        asked = asked.join(handles, ["f", "h"], "left")
        asked = asked.join(at(paths, "conv", "ne", end="h"), ["conv", "ne"], "left")
        hit, whole = F.col("node").isNotNull(), F.col("end") == F.col("node")
        a = F.when(~hit, F.col("a")).when(whole, F.col("ne")).otherwise(F.col("np"))
        b = F.when(~hit, F.col("f") - 1).when(whole, F.col("b")).otherwise(F.col("np"))
        step = pinned(asked.select("conv", "size", "tip", a.alias("a"), b.alias("b")))
        done.append(step.where("a >= b").drop("b"))
        left = step.where("a < b")
        if left.head() is None:
            out = done[0]
            for more in done[1:]:
                out = out.unionByName(more)
            return out


def shared(pairs: DataFrame, paths: DataFrame) -> DataFrame:
    """``pairs`` (conv, a, like, e, ...) with ``m``, the depth up to e to which conv and like go the same way, known to be at
    least a, and ``next``, the hash one turn further."""
    walked = pairs.select("conv", "a", "like", "e").join(paths.select("conv", "depth", "h"), "conv").where("depth > a AND depth <= e")
    same = walked.join(at(paths, "like", "depth", h="h"), ["like", "depth", "h"]).groupBy("conv").agg(F.count("*").alias("n_same"))
    left = pairs.join(same, "conv", "left").withColumn("m", F.col("a") + F.coalesce("n_same", F.lit(0).cast("bigint")))
    further = paths.select("conv", (F.col("depth") - 1).alias("m"), F.col("h").alias("next"))
    return left.join(further, ["conv", "m"], "left")


def place(found: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(conv, size, tip, node, m, next): depth m at which each sequence leaves the trie or ends, on ``node``'s edge or (null) at
    the node of depth a, and the hash one turn further."""
    heads = paths.select("conv", (F.col("depth") - 1).alias("a"), F.col("h").alias("head"))
    below = nodes.select(F.col("p").alias("a"), "head", "node", F.col("conv").alias("like"), "e")
    on_edge = pinned(found.join(heads, ["conv", "a"]).join(below, ["a", "head"], "left"))
    return pinned(shared(on_edge, paths).select("conv", "size", "tip", "node", "m", "next"))


def draw(leaving: DataFrame) -> DataFrame:
    """Of the sequences that leave at one place by one turn the one to become an edge: (next, like, e, p, node)."""
    first = F.min(F.struct(F.xxhash64("conv").alias("u"), "conv", "size", "m", "tip")).alias("d")
    drawn = leaving.groupBy("next").agg(first)
    return drawn.select("next", F.col("d.conv").alias("like"), F.col("d.size").alias("e"), F.col("d.m").alias("p"), F.col("d.tip").alias("node"))


def insert(placed: DataFrame, nodes: DataFrame | None, paths: DataFrame) -> DataFrame | None:
    """The nodes (None: the empty trie) with a batch of sequences that have been placed in the trie.

    Those that leave at one place by one turn go on along the one drawn of them, whose edge is new, until each is drawn or ends.
    """
    leaves, cuts, waiting = None, None, placed
    while True:
        here = waiting.where("node IS NOT NULL").select("node", F.col("m").alias("e"))
        cuts = here if cuts is None else cuts.unionByName(here)
        leaving = waiting.where("m < size")
        drawn = pinned(draw(leaving))
        if drawn.head() is None:
            break
        new = drawn.select("node", F.col("like").alias("conv"), "p", "e")
        leaves = new if leaves is None else leaves.unionByName(new)
        along = leaving.drop("node").withColumnRenamed("m", "a").join(drawn.drop("p"), "next").where("conv <> like").drop("next")
        waiting = pinned(shared(along, paths).select("conv", "size", "tip", "node", "m", "next"))
    if nodes is None and leaves is None:
        return None
    cuts = pinned(cuts.distinct())
    if nodes is None:
        changed = leaves
    else:
        cut = nodes.join(cuts.select("node").distinct(), "node", "left_semi").select("node", "conv", "p", "e")
        changed = cut if leaves is None else cut.unionByName(leaves)
    # a piece begins where the one before it ends; the positions on an edge are sorted, never held together
    ends = cuts.unionByName(changed.select("node", "e")).distinct().join(changed.select("node", "conv", F.col("p").alias("top")), "node")
    starts = F.lag("e").over(Window.partitionBy("node").orderBy("e"))
    pieces = edges(ends.select("conv", F.coalesce(starts, "top").alias("p"), "e"), paths)
    if nodes is None:
        return pinned(pieces)
    whole = nodes.join(cuts.select("node").distinct(), "node", "left_anti")
    return pinned(whole.unionByName(pieces))


def build(sequences: DataFrame, paths: DataFrame) -> DataFrame | None:
    """The compacted nodes of all sequences (conv, size, tip), each of at least one turn; None if there is none.

    The first batch, one of EARLY, leaves the empty trie at its root; the second, all others, where the search ends.
    """
    zero = F.lit(0).cast("bigint")
    early = F.pmod(F.xxhash64("conv", F.lit(EARLY)), F.lit(EARLY)) == 0
    first_turns = paths.where("depth = 1").select("conv", F.col("h").alias("next"))
    at_root = lambda some: pinned(some.join(first_turns, "conv").select("conv", "size", "tip", F.lit(None).cast("binary").alias("node"), zero.alias("m"), "next"))
    nodes = insert(at_root(sequences.where(early)), None, paths)
    rest = sequences.where(~early)
    if nodes is None:
        return insert(at_root(rest), None, paths)
    found = search(pinned(rest.withColumn("a", zero)), nodes, paths)
    return insert(place(found, nodes, paths), nodes, paths)


# --- sums over subtrees, and one row per depth ------------------------------------------------------------------------------


def over_subtrees(values: DataFrame, how: dict) -> DataFrame:
    """The columns of ``how`` taken over all nodes below and the node itself; ``values`` has them with node and parent.

    In round k ``up`` is the ancestor 2**k edges up, and a node's values are those of the nodes less than 2**k edges below.
    """
    now = pinned(values.withColumnRenamed("parent", "up"))
    while True:
        climbing = now.where("up IS NOT NULL")
        if climbing.head() is None:
            return now.drop("up")
        given = climbing.groupBy(F.col("up").alias("node")).agg(*[f(c).alias(f"more_{c}") for c, f in how.items()])
        above = now.select(F.col("node").alias("up"), F.col("up").alias("next"))
        both = lambda c, f: F.least(c, f"more_{c}") if f is F.min else F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("bigint"))
        joined = now.join(given, "node", "left").join(above, "up", "left")
        now = pinned(joined.select("node", F.col("next").alias("up"), *[both(c, f).alias(c) for c, f in how.items()]))


def lists_hashed(members: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv): the hash of each node's identifiers in order, with a comma between them.

    Ranges of identifiers become pieces of text in parallel, and the pieces of a list are hashed one after the other.
    """

    def pieces(batches):
        held, first, size = None, None, 0
        parts: list[str] = []

        def piece():
            return {"node": held, "first": first, "part": ",".join(parts)}

        for batch in batches:
            out = []
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
                if node != held or size == CHUNK:
                    if held is not None:
                        out.append(piece())
                    held, first, size, parts = node, conv, 0, []
                parts.append(str(conv))
                size += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([piece()], schema)

    def whole(batches):
        held, state = None, None
        for batch in batches:
            out = []
            for node, part in zip(batch.column("node").to_pylist(), batch.column("part").to_pylist()):
                if node != held:
                    if held is not None:
                        out.append({"node": held, "ends_sha256": state.hexdigest()})
                    held, state = node, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out)
        if held is not None:
            yield pa.RecordBatch.from_pylist([{"node": held, "ends_sha256": state.hexdigest()}])

    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("part", pa.string())])
    ranged = members.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    cut = ranged.mapInArrow(pieces, "node binary, first bigint, part string")
    return cut.repartition("node").sortWithinPartitions("node", "first").select("node", "part").mapInArrow(whole, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct prefix of turns of the rebuilt conversations, the empty one included.

    Turns are ordered by number, null first, and by a hash of role and text where numbers are the same; repeated
    rows are turns of their own. Null roles and texts are empty; rows without a conversation are left out. An empty
    table has no prefix and gives no row; a table whose conversations are all left without turns gives the root.
    Other columns are ignored, whatever their names.
    """
    turns, all_convs = rebuilt(conversations, key, turn, role, text)
    zero = F.lit(0).cast("bigint")
    every = pinned(hashed(turns))
    last = every.groupBy("conv").agg(F.max(F.struct("depth", "h")).alias("l"))
    members = pinned(all_convs.join(last, "conv", "left").select("conv", F.coalesce("l.depth", zero).alias("size"), F.coalesce("l.h", root()).alias("node")))
    ends = pinned(members.groupBy("node", "size").agg(F.min("conv").alias("conv"), F.count("*").alias("n_ends")))
    paths = pinned(every.join(ends.select("conv"), "conv", "left_semi"))
    nodes = build(ends.where("size > 0").select("conv", "size", F.col("node").alias("tip")), paths)
    kept = ["node", "parent", "conv", "p", "e", "upto_p", "upto_e"]
    empty = all_convs.groupBy().agg(F.min("conv").alias("conv")).where("conv IS NOT NULL").select(
        root().alias("node"), F.lit(None).cast("binary").alias("parent"), "conv", zero.alias("p"), zero.alias("e"), zero.alias("upto_p"), zero.alias("upto_e")
    )
    nodes = pinned(empty if nodes is None else nodes.select(*kept).unionByName(empty))

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    flat = pinned(
        nodes.join(children, "node", "left")
        .join(ends.select("node", "n_ends", F.col("conv").alias("first")), "node", "left")
        .select(*kept, "first", F.coalesce("n_ends", zero).alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"))
    )
    # what a subtree saves is the length of its members' paths less that of its edges and of what lies above it
    length = F.col("upto_e") - F.col("upto_p")
    own = flat.select(
        "node", "parent", F.col("first").alias("conv_id"), "n_convs", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
        (F.col("n_convs") * F.col("upto_e")).alias("paths"), length.alias("edges"),
    )
    summed = over_subtrees(own, {"conv_id": F.min, "n_convs": F.sum, "n_leaves": F.sum, "paths": F.sum, "edges": F.sum})
    above = summed.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = flat.drop("n_convs", "first").join(summed, "node").join(above, "parent", "left").join(lists_hashed(members), "node", "left")
    saved = F.col("paths") - F.col("n_convs") * F.col("upto_p") - F.col("edges")
    full = pinned(full.withColumn("saved", saved))

    starts = full.where("e > p").withColumn("start", F.explode(F.expr(f"sequence(p + 1, e, {CHUNK}L)")))
    depths = starts.withColumn("depth", F.explode(F.expr(f"sequence(start, least(start + {CHUNK - 1}, e))")))
    rows = depths.join(paths.select("conv", "depth", "chars", "upto"), ["conv", "depth"])
    last_one, first_one = F.col("depth") == F.col("e"), F.col("depth") == F.col("p") + 1
    none = F.lit(hashlib.sha256(b"").hexdigest())
    below = F.col("saved") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("chars") - F.col("upto_p"))
    inner = rows.select(
        "conv_id",
        "depth",
        F.when(first_one, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last_one, F.col("n_children")).otherwise(F.lit(1).cast("bigint")).alias("n_children"),
        "n_leaves",
        below.alias("saved_tokens"),
        F.when(last_one, F.coalesce("ends_sha256", none)).otherwise(none).alias("ends_sha256"),
    )
    top = full.where("parent IS NULL").select(
        "conv_id", F.col("e").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
    return inner.unionByName(top)


def query(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: Prefixes as strings of digests of their turns, whose ancestors are their own beginnings. CRC-32 is computed bit by bit.
ORACLE = """
WITH t AS (
  SELECT c, d, n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS i
  FROM (SELECT conv_id AS c, turn, length(coalesce(text, '')) AS n,
          md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT c, count(*) AS n FROM t GROUP BY c),
shared AS (
  SELECT s.c, s.c - s.c % 100 AS head, h, least(h, coalesce(r.n, 0)) AS k
  FROM (SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
          lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda y, z: xor(y >> 1, CASE WHEN y % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 6 AS h FROM sizes) s
  LEFT JOIN sizes r ON r.c = s.c - s.c % 100),
turns AS (
  SELECT s.c, t.i AS depth, t.d, t.n FROM shared s JOIN t ON t.c = s.head AND t.i <= s.h
  UNION ALL SELECT s.c, t.i - s.h + s.k, t.d, t.n FROM shared s JOIN t ON t.c = s.c AND t.i > s.h),
prefixes AS (
  SELECT c, depth, n, string_agg(d, '') OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING) AS p FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM sizes),
nodes AS (SELECT depth, p, min(c) AS c, count(*) AS n_convs, any_value(n) * (count(*) - 1) AS own FROM prefixes GROUP BY depth, p),
children AS (SELECT depth - 1 AS depth, substr(p, 1, 32 * (depth - 1)) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
above AS (
  SELECT a AS depth, substr(n.p, 1, 32 * a) AS p, sum(own)::BIGINT AS saved, count(*) FILTER (ch.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM nodes) n LEFT JOIN children ch ON ch.depth = n.depth AND ch.p = n.p GROUP BY ALL),
lasts AS (SELECT depth, p, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (
  SELECT c, max(depth) AS depth, arg_max(p, depth) AS p FROM prefixes GROUP BY c) GROUP BY depth, p)
SELECT n.c AS conv_id, n.depth::BIGINT AS depth, u.c AS parent_conv_id, n.n_convs, coalesce(ch.n, 0)::BIGINT AS n_children, a.leaves AS n_leaves,
  a.saved AS saved_tokens, sha256(coalesce(l.ids, '')) AS ends_sha256
FROM nodes n JOIN above a ON a.depth = n.depth AND a.p = n.p
LEFT JOIN children ch ON ch.depth = n.depth AND ch.p = n.p
LEFT JOIN lasts l ON l.depth = n.depth AND l.p = n.p
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = substr(n.p, 1, 32 * (n.depth - 1))
"""
