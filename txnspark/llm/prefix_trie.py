"""Conversation prefix trie, built as a burst trie.

A conversation is a sequence of turn ids; equal sequences are one entry with the number of its members, so a group of
copies never grows a container. The entries start in one container, that of the root.

1. Burst: a container with more than ``CONTAINER_TURNS`` turns (and more than one entry) becomes a trie head, and its
   entries move to containers by their next turn id. What all its entries have in common is one chain of nodes above the
   head, so a round is spent on branchings only. Each round is one aggregate over the entries of open containers.
2. Sweep: the containers left are dealt to shards, sorted by turn ids, and swept in one pass with a stack: a node opens
   where an entry leaves its predecessor and closes where the next one leaves it.
3. Heads take the sums of the containers and chains below them, one row per container and head above it.

The ids of a node's ending members are hashed in order from chunks of ``CHUNK_IDS`` ids: chunks are made by a range sort,
so that one task reads a hundredth of a percent of the rows of a hot sequence.

Defined results: turns sort by turn (NULL first), equal ones by the id of role and text; NULL role or text counts as
empty; equal rows are turns of their own; rows without conv_id belong to no conversation; a table without rows gives no
node; extra columns are not used. Texts, long or not, are only hashed and counted. A conversation's turn ids (32
characters a turn) travel in one row, a container holds ``CONTAINER_TURNS`` turns or a single entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.llm.common import stored, worker_code

worker_code(__name__)

CONTAINER_TURNS = 4096
CHUNK_IDS = 4096
ROOT = "root"  # first id of every sequence, so that the root is a node like others


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, lens): turn ids in order, and code points of the texts."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turn_id = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    said = F.struct("turn", turn_id.alias("id"), F.length(text).cast("bigint").alias("len"))
    grouped = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(said)).alias("said"))
    return grouped.select("conv_id", F.col("said.id").alias("ids"), F.col("said.len").alias("lens"))


def with_openings(convs: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """Conversations that begin with another's opening: the first ``shared`` (at most ``most``) turns of conversation
    ``base`` (all if fewer, none if absent), then their own turns after as many."""
    base, shared = base.cast("bigint").alias("base"), shared.cast("int").alias("shared")
    openings = convs.select(F.col("conv_id").alias("base"), *[F.slice(c, 1, most).alias(f"base_{c}") for c in ("ids", "lens")])
    named = convs.select("*", base, shared)
    openings = openings.join(named.select("base").distinct(), "base", "left_semi")

    def spliced(c: str) -> Column:
        opening = F.coalesce(F.slice(f"base_{c}", F.lit(1), F.col("shared")), F.slice(c, 1, 0))
        return F.concat(opening, F.slice(c, F.col("shared") + 1, F.size(c))).alias(c)

    return named.join(openings, "base", "left").select("conv_id", spliced("ids"), spliced("lens"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (entry, conv_id) to (entry, first conv_id, number, joined conv_ids), a run of one entry in pieces."""
    entry, ids, rows = None, [], []
    for batch in batches:
        for e, c in zip(batch.column("entry").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if e != entry or len(ids) == CHUNK_IDS:
                if ids:
                    rows.append((entry, ids[0], len(ids), ",".join(map(str, ids))))
                entry, ids = e, []
            ids.append(c)
        if len(rows) >= 1000:
            yield _batch(rows, _CHUNK)
            rows = []
    if ids:
        rows.append((entry, ids[0], len(ids), ",".join(map(str, ids))))
    yield _batch(rows, _CHUNK)


_CHUNK = pa.schema([("entry", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("joined", pa.string())])
_ENTRY = pa.schema([("entry", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (entry, first) to one row per entry with the hash of its whole list, fed chunk by chunk."""
    entry, first, n, state, rows = None, None, 0, None, []
    for batch in batches:
        for e, f, k, joined in zip(*[batch.column(c).to_pylist() for c in ("entry", "first", "n", "joined")], strict=True):
            if e != entry:
                if entry is not None:
                    rows.append((entry, first, n, state.hexdigest()))
                entry, first, n, state = e, f, 0, hashlib.sha256()
            state.update((("," if n else "") + joined).encode())
            n += k
        if len(rows) >= 10_000:
            yield _batch(rows, _ENTRY)
            rows = []
    if entry is not None:
        rows.append((entry, first, n, state.hexdigest()))
    yield _batch(rows, _ENTRY)


def entries(convs: DataFrame) -> DataFrame:
    """(ids, lens, n, first, ends) per distinct sequence: its members' number, smallest id, and the hash of their ids."""
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = F.md5(F.concat(F.size("ids").cast("string"), F.lit(":"), F.array_join("ids", "")))
    named = stored(convs.withColumn("entry", name), "sequences")
    members = named.select("entry", "conv_id").repartitionByRange(parts, "entry", "conv_id").sortWithinPartitions("entry", "conv_id")
    chunks = members.mapInArrow(_chunks, "entry string, first bigint, n bigint, joined string")
    whole = chunks.repartition(parts, "entry").sortWithinPartitions("entry", "first")
    counted = whole.mapInArrow(_digests, "entry string, first bigint, n bigint, ends string")
    # The first member has the sequence: one row each, however many copies there are.
    first = counted.join(named.withColumnRenamed("conv_id", "first"), ["entry", "first"])
    return first.select(F.concat(F.array(F.lit(ROOT)), "ids").alias("ids"), F.concat(F.array(F.lit(0).cast("bigint")), "lens").alias("lens"), "n", "first", "ends")


def _burst(start: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(entries in their last containers, heads). A container is ``home``, under the heads ``above`` (nearest last), its
    first node at ``depth``."""
    kind = F.array().cast("array<string>")
    open_ = stored(start.select(F.lit("").alias("home"), kind.alias("above"), F.lit(0).cast("bigint").alias("depth"), "*"), "container")
    closed, heads = [], []
    while True:
        low, high = F.min(F.struct("ids", "lens", "ends")).alias("low"), F.max("ids").alias("high")
        sizes = open_.groupBy("home").agg(
            F.sum(F.size("ids")).alias("turns"), F.count("*").alias("entries"), low, high, F.sum("n").alias("n"), F.min("first").alias("first"),
            F.first("above").alias("above"), F.first("depth").alias("depth"),
        )
        # Sorted entries have in common what the first and the last have.
        same = F.zip_with("low.ids", "high", lambda a, b: a.eqNullSafe(b))
        common = F.when(F.array_position(same, False) > 0, F.array_position(same, False) - 1).otherwise(F.size("low.ids"))
        big = sizes.where((F.col("turns") > CONTAINER_TURNS) & (F.col("entries") > 1)).withColumn("common", common.cast("int"))
        chain = F.slice("low.lens", F.lit(1), F.col("common")).alias("chain")
        ends = F.when(F.size("low.ids") == F.col("common"), F.col("low.ends")).alias("ends")
        big = stored(big.select("home", "above", "depth", "n", "first", "common", chain, ends), "heads")
        if big.isEmpty():
            return _union([*closed, open_]), _union(heads)
        heads.append(big)
        closed.append(open_.join(big.select("home"), "home", "left_anti").select(*open_.columns))
        moved = open_.join(big.select("home", "common"), "home").where(F.size("ids") > F.col("common"))
        path = F.array_join(F.slice("ids", F.lit(1), F.col("common") + 1), "")
        rest = [F.slice(c, F.col("common") + 1, F.size(c)).alias(c) for c in ("ids", "lens")]
        moved = moved.select(
            F.md5(F.concat("home", F.lit("/"), path)).alias("home"), F.concat("above", F.array("home")).alias("above"),
            (F.col("depth") + F.col("common")).alias("depth"), *rest, "n", "first", "ends",
        )
        open_ = stored(moved, "container")


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


_NODE = pa.schema(
    [("home", pa.string()), ("above", pa.list_(pa.string())), ("top", pa.bool_())]
    + [(c, pa.int64()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string())]
)
_NODE_DDL = (
    "home string, above array<string>, top boolean, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)


class _Node:
    __slots__ = ("id", "len", "depth", "n", "first", "ends", "children", "leaves", "saved", "below")

    def __init__(self, id_: str, length: int, depth: int):
        self.id, self.len, self.depth = id_, length, depth
        self.n, self.first, self.ends = 0, None, None
        self.children, self.leaves, self.saved = 0, 0, 0
        self.below: list[tuple] = []  # closed children, which wait for this node's smallest member


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries of containers to nodes."""
    rows: list[tuple] = []
    stack: list[_Node] = []
    home, above = None, None

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.len
            rows.extend((home, None, False, d, c, node.first, *rest) for d, c, *rest in node.below)
            done = (node.depth, node.first, node.n, node.children, leaves, saved, node.ends)
            if stack:
                up = stack[-1]
                up.n += node.n
                up.first = node.first if up.first is None else min(up.first, node.first)
                up.children += 1
                up.leaves += leaves
                up.saved += saved
                up.below.append(done)
            else:
                d, c, *rest = done
                rows.append((home, above, True, d, c, None, *rest))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("home", "above", "depth", "ids", "lens", "n", "first", "ends")]
        for h, up, depth, ids, lens, n, first, ends in zip(*columns, strict=True):
            if h != home:
                close(0)
                home, above = h, up
            common = 0
            while common < len(stack) and common < len(ids) and stack[common].id == ids[common]:
                common += 1
            close(common)
            stack.extend(_Node(ids[i], lens[i], depth + i) for i in range(common, len(ids)))
            last = stack[-1]
            last.n += n
            last.first = first if last.first is None else min(last.first, first)
            last.ends = ends
            if len(rows) >= 10_000:
                yield _batch(rows, _NODE)
                rows = []
    close(0)
    yield _batch(rows, _NODE)


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie of sequences (conv_id, ids, lens): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (over the subtree), ends (hash of the members that end here, NULL if none)."""
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held, heads = _burst(entries(convs))
    shards = held.repartition(parts, "home").sortWithinPartitions("home", "ids")
    nodes = shards.mapInArrow(_sweep, _NODE_DDL)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    if heads is None:
        return nodes.select(*out)
    nodes = stored(nodes, "nodes")
    own = F.expr("aggregate(chain, 0L, (s, x) -> s + (n - 1) * x)")
    heads = stored(heads.withColumn("own", own), "all-heads")
    tops = nodes.where("top").select("above", "n_leaves", F.col("saved_tokens").alias("saved"))
    below = tops.unionByName(heads.select("above", F.lit(0).cast("bigint").alias("n_leaves"), F.col("own").alias("saved")))
    nearest = F.element_at("above", -1)
    below = below.where(F.size("above") > 0).select(F.explode("above").alias("home"), nearest.alias("nearest"), "n_leaves", "saved")
    sums = below.groupBy("home").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("below"), F.count_if(F.col("home") == F.col("nearest")).alias("branches")
    )
    # A chain's nodes have the same members; each saves what its own text, and all below, save.
    after = F.expr("aggregate(slice(chain, i + 1, size(chain)), 0L, (s, x) -> s + (n - 1) * x)")
    parent = heads.select(F.col("home").alias("up"), F.col("first").alias("up_first"))
    links = heads.join(sums, "home").withColumn("up", F.try_element_at("above", F.lit(-1))).join(parent, "up", "left")
    last = F.col("i") == F.size("chain") - 1
    chains = links.select("*", F.explode(F.sequence(F.lit(0), F.size("chain") - 1)).alias("i")).select(
        F.col("first").alias("conv_id"),
        (F.col("depth") + F.col("i")).alias("depth"),
        F.when(F.col("i") == 0, F.col("up_first")).otherwise(F.col("first")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("branches")).otherwise(F.lit(1).cast("bigint")).alias("n_children"),
        "n_leaves",
        (F.col("below") + after).alias("saved_tokens"),
        F.when(last, F.col("ends")).alias("ends"),
    )
    inner = nodes.where("NOT top").select(*out)
    tops = nodes.where("top").withColumn("up", F.try_element_at("above", F.lit(-1))).join(parent, "up", "left")
    tops = tops.withColumn("parent_conv_id", F.col("up_first")).select(*out)
    return inner.unionByName(tops).unionByName(chains.select(*out))
