"""N-gram Jaccard join: documents whose sets of five-word shingles have a Jaccard similarity of at least 0.75.

Exact, by T-occurrence search. A set of n shingles must share T = ceil(0.75 n) with any partner, so

1. Documents with equal sets form a class; from here on only classes count.
2. The inverted index of all shingles is built in packed blocks, one shuffle of about nine bytes per shingle. A shingle
   of one class is in no overlap; a class with fewer than T shared shingles has no partner. That leaves little.
3. DivideSkip: the T - 1 longest lists of a class are set aside, the others are short. Partners meet in a short list of
   both. The short lists of a query are merged by a heap; the partners found there are probed by binary search for the
   rest of the shingles, and those that reach the required overlap are links.
4. A list asks one query, its first class, against all others; links make components, and only lists with several
   components ask again, sixteen times as many queries each round. From the second round on, when the pairs across
   components left are no more than ``PAIRS_PER_ENTRY`` per list entry, they are all checked. So no link between
   components is lost, and a group of copies costs a star, not a clique. From the second round on, pairs must also be
   near by ``BITS`` parities of their shingles: sets that differ in many parities differ in at least as many shingles.
   Texts that no link connects, though they share lists, are still compared with each other in these lists, by parities.

Defined results: without words (NULL, empty, white space) the set is empty and links with nothing; one to four words are
one shingle; rows of one id are one document for the component, each with its own n_shingles, NULL being an id after
all others; ``keep_one`` tells texts of one id apart; a table without rows gives none; extra columns are not used. Shingles and sets are known by 64-bit hashes.
The entries of one list, eight bytes a class, are read by one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.llm.common import body_hash, free_name, meet, stored, worker_code
from txnspark.llm.word_hashes import mix, slices

worker_code(__name__)

SHINGLE = 5
PERCENT = 75
BLOCK_SHINGLES = 1_000_000  # shingles that one block of the index gathers
BUCKET_SHINGLES = 1_000_000  # shingles that one task of the index holds
BLOCK_SETS = 10_000  # sets that one task of the last step holds
SLICE = 20_000  # list entries that one merge holds
PAIRS_PER_ENTRY = 256  # pairs across components, per list entry, at which the rest is checked at once
MORE = 16  # times as many queries per list in every further round
BITS = 1024  # parities per set


_PLACES = [np.uint64(x | 1) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for _, hashes, counts in slices(texts):
        n = len(hashes) - (SHINGLE - 1)
        windows = mix(sum(hashes[k : k + n] * _PLACES[k] for k in range(SHINGLE))) if n > 0 else hashes[:0]
        start = 0
        for count in counts.tolist():
            if count >= SHINGLE:
                yield np.unique(windows[start : start + count - SHINGLE + 1])
            elif count:
                # A short text is one shingle, told apart by its length.
                yield mix(sum(hashes[start + k : start + k + 1] * _PLACES[k] for k in range(count)) + np.uint64(count))
            else:
                yield hashes[:0]
            start += count


def _set_name(s: np.ndarray) -> np.int64:
    """Name of a set: the sum of its scrambled members, and its size."""
    return (mix(s * _PLACES[1]).sum(dtype=np.uint64) + np.uint64(len(s))).astype(np.int64)


HALF = np.uint64(1 << 63)


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, body, text) to (doc, body, class, n, low); ``low`` is the number of shingles in the lower half of the hash range."""
    for batch in batches:
        found = [(_set_name(s), len(s), int(np.searchsorted(s, HALF))) for s in shingle_sets(batch.column("text"))]
        names, sizes, low = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("body"), *[pa.array(x, pa.int64()) for x in (names, sizes, low)]],
            names=["doc", "body", "class", "n", "low"],
        )


def _packed(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of a number and packed arrays."""
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=names)


def _unpacked(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _pack(buckets: int, low: bool):
    """Blocks of postings: per bucket of the hash range its shingles, set by set, with classes and run lengths; of the
    lower half of the range alone if ``low``."""

    def block(sets: list[np.ndarray]) -> pa.RecordBatch:
        sets = [s for s in sets if len(s)]
        names = np.array([_set_name(s) for s in sets], np.int64)
        sizes = np.array([len(s) for s in sets], np.int32)
        if low:
            sets = [s[: np.searchsorted(s, HALF)] for s in sets]
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        bucket = ((tokens >> np.uint64(31 if low else 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        found, starts = np.unique(bucket, return_index=True)
        rows = []
        for b, lo, hi in zip(found, starts, np.append(starts[1:], len(bucket))[: len(starts)], strict=True):
            own = owner[lo:hi]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            runs = np.diff(np.append(first, hi - lo)).astype(np.int32)
            own = own[first]
            rows.append((int(b), tokens[lo:hi].tobytes(), names[own].tobytes(), sizes[own].tobytes(), runs.tobytes()))
        return _packed(rows, ["bucket", "tokens", "classes", "sizes", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, n = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column("text")):
                sets.append(s)
                n += len(s)
                if n >= BLOCK_SHINGLES:
                    yield block(sets)
                    sets, n = [], 0
        yield block(sets)

    return run


def _shared(groups: int):
    """One bucket to the shingles that at least two classes hold: a row for each group of classes, with the packed
    (class, size of its set, shingle, number of classes)."""

    def run(table: pa.Table) -> pa.Table:
        tokens = _unpacked(table, "tokens", np.uint64)
        runs = _unpacked(table, "runs", np.int32)
        classes = np.repeat(_unpacked(table, "classes", np.int64), runs)
        sizes = np.repeat(_unpacked(table, "sizes", np.int32), runs)
        order = np.argsort(tokens)
        same = tokens[order][1:] == tokens[order][:-1]
        order = order[np.append(same, False) | np.append(False, same)] if len(order) else order
        tokens, classes, sizes = tokens[order], classes[order], sizes[order]
        order = np.lexsort((classes, tokens))
        tokens, classes, sizes = tokens[order], classes[order], sizes[order]
        # Equal texts count as one class.
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1]))[: len(tokens)]
        tokens, classes, sizes = tokens[new], classes[new], sizes[new]
        _, back, df = np.unique(tokens, return_inverse=True, return_counts=True)
        df = df[back].astype(np.int32)
        keep = df >= 2
        group = (mix(classes[keep].view(np.uint64)) % np.uint64(groups)).astype(np.int32)
        order = np.argsort(group, kind="stable")
        columns = [x[keep][order] for x in (classes, sizes, tokens, df)]
        found, starts = np.unique(group[order], return_index=True)
        ends = np.append(starts[1:], len(order))[: len(starts)]
        rows = [(int(g), *[x[lo:hi].tobytes() for x in columns]) for g, lo, hi in zip(found, starts, ends, strict=True)]
        return pa.Table.from_batches([_packed(rows, ["bunch", "classes", "sizes", "tokens", "dfs"])])

    return run


def _gather(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All shared shingles of one group of classes, by class, then number of classes, then hash; where each class starts."""
    columns = [_unpacked(table, n, k) for n, k in (("classes", np.int64), ("sizes", np.int32), ("tokens", np.int64), ("dfs", np.int32))]
    order = np.lexsort((columns[2], columns[3], columns[0]))
    columns = [x[order] for x in columns]
    first = np.flatnonzero(np.append(True, columns[0][1:] != columns[0][:-1]))[: len(order)]
    return *columns, first


def _whole_sets(table: pa.Table) -> pa.Table:
    """The classes of one group that share enough shingles, with these."""
    classes, sizes, tokens, dfs, first = _gather(table)
    counts = np.diff(np.append(first, len(classes)))
    keep = 100 * counts.astype(np.int64) >= PERCENT * sizes[first].astype(np.int64)
    inside = np.repeat(keep, counts)
    weight = np.add.reduceat(dfs.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    words = BITS // 64
    place = mix(tokens.view(np.uint64) ^ _PLACES[2]) >> np.uint64(64 - (BITS.bit_length() - 1))
    flat = np.repeat(np.arange(len(first)), counts) * BITS + place.astype(np.int64)
    odd = (np.bincount(flat, minlength=len(first) * BITS) & 1).astype(np.uint8).reshape(len(first), BITS)
    bits = np.packbits(odd, axis=1).view(np.int64).reshape(len(first), words)[keep]
    offsets = pa.array(np.append(0, np.cumsum(counts[keep])).astype(np.int32))
    return pa.table(
        {
            "class": pa.array(classes[first][keep]),
            "n": pa.array(sizes[first][keep].astype(np.int64)),
            "weight": pa.array(weight[keep]),
            "tokens": pa.ListArray.from_arrays(offsets, pa.array(tokens[inside])),
            "bits": pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * words), pa.array(bits.ravel())),
        }
    )


def _count_shared(table: pa.Table) -> pa.Table:
    """Number of shared shingles of the classes of one group."""
    classes, _, _, _, first = _gather(table)
    return pa.table({"class": pa.array(classes[first]), "shared": pa.array(np.diff(np.append(first, len(classes))).astype(np.int64))})


def _postings(docs: DataFrame, text: str, total: int, low: bool) -> DataFrame:
    """Shared shingles, packed and grouped by groups of classes."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, math.ceil(total / BUCKET_SHINGLES))
    source = docs.select(F.col(text).alias("text"))
    blocks = source.mapInArrow(_pack(buckets, low), "bucket int, tokens binary, classes binary, sizes binary, runs binary")
    shared = blocks.groupBy("bucket").applyInArrow(_shared(buckets), "bunch int, classes binary, sizes binary, tokens binary, dfs binary")
    return shared.groupBy("bunch")


def classes_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, body, class, n) per row: ``class`` names the shingle set; sets are equal where it is."""
    source = docs.select(F.col(key).alias("doc"), body_hash(F.col(text)).alias("body"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return stored(source.mapInArrow(_name, f"doc {kind}, body bigint, class bigint, n bigint, low bigint"), "set-classes")


def candidates(docs: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """(class, n, weight, tokens, bits): classes with enough shared shingles, these by (number of classes, hash), and their
    parities.

    A class with a partner has at most a quarter of its shingles to itself, so not more than that in the lower half of
    the hash range either. Half the index rules out nearly all classes; only the rest, one document each, enter the whole.
    """
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    shared = _postings(docs, text, total // 2, True).applyInArrow(_count_shared, "class bigint, shared bigint")
    shared = shared.groupBy("class").agg(F.sum("shared").alias("shared"))
    first = classes.where("n > 0").groupBy("class").agg(F.min("doc").alias("doc"), F.max("n").alias("n"), F.max("low").alias("low"))
    own = F.col("low") - F.coalesce("shared", F.lit(0))
    left = first.join(shared, "class", "left").where(100 * own <= (100 - PERCENT) * F.col("n"))
    left = stored(left.select("class", "n", F.col("doc").alias("first_doc")), "possible-classes")
    total = left.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    few = meet(docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), left, F.col("doc").eqNullSafe(F.col("first_doc")), "left_semi")
    # A text that others were made from shares its shingles with most classes, which gives it weight.
    sets = _postings(few, "text", total, False).applyInArrow(_whole_sets, "class bigint, n bigint, weight bigint, tokens array<bigint>, bits array<bigint>")
    return stored(sets, "candidates")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heap-merge of the short lists of each query: rows (query, slice, token, other) in that order to (query, other)
    with the number of lists that hold ``other``. A group is one slice of a query's lists, so it is bounded."""

    def flush(query, lists, out):
        before, n = None, 0
        for other in heapq.merge(*lists):
            if other == before:
                n += 1
                continue
            if before is not None:
                out.append((query, before, n))
            before, n = other, 1
        if before is not None:
            out.append((query, before, n))

    def table(out):
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())],
            names=["x", "y", "n_short"],
        )

    group, token, lists, out = None, None, [], []
    for batch in batches:
        for x, part, t, y in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if (x, part) != group:
                if group is not None:
                    flush(group[0], lists, out)
                group, token, lists = (x, part), None, []
            if t != token:
                token = t
                lists.append([])
            lists[-1].append(y)
        if len(out) > 10_000:
            yield table(out)
            out = []
    if group is not None:
        flush(group[0], lists, out)
    yield table(out)


def _probe(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """Binary probes of the shingles of one set in the sorted shingles of its partner; pairs with the overlap are links."""
    offsets = sets.column("tokens").combine_chunks()
    values = offsets.flatten().to_numpy(zero_copy_only=False)
    cuts = np.append(0, np.cumsum(offsets.value_lengths().to_numpy(zero_copy_only=False)))
    place = {c: i for i, c in enumerate(sets.column("class").to_pylist())}
    n = sets.column("n").to_pylist()
    sorted_sets: dict[int, np.ndarray] = {}

    def of(i):
        if i not in sorted_sets:
            sorted_sets[i] = np.sort(values[cuts[i] : cuts[i + 1]])
        return sorted_sets[i]

    ok = []
    for x, y in zip(pairs.column("x").to_pylist(), pairs.column("y").to_pylist(), strict=True):
        i, j = place[x], place[y]
        a, b = of(i), of(j)
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        overlap = int(np.count_nonzero(b[at] == a))
        ok.append(100 * overlap >= PERCENT * (n[i] + n[j] - overlap))
    return pairs.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links. Classes are dealt to groups and pairs to blocks of two groups; a set travels once to each
    block that needs it, and a block holds about ``BLOCK_SETS`` sets at most."""
    total = sets.count()
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = max(math.ceil(math.sqrt(parts)), math.ceil(2 * total / BLOCK_SETS))
    deal = lambda c: F.pmod(F.xxhash64(c), F.lit(k))
    blocked = stored(pairs.select("x", "y", (deal("x") * k + deal("y")).alias("block")), "blocked-pairs")
    needed = blocked.select(F.col("block").alias("at"), F.explode(F.array("x", "y")).alias("class")).distinct()
    held = needed.join(sets.select("class", "n", "tokens"), "class")
    found = blocked.groupBy("block").cogroup(held.groupBy("at")).applyInArrow(_probe, "x bigint, y bigint")
    return stored(found, "links")


def _near(a: Column, b: Column) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def components(links: DataFrame) -> DataFrame:
    """(class, root): smallest class of each connected group, for classes with links. Alternating large and small stars."""
    edges = stored(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u != v").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (state["n"], state["h"]) == before:
            return edges.select(F.col("u").alias("class"), F.col("v").alias("root"))
        before = (state["n"], state["h"])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")


def _parents(links: DataFrame) -> DataFrame:
    """(class, root) after two steps up the links (x, y), which have one x for each y: classes of one root are connected."""
    up = links.select(F.col("y").alias("class"), F.col("x").alias("root"))
    above = up.select(F.col("class").alias("root"), F.col("root").alias("top"))
    return stored(up.join(above, "root", "left").select("class", F.coalesce("top", "root").alias("root")), "roots")


def _settle(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the pairs, enough to connect what they connect: every class first asks the partner with which it shares
    most short lists, so that groups collapse; then what is left apart."""
    best = stored(pairs.groupBy("y").agg(F.max_by("x", F.struct("n_short", "x")).alias("x")), "asked")
    first = _verify(best, sets)
    root = _parents(first)
    r = lambda v: root.select(F.col("class").alias(v), F.col("root").alias(f"r{v}"))
    rest = pairs.join(best, ["x", "y"], "left_anti").join(r("x"), "x", "left").join(r("y"), "y", "left")
    rest = rest.where(F.coalesce("rx", "x") != F.coalesce("ry", "y"))
    return first.unionByName(_verify(rest.select("x", "y"), sets))


def links(sets: DataFrame) -> DataFrame:
    """(x, y) between classes: enough true links to connect all that are connected."""
    need = F.ceil(F.col("n") * PERCENT / 100).cast("int")
    short = F.slice("tokens", 1, F.size("tokens") - need + 1)
    # ``after``: shingles of the class from this one on, in the order of the lists.
    entries = sets.select("class", "n", "weight", F.col("class").alias("root"), F.size("tokens").alias("m"), F.posexplode(short).alias("i", "token"))
    entries = stored(entries.withColumn("after", F.col("m") - F.col("i")).drop("m", "i"), "short-lists")
    found = sets.sparkSession.createDataFrame([], "x bigint, y bigint")
    words = [f"b{i}" for i in range(BITS // 64)]
    # Shingles of no other class are in no overlap, whatever the partner.
    alone = (F.col("n") - F.size("tokens")).alias("alone")
    parities = sets.select("class", alone, *[F.col("bits")[i].alias(w) for i, w in enumerate(words)])
    queries = 1
    while True:
        per_root = entries.groupBy("token", "root").agg(F.count("*").alias("m"))
        lists = per_root.groupBy("token").agg(
            F.sum("m").alias("size"), F.sum(F.col("m") * F.col("m")).alias("within"), F.count("*").alias("roots")
        )
        pairs = ((F.col("size") * F.col("size") - F.col("within")) / 2).alias("pairs")
        lists = stored(lists.where("roots > 1").select("token", "size", pairs), "open-lists")
        left = lists.agg(F.sum("pairs").alias("pairs"), F.sum("size").alias("entries")).first()
        if not left["entries"]:
            return found
        entries = entries.join(lists.select("token", "size"), "token")
        near = F.lit(True)
        if queries > 1:
            entries = entries.join(parities, "class")
            differ = reduce(Column.__add__, [F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}x"))) for w in words])
            # An overlap of 3/7 of both sizes leaves 1/7 of them to differ.
            near = (PERCENT + 100) * (differ + F.col("alone") + F.col("alonex")) <= (100 - PERCENT) * (F.col("n") + F.col("nx"))
        entries = stored(entries, "open-entries")
        # Before any answer every class is a component, and a group of copies all its pairs.
        last = queries > 1 and left["pairs"] <= PAIRS_PER_ENTRY * left["entries"]
        own = ["alone", *words] if queries > 1 else []
        asking = entries
        if not last:
            rank = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("weight"), F.desc("class")))
            asking = asking.withColumn("rank", rank).where(F.col("rank") <= queries)
        query = F.struct(F.col("weight"), F.col("class")).alias("q")
        renamed = [F.col(c).alias(f"{c}x") for c in own]
        asking = asking.select("token", query, F.col("n").alias("nx"), F.col("root").alias("rx"), F.col("after").alias("ax"), *renamed)
        if not last:
            asking = stored(asking, "queries")
        earlier = F.col("q") > F.struct(F.col("weight"), F.col("class"))
        # The first shingle that two sets share comes early enough in both for the overlap that their sizes need.
        overlap = F.ceil((F.col("n") + F.col("nx")) * PERCENT / (100 + PERCENT))
        early = F.least("after", "ax") >= overlap
        met = entries.join(asking, "token").where(earlier & (F.col("root") != F.col("rx")) & _near(F.col("n"), F.col("nx")) & early & near)
        met = met.withColumn("x", F.col("q.class"))
        part = F.pmod(F.xxhash64("class"), F.ceil(F.col("size") / SLICE)).cast("bigint")
        merged = met.select("x", part.alias("part"), "token", F.col("class").alias("y")).repartition("x", "part")
        merged = merged.sortWithinPartitions("x", "part", "token", "y").mapInArrow(_merge, "x bigint, y bigint, n_short int")
        # A hot list is cut into more slices than a short one, so a pair may come from two of them.
        settled = _settle(stored(merged.groupBy("x", "y").agg(F.sum("n_short").alias("n_short")), "pairs"), sets)
        found = found.unionByName(settled)
        if last:
            return found
        # The queries have met their whole lists.
        met = asking.select("token", F.col("q.class").alias("class"))
        entries = entries.join(met, ["token", "class"], "left_anti").drop("size", *own)
        # Lists whose classes are connected by now, through whatever links, are closed.
        known = components(found)
        entries = entries.drop("root").join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
        queries *= MORE


def _placed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, body, n, root) per row: rows of one root are connected."""
    classes = classes_of(docs, key, text)
    root = components(links(candidates(docs, classes, key, text)))
    # Documents without shingles are classes of their own; a document's class and root may be one.
    return classes.join(root, "class", "left").select("doc", "body", "n", F.coalesce("root", "class").alias("root"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links, itself included)."""
    placed = _placed(docs, key, text)
    first = stored(placed.where("n > 0").groupBy("root").agg(F.min("doc").alias("first")), "group-ids")
    return placed.join(first, "root", "left").select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.col("first")).otherwise(F.col("doc")).alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, of the smallest key (NULL after all others) and then of the smallest hash of the text; rows
    without shingles stay. The same columns."""
    placed = stored(_placed(docs, key, text).where("n > 0"), "grouped-texts")
    me = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "body")
    first = stored(placed.groupBy("root").agg(F.min(me).alias("first")), "first-texts")
    gone_key, gone_body = free_name(docs, "gone_key"), free_name(docs, "gone_body")
    named = [F.col("doc").alias(gone_key), F.col("body").alias(gone_body)]
    same = F.col(key).eqNullSafe(F.col(gone_key)) & (body_hash(F.col(text)) == F.col(gone_body))
    gone = stored(placed.join(first, "root").where(me != F.col("first")).select(*named).distinct(), "group-members")
    kept = meet(docs, gone, same, "left_anti")
    # Equal texts of one id, or without one, are one row too.
    again = stored(placed.groupBy("doc", "body").agg(F.count("*").alias("rows")).where("rows > 1").select(*named), "repeated-texts")
    if again.isEmpty():
        return kept
    row, body = free_name(docs, "row"), free_name(docs, "body")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    least = F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\0")) for c in columns])
    one = meet(kept, again, same, "left_semi").groupBy(key, body_hash(F.col(text)).alias(body))
    one = one.agg(F.min_by(F.struct(*columns), least).alias(row)).select(f"{row}.*")
    return meet(kept, again, same, "left_anti").union(one)
