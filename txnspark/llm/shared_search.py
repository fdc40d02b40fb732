"""Ranked lexical search of many queries at once, with common subexpressions evaluated once.

The score of a text is a sum over the query's terms, and a term's part depends on the text alone. So

1. One pass over the texts counts the terms that some query has: a forward row (doc_id, n, terms, counts) per text.
2. Per block of queries, shared term sets are mined. Terms held by the same queries are one set; then, again and again,
   the two sets that most queries have in common are joined. The sets and queries form a graph without cycles: a node
   adds up the accumulators of its parts, and a query the nodes that cover it.
3. The graph runs over the forward rows in slices of texts: every node is one accumulator per text, computed once and read
   by all the queries above it. A task keeps the best ``TOP`` of each query, and the last step ranks these.

Scores are whole numbers, so the order of additions does not matter. Queries are dealt to passes of about ``PASS_TERMS``
terms (one reading of the texts each; a pass's terms, 64 bytes each at most, go to the tasks) and to blocks of about
``BLOCK_TERMS`` terms, so that neither grows with the number of queries.

Defined results: a text or query without terms (NULL, empty, white space, punctuation) scores nothing and does not count
in N; a text is counted whole, however long; equal scores rank by doc_id, NULL last; texts of one id are texts of their
own; equal rows of ``items`` are one query, different texts of one item_id are ranked apart; without texts or queries
there is no row; extra columns are not used. Terms of more than 64 bytes are known by their 128-bit hash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnspark.llm.common import stored, worker_code

worker_code(__name__)

TOP = 10
PASS_TERMS = 250_000
BLOCK_TERMS = 8_000
MINED_SETS = 400  # a query left with more sets than this is evaluated from these as they are
SLICE_CELLS = 2_000_000  # accumulators (texts x nodes) that a task holds at a time
LONG = 64

# Term bytes: letters and digits, A-Z as a-z, and whatever is not ASCII; all else separates.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order."""
    return [] if text is None else text.encode().translate(_TABLE).split()


def _name(term: bytes) -> bytes:
    return term if len(term) <= LONG else b" " + hashlib.md5(term).digest()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) to (item, terms, counts)."""
    for batch in batches:
        found = [Counter(map(_name, terms(t))) for t in batch.column("text").to_pylist()]
        columns = [batch.column("item"), pa.array([list(c) for c in found], pa.list_(pa.binary())), pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "terms", "counts"])


def _forward(vocabulary: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc, text) to (doc, n, terms, counts), the terms as places in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocabulary)}
        known = place.keys()
        for batch in batches:
            sizes, cuts, ids, counts = [], [0], [], []
            for text in batch.column("text").to_pylist():
                found = terms(text)
                n = Counter(found)
                hit = known & n.keys()
                ids.extend(place[t] for t in hit)
                counts.extend(n[t] for t in hit)
                for t in n:
                    if len(t) > LONG and (i := place.get(_name(t))) is not None:
                        ids.append(i)
                        counts.append(n[t])
                sizes.append(len(found))
                cuts.append(len(ids))
            columns = [batch.column("doc"), pa.array(sizes, pa.int64())]
            columns += [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x, kind)) for x, kind in ((ids, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "terms", "counts"])

    return run


def mine(queries: list[dict]) -> tuple[list[list], list[list], list[dict]]:
    """Shared term sets of queries (dict term to count): (terms used, nodes, covers). A node lists its parts, a cover maps
    parts to how often they count; part i is term i, or node i - len(terms)."""
    held = defaultdict(dict)
    for q, query in enumerate(queries):
        for term, n in query.items():
            held[term][q] = n
    atoms = sorted(held)
    nodes: list[list[int]] = []
    covers: list[dict[int, int]] = [{} for _ in queries]
    # Terms held by the same queries, as often, are one set.
    alike = defaultdict(list)
    for i, term in enumerate(atoms):
        alike[tuple(held[term].items())].append(i)
    for who, parts in alike.items():
        part = parts[0]
        if len(parts) > 1:
            part = len(atoms) + len(nodes)
            nodes.append(parts)
        for q, n in who:
            covers[q][part] = n
    # Join the two sets that most queries hold, as long as two do.
    pairs: dict[tuple[int, int], set[int]] = defaultdict(set)
    shared = Counter(p for cover in covers for p in cover)
    mined = {q: {p for p in cover if shared[p] > 1} for q, cover in enumerate(covers)}
    mined = {q: parts for q, parts in mined.items() if len(parts) <= MINED_SETS}
    for q, parts in mined.items():
        for pair in combinations(sorted(parts), 2):
            pairs[pair].add(q)
    heap = [(-len(who), pair) for pair, who in pairs.items() if len(who) > 1]
    heapq.heapify(heap)
    while heap:
        size, pair = heapq.heappop(heap)
        who = pairs[pair]
        if len(who) < 2:
            continue
        if len(who) != -size:
            heapq.heappush(heap, (-len(who), pair))
            continue
        new, (a, b) = len(atoms) + len(nodes), pair
        nodes.append([a, b])
        touched = set()
        for q in list(who):
            cover, parts = covers[q], mined[q]
            n = min(cover[a], cover[b])
            for p in pair:
                cover[p] -= n
                if not cover[p]:
                    del cover[p]
                    parts.discard(p)
                    for other in parts:
                        pairs[min(p, other), max(p, other)].discard(q)
            pairs[pair].discard(q)
            for other in parts:
                pairs[other, new].add(q)
                touched.add((other, new))
            cover[new] = n
            parts.add(new)
        for t in sorted(touched):
            if len(pairs[t]) > 1:
                heapq.heappush(heap, (-len(pairs[t]), t))
    return atoms, nodes, covers


def _plan(block: pa.Table) -> pa.Table:
    """The queries of one block to their graph."""
    items, term, counts = (block.column(c).to_pylist() for c in ("item", "terms", "counts"))
    atoms, nodes, covers = mine([dict(zip(t, n, strict=True)) for t, n in zip(term, counts, strict=True)])
    plan = json.dumps({"items": items, "terms": [t.hex() for t in atoms], "nodes": nodes, "covers": [list(c.items()) for c in covers]})
    return pa.table({"block": block.column("block")[:1], "plan": pa.array([plan])})


def evaluate(parts: np.ndarray, nodes: list[list[int]], covers: list[list]) -> np.ndarray:
    """Scores (query, text) from the terms' parts (term, text): every node once, in the order of the graph."""
    n = len(parts)
    acc = np.empty((n + len(nodes), parts.shape[1]), np.int64)
    acc[:n] = parts
    for i, below in enumerate(nodes):
        np.add.reduce(acc[below], axis=0, out=acc[n + i])
    scores = np.zeros((len(covers), parts.shape[1]), np.int64)
    for i, cover in enumerate(covers):
        for part, count in cover:
            scores[i] += acc[part] if count == 1 else acc[part] * count
    return scores


def _best(plan: dict, places: list[int], weights: list[int], vocabulary: int, texts: int, words: int):
    """Forward rows to the best ``TOP`` texts of each query in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = np.full(vocabulary, -1, np.int64)
        column[places] = np.arange(len(places))
        weight = np.array(weights, np.int64)
        nodes, covers = plan["nodes"], plan["covers"]
        step = max(1, SLICE_CELLS // max(1, len(places) + len(nodes) + len(covers)))
        best: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3 for _ in covers]
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                ids = piece.column("terms").flatten().to_numpy(zero_copy_only=False)
                counts = piece.column("counts").flatten().to_numpy(zero_copy_only=False)
                sizes = piece.column("n").to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(piece.num_rows), piece.column("terms").value_lengths().to_numpy(zero_copy_only=False))
                at = column[ids]
                inside = at >= 0
                at, counts, owner = at[inside], counts[inside], owner[inside]
                m = 100 - 75 + (75 * sizes * texts) // words
                parts = np.zeros((len(places), piece.num_rows), np.int64)
                parts[at, owner] = weight[at] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[owner]))
                scores = evaluate(parts, nodes, covers)
                doc = piece.column("doc")
                missing = doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = doc.fill_null(0).to_numpy(zero_copy_only=False)
                for q, score in enumerate(scores):
                    kept = best[q]
                    least = kept[0][-1] if len(kept[0]) == TOP else 1
                    hit = np.flatnonzero(score >= max(least, 1))
                    if len(hit):
                        joined = [np.concatenate(x) for x in zip(kept, (score[hit], missing[hit], doc[hit]), strict=True)]
                        order = np.lexsort((joined[2], joined[1], -joined[0]))[:TOP]
                        best[q] = tuple(x[order] for x in joined)
        query = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        score, missing, doc = (np.concatenate([b[i] for b in best]) if best else np.zeros(0, np.int64) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(doc, pa.int64(), mask=missing == 1), pa.array(score, pa.int64())], names=["query", "doc", "score"]
        )

    return run


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(item, rank, doc_id, score): the best ``TOP`` texts of each query."""
    spark = docs.sparkSession
    kind = items.schema[item].dataType.simpleString()
    queries = items.select(F.col(item).alias("item"), F.col(text).alias("text")).distinct()
    queries = stored(queries.mapInArrow(_counted, f"item {kind}, terms array<binary>, counts array<bigint>").where("size(terms) > 0"), "queries")
    total = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    deal = F.xxhash64("item", "terms", "counts")
    passes, blocks = max(1, math.ceil(total / PASS_TERMS)), max(1, math.ceil(min(total, PASS_TERMS) / BLOCK_TERMS))
    queries = queries.select("*", F.pmod(deal, F.lit(passes)).alias("pass"), F.pmod(F.xxhash64(deal), F.lit(blocks)).alias("block"))
    source = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    found = []
    for p in range(passes):
        mine_ = queries.where(F.col("pass") == p)
        vocabulary = sorted(bytes(r["t"]) for r in mine_.select(F.explode("terms").alias("t")).distinct().collect())
        if not vocabulary:
            continue
        forward = source.mapInArrow(_forward(vocabulary), "doc bigint, n bigint, terms array<int>, counts array<bigint>")
        forward = stored(forward.where("n > 0"), "forward-rows")
        stats = forward.agg(F.count("*").alias("texts"), F.sum("n").alias("words")).first()
        held = {r["t"]: r["n"] for r in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
        plans = stored(mine_.groupBy("block").applyInArrow(_plan, "block bigint, plan string"), "plans")
        for b in range(blocks):
            row = plans.where(F.col("block") == b).first()
            if row is None:
                continue
            plan = json.loads(row["plan"])
            place = {t.hex(): i for i, t in enumerate(vocabulary)}
            places = [place[t] for t in plan["terms"]]
            texts, words = stats["texts"], stats["words"] or 0
            weights = [math.floor(1000 * math.log((2 * texts + 2) / (2 * held.get(i, 0) + 1))) for i in places]
            best = forward.mapInArrow(_best(plan, places, weights, len(vocabulary), texts, max(words, 1)), "query bigint, doc bigint, score bigint")
            rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
            best = best.withColumn("rank", rank).where(F.col("rank") <= TOP)
            names = F.broadcast(spark.createDataFrame(list(enumerate(plan["items"])), f"query bigint, item {kind}"))
            found.append(best.join(names, "query").select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score"))
    if not found:
        return spark.createDataFrame([], f"{item} {kind}, rank int, {key} bigint, score bigint")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
