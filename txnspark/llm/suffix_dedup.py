"""Suffix-array dedup: every byte covered by a ``MATCH``-byte string that also starts anywhere else goes.

1. Anchors: of the ``WINDOW`` strings of ``GRAM`` bytes in a ``MATCH``-byte string, the one with the smallest hash (the
   first of equal ones). Equal strings have equal anchors, so a string whose anchor occurs once in the corpus is alone.
   Neighbouring strings share an anchor: about one anchor per 80 bytes is hashed, counted and joined.
2. Segments: what the strings of one anchor cover in a text. Only those of anchors that occur again travel. Segments of
   one anchor meet in one shard, equal ones as one with a count; an anchor of more than ``SHARD_SEGMENTS`` is dealt to
   several shards.
3. Shards: where the segments of an anchor differ, a block of at most about ``SHARD_BYTES`` gets its suffix array by
   Larsson-Sadakane refinement (groups of suffixes equal in 7 bytes, then 14, and so on; only groups of several are sorted
   again) and its common prefixes by Kasai's recurrence, run in parallel lanes. Neighbours with a common prefix of
   ``MATCH`` bytes are the repeats.
4. Between the shards of one anchor the sorted names (64-bit hashes) of their strings are merged: each run is looked up
   in those before it by binary search, and every shard looks up its own strings among the ones found twice.
5. Runs of repeated strings become spans per distinct text; a text with copies goes as a whole.

Defined results: NULL counts as the empty text; texts under ``MATCH`` bytes lose nothing; matches do not cross rows; rows
of one doc_id, or without one, are texts of their own; equal rows are copies; a table without rows gives none; extra
columns are not used. Very long texts are read whole, in memory of about 60 times their bytes for a moment. Texts and
anchors are known by 128- and 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.llm.common import stored, worker_code
from txnspark.llm.word_hashes import BASE, _powers, mix

worker_code(__name__)

MATCH = 200
GRAM = 40
WINDOW = MATCH - GRAM + 1
SHARD_SEGMENTS = 4096
SHARD_BYTES = 1_000_000
SHARD_ROWS = 200_000  # segments, equal ones included, that a task judges at a time
LANE = 256  # positions that one lane of Kasai's recurrence covers
SLICE_BYTES = 500_000
_U = np.uint64


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes of a run of texts, where each starts and the last ends)."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def _hashes(raw: np.ndarray, size: int, powers: tuple[np.ndarray, np.ndarray], seed: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position on."""
    codes = mix((np.arange(256, dtype=np.uint64) + _U(seed)) * _U(BASE))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes[raw] * powers[0][: len(raw)], dtype=np.uint64)))
    n = len(raw) - size + 1
    return mix((sums[size:] - sums[:n]) * powers[1][:n])


def _whole(cuts: np.ndarray, n: int) -> np.ndarray:
    """Which of the first ``n`` positions start a ``MATCH``-byte string inside one text."""
    edge = np.zeros(max(int(cuts[-1]), n) + 1, np.int32)
    np.add.at(edge, np.maximum(cuts[:-1], cuts[1:] - (MATCH - 1)), 1)
    np.add.at(edge, cuts[1:], -1)
    return np.cumsum(edge)[:n] == 0


def anchors(raw: np.ndarray, cuts: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(text, anchor's hash, first string, number of further strings) of the texts between the cuts, in order."""
    n = len(raw) - MATCH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    h = _hashes(raw, GRAM, powers, 1)
    bits = _U(len(h).bit_length())
    # Smallest hash of each window, the place in its low bits: minima from the left and from the right of each block.
    value = np.full(-(-len(h) // WINDOW) * WINDOW, np.iinfo(np.uint64).max, np.uint64)
    value[: len(h)] = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    blocks = value.reshape(-1, WINDOW)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(right[:n], left[WINDOW - 1 : WINDOW - 1 + n]) & ((_U(1) << bits) - _U(1))).astype(np.int64)
    p = np.flatnonzero(_whole(cuts, n))
    if not len(p):
        return (np.zeros(0, np.int64),) * 4
    new = np.flatnonzero(np.append(True, (at[p[1:]] != at[p[:-1]]) | (p[1:] != p[:-1] + 1)))
    first, last = p[new], p[np.append(new[1:], len(p)) - 1]
    text = np.searchsorted(cuts, first, "right") - 1
    return text, h[at[first]].view(np.int64), first - cuts[text], last - first


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, text) to (k1, k2, hash, span), a span being the first string times 256 and the number of further ones."""
    powers = _powers(SLICE_BYTES + 1)
    for batch in batches:
        k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
        for start, raw, cuts in _slices(batch.column("text")):
            if len(raw) >= len(powers[0]):
                powers = _powers(len(raw) + 1)
            text, h, first, more = anchors(raw, cuts, powers)
            columns = [k1[text + start], k2[text + start], h, first * 256 + more]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "hash", "span"])


_SEGMENT_DDL = "hash bigint, salt bigint, shards bigint, k1 bigint, k2 bigint, first bigint, segment binary"


def _segments(split_only: bool):
    """Texts with their spans to segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece, rows = batch.slice(start, 256), []
                for k1, k2, text, spans in zip(*[piece.column(c).to_pylist() for c in ("k1", "k2", "text", "spans")], strict=True):
                    for s in spans:
                        if split_only and s["shards"] == 1:
                            continue
                        first, more = divmod(s["span"], 256)
                        rows.append((s["hash"], k1 % s["shards"], s["shards"], k1, k2, first, text[first : first + more + MATCH]))
                columns = zip(*rows, strict=True) if rows else [()] * 7
                kinds = [pa.int64()] * 6 + [pa.binary()]
                names = ["hash", "salt", "shards", "k1", "k2", "first", "segment"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def suffix_array(raw: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes."""
    n = len(raw)
    # Seven bytes of nine bits each; what lies behind the end is 0 and comes before all bytes.
    padded = np.concatenate((raw.astype(np.uint64) + _U(1), np.zeros(7, np.uint64)))
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << _U(9)) | padded[j : j + n]
    order = np.argsort(key)
    key = key[order]
    first = np.append(True, key[1:] != key[:-1])[:n]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    known = 7
    while True:
        slots = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(slots):
            return order
        at = order[slots]
        key = rank[at] * (n + 1) + (rank[np.minimum(at + known, n)] + 1)
        again = np.argsort(key)
        at, key = at[again], key[again]
        order[slots] = at
        new = np.append(True, key[1:] != key[:-1])
        first[slots] = new
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        known *= 2


def common_prefixes(raw: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, at most ``depth``, of each place of the order with the one before: Kasai's recurrence (a position
    shares at least one byte less than the position before it), in lanes of ``LANE`` positions that advance together."""
    n = len(raw)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    i = np.arange(0, n, LANE)
    end = np.minimum(i + LANE, n)
    h = np.zeros(len(i), np.int64)
    while len(i):
        j = before[i]
        inside = (j >= 0) & (h < depth) & (i + h < n) & (j + h < n)
        same = inside & (raw[np.minimum(i + h, n - 1)] == raw[np.minimum(j + h, n - 1)])
        h += same
        done = ~same
        shared[i[done]] = h[done]
        h[done] = np.maximum(h[done] - 1, 0)
        i = i + done
        left = i < end
        if not left.all():
            i, end, h = i[left], end[left], h[left]
    return shared[order]


def repeated(segments: list[bytes], counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, cuts, mask) of different segments that occur so often: which positions start a string that occurs again."""
    raw = np.frombuffer(b"".join(segments), np.uint8)
    cuts = np.append(0, np.cumsum([len(s) for s in segments]))
    whole = _whole(cuts, len(raw))
    order = suffix_array(raw)
    equal = np.cumsum(common_prefixes(raw, order, MATCH) < MATCH) - 1
    weight = np.where(whole, np.repeat(np.array(counts), np.diff(cuts)), 0)[order]
    total = np.bincount(equal, weights=weight) if len(equal) else np.zeros(0)
    mask = np.zeros(len(raw), bool)
    mask[order] = total[equal] >= 2
    return raw, cuts, mask & whole


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _names(raw: np.ndarray) -> np.ndarray:
    """Names of the ``MATCH``-byte strings."""
    return _hashes(raw, MATCH, _powers(len(raw) + 1), 7) if len(raw) >= MATCH else np.zeros(0, np.uint64)


_FOUND = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("a", "b", "start", "stop")], ("names", pa.binary())])
_FOUND_DDL = "kind int, a bigint, b bigint, start bigint, stop bigint, names binary"


class _Block:
    """Segments of whole anchors of one shard, judged together."""

    def __init__(self):
        self.groups: list[tuple[tuple, dict]] = []
        self.bytes = self.rows = 0

    def add(self, key: tuple, held: dict) -> None:
        self.groups.append((key, held))
        self.bytes += sum(map(len, held)) if len(held) > 1 else 0
        self.rows += sum(map(len, held.values()))

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or self.rows >= SHARD_ROWS

    def judge(self) -> pa.RecordBatch:
        """Rows of kind 0: text (a, b) has repeated strings from start to stop; of kind 1: the names, sorted, of the
        strings in part ``start`` of anchor a in its shard b."""
        rows, segments, places, split = [], [], [], []
        for key, held in self.groups:
            if len(held) == 1 and key[2] == 1:
                ((segment, where),) = held.items()
                if len(where) > 1:
                    rows.extend((0, k1, k2, first, first + len(segment) - MATCH + 1, None) for k1, k2, first in where)
                continue
            split.append((key, len(segments), len(segments) + len(held)))
            segments.extend(held)
            places.extend(held.values())
        if segments:
            raw, cuts, mask = repeated(segments, [len(w) for w in places])
            for start, stop in zip(*_runs(mask), strict=True):
                s = int(np.searchsorted(cuts, start, "right")) - 1
                lo, hi = int(start - cuts[s]), int(stop - cuts[s])
                rows.extend((0, k1, k2, first + lo, first + hi, None) for k1, k2, first in places[s])
            if any(key[2] > 1 for key, *_ in split):
                names, whole = _names(raw), _whole(cuts, max(len(raw) - MATCH + 1, 0))
                for (h, salt, shards), lo, hi in split:
                    if shards > 1:
                        inside = slice(int(cuts[lo]), int(cuts[hi]))
                        own = np.unique(names[inside][whole[inside]])
                        part = ((own >> _U(32)) * _U(shards)) >> _U(32)
                        for p in np.unique(part):
                            rows.append((1, h, salt, int(p), 0, own[part == p].tobytes()))
        columns = zip(*rows, strict=True) if rows else [()] * len(_FOUND)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (anchor, shard) to what repeats inside each shard."""
    block, key, held = _Block(), None, {}
    for batch in batches:
        for h, salt, shards, k1, k2, first, segment in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (h, salt, shards) != key:
                if key is not None:
                    block.add(key, held)
                    if block.full():
                        yield block.judge()
                        block = _Block()
                key, held = (h, salt, shards), {}
            held.setdefault(segment, []).append((k1, k2, first))
    if key is not None:
        block.add(key, held)
    yield block.judge()


def _probe(run: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of a run are among the sorted names, by binary search."""
    if not len(among):
        return np.zeros(len(run), bool)
    return among[np.minimum(np.searchsorted(among, run), len(among) - 1)] == run


def _merge(table: pa.Table) -> pa.Table:
    """Sorted runs of the shards of one anchor, in one part of the names, to those that two shards hold, for each shard."""
    runs = [np.frombuffer(x, np.uint64) for x in table.column("names").to_pylist()]
    seen, twice = np.zeros(0, np.uint64), [np.zeros(0, np.uint64)]
    for run in runs:
        hit = _probe(run, seen)
        twice.append(run[hit])
        new = run[~hit]
        seen = np.insert(seen, np.searchsorted(seen, new), new)
    both = np.unique(np.concatenate(twice))
    hits = [run[_probe(run, both)].tobytes() for run in runs]
    found = pa.table({"hash": table.column("a"), "salt": table.column("b"), "names": pa.array(hits, pa.binary())})
    return found.filter(pa.array([bool(x) for x in hits], pa.bool_()))


def _across(segments: pa.Table, hits: pa.Table) -> pa.Table:
    """Segments of one shard to the runs of strings that another shard of the anchor holds too."""
    names = np.sort(np.frombuffer(b"".join(hits.column("names").to_pylist()), np.uint64))
    held: dict[bytes, list[tuple]] = {}
    if len(names):
        for k1, k2, first, segment in zip(*[segments.column(c).to_pylist() for c in ("k1", "k2", "first", "segment")], strict=True):
            held.setdefault(segment, []).append((k1, k2, first))
    rows = []
    for segment, where in held.items():
        if len(where) > 1:  # repeats inside its own shard, which has reported it
            continue
        for start, stop in zip(*_runs(_probe(_names(np.frombuffer(segment, np.uint8)), names)), strict=True):
            rows.extend((k1, k2, first + int(start), first + int(stop)) for k1, k2, first in where)
    columns = zip(*rows, strict=True) if rows else [()] * 4
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a", "b", "start", "stop"), columns, strict=True)})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their runs to what is left of them."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece, rows = batch.slice(start, 256), []
            for k1, k2, text, runs in zip(*[piece.column(c).to_pylist() for c in ("k1", "k2", "text", "runs")], strict=True):
                spans: list[list[int]] = []
                for lo, hi in sorted((r["start"], r["stop"] + MATCH - 1) for r in runs):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(hi, spans[-1][1])
                    else:
                        spans.append([lo, hi])
                edges = [0, *[x for s in spans for x in s], len(text)]
                kept = b"".join(text[lo:hi] for lo, hi in zip(edges[::2], edges[1::2], strict=True))
                rows.append((k1, k2, spans, len(text) - len(kept), hashlib.sha256(kept).hexdigest()))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.int64(), pa.string()]
            names = ["k1", "k2", "spans", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _keys(text: str) -> list[Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2")]


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, spans, n_removed, kept_sha256) of the different texts, known by two hashes, that share a string with
    another or hold one twice; spans are [start, end) in bytes."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.where(F.octet_length(text) >= MATCH).select(*_keys(text), F.col(text).cast("binary").alias("text"))
    found = source.mapInArrow(_anchors, "k1 bigint, k2 bigint, hash bigint, span bigint")
    place = F.xxhash64("k1", "k2", "span")
    counts = found.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"))
    again = counts.where("low != high").select("hash", F.ceil(F.col("n") / SHARD_SEGMENTS).alias("shards"))
    again = stored(again, "repeated-anchors")
    spans = found.join(again, "hash").groupBy("k1", "k2").agg(F.collect_set(F.struct("span", "hash", "shards")).alias("spans"))
    texts = source.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    touched = stored(texts.join(spans, ["k1", "k2"]), "texts-with-repeats")

    dealt = touched.mapInArrow(_segments(False), _SEGMENT_DDL).repartition(parts, "hash", "salt").sortWithinPartitions("hash", "salt")
    judged = stored(dealt.mapInArrow(_shards, _FOUND_DDL), "repeats")
    runs = judged.where("kind = 0").select("a", "b", "start", "stop")
    if not again.where("shards > 1").isEmpty():
        merged = judged.where("kind = 1").groupBy("a", "start").applyInArrow(_merge, "hash bigint, salt bigint, names binary")
        split = touched.mapInArrow(_segments(True), _SEGMENT_DDL)
        across = split.groupBy("hash", "salt").cogroup(merged.groupBy("hash", "salt"))
        runs = runs.unionByName(across.applyInArrow(_across, "a bigint, b bigint, start bigint, stop bigint"))
    runs = runs.groupBy(F.col("a").alias("k1"), F.col("b").alias("k2")).agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    cut = touched.select("k1", "k2", "text").join(runs, ["k1", "k2"]).mapInArrow(
        _cut, "k1 bigint, k2 bigint, spans array<array<bigint>>, n_removed bigint, kept_sha256 string"
    )
    return stored(cut, "cut-texts")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans, [start, end) in bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(body).cast("bigint")
    rows = docs.select(F.col(key), *_keys(text), size.alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("whole_sha256"))
    copied = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.max("n_bytes").alias("size"))
    copied = copied.where(f"copies > 1 AND size >= {MATCH}").select("k1", "k2", F.lit(True).alias("copied"))
    info = copied.join(repeats(docs, text), ["k1", "k2"], "full")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    whole = F.array(F.array(F.lit(0).cast("bigint"), F.col("n_bytes")))
    none = F.array().cast("array<array<bigint>>")
    spans = F.when(F.col("copied"), whole).otherwise(F.coalesce("spans", none)).alias("spans")
    return rows.join(info, ["k1", "k2"], "left").select(
        F.col(key),
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
        F.when(F.col("copied"), nothing).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        spans,
    )


def remaining(text: Column, spans: Column) -> Column:
    """Bytes of a text outside its spans."""
    body = F.coalesce(text, F.lit("")).cast("binary")
    start = F.struct(F.lit(0).cast("bigint").alias("from"), F.unhex(F.lit("")).alias("kept"))

    def step(done: Column, span: Column) -> Column:
        part = F.substring(body, (done["from"] + 1).cast("int"), (span[0] - done["from"]).cast("int"))
        return F.struct(span[1].alias("from"), F.concat(done["kept"], part).alias("kept"))

    def end(done: Column) -> Column:
        return F.concat(done["kept"], F.substring(body, (done["from"] + 1).cast("int"), F.octet_length(body)))

    return F.aggregate(spans, start, step, end)
