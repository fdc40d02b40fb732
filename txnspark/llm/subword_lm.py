"""Language-model scoring with the likelihood of a subword lattice.

A text is its words and an end. The probability of a word is the sum over all ways to cut it into pieces of an existing
vocabulary, each cut weighing the product of its pieces' probabilities: a forward recursion over the lattice, in log
space, so no single segmentation is chosen. The vocabulary and its scores are read, never trained; the scores, which are
merge ranks, give the prior of each piece by Zipf's law, and the words of the training texts, segmented by the existing
tokenizer, give the counts. After each word the text ends with the share of ends among training tokens.

The corpus is read once into blocks of about ``BLOCK_CHARS`` characters, each with its distinct words and its texts as
numbers of those. Only (block, word) pairs are shuffled: to count words, to score each distinct word once, and back.

Defined results: NULL and empty texts are an end alone; a NULL key counts as the empty text for the split; words that
no vocabulary piece covers fall back to bytes, so every text has a probability; without training texts counts are 0 and the
prior stands; a table without rows gives none; repeated rows are texts of their own; extra columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.llm.common import stored, worker_code

worker_code(__name__)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_CHARS = 16_000_000
FOLDS, HELD_OUT = 7, 2
MIXED = np.uint64(0x9E3779B97F4A7C15)  # multiplier of the rolling hash


def held_out(key: Column) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, held, text) to one row per block: documents, their word numbers, the words and their training counts."""
    number = TaskContext.get().partitionId() << 24
    docs, held, sizes, numbers, words, chars = [], [], [], [], {}, 0

    def row():
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
        training = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(flat[training], minlength=len(words)).astype(np.int32)
        columns = {
            "block": pa.array([number], pa.int64()),
            "docs": pa.array([docs], pa.list_(doc_type)),
            "held": pa.array([held], pa.list_(pa.bool_())),
            "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "numbers": pa.array([flat], pa.list_(pa.int32())),
            "words": pa.array([list(words)], pa.list_(pa.binary())),
            "counts": pa.array([counts], pa.list_(pa.int32())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    for batch in batches:
        doc_type = batch.column("doc").type
        texts = batch.column("text").cast(pa.binary())
        for doc, is_held, text in zip(batch.column("doc").to_pylist(), batch.column("held").to_pylist(), texts, strict=True):
            # Bytes are cut at ASCII white space and lowered A-Z only, as the words are defined.
            found = (text.as_py() or b"").lower().split()
            number_of = words.setdefault
            numbers.append(np.fromiter((number_of(w, len(words)) for w in found), np.int32, len(found)))
            docs.append(doc)
            held.append(is_held)
            sizes.append(len(found))
            chars += len(text.as_py() or b"")
            if chars >= BLOCK_CHARS:
                yield row()
                docs, held, sizes, numbers, words, chars = [], [], [], [], {}, 0
                number += 1
    if docs:
        yield row()


def pieces(path: str = MODEL) -> dict[bytes, float]:
    """Bytes of each piece (a space for the word start) to its score; single bytes have the lowest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out, lowest = {}, -float(model.get_piece_size())
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            out.setdefault(bytes([int(model.id_to_piece(i)[3:5], 16)]), lowest)
        elif not (model.is_control(i) or model.is_unknown(i)):
            out[model.id_to_piece(i).replace("▁", " ").encode()] = model.get_score(i)
    for b in range(256):
        out.setdefault(bytes([b]), lowest)
    return out


def prior(scores: dict[bytes, float]) -> dict[bytes, float]:
    """Zipf's law over the ranks that the scores are (0, -1, -2, ...)."""
    weights = {p: 1 / (2.7 - s) for p, s in scores.items()}
    total = sum(weights.values())
    return {p: w / total for p, w in weights.items()}


def _count_pieces(path: str):
    """Rows (word, c) to (piece, n): counts of pieces over the training words, as the existing tokenizer cuts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            found = batch.column("word").to_pylist()
            cuts = model.encode([w.decode("utf-8", "replace") for w in found], num_threads=1)
            sizes = [len(c) for c in cuts]
            flat = np.fromiter((i for c in cuts for i in c), np.int64, sum(sizes))
            weights = np.repeat(batch.column("c").to_numpy(zero_copy_only=False), sizes)
            total += np.bincount(flat, weights, len(total)).astype(np.int64)
        used = np.flatnonzero(total)
        names = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in map(int, used)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(total[used])], names=["piece", "n"])

    return run


class Lattice:
    """Forward recursion for many words at once: words of one length are the rows of a matrix."""

    def __init__(self, log_p: dict[bytes, float]):
        by_length: dict[int, list[tuple[int, float]]] = {}
        for piece, lp in log_p.items():
            by_length.setdefault(len(piece), []).append((self._hash(piece), lp))
        self.tables = {}
        for length, found in sorted(by_length.items()):
            found.sort()
            self.tables[length] = (np.array([h for h, _ in found], np.uint64), np.array([p for _, p in found]))

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(MIXED) + b + 1) % 2**64
        return h

    def _same_length(self, m: np.ndarray) -> np.ndarray:
        """log probability of each row of a matrix of bytes."""
        n, size = m.shape
        codes = m.astype(np.uint64) + np.uint64(1)
        scores = {}
        h = np.zeros((n, size), np.uint64)
        for length in range(1, min(size, max(self.tables)) + 1):
            h = h[:, : size - length + 1] * MIXED + codes[:, length - 1 :]
            if length in self.tables:
                keys, lp = self.tables[length]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                scores[length] = np.where(keys[at] == h, lp[at], -np.inf)
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0
        for end in range(1, size + 1):
            for length, s in scores.items():
                if length <= end:
                    alpha[end] = np.logaddexp(alpha[end], alpha[end - length] + s[:, end - length])
        return alpha[size]

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word."""
        out = np.empty(len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes):
            which = np.flatnonzero(sizes == size)
            step = max(1, 200_000 // (int(size) + 1))
            for lo in range(0, len(which), step):
                some = which[lo : lo + step]
                m = np.frombuffer(b"".join(b" " + words[i] for i in some), np.uint8).reshape(len(some), size + 1)
                out[some] = self._same_length(m)
        return out / math.log(10)


def _score_words(log_p: dict[bytes, float]):
    """Rows (block, i, word, c), equal words next to each other, to packed rows per block: numbers, counts, log10 p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(log_p)
        for batch in batches:
            found = batch.column("word").to_pylist()
            new = np.fromiter((k == 0 or w != found[k - 1] for k, w in enumerate(found)), bool, len(found))
            lp = lattice([w for w, first in zip(found, new, strict=True) if first])[np.cumsum(new) - 1] if found else np.zeros(0)
            block, i, c = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("block", "i", "c"))
            order = np.argsort(block, kind="stable")
            names, starts = np.unique(block[order], return_index=True)
            cut = lambda a, kind: [x.astype(kind).tobytes() for x in np.split(a[order], starts[1:])]
            packed = [cut(i, np.int32), cut(c, np.int64), cut(lp, np.float64)] if len(names) else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), *[pa.array(x, pa.binary()) for x in packed]], names=["block", "i", "c", "lp"]
            )

    return run


def _score_block(totals: dict):
    """Documents of one block with the scores of its words."""

    def run(block: pa.Table, scored: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(scored.column(name).to_pylist()), kind)
        at = join("i", np.int32)
        c, lp = np.zeros(len(at), np.int64), np.zeros(len(at))
        c[at], lp[at] = join("c", np.int64), join("lp", np.float64)
        row = {name: block.column(name).chunk(0)[0].values for name in ("docs", "held", "sizes", "numbers")}
        sizes = row["sizes"].to_numpy().astype(np.int64)
        numbers = row["numbers"].to_numpy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        per_doc = lambda x: np.bincount(owner, x[numbers], len(sizes))
        ends = totals["ends"]
        base = per_doc(np.log10(c + 1.0)) + math.log10(ends + 1) - (sizes + 1) * math.log10(totals["tokens"] + totals["distinct"] + 1)
        p_end = (ends + 1) / (totals["tokens"] + 2)
        score = per_doc(lp) + sizes * math.log10(1 - p_end) + math.log10(p_end)
        known = per_doc((c > 0).astype(float)).astype(np.int64) + (ends > 0)
        return pa.table(
            {
                "doc": row["docs"],
                "held_out": row["held"],
                "n_tokens": pa.array(sizes + 1),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(sizes), totals["tokens"], np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    return run


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams of words) and score."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc"), held_out(F.col(key)).alias("held"), F.col(text).alias("text"))
    schema = f"block bigint, docs array<{kind}>, held array<boolean>, sizes array<int>, numbers array<int>, words array<binary>, counts array<int>"
    blocks = stored(source.mapInArrow(_blocks, schema), "blocks")
    ends = docs.where(~held_out(F.col(key))).count()
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w"))
    pairs = pairs.select("block", "i", F.col("w.words").alias("word"), F.col("w.counts").cast("bigint").alias("c"))
    by_word = Window.partitionBy("word")
    counted = pairs.select("block", "i", "word", F.sum("c").over(by_word).alias("c"), F.min(F.struct("block")).over(by_word)["block"].alias("b"))
    # Equal words stand together, the first mention of each is marked.
    counted = stored(counted.select("block", "i", "word", "c", (F.col("b") == F.col("block")).alias("first")), "counted-words")
    known = counted.where("first and c > 0")
    sums = known.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("words"), F.count("*").alias("distinct")).first()
    totals = {"ends": ends, "tokens": sums["words"] + ends, "distinct": sums["distinct"] + (ends > 0)}
    log_p = train(known, model)
    packed = counted.select("block", "i", "word", "c").mapInArrow(_score_words(log_p), "block bigint, i binary, c binary, lp binary")
    out = T.StructType(
        [
            T.StructField("doc", docs.schema[key].dataType),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
            *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")],
        ]
    )
    texts = blocks.select("block", "docs", "held", "sizes", "numbers")
    scored = texts.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(_score_block(totals), out)
    return scored.withColumnRenamed("doc", key)


def train(known: DataFrame, model: str = MODEL) -> dict[bytes, float]:
    """log probability of every piece: counts over the training words, smoothed by the prior with the weight of one
    count per piece. ``known`` has each training word once, as (word, c); counts of at most all pieces are collected."""
    before = prior(pieces(model))
    counted = known.select("word", "c").mapInArrow(_count_pieces(model), "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    n = {bytes(r["piece"]): r["n"] for r in counted.collect()}
    total = sum(n.get(p, 0) for p in before) + len(before)
    return {p: math.log((n.get(p, 0) + len(before) * q) / total) for p, q in before.items()}
