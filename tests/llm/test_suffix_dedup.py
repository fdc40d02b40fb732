"""Suffix-array dedup against brute force: arrays and prefixes alone, odd rows, and anchors split over shards."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnspark.llm import suffix_dedup as S


def dedup_by_hand(texts, n=S.MATCH):
    raw = [(t or "").encode() for t in texts]
    starts = Counter(t[i : i + n] for t in raw for i in range(len(t) - n + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - n + 1):
            if starts[t[i : i + n]] > 1:
                gone[i + 1 : i + n + 1] = True
        edge = np.flatnonzero(np.diff(gone.astype(int)))
        kept = bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)
        out.append((len(t), len(t) - len(kept), len(edge) // 2, hashlib.sha256(kept).hexdigest()))
    return out


def prose(rng, n, words=300):
    return " ".join(f"{'aeiou'[rng.randrange(5)]}{rng.randrange(words)}é"[: rng.randint(2, 6)] for _ in range(n))


def odd_texts():
    rng = random.Random(2)
    passage, line = prose(rng, 90), prose(rng, 70)
    texts = [None, "", "short", prose(rng, 400), prose(rng, 400)]
    texts += [prose(rng, k) + passage + prose(rng, 40) for k in range(1, 40)]  # one passage in many surroundings
    texts += [texts[3]] * 5 + [texts[3][: 300 + k] + "!" + texts[3][301 + k :] for k in range(0, 60, 7)]
    texts += ["x" * 150, "x" * 199, "x" * 200, "x" * 201, "ab" * 400, "ba" * 150, "\0" * 250 + "z" * 230]
    texts += [prose(rng, 20) + "\n" + line + "\n" + prose(rng, 60) + "\n" + line + "\n" + line[:-1]]
    texts += [passage.encode()[:k].decode(errors="ignore") for k in (199, 200, 201, 260)]
    texts += [prose(rng, 30000) + passage + "ü" * 500]
    return texts


@pytest.mark.parametrize("limit", [S.SHARD_SEGMENTS, 2])
def test_dedup_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "SHARD_SEGMENTS", limit)  # 2: nearly all anchors are split over shards
    monkeypatch.setattr(S, "SHARD_BYTES", 20_000)
    texts = odd_texts()
    ids = [*range(len(texts) - 3), None, None, 4]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    df = df.withColumn("k1", F.lit(1)).withColumn("spans", F.lit("clash"))
    rows = S.dedup(df)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows.collect())
    assert got == Counter((i, *r) for i, r in zip(ids, dedup_by_hand(texts), strict=True))
    # The spans say what to remove.
    left = df.select("doc_id", "text").join(rows.select("doc_id", "spans", "kept_sha256"), "doc_id").where("doc_id != 4")
    assert left.where(F.sha2(S.remaining(F.col("text"), F.col("spans")), 256) != F.col("kept_sha256")).isEmpty()


def test_dedup_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.dedup(df).count() == 0
    one = spark.createDataFrame([(1, None), (2, "a")], "doc_id long, text string")
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in S.dedup(one).orderBy("doc_id").collect()] == [(0, 0, 0), (1, 0, 0)]


@pytest.mark.parametrize("raw", [b"", b"a", b"banana" * 40, b"\0\0\0" * 30, b"abracadabra" * 7 + b"\0" * 9, prose(random.Random(4), 500, 9).encode()])
def test_suffix_array_and_prefixes(monkeypatch, raw):
    monkeypatch.setattr(S, "LANE", 16)
    data, depth = np.frombuffer(raw, np.uint8), 100
    order = S.suffix_array(data)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    cut = [raw[i : i + depth] for i in order]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    if raw:
        assert S.common_prefixes(data, order, depth).tolist() == [0, *[common(a, b) for a, b in zip(cut[1:], cut[:-1], strict=True)]]


def test_equal_strings_have_equal_anchors():
    rng = random.Random(9)
    common = prose(rng, 120).encode()
    texts = [prose(rng, 30).encode() + common + prose(rng, 50).encode() for _ in range(6)] + [b"", b"z" * 450, common[: S.MATCH]]
    raw, cuts = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    text, h, first, more = S.anchors(raw, cuts, S._powers(len(raw) + 1))
    anchor = {}
    for t, a, f, m in zip(text.tolist(), h.tolist(), first.tolist(), more.tolist(), strict=True):
        for p in range(f, f + m + 1):
            anchor[t, p] = a
    assert sorted(anchor) == [(t, p) for t, x in enumerate(texts) for p in range(len(x) - S.MATCH + 1)]
    by = {}
    for (t, p), a in anchor.items():
        assert by.setdefault(texts[t][p : p + S.MATCH], a) == a
