"""Rounds of queries and the parity filter lose no link."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from test_operators import brute_groups, prose

from txnspark.llm import shingle_join


@pytest.mark.parametrize("more", [2, 16])
def test_rounds_equal_brute_force(spark, monkeypatch, more):
    monkeypatch.setattr(shingle_join, "PAIRS_PER_ENTRY", 0)  # never all that is left
    monkeypatch.setattr(shingle_join, "MORE", more)
    rng = random.Random(21)
    rows, base = [], [prose(rng, n).split() for n in (30, 60, 90)]
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 7)):  # about as many edits as the similarity allows, so that copies link and do not
            w[rng.randrange(len(w))] = prose(rng, 1)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.groups(df).collect())
    assert got == brute_groups(rows)


def test_a_group_costs_a_star(spark, monkeypatch):
    checked, verify = [], shingle_join._verify

    def counted(pairs, sets):
        checked.append(pairs.count())
        return verify(pairs, sets)

    monkeypatch.setattr(shingle_join, "_verify", counted)
    rng = random.Random(8)
    base, rows = prose(rng, 100).split(), []
    for i in range(100):
        w = list(base)
        for k in range(1 if i < 70 else 2):  # one edit links with the others of one edit, two edits with few or none
            w[rng.randrange(50 * k, 50 * k + 45)] = f"{prose(rng, 1)}{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.groups(df).collect())
    assert got == brute_groups(rows)
    assert max(collections.Counter(c for _, _, c in got).values()) >= 70
    assert sum(checked) <= 5 * len(rows)  # all pairs across the group: 4950


def test_parities_differ_no_more_than_the_sets():
    rng = np.random.default_rng(4)
    sets = []
    for i in range(30):
        tokens = rng.choice(2000, size=rng.integers(5, 900), replace=False).astype(np.int64) * 7919
        sets.append((i, np.sort(tokens)))
    n = [len(t) for _, t in sets]
    table = pa.table({
        "classes": pa.array([np.full(k, i, np.int64).tobytes() for (i, _), k in zip(sets, n, strict=True)]),
        "sizes": pa.array([np.full(k, k, np.int32).tobytes() for k in n]),
        "tokens": pa.array([t.tobytes() for _, t in sets]),
        "dfs": pa.array([np.full(k, 2, np.int32).tobytes() for k in n]),
    })
    rows = shingle_join._whole_sets(table).to_pylist()
    assert [r["class"] for r in rows] == list(range(30)) and all(len(r["bits"]) == shingle_join.BITS // 64 for r in rows)
    for a, (_, s) in zip(rows, sets, strict=True):
        assert set(a["tokens"]) == set(s.tolist())
        for b, (_, t) in zip(rows, sets, strict=True):
            differ = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a["bits"], b["bits"], strict=True))
            assert differ <= len(set(s.tolist()) ^ set(t.tolist()))
