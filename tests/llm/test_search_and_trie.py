"""Shared-subexpression search and burst trie against brute force, on odd rows and with tiny containers."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from txnspark.llm import prefix_trie, shared_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def term_list(text):
    return TERM.findall((text or "").translate(LOWER))


def search_by_hand(docs, items):
    held = [(d, Counter(term_list(t))) for d, t, *_ in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    texts, words = len(held), sum(n for *_, n in held)
    out = []
    for item, text in {(i, t) for i, t, *_ in items}:
        scores = []
        for d, c, n in held:
            m = 100 - 75 + (75 * n * texts) // words
            s = 0
            for term in term_list(text):
                df = sum(term in x for _, x, _ in held)
                if c[term]:
                    s += math.floor(1000 * math.log((2 * texts + 2) / (2 * df + 1))) * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, rank, None if no else d, -s) for rank, (s, no, d) in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Émile", "straße", "数据", "x" * 90, "İx"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def prose(n):
        return " ,;".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(vocabulary, weights, k=n))

    docs = [(i, prose(rng.randint(1, 60)), "clash") for i in range(120)]
    docs += [(None, prose(20), "c"), (500, None, "c"), (501, "", "c"), (502, " .,\n", "c"), docs[3], (3, prose(9), "c"), (600, docs[4][1], "c")]
    docs += [(700, prose(20000), None)]
    shared = prose(12)
    items = [(i, shared + " " + prose(rng.randint(1, 12)), 1) for i in range(30)]
    items += [(50, None, 1), (51, "", 1), (52, "nowhere", 1), items[0], (0, "w1 w1 w1 w2", 1), (None, "w3 " + "x" * 90, 1)]
    return docs, items


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("blocks", [False, True])
def test_search_equals_brute_force(spark, corpus, monkeypatch, blocks):
    if blocks:  # several passes and blocks, slices of a few texts
        monkeypatch.setattr(shared_search, "PASS_TERMS", 120)
        monkeypatch.setattr(shared_search, "BLOCK_TERMS", 40)
        monkeypatch.setattr(shared_search, "SLICE_CELLS", 500)
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id bigint, text string, query string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string, terms int")
    assert found(shared_search.search(d, i)) == search_by_hand(docs, items)


def test_search_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert shared_search.search(d, i).count() == 0
    assert shared_search.search(i.withColumnRenamed("item_id", "doc_id"), i.limit(0)).count() == 0


def test_mined_sets_cover_each_query_and_are_shared():
    rng = random.Random(8)
    queries = [{f"t{rng.randint(0, 40)}": rng.randint(1, 3) for _ in range(10)} for _ in range(40)]
    for k, query in enumerate(queries):  # two instructions, each before half of the queries
        query.update({f"instruction{k % 2}-{i}": 1 for i in range(15)})
    atoms, nodes, covers = shared_search.mine(queries)

    def whole(part):
        return Counter({atoms[part]: 1}) if part < len(atoms) else sum((whole(p) for p in nodes[part - len(atoms)]), Counter())

    for query, cover in zip(queries, covers, strict=True):
        total = Counter()
        for part, n in cover.items():
            for term, k in whole(part).items():
                total[term] += n * k
        assert total == query

    def parts(part):
        return {part}.union(*(parts(p) for p in nodes[part - len(atoms)])) if part >= len(atoms) else {part}

    read_by = Counter(p for cover in covers for p in set().union(*map(parts, cover)))
    assert all(read_by[len(atoms) + i] >= 2 for i in range(len(nodes)))
    additions = sum(len(n) - 1 for n in nodes) + sum(len(c) for c in covers)
    assert additions < 0.7 * sum(len(q) for q in queries)


def trie_by_hand(turns):
    said = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), len(text)))
    said = {c: [(i, n) for _, _, i, n in sorted(v)] for c, v in said.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(said.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        below = [x for x in members if x[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == p)))
        out.append((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], sum(not children[x] for x in below),
            sum((len(members[x]) - 1) * (x[-1][1] if x else 0) for x in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def turns_of_all_kinds():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 60), *range(100, 160), 250, 307, -5, -120, -100]:
        first = rng.choice([("user", "hello"), ("user", "hello"), ("user", "hi"), (None, None), ("user", "")])
        rows.append((c, 0, *first))
        for t in range(1, rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "é数", None])))
    for c in range(400, 440):  # copies
        rows += [(c, t, "user", f"same {t}") for t in range(8)]
    rows += [(500, t, "user", f"long {t}") for t in range(300)] + [(501, t, "user", f"long {t}" if t < 250 else "other") for t in range(300)]
    rows += [(7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, None, "user", "before"), (None, 0, "user", "nobody"), (8, 1, "a", "b" * 50000)]
    rows += [(600, 0, None, None)]
    return rows


def nodes_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("home", F.lit("x")).withColumn("ids", F.lit(1))
    convs = prefix_trie.conversations(df)
    conv = F.col("conv_id")
    shared = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(6))
    nodes = prefix_trie.trie(prefix_trie.with_openings(convs, conv - conv % 100, shared, 5)).collect()
    none = hashlib.sha256(b"").hexdigest()
    return sorted((tuple(r[:-1]) + (r.ends or none,) for r in nodes), key=repr)


@pytest.mark.parametrize("container, chunk", [(4096, 4096), (60, 3), (1, 1)])
def test_trie_equals_brute_force(spark, monkeypatch, container, chunk):
    monkeypatch.setattr(prefix_trie, "CONTAINER_TURNS", container)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", chunk)
    rows = turns_of_all_kinds()
    assert nodes_of(spark, rows) == trie_by_hand(rows)


def test_trie_of_nothing_and_of_turnless(spark):
    assert nodes_of(spark, []) == []
    rows = [(101, 0, "user", "a")]  # its opening of 4 turns is absent: no turn is left
    assert zlib.crc32(b"101") % 6 > 0
    assert nodes_of(spark, rows) == trie_by_hand(rows) and len(trie_by_hand(rows)) == 1
