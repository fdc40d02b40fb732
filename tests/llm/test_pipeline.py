"""The whole pipeline over planted cases, against what each stage has to do with them."""

from __future__ import annotations

import collections
import random
import re

import pytest

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n):
    """Sentences of words that no other text shares by chance."""
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, n, 9)) + "."


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(12)
    clean = {i: prose(rng, 120) for i in range(60)}
    item = " ".join(prose(rng, 30).replace(".", "").lower().split())
    notice = " ".join(prose(rng, 14).replace(".", "").lower().split())
    rows = dict(clean)
    rows[100] = "too short"  # goes: words
    rows[101] = "\n".join([prose(rng, 10)] * 40)  # goes: one line again and again
    rows[102] = None
    rows[103] = ""
    for i in range(110, 116):  # notice in several texts: stays in the first alone
        rows[i] = prose(rng, 100) + "\n" + notice + "\n" + prose(rng, 60)
    rows[120] = clean[0]  # exact copy
    rows[121] = re.sub(r"\b(\w+)\.$", "changed.", clean[1]).replace(". ", ".\n")  # near copy in other lines
    rows[130] = prose(rng, 60) + " " + item + ". " + prose(rng, 60)  # quotes the benchmark
    sources = ["web", "book", None]
    table = [(i, t, "en", sources[i % 3], None if t is None else len(t)) for i, t in rows.items()]
    table.append((None, prose(rng, 130), "en", "web", 1))  # clean, without an id
    return table, item, notice


def test_planted_cases(spark, planted, tmp_path):
    table, item, notice = planted
    spark.createDataFrame(table, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
        after[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = {i for i in range(60)} | {None}
    assert set(after["quality_rules"]) & {100, 101, 102, 103} == set() and clean <= set(after["quality_rules"])
    lines = after["line_dedup"]
    assert notice in lines[110].lower() and not any(notice in lines[i].lower() for i in range(111, 116))
    assert all(lines[i] == after["quality_rules"][i] for i in clean - {0, 1})
    joined = set(after["ngram_jaccard_join"])
    # Of a text and its copy one stays, and it is the first; nothing else goes.
    assert 121 not in joined and 1 in joined and {0, 120} & joined and clean - {0} <= joined
    assert set(after["ngram_jaccard_join"]) - set(after["benchmark_decontamination"]) == {130}
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    assert mixed.columns == [*docs.columns, "copy", "position"]
    rows = mixed.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    kept = after["benchmark_decontamination"]
    assert {(r.doc_id, r.text) for r in rows} <= set(kept.items())
    copies = collections.Counter(r.doc_id for r in rows)
    assert max(copies.values()) <= 3
    # The shares of the sources follow their weights 1, 2 and 3, as far as three times their size allows.
    sizes, taken = collections.Counter(), collections.Counter()
    source = {i: s for i, _, _, s, _ in table}
    for i, text in kept.items():
        n = len(WORD.findall(text))
        sizes[source[i]] += n
        taken[source[i]] += n * copies[i]
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    capped: set = set()
    while True:
        room = total - sum(3 * sizes[s] for s in capped)
        share = {s: 3 * sizes[s] if s in capped else room * weights[s] / sum(weights[x] for x in order if x not in capped) for s in order}
        over = {s for s in order if s not in capped and share[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    longest = max(len(WORD.findall(t)) for t in kept.values())
    assert all(abs(taken[s] - share[s]) <= longest for s in order)
