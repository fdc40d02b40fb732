"""Rows that share an id, or have none, are judged each by its own text."""

from __future__ import annotations

import collections

from txnspark.llm import decontaminate, line_dedup, shingle_join

TEXT = "doc_id bigint, text string, tag string"
COMMON = "all rights are reserved by the house since long ago"


def bag(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_lines_go_from_their_own_text_only(spark):
    rows = [(1, COMMON), (None, f"{COMMON}\nsecond line"), (None, "first line here of another text that stays\nmore"), (2, f"own words\n{COMMON}"), (2, "kept\nkept too")]
    got = bag(line_dedup.drop_repeated(spark.createDataFrame([(*r, "x") for r in rows], TEXT)))
    assert got == collections.Counter([rows[0], (None, "second line"), rows[2], (2, "own words"), rows[4]])


def test_texts_of_one_id_are_contaminated_each_by_itself(spark):
    item = " ".join(f"w{chr(97 + i)}" for i in range(24))
    words = item.split()
    # Each half has too few windows and words alone, both together have enough.
    rows = [(None, " ".join(words[:12]), "x"), (None, " ".join(words[12:]), "x"), (None, "a clean text", "x"), (5, item, "x"), (5, "another clean text", "x"), (None, item, "x")]
    docs = spark.createDataFrame(rows, TEXT)
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert bag(decontaminate.drop_contaminated(docs, items)) == collections.Counter([r[:2] for r in (rows[0], rows[1], rows[2], rows[4])])
    assert {r.doc_id for r in decontaminate.contaminated(docs, items).collect()} == {None, 5}


def test_one_row_of_a_group_whatever_its_id(spark):
    a, b, c = (" ".join(f"{k}{chr(97 + i)}" for i in range(20)) for k in "abc")
    rows = [(3, a, "x"), (7, a, "x"), (7, b, "x"), (None, a, "x"), (None, c, "x"), (None, c, "y"), (None, "", "x"), (None, "", "x"), (9, b + " more", "x")]
    got = bag(shingle_join.keep_one(spark.createDataFrame(rows, TEXT)))
    assert got == collections.Counter([(3, a), (7, b), (None, c), (None, ""), (None, "")])
