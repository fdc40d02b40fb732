"""Operators do the whole job: cases that an earlier cut lost."""

from __future__ import annotations

from txnspark.llm import decontaminate

ITEM = "bc bd bf bg bh 5 bj 3 bl bm bn bp bq br bs"  # 15 words, two numbers near the middle, eight windows
TEXT = "doc_id bigint, text string"


def found(spark, items, rows):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.contaminated(spark.createDataFrame(rows, TEXT), items).collect()
    return {(r.doc_id, r.item_id): (r.n_windows, r.item_windows) for r in out}


def test_an_item_held_twice_with_other_values_is_found(spark):
    other = ITEM.replace("5", "1").replace("3", "8")
    third = ITEM.replace("5", "3").replace("3", "5")
    rows = [(1, f"{ITEM} and then {other}"), (2, f"{other} and then {third} and {other}"), (3, ITEM.replace("bj 3", "bj 5"))]
    got = found(spark, [(1, ITEM)], rows)
    assert got[1, 1] == got[2, 1] == (8, 8)
    assert (3, 1) not in got  # two values of the item stand for one


def made(n, start=0):
    """Ordinary words without digits, all different."""
    return ["w" + "".join(chr(97 + int(c)) for c in str(start + i)) for i in range(n)]


def test_partial_and_edited_items_are_found(spark):
    long, median = made(59), made(38, 100)
    edited = list(median)
    edited[12], edited[25] = "other", "words"
    few = made(10, 300)
    rows = [
        (1, " ".join(["so", "then", *long[:32]])),  # 25 of 52 windows
        (2, " ".join(edited)),  # 15 of 31 windows
        (3, " ".join([*made(5, 400), *long[20:33], *made(5, 500)])),  # 13 words
        (4, " ".join([*made(5, 400), *long[20:32], *made(5, 500)])),  # 12 words
        (5, " ".join([*few, *made(9, 600), *long[:8]])),
        (6, " ".join(str(x) for x in range(100, 113))),  # numbers only
    ]
    items = [(1, " ".join(long)), (2, " ".join(median)), (3, " ".join(str(x) for x in range(59)))]
    got = found(spark, items, rows)
    assert got == {(1, 1): (25, 52), (2, 2): (15, 31), (3, 1): (6, 52)}
