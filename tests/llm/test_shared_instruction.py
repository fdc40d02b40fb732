"""An instruction that many items begin with contaminates nothing by itself."""

from __future__ import annotations

import random

from txnspark.llm import decontaminate

INSTRUCTION = "please read the following question with care and choose the one answer that fits best before you go on"


def test_common_instruction_is_no_quotation(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    own = {i: " ".join(word() for _ in range(24)) for i in range(40)}
    items = [(i, f"{INSTRUCTION} {text}") for i, text in own.items()] + [(100, INSTRUCTION)]
    prose = lambda: " ".join(word() for _ in range(40))
    docs = [(i, f"{prose()} {INSTRUCTION} {prose()}") for i in range(20)]
    docs += [(50, f"{prose()} {INSTRUCTION} {own[3]} {prose()}"), (51, f"{prose()} {own[4]} {prose()}")]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    # The instruction alone is an item too, one that has nothing else.
    assert got == {(50, 3), (51, 4)} | {(i, 100) for i in [*range(20), 50]}
