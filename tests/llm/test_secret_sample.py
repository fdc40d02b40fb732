"""The sample of labelled strings holds the rare documents that have them."""

from __future__ import annotations

import random

from txnspark.llm import secrets

NAMES = "connection timeout handler request response buffer session manager account setting value".split()
CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def test_rare_labels_are_in_the_sample(spark):
    rng = random.Random(3)
    rand = lambda n: "".join(rng.choice(CHARS) for _ in range(n))
    # Of all ids, 575 has the largest hash.
    rows = [(i, " ".join(rng.sample(NAMES, 5)) + (f" token = {rand(400)}" if i == 575 else "")) for i in range(1000)]
    rows += [(None, " ".join(rng.sample(NAMES, 5))) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    uniform = secrets.train(docs.where("doc_id <> 575 or doc_id is null"), sample=300)
    model = secrets.train(docs, sample=300)
    assert uniform is not None and model is not None and model != uniform
    held = spark.createDataFrame([(1, f"see {rand(28)} here"), (2, "see connection_timeout_handler here")], "doc_id bigint, text string")
    for m in (model, uniform):
        got = {r.doc_id: len(r.spans) for r in secrets.scan(held, m).collect()}
        assert got == {1: 1, 2: 0}
    assert secrets.train(docs.limit(0)) is None


def test_held_out_strings_and_identifiers(spark):
    """Recall and false positives on strings the models have not seen, and the spellings of ordinary names."""
    rng = random.Random(8)
    rand = lambda n: "".join(rng.choice(CHARS) for _ in range(n))
    common = "the path example long very page some name max pool size default camel case this a identifier value list open close read".split() + NAMES
    word = lambda: rng.choice(common)
    prose = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    rows = [(i, prose(40) + (f' api_key = "{rand(32)}"' if i % 4 == 0 else "") + " " + prose(40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = secrets.train(docs)
    assert model.recall >= 0.9 and model.threshold >= secrets.THRESHOLD
    plain = ["MAX_CONNECTION_POOL_SIZE_DEFAULT", "https/example/path/to/some/page", "ThisIsAVeryLongCamelCaseIdentifierName", "=" * 16, "_" * 40]
    plain += ["_".join(word() for _ in range(6)) for _ in range(150)] + ["".join(word().capitalize() for _ in range(7)) for _ in range(150)]
    plain = [p for p in plain if len(p) >= 16]
    hidden = [rand(32) for _ in range(200)]
    texts = [(i, f"see {s} here") for i, s in enumerate(plain + hidden)]
    got = [len(r.spans) for r in secrets.scan(spark.createDataFrame(texts, docs.schema), model).orderBy("doc_id").collect()]
    wrong, right = got[: len(plain)], got[len(plain) :]
    assert sum(right) >= 0.9 * len(hidden)
    assert not any(wrong[:5]), list(zip(plain, wrong))[:5]
    assert sum(wrong) <= max(1, 0.01 * len(plain))


def test_places_of_many_matches(spark):
    """Places are sums of lengths, whatever the number of matches."""
    pieces = [f"{'é' * (i % 5)} {i:016x}" for i in range(3000)]
    text = "".join(pieces)
    row = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = secrets.scan(row, None).first().spans
    import re

    assert [(s["start"], s["end"]) for s in spans if s["kind"] == 2] == [m.span() for m in re.finditer("[0-9a-f]{16,}", text)]
