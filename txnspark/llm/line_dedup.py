"""Line dedup with a log-template tree.

Words with a digit are variable fields. The tree has fixed depth: a line goes to the leaf of its word count and its
first four words. In a leaf a word is constant at its place if two distinct lines hold it there, else variable; a line with at least three quarters constant words is generalised to the template of its constants, any other line is its
own template. A template found in at least two documents recurs: its lines stay in the document with the smallest id
and are dropped from all others.

All decisions are made on 64-bit hashes; only lines in leaves of several documents and several distinct lines show their
words, each distinct line once.
Counts are combined before every shuffle, so a line that a third of all documents share costs one row per task.

Defined results: lines are parts between line feeds; lines of fewer than five words carry no template and stay; NULL text
stays NULL, an empty one empty; a document that loses all lines stays with the empty text; rows of one id are one
document, NULL being an id after all others, but each text loses its own lines only; a table without rows gives none; other columns pass through, of any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.llm.common import body_hash, free_name, meet, stored, worker_code

worker_code(__name__)

DEPTH = 4
MIN_WORDS = 5
MIN_LINES = 2  # distinct lines of a leaf that make a word constant
CONSTANT_PERCENT = 75
FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")


def _line(raw: bytes) -> list[bytes]:
    """Masked words of a line; none if it has too few."""
    found = raw.split()  # at ASCII white space
    if len(found) < MIN_WORDS:
        return []
    return [FIELD if DIGIT.search(w) else w for w in found] if DIGIT.search(raw) else found


def _number(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - 2**63


def _leaf(words: list[bytes]) -> int:
    return _number([*words[:DEPTH], b"%d" % len(words)])


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, body, text) to (doc, body, no, leaf, line_h) of the lines with enough words."""
    for batch in batches:
        rows, owner = [], []
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            for no, raw in enumerate((text.as_py() or b"").split(b"\n")):
                if found := _line(raw):
                    rows.append((no, _leaf(found), _number(found)))
                    owner.append(i)
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(pa.array(owner, pa.int64())) for c in ("doc", "body")], pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
            names=["doc", "body", "no", "leaf", "line_h"],
        )


def _show_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text) to (leaf, line_h, line): the masked lines, each once per batch."""
    for batch in batches:
        seen = {}
        for text in batch.column("text").cast(pa.binary()):
            for raw in (text.as_py() or b"").split(b"\n"):
                if found := _line(raw):
                    seen.setdefault((_leaf(found), _number(found)), b" ".join(found))
        leaf, line_h = zip(*seen, strict=True) if seen else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf, pa.int64()), pa.array(line_h, pa.int64()), pa.array(list(seen.values()), pa.binary()).cast(pa.string())],
            names=["leaf", "line_h", "line"],
        )


def _several() -> Column:
    """Whether a group has several documents: smallest and largest id tell, NULL being an id of its own."""
    return (F.min("doc") != F.max("doc")) | (F.max(F.col("doc").isNull()) & F.max("doc").isNotNull())


def templates(docs: DataFrame, found: DataFrame, text: str) -> DataFrame:
    """(leaf, line_h, template) of the lines that are generalised; every other line is its own template."""
    leaves = found.groupBy("leaf").agg(_several().alias("docs"), (F.min("line_h") != F.max("line_h")).alias("lines"))
    shared = stored(leaves.where("docs and lines").select("leaf"), "shared-leaves")
    shown = docs.select(F.col(text).alias("text")).mapInArrow(_show_lines, "leaf bigint, line_h bigint, line string")
    distinct = meet(shown, shared, "leaf", "left_semi").groupBy("leaf", "line_h").agg(F.first("line").alias("line"))
    distinct = stored(distinct, "distinct-lines")
    placed = distinct.select("leaf", "line_h", F.posexplode(F.split("line", " ")).alias("pos", "word"))
    placed = placed.where(F.col("word") != FIELD.decode()).withColumn("word", F.xxhash64("word"))
    fixed = placed.groupBy("leaf", "pos", "word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_LINES)
    fixed = stored(fixed.select("leaf", "pos", "word"), "constant-words")
    general = placed.join(fixed, ["leaf", "pos", "word"], "left_semi").groupBy("leaf", "line_h").agg(
        F.count("*").alias("n_fixed"), F.xxhash64(F.sort_array(F.collect_list(F.struct("pos", "word")))).alias("general")
    )
    enough = 100 * F.col("n_fixed") >= CONSTANT_PERCENT * F.size(F.split("line", " "))
    named = distinct.join(general, ["leaf", "line_h"]).where(enough)
    return named.select("leaf", "line_h", F.xxhash64("leaf", "general").alias("template"))


def dropped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, body, nos): numbers of the lines that go, per text that loses any."""
    source = docs.select(F.col(key).alias("doc"), body_hash(F.col(text)).alias("body"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    found = stored(source.mapInArrow(_hash_lines, f"doc {kind}, body bigint, no int, leaf bigint, line_h bigint"), "line-hashes")
    names = stored(templates(docs, found, text), "templates")
    keyed = meet(found, names, ["leaf", "line_h"], "left").select("doc", "body", "no", F.coalesce("template", "line_h").alias("template"))
    recurring = keyed.groupBy("template").agg(F.min("doc").alias("first"), _several().alias("several")).where("several")
    recurring = stored(recurring.select("template", "first"), "recurring-templates")
    gone = meet(keyed, recurring, "template").where(~F.col("doc").eqNullSafe(F.col("first")))
    return gone.groupBy("doc", "body").agg(F.collect_set("no").alias("nos"))


def drop_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """The rows of ``docs`` without the lines that go; the same columns. ``count`` names a column with the text's length."""
    gone_key, gone_body, nos = free_name(docs, "gone_key"), free_name(docs, "gone_body"), free_name(docs, "nos")
    gone = stored(dropped(docs, key, text).toDF(gone_key, gone_body, nos), "dropped-lines")
    same = F.col(key).eqNullSafe(F.col(gone_key)) & (body_hash(F.col(text)) == F.col(gone_body))
    joined = docs.join(gone.hint("merge"), same, "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~F.array_contains(F.col(nos), i)), "\n")
    changed = F.col(nos).isNotNull() & F.col(text).isNotNull()
    new = F.when(changed, kept).otherwise(F.col(text))
    out = []
    for field in docs.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name == text:
            column = new
        elif field.name == count:
            column = F.when(changed, F.length(kept).cast(field.dataType)).otherwise(column)
        out.append(column.alias(field.name))
    return joined.select(*out)


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_chars before (NULL for NULL) and the text that stays."""
    kept = drop_repeated(docs.select(F.col(key), F.col(text), F.length(text).cast("bigint").alias("chars_before")), key, text)
    return kept.select(key, "chars_before", F.length(text).cast("bigint").alias("chars_after"), text)
