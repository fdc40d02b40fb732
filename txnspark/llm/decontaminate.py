"""Benchmark decontamination by canonical templates.

A text becomes a sequence of canonical words: lower case without outer punctuation, numbers, units after a number and
names (capitalised inside a sentence) replaced by typed placeholders that remember the replaced word. Windows of
eight canonical words are joined by hash to the windows of all benchmark items. A question whose numbers and names were
changed still meets its item; the slots then decide: within one item and one place of the document a value of the item
must always stand for the same value of the document and the other way round. A document may hold an item several times
with other values, so the slots are judged on the whole text, on each alignment (place in the text minus place in the
item), and on alignments at most ``NEAR`` words apart, and one consistent judgement is enough.

A document is contaminated by an item if consistent windows are at least ``COVERAGE`` of the item's windows; or if they
cover at least ``COVERAGE`` of the item's words and ``RUN`` words or more, as in a copy with a few edited words, each of
which breaks eight windows; or if they cover ``RUN`` words in a row, in place, however long the item is. Windows with
fewer than half ordinary words say too little and are not used, unless an item has no others; such an item is only
found by the share of its windows. Windows that more than ``SHARED_BY`` items hold, as of a common instruction, are left
out in the same way. The windows of the
benchmark are counted first: a small number is broadcast, of more, the windows of the documents meet them
in a shuffle join.

Defined results: NULL and empty texts have no windows; an item of fewer than eight words is one window of that length; an
item without words contaminates nothing; repeated items count as one per id; texts that share an id, NULL included, are
judged and dropped each by itself, and an id is listed with the most windows that one of them holds; empty tables give no
pairs; extra columns are not used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.llm import template_windows
from txnspark.llm.common import body_hash, free_name, let, meet, stored, words

WINDOW = 8
COVERAGE = 0.5
RUN = 13  # words in a row that are a quotation in themselves
SHARED_BY = 5  # items that may hold a window before it counts as common to all
NEAR = 4  # words put in or left out between two pieces of one occurrence

# Units that follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs ms % $ usd eur dollars dollar euros euro cents cent "
    "meters meter metres metre kilometers kilometres miles mile feet foot inches inch grams gram kilograms kilogram pounds pound "
    "liters liter litres litre seconds second minutes minute hours hour days day weeks week months month years year percent"
).split()


_MARK = "\u0001"  # stands before a name until all words are lower case
_SPACE = r"\x20\x09-\x0D"


def _marked(text: Column) -> Column:
    """Lower-case words without outer punctuation, names with the mark before them."""
    # A capital inside a sentence follows a space that does not follow the end of a sentence.
    named = F.regexp_replace(F.coalesce(text, F.lit("")), r" (?<![.!?:;] )(\p{Lu}\p{Ll})", f" {_MARK}$1")
    bare = F.regexp_replace(named, rf"[^\p{{L}}\p{{M}}\p{{N}}{_SPACE}$%.,:/{_MARK}]+", "")
    return F.lower(F.regexp_replace(bare, r"[.,:/]+(?![0-9])", ""))


def _placeholders(m: Column) -> Column:
    """Canonical words of a marked text."""
    t = F.regexp_replace(m, rf"{_MARK}[^{_SPACE}]+", "<name>")
    num = F.regexp_replace(t, rf"(?<![^{_SPACE}])[$]?[0-9][0-9.,:/]*%?(?![^{_SPACE}])", "<num>")
    units = "|".join(u.replace("$", "[$]") for u in UNITS)
    num = F.regexp_replace(num, rf"<num> (?:{units})(?![^{_SPACE}])", "<num> <unit>")
    return words(F.when(m.rlike("[0-9]"), num).otherwise(t))


def template(text: Column) -> Column:
    """Struct of two arrays of equal length: ``t`` canonical words, ``v`` the plain lower-case words."""
    return let(_marked(text), lambda m: F.struct(_placeholders(m).alias("t"), words(F.regexp_replace(m, _MARK, "")).alias("v")))


def _hashes(t: Column, length: int) -> Column:
    """Hash of each window of canonical words, from the hashes of the words."""

    def of(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - (length - 1))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, length)))
        return F.when(F.size(h) >= length, windows).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(t, lambda x: F.xxhash64(x)), of)


def _slots(t: Column, v: Column, start: Column, length: int) -> Column:
    """(type, value) of the placeholders of one window, in order; NULL for ordinary words."""
    return F.zip_with(
        F.slice(t, start, length), F.slice(v, start, length),
        lambda a, b: F.when(a.startswith("<") & a.endswith(">"), F.concat_ws(" ", a, b)),
    )


def index(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, part, length, h, p, slots, some, n_windows, n_covered): the windows of all items; ``part`` tells texts of one
    id apart, ``some`` whether the item has windows with enough ordinary words, ``n_covered`` counts the words in windows."""
    parts = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).distinct()
    parts = parts.select("item", F.xxhash64("text").alias("part"), template(F.col("text")).alias("c"))
    t, v = F.col("c.t"), F.col("c.v")
    out = None
    for length in range(1, WINDOW + 1):
        fits = F.size(t) >= WINDOW if length == WINDOW else F.size(t) == length
        windows = parts.where(fits).select(
            "item", "part", F.lit(length).alias("length"),
            F.explode(F.transform(_hashes(t, length), lambda h, i: F.struct(
                h.alias("h"), i.alias("p"), _slots(t, v, i + 1, length).alias("slots")))).alias("w"),
        ).select("item", "part", "length", "w.*")
        out = windows if out is None else out.unionByName(windows)
    # Half of a window must be ordinary words, unless the item has no such window.
    plain = F.size(F.filter("slots", lambda s: s.isNull())) * 2 >= F.col("length")
    by_item = Window.partitionBy("item", "part")
    ranked = out.withColumn("plain", plain).withColumn("some", F.max("plain").over(by_item)).where(F.col("plain") | ~F.col("some"))
    # What many items begin with says nothing about one of them, unless an item has nothing else.
    holders = ranked.select("h", "item", "part").distinct().groupBy("h").agg(F.count("*").alias("holders"))
    own = ranked.join(holders, "h").withColumn("own", F.col("holders") <= SHARED_BY).drop("holders")
    ranked = own.withColumn("any_own", F.max("own").over(by_item)).where(F.col("own") | ~F.col("any_own")).drop("own", "any_own")
    gap = F.lead("p").over(by_item.orderBy("p")) - F.col("p")
    ranked = ranked.withColumn("adds", F.least(F.coalesce(gap, "length"), "length"))
    ranked = ranked.withColumn("n_windows", F.count("*").over(by_item)).withColumn("n_covered", F.sum("adds").over(by_item))
    return ranked.drop("plain", "adds")


def _occurrences(met: DataFrame) -> DataFrame:
    """The matched windows once per group in which their slots are judged: (kind, at) names the whole text, an alignment
    or a run of near alignments."""
    ids = ["doc", "body", "item", "part"]
    along = Window.partitionBy(*ids).orderBy("shift")
    shifted = met.withColumn("shift", F.col("q") - F.col("p"))
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(along) > NEAR, F.lit(True))
    opened = shifted.withColumn("opens", F.when(apart, F.col("shift")))
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    near = opened.withColumn("run", F.last("opens", ignorenulls=True).over(so_far)).drop("opens")
    kinds = [F.struct(F.lit(k).alias("kind"), at.alias("at")) for k, at in enumerate((F.lit(0), F.col("shift"), F.col("run")))]
    return near.withColumn("group", F.explode(F.array(*kinds))).select(*met.columns, "shift", "group.*")


def _named_windows(items: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(h, item, part, p, some, n_windows): the windows of the index under the hashes of the first pass."""
    parts = benchmark.select(F.col(item).alias("item"), F.xxhash64(text).alias("part"), F.col(text).alias("text")).distinct()
    kind = benchmark.schema[item].dataType.simpleString()
    read = template_windows.all_windows(UNITS, WINDOW)
    named = parts.mapInArrow(read, f"item {kind}, part bigint, length int, p int, h bigint")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("item", "part", "length", "p")]
    return items.alias("a").join(named.alias("b"), same).select("b.h", "a.item", "a.part", "a.p", "a.some", "a.n_windows")


BITS = 26  # at most two to so many bits say which hashes the benchmark has


def _bits(named: DataFrame) -> np.ndarray:
    """One bit per leading bits of a hash, about sixteen times as many as there are hashes, eight megabytes at most. A
    large benchmark sets most of them, and more windows go on to the join, which decides."""
    size = min(BITS, max(10, (16 * named.count()).bit_length()))
    places = named.select(F.shiftrightunsigned("h", 64 - size).alias("bit"))
    one = F.expr("shiftleft(1, CAST(bit % 8 AS INT))")
    words = places.groupBy(F.shiftright("bit", 3).alias("byte")).agg(F.bit_or(one).alias("bits")).collect()
    out = np.zeros(1 << (size - 3), np.uint8)
    for row in words:
        out[row["byte"]] = row["bits"]
    return out


def _found(docs: DataFrame, benchmark: DataFrame, key: str, text: str, coverage: float) -> DataFrame:
    """(doc, body, item, n_windows, item_windows): pairs of text and item part with enough consistent windows."""
    items = stored(index(benchmark), "benchmark-windows")
    lengths = [r["length"] for r in items.select("length").distinct().collect()]  # at most eight values
    source = docs.select(F.col(key).alias("doc"), body_hash(F.col(text)).alias("body"), F.col(text).alias("text"))
    by_hash = stored(_named_windows(items, benchmark), "named-windows")
    kind = docs.schema[key].dataType.simpleString()
    find = template_windows.found_windows(UNITS, lengths or [WINDOW], _bits(by_hash))
    found = source.mapInArrow(find, f"doc {kind}, body bigint, h bigint")
    hits = meet(found, by_hash, "h", "inner")
    # What covers RUN words has two windows that far apart.
    spread = F.first("some") & (F.max("p") - F.min("p") + WINDOW >= RUN)
    enough = (F.countDistinct("p") >= coverage * F.first("n_windows")) | spread
    pairs = stored(hits.groupBy("doc", "body", "item", "part").agg(enough.alias("ok")).where("ok").drop("ok"), "candidate-pairs")
    # The few candidates again, now with places and slots.
    chosen = pairs.select(F.col("doc").alias("chosen"), F.col("body").alias("chosen_body")).distinct()
    chosen = stored(chosen, "candidates")
    again = meet(source, chosen, F.col("doc").eqNullSafe(F.col("chosen")) & (F.col("body") == F.col("chosen_body")), "left_semi")
    c = again.select("doc", "body", template(F.col("text")).alias("c"))
    t, v = F.col("c.t"), F.col("c.v")

    def windows(n: int) -> Column:
        return F.transform(_hashes(t, n), lambda h, i: F.struct(h.alias("h"), i.alias("q"), _slots(t, v, i + 1, n).alias("said")))

    placed = c.select("doc", "body", F.explode(F.flatten(F.array(*map(windows, lengths or [WINDOW])))).alias("w")).select("doc", "body", "w.*")
    same_pair = [F.col("doc").eqNullSafe(F.col("doc_")), F.col("item").eqNullSafe(F.col("item_")), F.col("part") == F.col("part_"), F.col("body") == F.col("body_")]
    met = meet(placed, items, "h", "inner").join(pairs.toDF("doc_", "body_", "item_", "part_"), same_pair, "left_semi")
    met = stored(_occurrences(met.select("doc", "body", "item", "part", "length", "p", "q", "slots", "said", "some", "n_windows", "n_covered")), "matched-windows")
    ids = ["doc", "body", "item", "part", "kind", "at"]
    slots = met.select(*ids, "p", "q", F.explode(F.filter(
        F.arrays_zip("slots", "said"), lambda z: z["slots"].isNotNull())).alias("z"))
    slots = slots.select(*ids, "p", "q", F.col("z.slots").alias("asked"), F.col("z.said").alias("said"))
    counts = slots.groupBy(*ids, "asked", "said").agg(F.count("*").alias("n"))
    best = counts
    for given, taken in (("asked", "said"), ("said", "asked")):
        commonest = F.max_by(taken, F.struct("n", taken)).over(Window.partitionBy(*ids, given))
        best = best.withColumn(f"{given}_ok", F.col(taken) == commonest)
    wrong = best.where(~(F.col("asked_ok") & F.col("said_ok"))).select(*ids, "asked", "said")
    eq = lambda a, b, names: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    torn = slots.alias("s").join(wrong.alias("w"), eq("s", "w", [*ids, "asked", "said"]), "left_semi").select(*ids, "p", "q").distinct()
    whole = met.alias("m").join(torn.alias("t"), eq("m", "t", [*ids, "p", "q"]), "left_anti")
    # Windows of one alignment that touch are words in a row.
    row = Window.partitionBy(*ids, "shift").orderBy("p")
    behind = F.col("p") - F.lag("p").over(row)
    broken = F.coalesce(behind > F.col("length"), F.lit(True)).cast("int")
    rows = whole.withColumn("broken", broken).withColumn("nth", F.sum("broken").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.groupBy(*ids, "shift", "nth").agg(
        F.collect_set("p").alias("ps"), (F.max("p") - F.min("p") + F.first("length")).alias("in_row"),
        *[F.first(c).alias(c) for c in ("length", "some", "n_windows", "n_covered")],
    )
    judged = rows.groupBy(*ids).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ps")))).alias("ps"), F.max("in_row").alias("in_row"),
        *[F.first(c).alias(c) for c in ("length", "some", "n_windows", "n_covered")],
    )
    adds = F.transform("ps", lambda p, i: F.least(F.coalesce(F.get("ps", i + 1) - p, "length"), "length"))
    covered = F.aggregate(adds, F.lit(0), lambda n, x: n + x)
    edited = (covered >= RUN) & (covered >= coverage * F.col("n_covered"))
    whole_enough = F.size("ps") >= coverage * F.col("n_windows")
    return (
        judged.where(whole_enough | (F.col("some") & (edited | (F.col("in_row") >= RUN))))
        .select("doc", "body", "item", F.size("ps").cast("bigint").alias("n_windows"), F.col("n_windows").alias("item_windows"))
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """(key, item_id, n_windows, item_windows): pairs of document and item with enough consistent windows."""
    found = _found(docs, benchmark, key, text, coverage).groupBy(F.col("doc").alias(key), F.col("item").alias("item_id"))
    return found.agg(F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that hold a benchmark item; the same columns."""
    name, body = free_name(docs, "contaminated"), free_name(docs, "contaminated_body")
    found = _found(docs, benchmark, key, text, COVERAGE)
    ids = stored(found.select(F.col("doc").alias(name), F.col("body").alias(body)).distinct(), "contaminated")
    return meet(docs, ids, F.col(key).eqNullSafe(F.col(name)) & (body_hash(F.col(text)) == F.col(body)), "left_anti")
