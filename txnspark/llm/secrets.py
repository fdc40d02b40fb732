"""Secret scans: patterns of known secrets, and strings that look random to character Markov models.

Three patterns give the base spans. Their matches are the labelled samples of random strings; all other tokens of the
texts, and identifiers made of them, are the samples of ordinary strings. Two first-order Markov models of single
characters are counted from the samples by one aggregate of at most 66 x 66 rows; a candidate string of at least 16
characters whose log-likelihood ratio per character exceeds a threshold is a further span (kind ``random``). Strings held
out from the counts set the threshold by the share of false positives that is allowed.

Spark's functions return matches but no places: the pieces between matches (``split``) and the matches
(``regexp_extract_all``) alternate, so running sums of their lengths are the places, in code points.

Defined results: NULL and empty texts have no spans; a table without rows gives none and a model without counts, which adds nothing;
a table without any base match has random strings of the prior model, all characters alike (add-one smoothing of no
counts), and one without ordinary strings has them so; repeated rows and equal matches are scanned each; texts are scanned whole, the
places of n matches taking about n times the square root of n steps; other columns are not used by ``scan``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark.llm.common import body_hash, let, stored

# The patterns of the base kinds, in listed order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]

# Candidates and samples: maximal runs of these characters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
CANDIDATE = r"[A-Za-z0-9+/_=]{16,}"
# The last character class stands for the start of a string.
CODES = len(ALPHABET) + 1
THRESHOLD = 0.1  # nats per character


def running_sums(values: Column) -> Column:
    """Sum of the values before each one. In blocks of about the square root of their number, since appending to an array
    copies it: the sums of the blocks first, then those inside each block."""
    none = F.array().cast("array<int>")

    def plain(v: Column, start: Column) -> Column:
        def step(done: Column, x: Column) -> Column:
            return F.struct((done["at"] + x).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out"))

        return F.aggregate(v, F.struct(start.alias("at"), none.alias("out")), step, lambda done: done["out"])

    def blocked(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int")
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / width).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(v, b * width + 1, width))

        def placed(found: Column) -> Column:
            totals = F.transform(found, lambda x: F.aggregate(x, F.lit(0), lambda n, y: n + y))
            return F.flatten(F.zip_with(found, plain(totals, F.lit(0)), plain))

        return let(blocks, placed)

    return F.when(F.size(values) == 0, none).when(F.size(values) <= 64, plain(values, F.lit(0))).otherwise(blocked(values))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches."""
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
        steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("g"), F.length(v).alias("n"), v.alias("v")))
        return let(
            steps,
            lambda st: F.zip_with(
                st,
                running_sums(F.transform(st, lambda x: x["g"] + x["n"])),
                lambda x, at: F.struct((at + x["g"]).alias("start"), (at + x["g"] + x["n"]).alias("end"), x["v"].alias("value")),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, nothing).otherwise(placed(found)),
    )


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value) of the three patterns, by start, then kind as listed (0, 1, 2)."""

    def of(kind: int, pattern: str, accept=None) -> Column:
        found = matches(text, pattern)
        if accept:
            found = F.filter(found, accept)
        return F.transform(
            found,
            lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["value"].alias("value")),
        )

    # A failing assignment still uses up its text, so the length of its value is tested after the search. Runs of the
    # other two kinds are maximal, so a minimum in the pattern finds the same.
    long_value = lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= 12
    return F.sort_array(F.concat(of(0, ASSIGN, long_value), of(1, ACCESS), of(2, HEX)))


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _pairs(value: Column) -> Column:
    """Transitions of a string as codes before * CODES + after; code 0 stands for the start and foreign characters."""
    return let(
        _codes(value),
        lambda k: F.transform(k, lambda c, i: F.when(i == 0, F.lit(0)).otherwise(F.get(k, i - 1)) * CODES + c),
    )


def _ratio(value: Column, table: Column) -> Column:
    """Log-likelihood ratio per character."""
    total = F.aggregate(_pairs(value), F.lit(0.0), lambda acc, p: acc + F.get(table, p))
    return total / F.length(value)


SAMPLE_DOCUMENTS = 4000
FALSE_POSITIVES = 0.005  # share of the held-out ordinary strings that may pass the threshold
MISSED = 0.05  # share of the held-out random strings that may fall below the middle
HELD_OUT = 4  # one in so many labelled strings sets the threshold and is not counted
SHORTEST = 8  # characters of an ordinary string that sets the threshold
_TOKEN = r"[A-Za-z0-9+/_=]{4,}"


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of each transition, and the ratio per character from which a string counts as random."""

    ratios: tuple[float, ...]
    threshold: float
    recall: float | None = None  # share of the held-out random strings that reach it


def _ordinary(tokens: Column) -> Column:
    """Ordinary strings of a text: its tokens, and identifiers made of them in the usual spellings, since a text of plain
    words shows few capitals and separators: upper case, capitalised, three in a row joined by each separator and in
    camel case, with a number; and rows of one sign."""
    # Words, cut where a token has other signs.
    words = F.filter(F.flatten(F.transform(tokens, lambda t: F.split(t, "[^A-Za-z]+"))), lambda w: F.length(w) >= 2)

    def made(w: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: (i % 3 == 1) & (i + 2 <= F.size(w)))
        triples = F.transform(starts, lambda i: F.slice(w, i, 3))
        upper = F.transform(triples, lambda t: F.transform(t, lambda x: F.upper(x)))
        camel = F.transform(triples, lambda t: F.array_join(F.transform(t, lambda x: F.initcap(x)), ""))

        def joined_by(sign: str, parts: Column) -> Column:
            return F.transform(parts, lambda t: F.array_join(t, sign))

        joined = [joined_by(sign, parts) for parts in (triples, upper) for sign in ("_", "/", "")]
        numbered = F.transform(triples, lambda t: F.concat(F.array_join(t, "_"), F.lit("_"), F.length(t[0]).cast("string")))
        return F.flatten(F.array(*joined, camel, numbered))

    rows = F.transform(F.slice(tokens, 1, 2), lambda t: F.repeat(F.left(t, F.lit(1)), F.lit(16)))
    signs = F.array(*[F.lit(c * 16) for c in "=+/_"])
    return F.concat(tokens, F.transform(words, lambda w: F.upper(w)), F.transform(words, lambda w: F.initcap(w)), let(words, made), rows, signs)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCUMENTS) -> Model | None:
    """Models of random and of ordinary strings, add-one smoothed, and their threshold; None without any sample.

    The labelled strings come from at most ``sample`` documents with a base match and as many without, those with the smallest hash
    of their key, so rare secrets are found and the bound does not depend on the input. Random strings are the values of
    base matches, ordinary ones all other tokens and what identifiers are made of them. One in ``HELD_OUT`` strings, by
    hash, is not counted: the threshold is the ratio that a share of ``FALSE_POSITIVES`` of the ordinary ones reach, at
    least ``THRESHOLD``, or the middle between that and what all but a share of ``MISSED`` random ones reach, if higher. Counts of at most 2 x 67 x 67 transitions and one row of shares reach the driver.
    """
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    body = F.coalesce(F.col(text), F.lit(""))
    me = [order.alias("chosen"), body_hash(F.col(text)).alias("body")]
    keys = stored(docs.select(*me, (F.size(base_spans(body)) > 0).alias("labelled")).distinct(), "sample-keys")
    first = lambda rows: rows.select("chosen", "body").orderBy("chosen", "body").limit(sample)
    chosen = first(keys.where("labelled")).unionByName(first(keys.where("not labelled")))
    texts = docs.select(*me, body.alias("text")).join(F.broadcast(chosen), ["chosen", "body"])
    spans = texts.select("text", base_spans(F.col("text")).alias("spans"))
    secret = F.transform(
        "spans", lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"])
    )
    # Base matches of the other kinds inside an assignment's value are the same string.
    outside = F.aggregate("spans", F.col("text"), lambda t, s: F.replace(t, s["value"], F.lit(" ")))
    plain = _ordinary(F.regexp_extract_all(outside, F.lit(_TOKEN), F.lit(0)))
    samples = [F.struct(F.lit(1).alias("label"), secret.alias("v")), F.struct(F.lit(0).alias("label"), plain.alias("v"))]
    strings = spans.select(F.explode(F.array(*samples)).alias("s")).select("s.label", F.explode("s.v").alias("v"))
    strings = stored(strings.where(F.length("v") > 0).groupBy("label", "v").agg(F.count("*").alias("n")), "labelled-strings")
    held_out = F.pmod(F.xxhash64("v"), F.lit(HELD_OUT)) == 0
    pairs = strings.where(~held_out).select("label", "n", F.explode(_pairs(F.col("v"))).alias("pair"))
    counts = pairs.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    by = {(r["label"], r["pair"]): r["n"] for r in counts}
    rows = {(label, a): sum(by.get((label, a * CODES + b), 0) for b in range(CODES)) for label in (0, 1) for a in range(CODES)}
    if not by:
        return None

    def log_p(label: int, a: int, b: int) -> float:
        return math.log((by.get((label, a * CODES + b), 0) + 1) / (rows[label, a] + CODES))

    ratios = [log_p(1, a, b) - log_p(0, a, b) for a in range(CODES) for b in range(CODES)]
    judged = strings.where(held_out).select("label", "n", F.length("v").alias("length"), let(_table(ratios), lambda t: _ratio(F.col("v"), t)).alias("ratio"))
    long_enough = judged.where(F.col("length") >= SHORTEST)
    shares = long_enough.agg(
        F.percentile(F.when(F.col("label") == 0, F.col("ratio")), 1 - FALSE_POSITIVES).alias("plain"),
        F.percentile(F.when(F.col("label") == 1, F.col("ratio")), MISSED).alias("random"),
    ).first()
    threshold = max(THRESHOLD, shares["plain"] or 0.0)
    if shares["random"] is not None:
        threshold = max(threshold, (threshold + shares["random"]) / 2)
    recall = long_enough.where("label = 1").agg(F.avg((F.col("ratio") > threshold).cast("double")).alias("r")).first()["r"]
    return Model(tuple(ratios), threshold, recall)


def _table(ratios: Sequence[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")


def scan(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``spans``, an array of (start, kind, end, value) by start, then kind (index into ``KINDS``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    if model is None:
        return docs.select(F.col(key).alias(key), base_spans(body).alias("spans"))
    def added(base: Column) -> Column:
        found = let(
            _table(model.ratios),
            lambda t: F.filter(
                matches(body, CANDIDATE),
                lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
                & (_ratio(m["value"], t) > model.threshold),
            ),
        )
        new = F.transform(
            found,
            lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end"), m["value"].alias("value")),
        )
        return F.sort_array(F.concat(base, new))

    return docs.select(F.col(key).alias(key), let(base_spans(body), added).alias("spans"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
