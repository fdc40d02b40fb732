"""HTML extraction by minimum cut.

A page becomes its text blocks in page order. A naive Bayes classifier over shape features (share of link text, length, end of
sentence, element) and the zone that the page's own markup claims give each block two costs, of calling it content
and of calling it boilerplate: the capacities of its edges to the two terminals. Neighbouring blocks, and
blocks of one parent element, are tied by smoothness edges that weaken with their distance in the tree. The minimum cut
labels all blocks at once; the content blocks are the main text.

The classifier is trained on blocks whose landmark elements say what they are, from at most ``SAMPLE_PAGES`` pages (those
with the smallest hash of their key); counts of a few dozen features reach the driver. Pages are independent: no shuffle.

Defined results: NULL and empty pages give the empty text; broken markup, cut tags and unclosed elements end where the
page ends; a table without rows gives none and a classifier of its prior counts; repeated rows are pages of their own;
extra columns are not used. A block without any evidence either way counts as content.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.llm.common import worker_code

worker_code(__name__)

SAMPLE_PAGES = 2000
ZONE_WEIGHT = 6.0  # log odds of what landmark elements and class names claim
ADJACENT, PROXIMITY = 0.4, 1.2  # smoothness of neighbours in the page; of neighbours in the tree, over 1 + distance
ODDS_LIMIT = 4.0

# Element names of HTML by what they do here.
SKIPPED = set("head script style noscript template svg math iframe object canvas audio video select textarea button datalist".split())
# Elements whose content is plain text up to their literal end tag.
RAW = set("script style textarea title iframe xmp noembed noframes".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
# What may stand in a head; anything else ends it.
HEAD = set("html head base basefont bgsound link meta title style script noscript noframes template".split())
BOILERPLATE = set("nav footer aside form menu dialog".split())
CONTENT = {"article", "main"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
# Words of class, id and role names that mark page furniture.
FURNITURE = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notification paywall popup "
    "promo promoted promotion related replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "topbar widget widgets".split()
)
# Furniture in which an article element is not the main one.
ECHOES = set("comment comments discussion disqus related replies reply".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _claim(tag: str, attributes: str, above: str) -> str:
    """Zone of an element: ``content``, ``boiler``, ``echo`` (boilerplate whose articles do not count) or ``none``."""
    claimed = above
    if tag in BOILERPLATE or (tag == "header" and above != "content"):
        claimed = "echo"
    if attributes and tag not in ("html", "body"):
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and HIDDEN.search(value)):
                return "echo"
            if name in ("class", "id", "role") and tag != "main":
                parts = set(re.split(r"[^a-z]+", value.lower()))
                if parts & ECHOES:
                    return "echo"
                if parts & FURNITURE and tag != "article":
                    claimed = "boiler" if claimed != "echo" else claimed
    if tag in CONTENT and claimed != "echo":
        claimed = "content"
    return claimed


BODY = re.compile(r"<body\b", re.I)
FORM_END = re.compile(r"</form(?=[\s>])", re.I)
LANDMARK = re.compile(r"<(?:article|main)\b", re.I)


def _form(page: str, start: int) -> tuple[int, bool]:
    """End of the form that opens before ``start``, and whether it wraps the page: it holds an article or main element, or
    more than half of the body. Such a form claims nothing."""
    end = m.start() if (m := FORM_END.search(page, start)) else len(page)
    body = m.start() if (m := BODY.search(page, 0, start)) else 0
    return end, 2 * (end - start) > len(page) - body or bool(LANDMARK.search(page, start, end))


def blocks(page: str) -> list[tuple[str, str, tuple[int, ...], str, int]]:
    """Text blocks in page order: (text, element, path of element numbers, zone, characters inside links)."""
    out: list = []
    stack: list[tuple[str, int, str]] = []  # element, number, zone
    number, skip, link = 0, None, False
    in_head = False  # whether the skipped element stands in the head
    pos, form_end = 0, 0
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack[-1] if stack else ("", 0, "none")
                out.append((text, top[0], tuple(s[1] for s in stack), top[2], min(linked, len(text))))
            parts.clear()
        linked = 0

    while m := TOKEN.match(page, pos):
        pos = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if skip == "head" and (piece[0] != "<" or piece == "<") and piece.strip():
                skip = None  # text ends the head
            if skip is None and (piece[0] != "<" or piece == "<"):
                parts.append(piece)
                if link:
                    linked += len(piece.strip())
            continue
        tag, closing = tag.lower(), m[1]
        if skip is not None:
            if closing and tag == skip:
                skip, in_head = "head" if in_head else None, False
                continue
            if not closing and tag in RAW and not m[3].endswith("/"):
                if raw := RAW_END[tag].search(page, pos):
                    pos = raw.end()
                elif tag != "title":
                    pos = len(page)
                continue
            if skip != "head" or closing or tag in HEAD:
                if skip == "head" and not closing and tag in SKIPPED and tag != "head" and not m[3].endswith("/"):
                    skip, in_head = tag, True
                continue
            skip = None  # an element of the body ends the head
        if tag == "a":
            link = not closing
        if tag in INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            link = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        attributes = m[3]
        if attributes.endswith("/") and tag not in ("p", "div"):
            continue
        if tag in SKIPPED:
            if tag in RAW:
                pos = raw.end() if (raw := RAW_END[tag].search(page, pos)) else len(page)
            else:
                skip = tag
            continue
        while stack and stack[-1][0] in CLOSES.get(tag, ()):
            stack.pop()
        number += 1
        plain_form = False
        if tag == "form" and pos > form_end:  # forms do not nest
            form_end, plain_form = _form(page, pos)
        stack.append((tag, number, _claim("div" if plain_form else tag, attributes, stack[-1][2] if stack else "none")))
    flush()
    return out


def features(block) -> tuple[str, ...]:
    text, tag, _, _, linked = block
    n = text.count(" ") + 1
    share = linked / len(text)
    return (
        "links:" + ("none" if share == 0 else "few" if share < 0.3 else "many" if share < 0.8 else "all"),
        "words:" + ("1-2" if n < 3 else "3-7" if n < 8 else "8-20" if n < 21 else "21-60" if n < 61 else "more"),
        "ends:" + ("sentence" if text[-1] in ".!?\"'”»…" else "open"),
        "in:" + (tag if tag in ("p", "li", "td", "div", "section", "blockquote", "pre") else "heading" if re.fullmatch("h[1-6]", tag) else "other"),
    )


# Pseudo counts (content, boilerplate) that stand in where the sample says nothing.
PRIOR = {
    "links:none": (4, 2), "links:few": (3, 2), "links:many": (1, 3), "links:all": (1, 6),
    "words:1-2": (1, 4), "words:3-7": (1, 2), "words:8-20": (2, 2), "words:21-60": (4, 1), "words:more": (6, 1),
    "ends:sentence": (4, 2), "ends:open": (1, 2),
    "in:p": (4, 1), "in:heading": (2, 1), "in:blockquote": (3, 1), "in:pre": (3, 1), "in:li": (1, 2), "in:td": (1, 2),
    "in:div": (1, 2), "in:section": (1, 1), "in:other": (1, 1),
}


def odds_of(counts: dict[tuple[str, str], int]) -> dict[str, float]:
    """Log odds of content per feature from counts of (feature, zone)."""
    family = Counter()
    seen = {}
    for name, (good, bad) in PRIOR.items():
        seen[name] = (good + counts.get((name, "content"), 0), bad + counts.get((name, "boiler"), 0))
        kind = name.split(":")[0]
        family[kind, 0] += seen[name][0]
        family[kind, 1] += seen[name][1]
    return {
        name: math.log(good / family[name.split(":")[0], 0]) - math.log(bad / family[name.split(":")[0], 1])
        for name, (good, bad) in seen.items()
    }


def _edges(found: list) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in the page, and the last block before with the same parent element."""
    out, last = [], {}
    for i, block in enumerate(found):
        path = block[2]
        if i:
            before = found[i - 1][2]
            common = 0
            for a, b in zip(path, before):  # noqa: B905
                if a != b:
                    break
                common += 1
            distance = len(path) + len(before) - 2 * common
            out.append((i - 1, i, ADJACENT + PROXIMITY / (1 + distance)))
        parent = path[:-1]
        j = last.get(parent)
        if j is not None and j < i - 1:
            out.append((j, i, PROXIMITY / 3))
        last[parent] = i
    return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost: softplus(-odds) to call a block content, softplus(odds) to call it boilerplate,
    and the capacity of each edge between unlike blocks.

    A block whose own preference exceeds all its edges keeps it in a best labelling; fixing it moves its edges into the
    preferences of its neighbours. What stays undecided after that is solved by maximum flow.
    """
    n = len(odds)
    # Of the two terminal capacities only the difference matters: softplus(odds) - softplus(-odds) = odds.
    pull = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        near[i][j] = near[i].get(j, 0.0) + c
        near[j][i] = near[j].get(i, 0.0) + c
    label: list = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(pull[i]) > sum(near[i].values()) or label[i] is None and not near[i]:
            label[i] = pull[i] >= 0
            for j, c in near[i].items():
                pull[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        side = _source_side(rest, pull, near)
        for i in rest:
            label[i] = i in side
    return label


def _source_side(nodes: list[int], pull: list[float], near: list[dict[int, float]]) -> set[int]:
    """Maximum flow by shortest augmenting paths; nodes that cannot be cut off from the sink's side are not in the result."""
    left = {i: dict(near[i]) for i in nodes}
    supply = {i: max(pull[i], 0.0) for i in nodes}
    demand = {i: max(-pull[i], 0.0) for i in nodes}
    eps = 1e-12
    while True:
        came = {i: None for i in nodes if supply[i] > eps}
        queue, end = deque(came), None
        while queue:
            i = queue.popleft()
            if demand[i] > eps:
                end = i
                break
            for j, c in left[i].items():
                if c > eps and j not in came:
                    came[j] = i
                    queue.append(j)
        if end is None:
            break
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        amount = min([supply[path[0]], demand[end], *[left[a][b] for a, b in zip(path, path[1:])]])  # noqa: B905
        supply[path[0]] -= amount
        demand[end] -= amount
        for a, b in zip(path, path[1:]):  # noqa: B905
            left[a][b] -= amount
            left[b][a] = left[b].get(a, 0.0) + amount
    # Content is everything that cannot reach an unmet demand.
    into = {i: [] for i in nodes}
    for i in nodes:
        for j, c in left[i].items():
            if c > eps:
                into[j].append(i)
    sink = {i for i in nodes if demand[i] > eps}
    queue = deque(sink)
    while queue:
        for j in into[queue.popleft()]:
            if j not in sink:
                sink.add(j)
                queue.append(j)
    return set(nodes) - sink


def main_text(page: str | None, odds: dict[str, float]) -> str:
    found = blocks(page or "")
    weights = []
    for block in found:
        shape = sum(odds[f] for f in features(block))
        claim = {"content": ZONE_WEIGHT, "none": 0.0}.get(block[3], -ZONE_WEIGHT)
        weights.append(min(max(shape, -ODDS_LIMIT), ODDS_LIMIT) + claim)
    keep = minimum_cut(weights, _edges(found))
    return " ".join(b[0] for b, k in zip(found, keep, strict=True) if k)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            for block in blocks(page or ""):
                if block[3] != "none":
                    label = "content" if block[3] == "content" else "boiler"
                    counts.update((f, label) for f in features(block))
    rows = [{"feature": f, "label": z, "n": n} for (f, z), n in counts.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("feature", pa.string()), ("label", pa.string()), ("n", pa.int64())]))


def train(pages: DataFrame, key: str = "page_id", page: str = "html", sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Log odds per feature from at most ``sample`` pages."""
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    chosen = pages.select(order.alias("chosen")).distinct().orderBy("chosen").limit(sample)
    rows = pages.select(order.alias("chosen"), F.col(page).alias("html")).join(F.broadcast(chosen), "chosen").select("html")
    counts = rows.mapInArrow(_count, "feature string, label string, n bigint").groupBy("feature", "label").agg(F.sum("n").alias("n"))
    return odds_of({(r["feature"], r["label"]): r["n"] for r in counts.collect()})


def extract(pages: DataFrame, odds: dict[str, float], key: str = "page_id", page: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per row: key, the columns of ``keep``, ``text`` and ``n_chars`` (code points)."""
    names = [key, *keep]
    source = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(page).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, odds) for p in batch.column("html").to_pylist()]
            columns = [batch.column(i) for i in range(len(names))] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(names))] + ["text", "n_chars"])

    fields = [T.StructField(f"c{i}", pages.schema[c].dataType) for i, c in enumerate(names)]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return source.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "text", "n_chars")
