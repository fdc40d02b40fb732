"""Oracle SQL of the registered queries, written from the meaning of each result."""

from __future__ import annotations

from txnspark.llm import quality_rules as Q

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _count(pattern: str) -> str:
    return f"length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '{pattern}', '', 'g'))"


def _quality_rules() -> str:
    # The rules again as text: (bad if, good if).
    rules = {
        "shape": ("n_words < 20", "n_words >= 40 AND word_chars BETWEEN 3 * n_words AND 10 * n_words"),
        "symbols": ("10 * n_symbols > n_words", "false"),
        "symbol_share": ("100 * n_symbols > 3 * word_chars", "false"),
        "dup_lines": ("2 * n_dup_lines > n_lines", "false"),
        "repeats": ("100 * n_repeat_words > 25 * n_words", "false"),
        "capitals": ("10 * n_upper > 3 * word_chars", "false"),
        "shouts": ("5 * n_shouts > n_words", "false"),
    }
    names = list(rules)
    odds = f"ln({Q.BALANCE} / (1 - {Q.BALANCE}))" + "".join(f" + v.{n} * ln(e.{n} / (1 - e.{n}))" for n in names)
    posterior = f"1 / (1 + exp(-({odds})))"
    steps = ["e0 AS MATERIALIZED (SELECT " + ", ".join(f"{Q.START_ACCURACY}::DOUBLE AS {n}" for n in names) + ")"]
    low, high = Q.ACCURACY_RANGE
    for i in range(Q.ITERATIONS):
        estimates = []
        for n in names:
            right = f"sum(n * CASE v.{n} WHEN 1 THEN q WHEN -1 THEN 1 - q END) / sum(n) FILTER (v.{n} <> 0)"
            estimates.append(f"coalesce(round(least(greatest({right}, {low}), {high}), 12), any_value(e.{n})) AS {n}")
        steps.append(
            f"e{i + 1} AS MATERIALIZED (SELECT {', '.join(estimates)} FROM e{i} e LEFT JOIN "
            f"(SELECT v.*, {posterior} AS q FROM patterns v, e{i} e) v ON true)"
        )
    cases = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS {n}" for n, (bad, good) in rules.items())
    return f"""
WITH parts AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    {_count('[#*$%&|<>]')} AS n_symbols, {_count('[A-Z]')} AS n_upper, {_count('!')} AS n_shouts FROM documents),
windows AS (
  SELECT r, p, array_to_string(w[p:p + {Q.WINDOW - 1}], ' ') AS t
  FROM (SELECT r, w, unnest(range(1, len(w) - {Q.WINDOW - 2})) AS p FROM parts)),
again AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, t) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p + i) AS n FROM again, range({Q.WINDOW}) x(i) GROUP BY r),
counts AS MATERIALIZED (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, n_upper::BIGINT AS n_upper, n_shouts::BIGINT AS n_shouts
  FROM parts LEFT JOIN covered USING (r)),
cast_votes AS MATERIALIZED (SELECT *, {cases} FROM counts),
patterns AS MATERIALIZED (SELECT {', '.join(names)}, count(*) AS n FROM cast_votes GROUP BY ALL),
{', '.join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_shouts, base_failed, good_probability,
  NOT base_failed AND good_probability >= {Q.THRESHOLD} AS kept
FROM (SELECT v.*, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  round({posterior}, 6) AS good_probability FROM cast_votes v, e{Q.ITERATIONS} e)
"""


QUALITY_RULES = _quality_rules()

SOURCE_MIXING = f"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::HUGEINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS total
  FROM sources),
-- Water level: a source is open if the level that its own cap would need holds more words than there are.
levels AS (
  SELECT a.source, a.source_size, a.weight, a.cap, a.total,
    sum(least(b.cap * a.weight, a.cap * b.weight)) <= a.total * a.weight AS capped
  FROM weighed a, weighed b GROUP BY a.source, a.source_size, a.weight, a.cap, a.total),
rated AS (
  SELECT *, (any_value(total) OVER () - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE AS open_words,
    (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE AS open_weight FROM levels),
goals AS (
  SELECT source, source_size, weight, CASE WHEN capped THEN cap::DOUBLE ELSE open_words / open_weight * weight END AS target FROM rated),
placed AS (
  SELECT s.*, g.source_size, g.weight, g.target, coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, CASE WHEN size > 0 THEN least(greatest(ceil((target - before::DOUBLE - size / 2.0::DOUBLE) / source_size::DOUBLE), 0), 3) ELSE 0 END::BIGINT AS copies,
    (before::DOUBLE + size / 2.0::DOUBLE) / target AS share FROM placed)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (copies * size)::BIGINT AS taken,
  CASE WHEN copies > 0 THEN round(CASE weight
    WHEN 1 THEN (sqrt(2.25 - 2 * share) - 1.5) / -1 WHEN 3 THEN (sqrt(0.25 + 2 * share) - 0.5) / 1 ELSE share END, 9) END AS first_position
FROM taken
"""

CHAT_FORMATTING = """
WITH turns AS MATERIALIZED (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
listed AS MATERIALIZED (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    list({'r': role, 't': text} ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS said FROM turns GROUP BY conv_id),
whole AS (SELECT said, any_value(n_turns) AS n_turns, min(conv_id) AS conv_id, count(*)::BIGINT AS n_copies FROM listed GROUP BY said),
starts AS (SELECT DISTINCT said[:k] AS said FROM (SELECT said, unnest(range(1, n_turns)) AS k FROM whole)),
kept AS (SELECT * FROM whole WHERE said NOT IN (SELECT said FROM starts))
SELECT conv_id, coalesce(floor(turn / 256)::BIGINT, 9007199254740992) AS part, n_turns, n_copies,
  string_agg('<|' || replace(replace(coalesce(role, ''), '<|', '<\\|'), '|>', '|\\>') || '|>' || chr(10)
    || replace(replace(coalesce(text, ''), '<|', '<\\|'), '|>', '|\\>') || '<|end|>' || chr(10), ''
    ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS rendered
FROM turns JOIN kept USING (conv_id) GROUP BY ALL
"""

LINE_DEDUP = r"""
WITH split AS MATERIALIZED (
  SELECT doc_id, r, no, raw, regexp_extract_all(regexp_replace(raw, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, r, unnest(parts) AS raw, generate_subscripts(parts, 1) AS no FROM (
    SELECT doc_id, row_number() OVER () AS r, string_split(text, chr(10)) AS parts FROM documents))),
lines AS (SELECT DISTINCT doc_id, w, len(w) AS n, w[:4] AS lead FROM split WHERE len(w) >= 5),
shared AS (
  SELECT DISTINCT n, lead, w FROM lines
  SEMI JOIN (SELECT n, lead FROM lines GROUP BY ALL HAVING count(DISTINCT doc_id) > 1 AND count(DISTINCT w) > 1) x USING (n, lead)),
words AS (SELECT n, lead, w, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM shared),
support AS (SELECT *, count(*) OVER (PARTITION BY n, lead, pos, word) AS support FROM words),
general AS (
  SELECT n, lead, w, list(CASE WHEN word <> '<*>' AND support >= 2 THEN word END ORDER BY pos) AS g,
    100 * count(*) FILTER (word <> '<*>' AND support >= 2) >= 75 * n AS enough FROM support GROUP BY n, lead, w),
templates AS (
  SELECT DISTINCT l.w, CASE WHEN enough THEN {'general': true, 't': g} ELSE {'general': false, 't': l.w} END AS template
  FROM lines l LEFT JOIN general g ON l.w = g.w),
recurring AS (
  SELECT template, min(doc_id) AS first FROM lines JOIN templates USING (w) GROUP BY template HAVING count(DISTINCT doc_id) > 1),
kept AS (
  SELECT r, string_agg(raw, chr(10) ORDER BY no) AS text FROM split s
  WHERE NOT EXISTS (SELECT 1 FROM templates t JOIN recurring u ON t.template = u.template WHERE t.w = s.w AND u.first <> s.doc_id)
  GROUP BY r)
SELECT doc_id, length(d.text)::BIGINT AS chars_before, length(CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END)::BIGINT AS chars_after,
  CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM (SELECT *, row_number() OVER () AS r FROM documents) d LEFT JOIN kept k USING (r)
"""

ZIP_WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
-- Five hex digits are four base32 digits.
coded AS (
  SELECT page_id, html, octet_length(encode(html))::BIGINT AS payload_bytes, array_to_string(list_transform(range(8), lambda g:
    array_to_string(list_transform(range(4), lambda k:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * g::INT, 5))::INT >> (15 - 5 * k::INT)) & 31), 1)), '')), '') AS payload_digest
  FROM payloads),
lasts AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM coded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last IS NULL OR page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM lasts
"""

RANKED_SEARCH = r"""
WITH said AS MATERIALIZED (
  SELECT doc_id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM (SELECT doc_id, text, row_number() OVER () AS r FROM documents)),
asked AS MATERIALIZED (
  SELECT item_id, q, t, count(*)::BIGINT AS k FROM (
    SELECT item_id, q, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT item_id, text, row_number() OVER () AS q FROM (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY ALL),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM said WHERE len(t) > 0),
held AS MATERIALIZED (
  SELECT doc_id, r, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, r, len(t)::BIGINT AS n, unnest(t) AS t FROM said)
  WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weighed AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w, n_docs, n_terms
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), whole),
scored AS (
  SELECT item_id, q, doc_id, r, sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weighed USING (t) JOIN held USING (t) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# crc32 of the decimal digits, bit by bit.
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), "
    "lambda a, d: list_reduce(list_prepend(xor(a, d), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
    "lambda b, z: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384::BIGINT) ELSE b >> 1 END)), 4294967295::BIGINT)"
)

PREFIX_TRIE = f"""
WITH said AS MATERIALIZED (
  SELECT conv_id AS c, turn, md5(length(role) || ':' || role || text) AS id, length(text)::BIGINT AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS MATERIALIZED (
  SELECT c, list({{'id': id, 'n': n}} ORDER BY turn NULLS FIRST, id) AS said, ({_CRC32}) % 6 AS h FROM said GROUP BY c),
rebuilt AS MATERIALIZED (
  SELECT convs.c, list_concat(coalesce(base.said, [])[:convs.h], convs.said[convs.h + 1:]) AS said
  FROM convs LEFT JOIN convs base ON base.c = convs.c - convs.c % 100),
steps AS MATERIALIZED (
  SELECT c, len(said)::BIGINT AS length, d, md5(array_to_string(list_transform(said[:d], lambda x: x.id), ',')) AS node,
    CASE WHEN d = 0 THEN 0 ELSE said[d].n END AS n
  FROM (SELECT c, said, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS MATERIALIZED (
  SELECT d, node, min(c) AS conv_id, count(*)::BIGINT AS n_convs, any_value(n) AS n,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (length = d), '')) AS ends_sha256
  FROM steps GROUP BY d, node),
-- A node and the nodes above it, itself included: the steps of its smallest member.
above AS MATERIALIZED (
  SELECT n.d, n.node, s.d AS up_d, s.node AS up, (n.n_convs - 1) * n.n AS saved
  FROM nodes n JOIN steps s ON s.c = n.conv_id AND s.d <= n.d),
children AS (SELECT up_d AS d, up AS node, count(*)::BIGINT AS n_children FROM above WHERE up_d = d - 1 GROUP BY ALL),
below AS (
  SELECT up_d AS d, up AS node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children IS NULL)::BIGINT AS n_leaves
  FROM above LEFT JOIN children USING (d, node) GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves,
  saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (d, node) LEFT JOIN children USING (d, node)
LEFT JOIN above a ON a.d = n.d AND a.node = n.node AND a.up_d = n.d - 1
LEFT JOIN nodes p ON p.d = a.up_d AND p.node = a.up
"""
