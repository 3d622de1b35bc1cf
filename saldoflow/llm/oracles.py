"""DuckDB SQL for the corpus queries, written from the definitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT r, doc_id, array_to_string(ws[i:i + 4], ' ') AS t
  FROM (SELECT r, doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id),
links AS (
  SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.t = b.t AND a.r <> b.r
    JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r
  GROUP BY a.r, b.r HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), reach(a, b) AS (
  SELECT r, r FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n ON n.r = d.r JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b
GROUP BY d.r, d.doc_id
"""

WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), q AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS holder FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN holder IS NOT NULL AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder IS NOT NULL AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM q
"""

LINE_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, d.doc_id, d.source, coalesce(d.text, '') AS t,
         regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents d
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, range(3) AS s(k) GROUP BY r
), lines AS (
  SELECT r, source, t, l,
         lower(regexp_replace(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), frequent AS (
  SELECT source, line FROM lines GROUP BY source, line HAVING count(DISTINCT t) > 20
), per_doc AS (
  SELECT x.r, count(*) - count(DISTINCT x.l) AS dup, sum(CASE WHEN f.line IS NOT NULL THEN x.n ELSE 0 END) AS gone
  FROM lines x LEFT JOIN frequent f ON f.source IS NOT DISTINCT FROM x.source AND f.line = x.line
  GROUP BY x.r
), measured AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(p.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(q.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(w) - coalesce(p.gone, 0) AS BIGINT) AS n_left_words
  FROM d LEFT JOIN per_doc p USING (r) LEFT JOIN repeats q USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT *, NOT base_failed AND 100 * n_left_words >= 30 * n_words AS kept FROM judged
"""


def mixing(weights: Mapping[str, float], seed: int) -> str:
    """Poisson counts by the closed form of the distribution; for means of up to 32 a piece."""
    named = " ".join(f"WHEN source = '{s}' THEN {w}::DOUBLE" for s, w in weights.items())
    return f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, ''))) AS size, CASE {named} ELSE 1.0::DOUBLE END AS weight
  FROM documents GROUP BY source
), totals AS (
  SELECT sum(size)::DOUBLE AS size, sum(CASE WHEN size > 0 THEN weight END) AS weight FROM sizes
), rates AS (
  SELECT s.source, CASE WHEN s.size > 0 THEN t.size * s.weight / (t.weight * s.size) ELSE 1.0 END AS rate
  FROM sizes s, totals t
), means AS (
  SELECT *, greatest(1, ceil(rate / 32))::INT AS pieces, rate / greatest(1, ceil(rate / 32)) AS mean FROM rates
), cdfs AS (
  SELECT source, pieces, list(c ORDER BY k) AS cdf FROM (
    SELECT source, pieces, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
    FROM (SELECT *, unnest(range(0, (mean + 12 * sqrt(mean) + 40)::INT + 1)) AS k FROM means)
  ) GROUP BY source, pieces
), drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, list_sum(list_transform(range(1, r.pieces + 1), lambda p: len(list_filter(r.cdf, lambda c:
    c <= (('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || p), 1, 13))::BIGINT + 0.5) / 4503599627370496.0))))::INT AS n_copies
  FROM documents d JOIN cdfs r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT *, ('0x' || substr(md5('{seed}:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || "copy"), 1, 13))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1))::INT AS "copy" FROM drawn)
"""


def license_scan(templates: Sequence, base: Mapping[str, str]) -> str:
    """Starts of templates from every pair of a word and an equal word of a key phrase."""
    from saldoflow.llm.license_scan import key_words

    def rows(values: list[tuple]) -> str:
        return "VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in values)

    words = rows([(t, i, w) for t, x in enumerate(templates) for i, w in enumerate(x.text.split())])
    needed = rows([(t, i, w) for t, x in enumerate(templates) for i, w in key_words(x)])
    labels = rows([(t, x.label, len(x.text.split()), len(key_words(x))) for t, x in enumerate(templates)])
    phrases = rows([(n, label, len(p.split()), k, w) for n, (p, label) in enumerate(base.items()) for k, w in enumerate(p.split())])
    return rf"""
WITH tw(t, i, w) AS ({words}), need(t, i, w) AS ({needed}), lab(t, label, n, must) AS ({labels}),
phrase(p, label, n, k, w) AS ({phrases}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), f AS (SELECT r, unnest(range(0, len(ws))) AS at, unnest(ws) AS w FROM d),
sure AS (
  SELECT f.r, need.t, f.at - need.i AS s FROM f JOIN need ON need.w = f.w JOIN lab ON lab.t = need.t
  GROUP BY ALL HAVING count(*) = any_value(lab.must)
), share AS (
  SELECT s.r, lab.label, count(*) / any_value(lab.n)::DOUBLE AS share
  FROM sure s JOIN tw ON tw.t = s.t JOIN f ON f.r = s.r AND f.at = s.s + tw.i AND f.w = tw.w JOIN lab ON lab.t = s.t
  GROUP BY s.r, s.t, s.s, lab.label
), place AS (
  SELECT f.r, p.label, f.at - p.k AS s FROM f JOIN phrase p ON p.w = f.w
  GROUP BY f.r, p.p, p.label, p.n, f.at - p.k HAVING count(*) = p.n
), b AS (
  SELECT r, count(*) AS n, min(s) AS lo, max(s) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY r
), m AS (SELECT r, max(share) AS score FROM share GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM place UNION ALL SELECT r, label FROM share) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(m.score, 0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r) LEFT JOIN l USING (r)
"""


def _crc_table() -> str:
    """The crc32 of four bits, for reading a text by its hexadecimal digits."""
    values = list(range(16))
    for _ in range(4):
        values = [(v >> 1) ^ (0xEDB88320 if v & 1 else 0) for v in values]
    return f"[{', '.join(f'{v}::BIGINT' for v in values)}]"


def crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8; the low half of a byte comes first."""
    digits = f"list_transform(range(1, 1 + octet_length(encode({text})) * 2), lambda i: {{}})"
    digit = f"instr('0123456789ABCDEF', hex(encode({text}))[i + CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END]) - 1"
    step = f"xor(c >> 4, {_crc_table()}[1 + (xor(c, d) & 15)])"
    return f"xor(list_reduce({digits.format(digit)}, lambda c, d: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def turn_repair() -> str:
    """The dynamic program row by row; a state is its cost in nine digits and its audit, so the least text counts."""

    def add(state: str, cost: str, letter: str) -> str:
        return f"lpad((CAST({state}[1:9] AS INT) + {cost})::VARCHAR, 9, '0') || {state}[10:] || {letter}"

    def inserts(v: list[str]) -> list[str]:
        w2 = f"least({v[2]}, {add(v[0], '3', chr(39) + 'I' + chr(39))}, {add(v[1], '3', chr(39) + 'I' + chr(39))}, {add(v[3], '3', chr(39) + 'I' + chr(39))})"
        return [v[0], v[1], w2, v[3]]

    last = add("w2", "3", "'I'")
    opened = ", ".join(f"{x} AS w{i}" for i, x in enumerate(inserts(["v0", "v1", "v2", "v3"])))
    gone = [add(f"w{i}", "4", "'D'") for i in range(4)]
    kept = {r: f"cut + CASE WHEN y = '{r}' THEN 0 ELSE 3 END" for r in "ua"}
    letter = {r: f"CASE WHEN y = '{r}' THEN 'K' ELSE 'R' END" for r in "ua"}
    to_u = ", ".join(add(w, kept["u"], letter["u"]) for w in ("w0", "w1", "z3"))
    gone[3] = add("z3", "4", "'D'")
    return rf"""
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS g, conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), hashed AS (SELECT *, {crc32('k')} % 20 AS h FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS nth FROM hashed WHERE h <> 0)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again,
         CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS initial,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
), faulty AS (
  SELECT *, CASE WHEN t = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN t[-1] NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM ordered
), sequences AS (
  SELECT conv_id, list(CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' ELSE initial END ORDER BY i) AS ys,
         list(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END ORDER BY i) AS cuts,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), steps AS (
  SELECT conv_id, ys, cuts, 0 AS i, '000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3
  FROM sequences
  UNION ALL
  SELECT conv_id, ys, cuts, i + 1, {gone[0]},
         least({gone[1]}, CASE WHEN y = 's' THEN {add('w0', 'cut', "'K'")} END),
         least({gone[2]}, CASE WHEN y <> 'x' THEN least({to_u}) END),
         least({gone[3]}, CASE WHEN y <> 'x' THEN {add('w2', kept['a'], letter['a'])} END)
  FROM (SELECT *, least(w3, {last}) AS z3, ys[i + 1] AS y, cuts[i + 1] AS cut FROM (SELECT *, {opened} FROM steps WHERE i < len(ys)))
), ended AS (
  SELECT conv_id, least(w0, w3, {last}) AS best FROM (SELECT *, {opened} FROM steps WHERE i = len(ys))
), letters AS (
  SELECT conv_id, p, best[10:][p] AS letter FROM (SELECT *, unnest(range(1, len(best) - 8)) AS p FROM ended)
), counted AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) AS n
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING)
), texts AS (
  SELECT c.conv_id, string_agg(CASE WHEN c.letter = 'K' THEN f.role WHEN (c.o - c.n % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN c.letter = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY c.p) AS t
  FROM counted c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.i AND c.letter <> 'I'
  WHERE c.letter <> 'D' GROUP BY c.conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(CAST(best[1:9] AS BIGINT), 0) AS cost,
       coalesce(best[10:], '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN sequences s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM a.conv_id
"""


#: Near words by the words that lack one code point, with its place for replacements.
SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
  GROUP BY doc_id, w
), hashed AS (
  SELECT w, n, {crc32('k')} AS h FROM (SELECT w, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS k FROM runs)
), words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), lacking AS (
  SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM lacking a JOIN lacking b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word FROM lacking l JOIN words w ON w.word = l.rest
  UNION SELECT w.word, l.word FROM lacking l JOIN words w ON w.word = l.rest
), near AS (
  SELECT a, count(*) AS n_near, arg_min(b, (-w.n, b)) AS best, max(w.n) AS most FROM pairs JOIN words w ON w.word = b GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN best END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN near ON a = word
), roots AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT r.word, f.form FROM roots r JOIN formed f ON f.word = r.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM formed f JOIN roots r ON r.word = f.word JOIN formed e ON e.word = r.at AND e.form IS NULL
"""
