"""SQL for the queries that SQL can express, as DuckDB runs it."""

from __future__ import annotations

from riskloom.llm import license_scan as ls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(column: str) -> str:
    """A-Z lower-cased, nothing else."""
    return f"translate({column}, '{UPPER}', '{LOWER}')"


OP1 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id,
         regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i
        FROM texts WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), reach AS (
  SELECT doc_id, doc_id AS node FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.node = links.a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(node) AS component_id,
       doc_id = min(node) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP3 = rf"""
WITH lines AS (
  SELECT r, doc_id, i, l[i] AS line,
         {lowered(r"regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key
  FROM (SELECT r, doc_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id,
                     string_split(coalesce(text, ''), chr(10)) AS l
              FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT r) >= 3
), judged AS (
  SELECT r, doc_id, i, line, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS dropped
  FROM lines LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

OP5 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes
  FROM pages
), firsts AS (
  SELECT html, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY html
)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (html)
"""

def _op6() -> str:
    """The scan with k-grams as text; templates and phrases are the operator's own."""
    templates = ", ".join(
        f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(ls.TEMPLATES)
    )
    phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in ls.PHRASES.items())
    return rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")},
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, w, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS gram
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS i FROM texts WHERE len(w) >= 3)
), templates AS (
  SELECT template, label, string_split(t, ' ') AS tw
  FROM (VALUES {templates}) AS x(template, label, t)
), t_grams AS (
  SELECT template, label, tw, place,
         tw[place + 1] || ' ' || tw[place + 2] || ' ' || tw[place + 3] AS gram
  FROM (SELECT *, unnest(range(0, len(tw) - 2)) AS place FROM templates)
), votes AS (
  SELECT doc_id, template, label, place, i, i - place AS diagonal, len(tw) AS t_size,
         list_sum(list_transform(range(0, len(tw)), lambda j:
           CASE WHEN i - place + j >= 0 AND w[i - place + j + 1] = tw[j + 1]
                THEN 1 ELSE 0 END)) AS equal
  FROM grams JOIN t_grams USING (gram)
), apart AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER one > {ls.GAP}, FALSE)::INT AS fresh
  FROM votes WINDOW one AS (PARTITION BY doc_id, template ORDER BY diagonal, i)
), spans AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal, i) AS span
  FROM apart
), merged AS (
  SELECT doc_id, template, label, any_value(t_size) AS t_size,
         min(i) AS first, max(i) + 2 AS last,
         count(DISTINCT place) / (any_value(t_size) - 2) AS covered,
         count(DISTINCT place) / (any_value(t_size) - 2) >= {ls.COVERED}
           AND max(i) + 3 - min(i) <= greatest(
             ceil(any_value(t_size) * CAST({ls.LONGER} AS DOUBLE)), any_value(t_size) + {ls.GAP})
           AND max(equal) >= any_value(t_size) * {ls.ALIGNED} AS verified
  FROM spans GROUP BY doc_id, template, label, span
), beaten AS (
  SELECT DISTINCT m.doc_id, m.template, m.first
  FROM merged m JOIN merged o ON o.doc_id = m.doc_id AND o.verified AND o.label <> m.label
   AND o.first <= m.last AND o.last >= m.first
   AND (o.covered, o.t_size, -o.template) > (m.covered, m.t_size, -m.template)
), own AS (
  SELECT doc_id, max(covered) AS covered,
         coalesce(list(label) FILTER (WHERE verified AND beaten.doc_id IS NULL), []) AS labels
  FROM merged LEFT JOIN beaten USING (doc_id, template, first) GROUP BY doc_id
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         list(label) AS labels
  FROM grams JOIN (VALUES {phrases}) AS p(phrase, label)
    ON array_to_string(w[i + 1 : i + len(string_split(phrase, ' '))], ' ') = phrase
  GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(
         list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE)
            ELSE least(coalesce(covered, 0), 1) END AS score
FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""


OP6 = _op6()

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def _op10(
    margins: tuple[str, ...], sweeps: int, power: float, least: float, seed: str
) -> str:
    """The sweeps written out one after the other: plain ones, then bounded ones."""

    def marks(mark: str) -> str:
        return f"(length(t) - length(replace(t, {mark}, '')))"

    parts = [
        f"""described AS (
  SELECT doc_id, source, lang,
         CASE WHEN {marks("'|'")} >= 5 THEN 'table' WHEN {marks("'!'")} >= 5 THEN 'loud'
              WHEN {marks("'#'")} + {marks("'%'")} + {marks("'$'")} >= 5 THEN 'symbols'
              WHEN regexp_matches(t, '[0-9]') THEN 'numbers'
              WHEN {marks("chr(10)")} >= 5 THEN 'long form' ELSE 'short form' END AS topic,
         len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        """c0 AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens) AS w, 1.0 / sum(sum(tokens)) OVER () AS f
  FROM described GROUP BY ALL)""",
    ]
    for m in margins:
        parts.append(
            f"""want_{m} AS MATERIALIZED (
  SELECT {m}, have, have_p / sum(have_p) OVER () AS want
  FROM (SELECT {m}, sum(w) AS have, pow(sum(w), {power}) AS have_p FROM c0 GROUP BY {m})
  WHERE have > 0)"""
        )
    n = 0
    for _ in range(sweeps):
        for m in margins:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (
  SELECT x.source, x.lang, x.topic, w,
         f * CASE WHEN x.have > 0 THEN coalesce(want, 0) / x.have ELSE 1 END AS f
  FROM (SELECT *, sum(w * f) OVER (PARTITION BY {m}) AS have FROM c{n}) x
  LEFT JOIN want_{m} y ON x.{m} IS NOT DISTINCT FROM y.{m})"""
            )
            n += 1
    # Values that have too few tokens are kept whole, the others share what is left of the size.
    for m in margins:
        parts.append(
            f"""reach_{m} AS MATERIALIZED (
  SELECT {m}, least(have, want * (
           SELECT arg_min(each, ratio) FROM (
             SELECT ({least} * total - held) / rest AS each, ratio, rest FROM (
               SELECT have / want AS ratio,
                      coalesce(sum(have) OVER before, 0) AS held,
                      1 - coalesce(sum(want) OVER before, 0) AS rest, sum(have) OVER () AS total
               FROM want_{m}
               WINDOW before AS (ORDER BY have / want, {m}
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
           WHERE rest > 0 AND ratio > each)) AS want
  FROM want_{m})"""
        )
    parts.append(
        f"""b0 AS MATERIALIZED (
  SELECT source, lang, topic, w,
         f * {least} * sum(w) FILTER (WHERE f > 0) OVER () / sum(w * f) OVER () AS f
  FROM c{n})"""
    )
    k = 0
    for _ in range(sweeps):
        for m in margins:
            parts.append(
                f"""b{k + 1} AS MATERIALIZED (
  SELECT x.source, x.lang, x.topic, w,
         f * CASE WHEN free > 0 AND want > held THEN (want - held) / free
                  WHEN want < held THEN want / all_of ELSE 1 END AS f
  FROM (SELECT *, sum(CASE WHEN f >= 1 THEN w ELSE 0 END) OVER (PARTITION BY {m}) AS held,
               sum(CASE WHEN f >= 1 THEN 0 ELSE w * f END) OVER (PARTITION BY {m}) AS free,
               sum(w * f) OVER (PARTITION BY {m}) AS all_of
        FROM b{k}) x
  LEFT JOIN reach_{m} y ON x.{m} IS NOT DISTINCT FROM y.{m})"""
            )
            k += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, d.source, d.lang, d.topic, tokens, p AS probability,
       ('0x' || substr(md5('{seed}/' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
         / 4294967296.0 < p AS kept
FROM described d JOIN (
  SELECT c.source, c.lang, c.topic,
         round(least(CASE WHEN plain THEN c.f / top ELSE b.f END, 1.0), 6) AS p
  FROM (SELECT *, max(f) FILTER (WHERE w > 0) OVER () AS top,
               sum(w * f) OVER () / max(f) FILTER (WHERE w > 0) OVER ()
                 >= {least} * sum(w) FILTER (WHERE f > 0) OVER () AS plain FROM c{n}) c
  JOIN b{k} b ON b.source IS NOT DISTINCT FROM c.source AND b.lang IS NOT DISTINCT FROM c.lang
   AND b.topic = c.topic
) c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang
   AND d.topic = c.topic
"""


OP10 = _op10(("source", "lang", "topic"), 30, 0.8, 0.4, "mix-1")

# Unsigned crc32 of a list of bytes, given crc_table.tab.
CRC_TABLE = """
crc_steps AS (
  SELECT range AS i, 0 AS step, range AS x FROM range(256)
  UNION ALL
  SELECT i, step + 1, xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)
  FROM crc_steps WHERE step < 8
), crc_table AS (
  SELECT list(x ORDER BY i) AS tab FROM crc_steps WHERE step = 8
)"""


def crc32(codes: str) -> str:
    first = f"list_prepend(4294967295::BIGINT, {codes})"
    return f"xor(4294967295, list_reduce({first}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"


def _op11(every: int, most: int) -> str:
    digits = "list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)"
    return f"""
WITH RECURSIVE {CRC_TABLE}, turns AS (
  SELECT conv_id, coalesce(text, '') AS text,
         sha256(to_json([coalesce(role, ''), coalesce(text, '')])) AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(t ORDER BY p) AS t, list(length(text) ORDER BY p) AS n
  FROM turns GROUP BY conv_id
), heads AS (
  SELECT own.*, conv_id - conv_id % {every} AS base, {crc32(digits)} % {most} AS h
  FROM own, crc_table
), rebuilt AS (
  SELECT heads.conv_id,
         list_concat(coalesce(b.t, [])[1 : h], heads.t[h + 1 :]) AS t,
         list_concat(coalesce(b.n, [])[1 : h], heads.n[h + 1 :]) AS n
  FROM heads LEFT JOIN own b ON b.conv_id = base
), steps AS (
  SELECT conv_id, d AS depth, len(t) = d AS ends, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS chars,
         sha256(array_to_string(t[1 : d], ',')) AS path,
         CASE WHEN d > 0 THEN sha256(array_to_string(t[1 : d - 1], ',')) END AS parent
  FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, any_value(parent) AS parent,
         count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                         FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY path, depth
), children AS (
  SELECT parent AS path, depth - 1 AS depth, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children
  FROM nodes LEFT JOIN children USING (path, depth)
), totals AS (
  SELECT a.path, a.depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         CAST(sum((n_convs - 1) * c.chars) AS BIGINT) AS saved_tokens
  FROM counted c JOIN steps a ON a.conv_id = c.conv_id AND a.depth <= c.depth
  GROUP BY ALL
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
       saved_tokens, c.ends_sha256
FROM counted c JOIN totals USING (path, depth)
LEFT JOIN nodes p ON p.path = c.parent AND p.depth = c.depth - 1
"""


OP11 = _op11(100, 6)


def _op12(length: int) -> str:
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS x,
         strlen(coalesce(text, '')) AS n
  FROM documents
), windows AS (
  SELECT r, p, md5(array_slice(x, p + 1, p + {length})) AS w
  FROM (SELECT r, x, unnest(range(0, n - {length - 1})) AS p FROM texts WHERE n >= {length})
), repeated AS (
  SELECT r, p FROM windows JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)
), apart AS (
  SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > {length}, TRUE) AS fresh
  FROM repeated
), spans AS (
  SELECT r, min(p) AS a, max(p) + {length} AS b FROM (
    SELECT r, p, sum(fresh::INT) OVER (PARTITION BY r ORDER BY p) AS span FROM apart)
  GROUP BY r, span
), edges AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT r, max(b), NULL FROM spans GROUP BY r
), cut AS (
  SELECT r, count(*) - 1 AS n_spans,
         unhex(string_agg(hex(array_slice(x, a + 1, coalesce(b, n))), '' ORDER BY a, b NULLS LAST))
           AS kept
  FROM edges JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, n AS n_bytes, n - octet_length(coalesce(kept, x)) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, x)) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""


OP12 = _op12(400)


def _op13(min_chars: int, least: int, ratio: int) -> str:
    letters = "[a-z\u00c0-\u00ff]"
    codes = """flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                            ELSE [(192 + unicode(c) // 64)::BIGINT, 128 + unicode(c) % 64] END))"""
    return f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({lowered("coalesce(text, '')")},
                              '{letters}+')) AS w FROM documents)
  WHERE length(w) >= {min_chars} GROUP BY ALL
), marked AS (
  SELECT w, n, {crc32(codes)} AS h FROM runs, crc_table
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN w[1 : h % length(w)] || w[h % length(w) + 2 :]
                   ELSE w END AS word FROM marked)
  WHERE length(word) >= {min_chars} GROUP BY word HAVING sum(n) >= {least}
), cut AS (
  SELECT word, i, word[1 : i - 1] || word[i + 1 :] AS rest, length(word) AS size
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y USING (size, i, rest)
  WHERE x.word <> y.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
), near AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS best_n,
         arg_min(b, (-n, b)) AS best
  FROM pairs JOIN words ON words.word = b GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= {ratio} * n THEN best END AS form,
         CASE WHEN best_n >= {ratio} * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS node, form AS next FROM formed
  UNION ALL
  SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON chain.next = formed.word
)
SELECT word, form, node AS root, n, n_near, form_n
FROM formed JOIN chain USING (word) WHERE next IS NULL
"""


OP13 = _op13(7, 2, 10)

STATEMENTS = {
    "op1_minhash_near_dedup": OP1,
    "op3_line_dedup": OP3,
    "op5_warc": OP5,
    "op6_license_scan": OP6,
    "op9_topk_search": OP9,
    "op10_mixing": OP10,
    "op11_prefix_trie": OP11,
    "op12_suffix_dedup": OP12,
    "op13_spelling_variants": OP13,
}
