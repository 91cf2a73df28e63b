"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from harvestline.llm import collocations, embeddings, licenses, line_dedup, sharding

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- op1: the same order, with running sums over the whole table ---------------

# CRC-32 has no function in DuckDB: its table of 256 steps is made by its rule.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_concat([i::UBIGINT], list_transform(range(8), lambda k: k::UBIGINT)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END
    )) AS t
)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(
        list_concat([4294967295::UBIGINT], list_transform(
            regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::UBIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])
    ), 4294967295::UBIGINT)::BIGINT"""


ORACLE["op1_sharding"] = f"""
WITH {_CRC_TABLE},
rows AS (
    SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT + {sharding.ROW_BYTES} AS size,
        ('0x' || md5(coalesce(text, ''))[1:15])::BIGINT AS key
    FROM documents
),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)::BIGINT - size AS before,
        sum(size) OVER ()::BIGINT AS total
    FROM rows
),
sharded AS (
    SELECT *, least((2 * before + size) * {sharding.SHARDS} // (2 * total), {sharding.SHARDS - 1})::INTEGER AS shard
    FROM placed
)
SELECT doc_id, size,
    {_crc32("text")} AS text_crc32,
    'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST) - 1 AS slot,
    NULL::INTEGER AS grown_shard
FROM sharded, crc_table
"""


# --- op2: prefixes in the exact order of rarity, every pair verified ----------------

_PART, _WHOLE = line_dedup.PART, line_dedup.WHOLE

ORACLE["op2_line_dedup"] = f"""
WITH split AS (
    SELECT doc_id, unnest(range(len(l)))::INTEGER AS pos, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
),
worded AS (
    SELECT doc_id, pos, list_sort(list_distinct(list_filter(
        regexp_split_to_array(lower(line), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS words
    FROM split
),
sets AS (
    SELECT words, min(row(doc_id, pos)) AS first, row_number() OVER () AS s, len(words) AS n
    FROM worded WHERE len(words) > 0 GROUP BY words
),
each AS (SELECT s, n, first, unnest(words) AS w FROM sets),
ordered AS (
    SELECT s, n, first, w, row_number() OVER (PARTITION BY s ORDER BY df, w) AS i
    FROM each JOIN (SELECT w, count(*) AS df FROM each GROUP BY w) USING (w)
),
prefix AS (SELECT * FROM ordered WHERE i <= n - (n * {_PART} + {_WHOLE - 1}) // {_WHOLE} + 1),
pairs AS (
    SELECT DISTINCT a.s, b.s AS t FROM prefix a JOIN prefix b ON a.w = b.w AND b.first < a.first
    WHERE least(a.n, b.n) * {_WHOLE} >= greatest(a.n, b.n) * {_PART}
),
shared AS (
    SELECT p.s, a.n, b.n AS m, len(list_intersect(a.words, b.words)) AS k
    FROM pairs p JOIN sets a ON a.s = p.s JOIN sets b ON b.s = p.t
),
matched AS (SELECT DISTINCT s FROM shared WHERE k * {_WHOLE} >= (n + m - k) * {_PART}),
fate AS (
    SELECT w.doc_id, w.pos, row(w.doc_id, w.pos) > f.first OR f.s IN (FROM matched) AS gone
    FROM worded w JOIN sets f ON f.words = w.words
),
joined AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT coalesce(gone, false)) AS text,
        count(*)::INTEGER AS n_lines, count(*) FILTER (WHERE gone)::INTEGER AS n_removed
    FROM split LEFT JOIN fate USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(j.text, '') END AS text,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN joined j USING (doc_id)
"""


# --- op7: the same canonical form, with the functions of the other engine ------


def _canonical(text: str) -> str:
    made = f"regexp_replace(lower({text}), '\\r\\n?', chr(10), 'g')"
    made = f"regexp_replace({made}, {_text(licenses.COPYRIGHT)}, '\\1', 'g')"
    made = f"regexp_replace({made}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    made = f"' ' || replace({made}, chr(10), ' ' || chr(10) || ' ') || ' '"
    for old, new in licenses.EQUIVALENT:
        made = f"replace({made}, ' {old} ', ' {new} ')"
    return made


_EVENED = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_KNOWN = ", ".join(f"({_text(name)}, {_text(body)})" for name, body in licenses.KNOWN)

ORACLE["op7_licenses"] = f"""
WITH known AS (
    SELECT sha256({_EVENED.format(_canonical("body"))}) AS digest, min(license) AS license
    FROM (VALUES {_KNOWN}) AS k(license, body) GROUP BY 1
),
canonical AS (
    SELECT doc_id, {_canonical("text")} AS body FROM documents WHERE text IS NOT NULL
),
lines AS (
    SELECT doc_id, string_split(body, chr(10)) AS bodies FROM canonical
),
units AS (
    SELECT doc_id, 'text' AS unit, -1 AS line, body FROM canonical
    UNION ALL
    SELECT doc_id, 'line', (unnest(range(len(bodies))))::INTEGER, unnest(bodies) FROM lines
),
digests AS (
    SELECT doc_id, unit, line, {_EVENED.format("body")} AS body FROM units
)
SELECT doc_id, unit, line, digest, license
FROM (SELECT *, sha256(body) AS digest FROM digests WHERE body <> '') JOIN known USING (digest)
"""


# --- op10: all pairs of equal labels, in double precision ------------------------

ORACLE["op10_embeddings"] = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v,
        label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good
    FROM embeddings
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM vectors a JOIN vectors b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND a.good AND b.good AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= {embeddings.THRESHOLD}
),
reach(vec_id, root) AS (
    SELECT vec_id, vec_id FROM vectors
    UNION
    SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id
),
roots AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)
"""


# --- op11: every prefix as a list of turns, every subtree by the prefixes of its nodes ----

ORACLE["op11_prefix_trie"] = f"""
WITH {_CRC_TABLE},
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, n, {_crc32("conv_id::VARCHAR")} % 4 AS h, conv_id - conv_id % 20 AS family
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1), crc_table
),
rebuilt AS (
    SELECT c.conv_id, i AS place, role, text
    FROM convs c JOIN turns t ON t.conv_id = c.family AND i <= h
    UNION ALL
    SELECT c.conv_id, i - c.h + least(c.h, coalesce(p.n, 0)), role, text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND i > c.h
        LEFT JOIN convs p ON p.conv_id = c.family
),
paths AS (
    SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY place) FILTER (WHERE place IS NOT NULL), []) AS path
    FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY 1
),
members AS (
    SELECT conv_id, path, d AS depth, path[:d] AS node
    FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)
),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '') AS ends
    FROM members GROUP BY 1, 2
),
children AS (SELECT node[:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (
    SELECT m.*, coalesce(c.n, 0) AS n_children,
        CASE WHEN depth = 0 THEN 0 ELSE
            (n_convs - 1) * len(regexp_extract_all(m.node[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes m LEFT JOIN children c ON c.node = m.node
),
sums AS (
    SELECT node[:d] AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM own) GROUP BY 1
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
    s.saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN sums s ON s.node = o.node
    LEFT JOIN nodes p ON o.depth > 0 AND p.node = o.node[:o.depth - 1]
"""


# --- op12: all n-grams spelled out and counted --------------------------------------

ORACLE["op12_collocations"] = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
),
worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
),
grams AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i
        FROM (SELECT *, unnest(range(1, {collocations.LONGEST + 1})) AS m FROM worded))
),
counts AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY 1, 2, 3),
often AS (SELECT * FROM counts WHERE a >= {collocations.LEAST}),
sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY 1),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM often WHERE m > 1),
cuts AS (
    SELECT c.lang, c.phrase, c.a, c.m, k, f.a AS l, g.a AS r, s.n,
        (1000::HUGEINT * c.a * s.n) // (f.a::HUGEINT * g.a) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
        JOIN often f ON f.lang = c.lang AND f.phrase = array_to_string(w[:k], ' ')
        JOIN often g ON g.lang = c.lang AND g.phrase = array_to_string(w[k + 1:], ' ')
        JOIN sizes s ON s.lang = c.lang
),
weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
whole AS (
    SELECT * FROM weakest c WHERE NOT EXISTS (
        SELECT 1 FROM candidates q WHERE q.lang = c.lang AND q.m > c.m AND 100 * q.a >= 100 * c.a
            AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score::BIGINT AS score
FROM whole
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {collocations.TOP}
"""
