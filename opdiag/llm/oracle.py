"""DuckDB SQL for the queries that SQL can express.

Each statement is written from the definition in the operator's docstring, not from its steps.
"""

_WORDS = (
    "regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
)


def _shingles(name: str, table: str, key: str, short: bool) -> str:
    """Common table expressions for the distinct shingles of a table's texts.

    ``short`` gives texts of one to four words a shingle of all their words.
    """
    words = _WORDS.format(text="text")
    least = "greatest(len(w) - 4, 1)" if short else "len(w) - 4"
    return f"""
    {name}_words AS (SELECT {key}, {words} AS w FROM {table}),
    {name} AS (
        SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + 4), ' ') AS shingle
        FROM (SELECT {key}, w, unnest(range(1, {least} + 1)) AS i FROM {name}_words
              WHERE len(w) > 0)
    )"""


OP7 = f"""
WITH {_shingles("item_shingles", "benchmark", "item_id", True)},
sizes_used AS (SELECT DISTINCT least(len(w), 5) AS size FROM item_shingles_words WHERE len(w) > 0),
doc_words AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
doc_shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + size - 1), ' ') AS shingle
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc_words, sizes_used WHERE len(w) >= size)
),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id),
shared AS (
    SELECT doc_id, item_id, count(*) AS n_shared
    FROM doc_shingles JOIN item_shingles USING (shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shingles, n_shared
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_shingles
"""

OP10 = f"""
WITH RECURSIVE {_shingles("sets", "documents", "doc_id", True)},
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_common
    FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
),
links AS (
    SELECT a, b, n_common = p.n AND n_common = q.n AS alike
    FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE n_common >= 0.8 * (p.n + q.n - n_common)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
groups AS (SELECT a AS doc_id, min(b) AS group_id FROM reach GROUP BY a),
counts AS (
    SELECT a AS doc_id, count(*) AS n, min(CASE WHEN alike THEN b END) AS first_alike
    FROM links GROUP BY a
)
SELECT d.doc_id, group_id AS class_id, least(d.doc_id, coalesce(first_alike, d.doc_id)) AS copy_id,
       coalesce(n, 0) AS n_links
FROM documents d LEFT JOIN groups USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

OP8 = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
digests AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
           unhex(sha1(payload))::BIT::VARCHAR AS bits,
           max(page_id) OVER (PARTITION BY payload) AS largest
    FROM payloads
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(5), lambda j:
               substr(bits, (5 * i + j + 1)::BIGINT, 1)::INTEGER * (1 << (4 - j)::INTEGER)))::BIGINT,
           1)), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM digests
"""

_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
)"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text; needs ``crc_table`` among the tables read."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), "
        "lambda c, b: xor(entries[xor(c & 255, b) + 1], c >> 8)), 4294967295)"
    )


OP12 = f"""
WITH {_CRC_TABLE},
own AS (
    SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("conv_id::VARCHAR")} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM own) CROSS JOIN crc_table
),
turns AS (
    SELECT c.conv_id, place, turn FROM convs c JOIN own o ON o.conv_id = c.base WHERE place <= h
    UNION ALL
    SELECT c.conv_id, place, turn FROM convs c JOIN own o USING (conv_id) WHERE place > h
),
whole AS (
    SELECT conv_id, coalesce(list(turn ORDER BY place) FILTER (turn IS NOT NULL), []) AS turns
    FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id
),
prefixes AS (
    SELECT conv_id, len(turns) AS n, turns[1:depth] AS prefix, depth
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM whole)
),
nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE
               len(regexp_extract_all(prefix[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS repeated,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
               FILTER (n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY prefix, depth
),
named AS (
    SELECT p.conv_id AS member, depth, nodes.conv_id
    FROM prefixes p JOIN nodes USING (prefix, depth)
),
children AS (
    SELECT up.conv_id, up.depth, count(*) AS n_children
    FROM nodes JOIN named up ON up.member = nodes.conv_id AND up.depth = nodes.depth - 1
    GROUP BY up.conv_id, up.depth
),
below AS (
    SELECT up.conv_id, up.depth, sum(repeated)::BIGINT AS saved_tokens,
           count(*) FILTER (n_children IS NULL) AS n_leaves
    FROM nodes LEFT JOIN children USING (conv_id, depth)
    JOIN named up ON up.member = nodes.conv_id AND up.depth <= nodes.depth
    GROUP BY up.conv_id, up.depth
)
SELECT nodes.conv_id, nodes.depth, up.conv_id AS parent_conv_id, n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM nodes LEFT JOIN named up ON up.member = nodes.conv_id AND up.depth = nodes.depth - 1
LEFT JOIN children ON children.conv_id = nodes.conv_id AND children.depth = nodes.depth
JOIN below ON below.conv_id = nodes.conv_id AND below.depth = nodes.depth
"""

# What may happen to a row: state before (0 nothing yet, 1 after s, 2 after u, 3 after a), initial
# that the row must have, letters, cost, state after, lines inserted before, role written.
_MOVES = """moves(before, initial, letters, price, after, inserted, written) AS (VALUES
    (0, NULL, 'D', 3, 0, [], NULL), (1, NULL, 'D', 3, 1, [], NULL),
    (2, NULL, 'D', 3, 2, [], NULL), (3, NULL, 'D', 3, 3, [], NULL),
    (0, 's', 'K', 0, 1, [], NULL), (0, 'u', 'K', 0, 2, [], NULL), (1, 'u', 'K', 0, 2, [], NULL),
    (3, 'u', 'K', 0, 2, [], NULL), (2, 'a', 'K', 0, 3, [], NULL),
    (0, NULL, 'R', 2, 2, [], 'user'), (1, NULL, 'R', 2, 2, [], 'user'),
    (3, NULL, 'R', 2, 2, [], 'user'), (2, NULL, 'R', 2, 3, [], 'assistant'),
    (0, 'a', 'IK', 2, 3, ['user:'], NULL), (1, 'a', 'IK', 2, 3, ['user:'], NULL),
    (3, 'a', 'IK', 2, 3, ['user:'], NULL), (2, 'u', 'IK', 2, 2, ['assistant:'], NULL),
    (0, NULL, 'IR', 4, 3, ['user:'], 'assistant'), (1, NULL, 'IR', 4, 3, ['user:'], 'assistant'),
    (3, NULL, 'IR', 4, 3, ['user:'], 'assistant'), (2, NULL, 'IR', 4, 2, ['assistant:'], 'user'),
    (0, 'u', 'IIK', 4, 2, ['user:', 'assistant:'], NULL),
    (1, 'u', 'IIK', 4, 2, ['user:', 'assistant:'], NULL),
    (0, NULL, 'IIR', 6, 2, ['user:', 'assistant:'], 'user'),
    (1, NULL, 'IIR', 6, 2, ['user:', 'assistant:'], 'user')
)"""

OP13 = f"""
WITH RECURSIVE {_CRC_TABLE}, {_MOVES},
shown AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20
               AS kind
    FROM conversations CROSS JOIN crc_table
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END
               AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM shown
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth
    FROM damaged
),
lines AS (
    SELECT conv_id, turn, role, left(role, 1) AS initial, text, nth,
           regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS final,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)
               AS place,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)
               || left(role, 1) AS pair
    FROM numbered
),
judged AS (
    SELECT *, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                   WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM lines
),
-- cheapest way into each state after so many rows; the key orders by cost, then by letters
ways AS (
    SELECT conv_id, 0::BIGINT AS place, 0 AS state, 0 AS cost, '' AS letters,
           []::VARCHAR[] AS kept
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, place, state, best.cost, best.letters, best.kept
    FROM (
        SELECT conv_id, place, after AS state,
               arg_min({{'cost': cost, 'letters': letters, 'kept': kept}},
                       lpad(cost::VARCHAR, 9, '0') || letters) AS best
        FROM (
            SELECT w.conv_id, j.place, m.after, w.letters || m.letters AS letters,
                   w.cost + m.price
                       + CASE WHEN fault = 'truncated' AND m.letters <> 'D' THEN 1 ELSE 0 END AS cost,
                   CASE WHEN m.letters = 'D' THEN w.kept
                        ELSE list_concat(w.kept, m.inserted::VARCHAR[],
                                         [coalesce(m.written, j.role) || ':' || j.text]) END AS kept
            FROM ways w
            JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
            JOIN moves m ON m.before = w.state
                AND (m.initial IS NULL OR m.initial = j.initial)
                AND (m.letters = 'D' OR fault NOT IN ('blank', 'duplicate'))
        ) GROUP BY conv_id, place, after
    )
),
counts AS (
    SELECT conv_id, count(*) AS n,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
),
ends(state, price, letters, added) AS (VALUES
    (0, 0, '', []), (1, 4, 'II', ['user:', 'assistant:']), (2, 2, 'I', ['assistant:']), (3, 0, '', [])
),
best AS (
    SELECT conv_id, arg_min({{'cost': cost, 'audit': letters, 'kept': kept}},
                            lpad(cost::VARCHAR, 9, '0') || letters) AS way
    FROM (
        SELECT w.conv_id, w.cost + e.price AS cost, w.letters || e.letters AS letters,
               list_concat(w.kept, e.added::VARCHAR[]) AS kept
        FROM ways w JOIN ends e USING (state)
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
        WHERE w.place = coalesce(c.n, 0)
    ) GROUP BY conv_id
)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, way.cost::BIGINT AS cost, way.audit AS audit,
       sha256(array_to_string(way.kept, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""

SQL: dict[str, str] = {
    "op7_decontamination": OP7,
    "op8_warc": OP8,
    "op10_jaccard_join": OP10,
    "op12_prefix_trie": OP12,
    "op13_structure_repair": OP13,
}
