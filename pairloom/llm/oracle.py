"""The operators in SQL, for DuckDB over the same tables."""

from pairloom.llm.licences import SIGNS, TEMPLATES

# Words and distinct five-word shingles of a text column, as in common.py.
WORDS = r"regexp_extract_all(lower(coalesce({text}, '')), '[\p{{L}}\p{{N}}]+')"
SHINGLES = (
    "list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' ')))"
)

DOCS = "documents"

LEAKS = f"""
    d AS (SELECT doc_id, text, {WORDS.format(text="text")} AS w FROM {DOCS} WHERE text IS NOT NULL),
    ds AS (SELECT DISTINCT doc_id, text, unnest({SHINGLES}) AS s FROM d),
    b AS (SELECT item_id, {WORDS.format(text="text")} AS w FROM benchmark),
    bs AS (SELECT item_id, unnest({SHINGLES}) AS s FROM b),
    bn AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
    found AS (
        SELECT ds.doc_id, ds.text, bs.item_id, count(*) AS n_shared
        FROM ds JOIN bs USING (s) GROUP BY ALL
    ),
    leaks AS (
        SELECT DISTINCT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
        FROM found JOIN bn USING (item_id) WHERE n_shared >= ceil(round(n_item * 0.8, 6))
    )
"""

# Lines by position; a line goes if an earlier one is equal or one word away.
LINES = f"""
    raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM {DOCS}),
    l AS (SELECT doc_id, line_no, line, list_filter(string_split(lower(line), ' '), lambda x: x <> '') AS w, doc_id * 1000000 + line_no AS pos FROM raw),
    u AS (SELECT w, min(pos) AS pos, len(w) AS n FROM l WHERE len(w) > 0 GROUP BY w),
    v AS (SELECT w, pos, n, i, list_concat(w[:i - 1], w[i + 1:]) AS rest
          FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM u WHERE n >= 8)),
    replaced AS (SELECT w FROM (SELECT w, pos, min(pos) OVER (PARTITION BY rest, i) AS hub FROM v) WHERE hub < pos),
    inserted AS (SELECT v.w AS longer, v.pos AS pos_longer, u.w AS shorter, u.pos AS pos_shorter
                 FROM v JOIN u ON v.rest = u.w AND u.n >= 8),
    near AS (SELECT w FROM replaced UNION SELECT longer FROM inserted WHERE pos_shorter < pos_longer
             UNION SELECT shorter FROM inserted WHERE pos_longer < pos_shorter),
    lines AS (SELECT l.doc_id, l.line_no, l.line,
                     len(l.w) > 0 AND (l.pos > u.pos OR near.w IS NOT NULL) AS goes
              FROM l LEFT JOIN u ON l.w = u.w LEFT JOIN near ON l.w = near.w)
"""

# Licence templates, and their words' weights.
NOTICES = ", ".join(f"({k}, '{licence}', '{text}')" for k, (licence, text) in enumerate(TEMPLATES))
SIGN = SIGNS.removeprefix("(?i)")
LICENCES = f"""
    t AS (SELECT * FROM (VALUES {NOTICES}) AS t(template, licence, text)),
    tw AS (SELECT template, licence, word, count(*) AS tf
           FROM (SELECT template, licence, unnest({WORDS.format(text="text")}) AS word FROM t) GROUP BY ALL),
    idf AS (SELECT word, ln((1 + {len(TEMPLATES)}) / (1 + count(*))) + 1 AS idf FROM tw GROUP BY word),
    v AS (SELECT template, licence, word, tf * idf AS w,
                 tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS weight FROM tw JOIN idf USING (word)),
    o AS (SELECT *, coalesce(regexp_matches(text, '{SIGN}', 'i'), false) AND doc_id % 2 = 0 AS whole FROM {DOCS}),
    f AS (SELECT doc_id, text, whole, '/' || concat_ws('/', coalesce(source, '-'), CASE WHEN NOT whole OR doc_id % 3 < 2 THEN coalesce(lang, '-') END,
                 CASE WHEN NOT whole OR doc_id % 3 < 1 THEN (doc_id // 100)::VARCHAR END, doc_id) AS path FROM o),
    lines AS (SELECT doc_id, line_no, line FROM (
                SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM f)
              WHERE regexp_matches(line, '{SIGN}', 'i')
              UNION ALL SELECT doc_id, -1, text FROM f WHERE whole),
    tf AS (SELECT doc_id, line_no, word, count(*) AS tf
           FROM (SELECT doc_id, line_no, unnest({WORDS.format(text="line")}) AS word FROM lines) GROUP BY ALL),
    w AS (SELECT doc_id, line_no, word, tf * coalesce(idf, ln(1 + {len(TEMPLATES)}) + 1) AS w FROM tf LEFT JOIN idf USING (word)),
    len AS (SELECT doc_id, line_no, sqrt(sum(w * w)) AS length FROM w GROUP BY ALL),
    dot AS (SELECT doc_id, line_no, template, licence, sum(w.w * weight) AS dot FROM w JOIN v USING (word) GROUP BY ALL),
    own AS (SELECT doc_id, licence, score FROM (
                SELECT doc_id, licence, round(dot / length, 6) AS score,
                       row_number() OVER (PARTITION BY doc_id ORDER BY round(dot / length, 6) DESC, licence) AS r
                FROM dot JOIN len USING (doc_id, line_no) WHERE round(dot / length, 6) >= 0.75) WHERE r = 1),
    above AS (SELECT doc_id, up, '/' || array_to_string(parts[1:len(parts) - 1 - up], '/') || '/' AS dir
              FROM (SELECT doc_id, parts, unnest(range(len(parts) - 1)) AS up
                    FROM (SELECT doc_id, string_split(path[2:], '/') AS parts FROM f))),
    dirs AS (SELECT dir, licence FROM (
                SELECT dir, licence, row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) AS r
                FROM f JOIN own USING (doc_id) JOIN above USING (doc_id) WHERE whole AND up = 0) WHERE r = 1),
    near AS (SELECT doc_id, dir, licence FROM (
                SELECT above.doc_id, dir, dirs.licence, row_number() OVER (PARTITION BY above.doc_id ORDER BY up) AS r
                FROM above JOIN dirs USING (dir)) WHERE r = 1)
"""

# CRC-32 of a text of ASCII characters.
CRC = """
    crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS entries)
"""
CRC_OF = """xor(4294967295, list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT),
    lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))"""

# Rebuilt conversations, and for each of their beginnings a key.
DIGEST = "md5(length(role)::VARCHAR || ':' || role || text)"
TRIE = f"""
    {CRC},
    raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT conv_id, {DIGEST} AS digest, len(regexp_extract_all(text, '[^ \t-\r]+')) AS words,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {DIGEST}) AS pos FROM raw),
    c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC_OF.format(text="conv_id::VARCHAR")} % 4 AS h
          FROM (SELECT DISTINCT conv_id FROM raw), crc_table),
    b AS (SELECT c.conv_id, t.pos, t.digest, t.words FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
          UNION ALL SELECT c.conv_id, t.pos, t.digest, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
    d AS (SELECT conv_id, row_number() OVER w AS depth, md5(string_agg(digest, ',') OVER w) AS key, words
          FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
    k AS (SELECT * FROM d UNION ALL SELECT conv_id, 0, '', 0 FROM c),
    p AS (SELECT *, lag(key) OVER w AS parent, lead(key) OVER w IS NULL AS ends FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
    n AS (SELECT key, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM p GROUP BY key, depth),
    kids AS (SELECT parent AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
    below AS (SELECT k.key, sum((n_children IS NULL)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * n.words)::BIGINT AS saved_tokens
              FROM n LEFT JOIN kids USING (key) JOIN k ON k.conv_id = n.conv_id AND k.depth <= n.depth GROUP BY k.key)
"""

ORACLE = {
    "op13_prefix_trie": f"""WITH {TRIE}
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
               saved_tokens, sha256(n.ends) AS ends_sha256
        FROM n JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN n up ON n.parent = up.key AND up.depth = n.depth - 1""",
    "op6_licences": f"""
        WITH {LICENCES}
        SELECT f.doc_id, path, own.licence AS own_licence, score,
               CASE WHEN own.licence IS NULL THEN near.licence END AS inherited_licence,
               CASE WHEN own.licence IS NULL THEN near.dir END AS inherited_from,
               coalesce(own.licence, near.licence) AS licence
        FROM f LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)""",
    "op1_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.e, p.e)::BIGINT AS score
              FROM v q JOIN v p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN kept <> page_id THEN kept END AS refers_to
        FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000""",
    "op7_line_dedup": f"""WITH {LINES}
        SELECT d.doc_id, coalesce(count(line_no), 0) AS n_lines, coalesce(sum(goes::INT), 0)::BIGINT AS n_removed,
               md5(CASE WHEN coalesce(bool_or(goes), false)
                   THEN coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT goes), '')
                   ELSE any_value(d.text) END) AS kept_md5
        FROM {DOCS} d LEFT JOIN lines USING (doc_id) GROUP BY d.doc_id""",
    "op3_decontamination": f"WITH {LEAKS} SELECT * FROM leaks",
}
