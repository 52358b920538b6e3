"""DuckDB statements for the training-data queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# each word of a text with its place; a window is looked up by its words, joined
_CONTAMINATION = f"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
    FROM benchmark
), sized AS (
    SELECT item, words, least(len(words), 10) AS size FROM items WHERE len(words) > 0
), item_starts AS (
    SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM sized
), windows AS (
    SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS w FROM item_starts
), places AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM doc_words, (SELECT DISTINCT size FROM windows)
), spelled AS (
    SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS w FROM places
), hits AS (
    SELECT doc_id, i, size, item FROM spelled JOIN windows USING (size, w)
), hit_places AS (
    SELECT doc_id, item, unnest(range(i, i + size)) AS place FROM hits
), per_doc AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit, count(DISTINCT item) AS n_items,
        string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM hit_places GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN per_doc USING (doc_id)
"""

_EXACT = f"""
WITH normal AS (SELECT doc_id, {_LOWER.format("text")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM normal WINDOW g AS (PARTITION BY t)
"""

# words stand between ASCII white space, here and in the next statement
_REPEATED = """
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM split WHERE len(words) >= 35
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS w FROM starts
), often AS (
    SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows JOIN often USING (w)
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

# a byte is two hexadecimal digits; runs of removed bytes are told apart by a gap to the start before
_REPEATED_BYTES = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), starts AS (
    SELECT doc_id, digits, unnest(range(0, length(digits) // 2 - 199)) AS i FROM texts WHERE length(digits) >= 400
), windows AS (
    SELECT doc_id, i, substr(digits, 2 * i + 1, 400) AS w FROM starts
), often AS (
    SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
    SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 200, true) AS opens FROM windows SEMI JOIN often USING (w)
), numbered AS (
    SELECT doc_id, i, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone
), runs AS (
    SELECT doc_id, min(i) AS first, max(i) + 200 AS last FROM numbered GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS open FROM runs
), kept AS (
    SELECT doc_id, count(*) AS n_spans, CAST(sum(last - first) AS BIGINT) AS n_removed, max(last) AS tail,
        string_agg(substr(digits, 2 * open + 1, 2 * (first - open)), '' ORDER BY first) AS before
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(before, '') || substr(digits, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

_NEAR = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM split WHERE len(words) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS s FROM starts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY x, y
), links AS (
    SELECT x, y FROM shared JOIN sizes AS a ON a.doc_id = x JOIN sizes AS b ON b.doc_id = y
    WHERE 100 * k >= 90 * (a.n + b.n - k)
), numbers AS (
    SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reached JOIN links ON b = x
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, coalesce(any_value(n_links), 0) AS n_links
FROM documents JOIN reached ON a = doc_id LEFT JOIN sizes USING (doc_id) LEFT JOIN numbers USING (doc_id) GROUP BY doc_id
"""

# CRC-32 of a list of bytes: each byte enters, then eight steps of one bit
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform({0}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda a, k: CASE WHEN k >= 0 THEN xor(a, k) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""
# UTF-8 of a text whose characters are below U+0100
_BYTES = """flatten(list_transform(string_split({0}, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))"""
_DIGITS = "list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: unicode(c)::BIGINT)"

# near words share what is left without one code point: both without the same place, or the shorter one whole
_SPELLING = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
), per_doc AS (
    SELECT doc_id, run, count(*) AS k FROM runs GROUP BY doc_id, run
), hashed AS (
    SELECT run, k, {_CRC32.format(_BYTES.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS h FROM per_doc
), spelled AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k
    FROM hashed
), words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), places AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words
), shorter AS (
    SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest FROM places
), replaced AS (
    SELECT a.word, b.word AS other, b.n FROM shorter AS a JOIN shorter AS b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
), deleted AS (
    SELECT DISTINCT a.word, b.word AS other, a.n, b.n AS other_n FROM shorter AS a JOIN words AS b ON a.rest = b.word
), near AS (
    SELECT word, other, n FROM replaced
    UNION ALL SELECT word, other, other_n FROM deleted UNION ALL SELECT other, word, n FROM deleted
), ranked AS (
    SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(other)) AS place
    FROM near
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN ranked.n >= 2 * words.n THEN other END AS form, CASE WHEN ranked.n >= 2 * words.n THEN ranked.n END AS form_n
    FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1
), followed AS (
    SELECT word, word AS root FROM formed UNION ALL SELECT followed.word, form FROM followed JOIN formed ON root = formed.word WHERE form IS NOT NULL
), roots AS (
    SELECT followed.word, root FROM followed JOIN formed ON root = formed.word WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

# a beginning is the list of its turns; a node's subtree holds the nodes that begin with it
_TRIE = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, role, text
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), whole AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS own FROM turns GROUP BY conv_id
), taken AS (
    SELECT conv_id, own, conv_id - conv_id % 5 AS base, {_CRC32.format(_DIGITS.format("conv_id"))} % 9 AS h FROM whole
), rebuilt AS (
    SELECT taken.conv_id, list_concat(coalesce(base.own[1:h], []), taken.own[h + 1:]) AS seq
    FROM taken LEFT JOIN whole AS base ON base.conv_id = taken.base
), members AS (
    SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt
), beginnings AS (
    SELECT conv_id, depth, CASE WHEN depth = 0 THEN [] ELSE seq[1:depth] END AS node, depth = len(seq) AS last FROM members
), nodes AS (
    SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN depth = 0 THEN NULL WHEN depth = 1 THEN [] ELSE node[1:depth - 1] END AS up,
        CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(node[depth].text)) END AS bytes,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM beginnings GROUP BY depth, node
), families AS (
    SELECT up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up
), numbered AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children, parent.conv_id AS parent_conv_id
    FROM nodes LEFT JOIN families ON families.node = nodes.node AND families.node IS NOT NULL
    LEFT JOIN (SELECT node, conv_id FROM nodes) AS parent ON parent.node = nodes.up
), lines AS (
    SELECT depth, node, unnest(range(0, depth + 1)) AS above, bytes * (n_convs - 1) AS saved, CAST(n_children = 0 AS BIGINT) AS leaf FROM numbered
), subtrees AS (
    SELECT CASE WHEN above = 0 THEN [] ELSE node[1:above] END AS node, CAST(sum(saved) AS BIGINT) AS saved_tokens, CAST(sum(leaf) AS BIGINT) AS n_leaves
    FROM lines GROUP BY 1
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM numbered JOIN subtrees USING (node)
"""

ORACLES = {
    "op1_phrase_automata": _REPEATED,
    "op2_divide_skip": _NEAR,
    "op5_winnowing": _CONTAMINATION,
    "op6_streaming_dedup": _EXACT,
    "op10_longest_previous_factor": _REPEATED_BYTES,
    "op12_prefix_suffix_tiles": _SPELLING,
    "op13_sequence_collapse": _TRIE,
}
