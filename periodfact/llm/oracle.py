"""DuckDB SQL of operators whose method has a plain form: exact, by brute force."""

NEARDUP = """
WITH RECURSIVE
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, u.b FROM r JOIN u ON u.a = r.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON m.x = d.doc_id
"""

_CHAT = """
WITH RECURSIVE
m AS (SELECT row_number() OVER () AS id, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS l FROM {messages}),
x AS (SELECT id, conv_id, turn, role, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM m),
q AS (SELECT *, regexp_extract(line, '^[ \\t]*>[> \\t]*') AS marks FROM x),
v AS (SELECT *, length(regexp_replace(marks, '[ \\t]', '', 'g')) AS level, substr(line, length(marks) + 1) AS said FROM q),
o AS (SELECT *, level = 0 AND coalesce(lead(level) OVER (PARTITION BY id ORDER BY i), 0) > 0 AND length(line) <= 300 AND regexp_matches(line,
        '(?i)^[ \\t]*(on .+ wrote|.+ (wrote|writes|said)|(am|le) .+ (schrieb|a écrit).*|el .+ escribió)[ \\t]*:[ \\t]*$') AS announces,
        CASE WHEN level = lag(level) OVER (PARTITION BY id ORDER BY i) THEN 0 ELSE 1 END AS opens FROM v),
t AS (SELECT id, conv_id, turn, role, max(level) AS quote_level, count(*) FILTER (level > 0) AS n_quoted,
        coalesce(trim(string_agg(line, chr(10) ORDER BY i) FILTER (level = 0 AND NOT announces), concat(' ', chr(9), chr(10), chr(13))), '') AS content
      FROM o GROUP BY ALL),
g AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY i) AS passage FROM o),
p AS (SELECT conv_id, turn, level, string_split(w, ' ') AS w FROM (
        SELECT conv_id, turn, level, trim(lower(regexp_replace(string_agg(said, ' ' ORDER BY i), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS w
        FROM g WHERE level > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY id, conv_id, turn, level, passage) WHERE w <> ''),
qu AS (SELECT DISTINCT conv_id, turn, level, array_to_string(w[k:k + 4], ' ') AS u
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM p)),
c AS (SELECT conv_id, turn, content, trim(lower(regexp_replace(content, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS w FROM t
      WHERE turn IS NOT NULL AND conv_id IN (SELECT conv_id FROM p)),
own AS (SELECT conv_id, turn, array_to_string(ws[k:k + 4], ' ') AS u
        FROM (SELECT conv_id, turn, string_split(w, ' ') AS ws, unnest(range(1, len(string_split(w, ' ')) - 3)) AS k FROM c)
        UNION ALL
        SELECT conv_id, turn, s FROM (
          SELECT conv_id, turn, trim(lower(regexp_replace(part, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) AS s FROM (
            SELECT conv_id, turn, unnest(list_concat(string_split(content, chr(10)), regexp_split_to_array(content, '[.!?\\n]+'), [content])) AS part FROM c))
        WHERE s <> '' AND len(string_split(s, ' ')) < 5),
f AS (SELECT conv_id, u, min(turn) AS parent FROM own GROUP BY ALL),
n AS (SELECT conv_id, turn, level, parent, count(*) AS n FROM qu JOIN f USING (conv_id, u) WHERE parent < turn GROUP BY ALL),
k AS (SELECT conv_id, turn, parent FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, parent DESC) AS rn FROM n) WHERE rn = 1),
w(conv_id, turn, root, depth) AS (
  SELECT DISTINCT conv_id, turn, turn, 0 FROM t ANTI JOIN k USING (conv_id, turn) WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  UNION ALL SELECT k.conv_id, k.turn, w.root, w.depth + 1 FROM w JOIN k ON k.conv_id = w.conv_id AND k.parent = w.turn)
SELECT t.conv_id, t.turn, t.role, k.parent AS parent_turn, coalesce(w.root, t.turn) AS thread_root, CAST(coalesce(w.depth, 0) AS BIGINT) AS depth,
       CAST(t.quote_level AS BIGINT) AS quote_level, CAST(t.n_quoted AS BIGINT) AS n_quoted,
       CAST(length(t.content) AS BIGINT) AS n_chars, md5(t.content) AS content_md5
FROM t LEFT JOIN k USING (conv_id, turn) LEFT JOIN w USING (conv_id, turn)
"""

_QUOTED = """(
SELECT a.conv_id, a.turn, a.role, CASE
    WHEN a.turn % 2 = 1 AND b.text IS NOT NULL THEN 'On Monday, A wrote:' || chr(10) || '> ' || replace(
        regexp_replace(b.text, '((?:\\S+ ){6})', '\\1' || chr(10), 'g'), chr(10), chr(10) || '> ') || chr(10) || a.text
    WHEN a.turn % 2 = 0 AND b.text IS NOT NULL AND c.text IS NOT NULL THEN '> > ' || replace(c.text, chr(10), chr(10) || '> > ') || chr(10)
        || '> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10) || a.text
    ELSE a.text END AS text
FROM base a LEFT JOIN base b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1
LEFT JOIN base c ON c.conv_id = a.conv_id AND c.turn = a.turn - 2)"""

CHAT = _CHAT.format(messages="conversations")
QUOTED_REPLIES = _CHAT.format(messages=_QUOTED + " AS quoted").replace(
    "WITH RECURSIVE\n", """WITH RECURSIVE
base AS (SELECT conv_id, turn, min(role) AS role, min(coalesce(text, '')) AS text FROM conversations
         WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
""", 1)
