"""DuckDB SQL of the training-data queries that SQL can express."""

WORD_LISTS = r"""
    SELECT doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l
    FROM documents),
sh AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')]
        ELSE list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) END) AS s
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
low AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d JOIN low ON low.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

LINE_QUALITY = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce('h' || source, '') AS host FROM documents),
w AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM t),
windows AS (
    SELECT doc_id, unnest(range(0, len(words) - 4)) AS p, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS s
    FROM w WHERE len(words) >= 5),
twice AS (SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY doc_id),
each AS (
    SELECT doc_id, host, text, unnest(lines) AS raw FROM w),
line AS (
    SELECT doc_id, host, text, trim(regexp_replace(regexp_replace(lower(raw), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line,
        len(list_filter(regexp_split_to_array(raw, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
    FROM each),
common AS (SELECT host, line FROM line GROUP BY host, line HAVING count(DISTINCT doc_id) > 10),
lost AS (
    SELECT doc_id, sum(words) AS n, sum(CASE WHEN c.line IS NOT NULL THEN words ELSE 0 END) AS removed
    FROM line l LEFT JOIN common c ON c.host = l.host AND c.line = l.line GROUP BY doc_id),
base AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT f.*, NOT base_failed AND NOT coalesce(100 * removed > 50 * n, false) AS kept, coalesce(removed, 0)::BIGINT AS n_removed_words
FROM failed f LEFT JOIN lost l ON l.doc_id = f.doc_id
"""

#: The rule itself, without masks or seeds: an item's stretch of 20 words (or all of a shorter one) agrees with the
#: document in 75 % of its places, an item of fewer than nine words in all.
SPACED_SEEDS = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS p FROM d),
iw AS (
    SELECT item_id, len(w) AS m, least(20, len(w)) AS reach, CASE WHEN len(w) < 9 THEN 100 ELSE 75 END AS percent, unnest(w) AS x, unnest(range(0, len(w))) AS q
    FROM i),
same AS (
    SELECT doc_id, item_id, m, reach, percent, p - q AS shift, list(q ORDER BY q) AS qs
    FROM dw JOIN iw USING (x) GROUP BY doc_id, item_id, m, reach, percent, p - q HAVING 100 * count(*) >= any_value(percent * reach)),
stretch AS (SELECT *, unnest(range(0, m - reach + 1)) AS s FROM same),
hits AS (
    SELECT DISTINCT doc_id, item_id FROM stretch
    WHERE 100 * len(list_filter(qs, lambda q: q >= s AND q < s + reach)) >= percent * reach)
SELECT d.doc_id, count(h.item_id) AS n_items, min(h.item_id) AS first_item, count(h.item_id) = 0 AS kept
FROM d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id
"""
