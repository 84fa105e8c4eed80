"""Oracle SQL (DuckDB) of the registered queries, by name."""

from __future__ import annotations

_SIZES = r"""sized AS (
    SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents)"""

# Water filling by prefix sums over the sources in order of size per weight.
OP2 = rf"""
WITH {_SIZES},
stats AS (SELECT source, sum(size)::HUGEINT AS s FROM sized GROUP BY source),
weighed AS (
    SELECT source, s, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
        WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::HUGEINT AS w FROM stats),
ordered AS (
    SELECT *, sum(s) OVER () AS total,
        coalesce(sum(s) OVER (ORDER BY s::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
        sum(w) OVER (ORDER BY s::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
    FROM weighed),
capped AS (SELECT *, w * (3 * total - 4 * below) > 4 * s * left_w AS full_up FROM ordered),
level AS (
    SELECT (3 * any_value(total) - 4 * coalesce(sum(s) FILTER (full_up), 0))::DOUBLE AS pool,
        (2 * coalesce(sum(w) FILTER (NOT full_up), 0))::DOUBLE AS free FROM capped),
targets AS (
    SELECT source, s, CASE WHEN full_up THEN 2.0::DOUBLE * s::DOUBLE ELSE w::DOUBLE * pool / greatest(free, 2) END AS target
    FROM capped, level),
rated AS (
    SELECT d.doc_id, d.size, t.s::BIGINT AS source_size, t.target,
        CASE WHEN t.s > 0 THEN t.target / t.s::DOUBLE ELSE 0 END AS rate,
        ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT::DOUBLE / pow(16, 13) AS draw
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated
"""

OP6 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
made AS (
    SELECT *, length('<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') || chr(10)
        || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10)) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM made GROUP BY conv_id
"""

OP7 = r"""
WITH words AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
base AS (
    SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        row_number() OVER () AS id FROM words),
windows AS (
    SELECT id, unnest(range(1, n_words - 1)) AS p, w FROM base WHERE n_words >= 3),
spelled AS (SELECT id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS words FROM windows),
found AS (SELECT id, p FROM (SELECT *, count(*) OVER (PARTITION BY id, words) AS c FROM spelled) WHERE c > 1),
repeated AS (
    SELECT id, count(DISTINCT pos) AS n_repeat_words FROM (SELECT id, unnest([p, p + 1, p + 2]) AS pos FROM found) GROUP BY id),
rows_ AS (
    SELECT b.id, doc_id, lang, source, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM base b LEFT JOIN repeated USING (id)),
rated AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        ceil(ln((n_symbols + 0.5::DOUBLE) / (word_chars + 1)) / ln(1.02::DOUBLE))::INTEGER AS symbols,
        ceil(ln((n_dup_lines + 0.5::DOUBLE) / (n_lines + 1)) / ln(1.02::DOUBLE))::INTEGER AS dup_lines,
        ceil(ln((n_repeat_words + 0.5::DOUBLE) / (n_words + 1)) / ln(1.02::DOUBLE))::INTEGER AS repeats,
        ceil(ln((word_chars + 0.5::DOUBLE) / (n_words + 1)) / ln(1.02::DOUBLE))::INTEGER AS word_length FROM rows_),
long AS (
    SELECT lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) AS measure,
        unnest([symbols, dup_lines, repeats, word_length]) AS bin FROM rated WHERE NOT base_failed),
levels AS (
    SELECT 0 AS level, lang, source, measure, bin FROM long
    UNION ALL SELECT 1, lang, NULL, measure, bin FROM long UNION ALL SELECT 2, NULL, NULL, measure, bin FROM long),
tails AS (
    SELECT level, lang, source, measure, count(*) AS docs, 2 * quantile_disc(bin, 0.99) - quantile_disc(bin, 0.9) AS tail
    FROM levels GROUP BY ALL),
steps AS (
    SELECT level, lang, source, measure, bin, n, sum(n) OVER w AS run, sum(n) OVER (PARTITION BY level, lang, source, measure) AS whole,
        lead(bin) OVER w - bin AS gap
    FROM (SELECT *, count(*) AS n FROM levels GROUP BY ALL) WINDOW w AS (PARTITION BY level, lang, source, measure ORDER BY bin)),
edges AS (
    SELECT level, lang, source, measure, min(bin) AS edge FROM steps
    WHERE gap >= ceil(ln(4) / ln(1.02::DOUBLE)) AND run >= 0.75 * whole GROUP BY level, lang, source, measure),
fenced AS (
    SELECT t.*, least(tail, edge) AS fence FROM tails t LEFT JOIN edges e ON t.level = e.level AND t.measure = e.measure
        AND t.lang IS NOT DISTINCT FROM e.lang AND t.source IS NOT DISTINCT FROM e.source),
wide AS (
    SELECT level, lang, source, any_value(docs) AS docs, max(fence) FILTER (measure = 'symbols') AS symbols,
        max(fence) FILTER (measure = 'dup_lines') AS dup_lines, max(fence) FILTER (measure = 'repeats') AS repeats,
        max(fence) FILTER (measure = 'word_length') AS word_length FROM fenced GROUP BY level, lang, source),
chosen AS (
    SELECT a.lang, a.source, unnest(CASE WHEN a.docs >= 1000 THEN [a] WHEN b.docs >= 1000 THEN [b] ELSE [c] END) AS f
    FROM wide a JOIN wide b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang JOIN wide c ON c.level = 2
    WHERE a.level = 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(r.symbols <= f.symbols, true) AND coalesce(r.dup_lines <= f.dup_lines, true)
        AND coalesce(r.repeats <= f.repeats, true) AND coalesce(r.word_length <= f.word_length, true) AS kept
FROM rated r LEFT JOIN chosen t ON r.lang IS NOT DISTINCT FROM t.lang AND r.source IS NOT DISTINCT FROM t.source
"""

# Shingles of every text, all pairs that share one, and the closure of the links.
OP8 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
grams AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least USING (doc_id)
"""

# Shingles of every line, all pairs of lines that share one, and the earlier of each pair.
OP10 = r"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS MATERIALIZED (
    SELECT doc_id, pos, ls[pos] AS line, regexp_extract_all(
        translate(ls[pos], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos FROM split)),
sets AS MATERIALIZED (
    SELECT doc_id, pos, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM lines WHERE len(w) > 0),
classes AS MATERIALIZED (
    SELECT list_sort(s) AS s, min((doc_id, pos)) AS first, row_number() OVER () AS id FROM sets GROUP BY list_sort(s)),
grams AS MATERIALIZED (SELECT id, len(s) AS n, first, unnest(s) AS g FROM classes),
near AS (
    SELECT b.id FROM grams a JOIN grams b ON a.g = b.g AND a.first < b.first GROUP BY a.id, b.id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
gone AS (
    SELECT s.doc_id, s.pos FROM sets s JOIN classes c ON list_sort(s.s) = c.s
    WHERE (s.doc_id, s.pos) <> c.first OR c.id IN (SELECT id FROM near)),
told AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
        coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '') AS left_text
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, length(left_text) AS n_chars_left, sha256(left_text) AS text_sha256 FROM told
"""

OP1 = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM (SELECT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM best WHERE rank <= 10
"""

# All windows of 35 words, those whose words stand twice, and the words they cover.
OP11 = r"""
WITH split AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
    SELECT id, p, array_to_string(w[p:p + 34], ' ') AS words
    FROM (SELECT id, w, unnest(range(1, len(w) - 33)) AS p FROM split WHERE len(w) >= 35)),
again AS (SELECT id, p FROM (SELECT *, count(*) OVER (PARTITION BY words) AS c FROM windows) WHERE c > 1),
words AS (SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
judged AS (
    SELECT w.id, w.i, w.word, coalesce(w.i - max(a.p) OVER (PARTITION BY w.id ORDER BY w.i) < 35, false) AS gone
    FROM words w LEFT JOIN again a ON a.id = w.id AND a.p = w.i),
told AS (
    SELECT id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM judged GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN told USING (id)
"""

# Terms of every document and item, joined by term.
OP12 = r"""
WITH low AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
whole AS (SELECT count(*) AS total, sum(len(t))::BIGINT AS words FROM low WHERE len(t) > 0),
held AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM low) GROUP BY id, term),
weighed AS (
    SELECT term, floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, whole GROUP BY term),
lengths AS (SELECT id, doc_id, 100 - 25 + ((25 * len(t) * total) // words) AS m FROM low, whole WHERE len(t) > 0),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
scored AS (
    SELECT item_id, id, any_value(doc_id) AS doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN lengths USING (id) GROUP BY item_id, id),
best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM best WHERE rank <= 20
"""

SQL = {"op1_top_k": OP1, "op2_mix_sources": OP2, "op6_chat_format": OP6, "op7_quality_rules": OP7,
       "op8_near_duplicates": OP8, "op10_line_dedup": OP10, "op11_substring_dedup": OP11, "op12_lexical_search": OP12}
