"""DuckDB SQL with the results of the queries that SQL can express."""

#: Expected copies by size class, then a walk in Pareto order that takes each document that the words left still hold.
OP4 = r"""
WITH RECURSIVE rows AS (SELECT doc_id, source, size, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS k FROM (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents)),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY 1),
weighed AS (SELECT *, 3 * source_size AS most, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight FROM by_source),
ordered AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS k FROM weighed),
levels AS (SELECT a.*, (SELECT CAST(sum(source_size) AS BIGINT) FROM ordered) - coalesce((SELECT CAST(sum(most) AS BIGINT) FROM ordered b WHERE b.k < a.k), 0) AS due_all, (SELECT CAST(sum(weight) AS BIGINT) FROM ordered b WHERE b.k >= a.k) AS w FROM ordered a),
level AS (SELECT arg_min(CAST(due_all AS DOUBLE) / CAST(w AS DOUBLE), k) AS x FROM levels WHERE CAST(due_all AS DOUBLE) / CAST(w AS DOUBLE) * weight <= most),
targets AS (SELECT source, source_size, least(CAST(most AS DOUBLE), coalesce(x * weight, CAST(most AS DOUBLE))) AS target FROM weighed, level),
classes AS (SELECT r.source, k, 8 + k AS w, CAST(sum(size) AS BIGINT) AS n, any_value(target) AS target FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source WHERE k > 0 GROUP BY 1, 2),
factors AS (SELECT a.source, max(a.k) AS k, arg_max((a.target - CAST(3 * coalesce(above.n, 0) AS DOUBLE)) / CAST(rest.n AS DOUBLE), a.k) AS c
  FROM classes a, LATERAL (SELECT CAST(sum(n) AS BIGINT) AS n FROM classes b WHERE b.source IS NOT DISTINCT FROM a.source AND b.k > a.k) above, LATERAL (SELECT CAST(sum(w * n) AS BIGINT) AS n FROM classes b WHERE b.source IS NOT DISTINCT FROM a.source AND b.k <= a.k) rest
  WHERE (a.target - CAST(3 * coalesce(above.n, 0) AS DOUBLE)) / CAST(rest.n AS DOUBLE) * a.w <= 3 GROUP BY 1),
copies AS (SELECT s.source, s.k, s.n, s.target, least(3.0::DOUBLE, coalesce(f.c * s.w, 3.0::DOUBLE)) AS e FROM classes s LEFT JOIN factors f ON s.source IS NOT DISTINCT FROM f.source),
dues AS (SELECT source, any_value(target) - sum(floor(e) * n) AS due FROM copies GROUP BY 1),
drawn AS (SELECT r.*, coalesce(floor(c.e), 0) AS whole, c.e - floor(c.e) AS p, (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || 'mix'), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM rows r LEFT JOIN copies c ON r.source IS NOT DISTINCT FROM c.source AND r.k = c.k),
odds AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM drawn),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, q IS NULL ORDER BY q / (1 + q), doc_id NULLS FIRST, size) AS r FROM odds),
free AS (SELECT source, r, size FROM ranked WHERE q IS NOT NULL),
walk(source, r, due) AS (SELECT source, CAST(0 AS BIGINT), due FROM dues UNION ALL
  SELECT source, r, due - size FROM (SELECT w.source, w.due, min((f.r, f.size)) AS x, x[1] AS r, x[2] AS size FROM walk w JOIN free f ON f.source IS NOT DISTINCT FROM w.source AND f.r > w.r AND f.size <= w.due GROUP BY ALL))
SELECT d.doc_id, d.size, t.source_size, t.target, CAST(whole + CASE WHEN d.q IS NOT NULL AND w.r IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) * d.size AS taken
FROM ranked d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN walk w ON d.source IS NOT DISTINCT FROM w.source AND d.r = w.r AND d.q IS NOT NULL
"""

#: Repeats of at least four words are runs of equal four-word windows at a fixed distance.
OP5 = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
sized AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS word_chars, CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, text FROM texts),
windows AS (SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS w3, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice3 AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w3) AS c FROM windows WHERE w3 IS NOT NULL) WHERE c > 1),
twice4 AS (SELECT doc_id, i, w4 FROM (SELECT doc_id, i, w4, count(*) OVER (PARTITION BY doc_id, w4) AS c FROM windows WHERE w4 IS NOT NULL) WHERE c > 1),
cover3 AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice3, unnest([0, 1, 2]) AS t(k) GROUP BY 1),
cover4 AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice4, unnest([0, 1, 2, 3]) AS t(k) GROUP BY 1),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS gap, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS island FROM twice4 a JOIN twice4 b ON a.doc_id = b.doc_id AND a.w4 = b.w4 AND a.i < b.i),
longest AS (SELECT doc_id, max(c) + 3 AS longest FROM (SELECT doc_id, count(*) AS c FROM pairs GROUP BY doc_id, gap, island) GROUP BY 1),
lines AS (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dups AS (SELECT doc_id, sum(c - 1) AS n FROM lines GROUP BY 1)
SELECT *, NOT base_failed AND NOT (100 * n_covered > 20 * n_words OR longest > 30 OR 100 * longest > 15 * n_words) AS kept FROM (
  SELECT s.doc_id, n_words, word_chars, n_symbols, CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c3.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(c4.n, 0) AS BIGINT) AS n_covered, CAST(coalesce(l.longest, 0) AS BIGINT) AS longest,
    n_words < 50 OR 100 * coalesce(c3.n, 0) > 50 * n_words AS base_failed
  FROM sized s LEFT JOIN dups d USING (doc_id) LEFT JOIN cover3 c3 USING (doc_id) LEFT JOIN cover4 c4 USING (doc_id) LEFT JOIN longest l USING (doc_id))
"""

#: Bytes as two hexadecimal digits each.
OP6 = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) / 2 AS BIGINT) - 49)) AS i FROM texts)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least FROM windows) WHERE doc_id > least),
islands AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone)),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM islands GROUP BY 1, 2),
kept AS (SELECT t.doc_id, s.k, substr(h, 2 * coalesce(lag(s.b) OVER (PARTITION BY t.doc_id ORDER BY s.k), 0) + 1, 2 * (s.a - coalesce(lag(s.b) OVER (PARTITION BY t.doc_id ORDER BY s.k), 0))) AS part FROM texts t JOIN spans s USING (doc_id)),
summed AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM spans GROUP BY 1),
front AS (SELECT doc_id, string_agg(part, '' ORDER BY k) AS h FROM kept GROUP BY 1)
SELECT t.doc_id, CAST(len(t.h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(s.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(f.h, '') || substr(t.h, CAST(2 * coalesce(s.last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM texts t LEFT JOIN summed s USING (doc_id) LEFT JOIN front f USING (doc_id)
"""

OP9 = r"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM texts),
classes AS (SELECT min(doc_id) AS id, list_sort(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY 2),
each AS (SELECT id, n, unnest(s) AS x FROM classes),
links AS (SELECT a.id AS a, b.id AS b FROM each a JOIN each b ON a.x = b.x AND a.id < b.id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY a.id, b.id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT id, id FROM classes UNION SELECT r.id, b.b FROM reach r JOIN both_ways b ON r.other = b.a),
found AS (SELECT id, min(other) AS component_id FROM reach GROUP BY 1),
degree AS (SELECT a AS id, count(*) AS n_links FROM both_ways GROUP BY 1)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, coalesce(f.component_id, t.doc_id) AS component_id, t.doc_id = coalesce(f.component_id, t.doc_id) AS kept
FROM sets t LEFT JOIN classes c ON list_sort(t.s) = c.s LEFT JOIN found f ON f.id = c.id
"""

OP10 = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS last FROM keyed WHERE len(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.doc_id, k.i, k.line, coalesce(k.doc_id < s.last, false) AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM judged GROUP BY 1
"""

#: Rounds of k-means by list arithmetic over whole numbers; floor(sum / count) is exact as a double below 2^53.
OP12 = r"""
WITH kept AS (SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM kept, unnest([0, 1, 2, 3]) AS t(p)),
c0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM x QUALIFY k < 256),
{rounds}
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY 1),
books AS (SELECT sha256(string_agg(v, ',' ORDER BY p, k)) AS codebooks_sha256 FROM (SELECT p, k, array_to_string(c, ',') AS v FROM c4)),
labels_ AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN coded USING (vec_id) GROUP BY 1)
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id) JOIN labels_ ON kept.label IS NOT DISTINCT FROM labels_.label, books
"""
_ASSIGN = """a{r} AS MATERIALIZED (SELECT vec_id, p, z.d AS d, z.k AS k, x FROM (SELECT vec_id, p, any_value(x) AS x, min({{'d': list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)]), 'k': k}}) AS z FROM x JOIN c{r} USING (p) GROUP BY 1, 2)),"""
_MOVE = """c{n} AS MATERIALIZED (SELECT c{r}.p, c{r}.k, coalesce(m, c) AS c FROM c{r} LEFT JOIN (SELECT p, k, list(m ORDER BY i) AS m FROM (SELECT p, k, i, CAST(floor(CAST(sum(y) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM (SELECT p, k, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY ALL) GROUP BY 1, 2) u ON u.p = c{r}.p AND u.k = c{r}.k),"""
OP12 = OP12.format(rounds="\n".join(_ASSIGN.format(r=r) + "\n" + _MOVE.format(r=r, n=r + 1) for r in range(4)) + "\n" + _ASSIGN.format(r=4))


def _line(head: str, w: str) -> str:
    return f"CASE WHEN {w}.m IS NULL THEN {head} ELSE {head} || chr(10) || {w}.m END"


def _step(q: int, due: int, role: str) -> str:
    """The least of delete, give the role due, and keep, in state q: structs of cost, letters and messages from here on."""
    keep = {0: "s.kind IN ('s', 'u')", 1: "s.kind = 'u'", 2: "s.kind = 'a'", 3: "s.kind = 'u'"}[q]
    to = "(CASE WHEN s.kind = 's' THEN s.w1 ELSE s.w2 END)" if q == 0 else f"s.w{due}"
    deleted = f"{{'c': s.w{q}.c + 4, 'a': 'D' || s.w{q}.a, 'm': s.w{q}.m}}"
    given = f"{{'c': s.w{due}.c + 3 + s.more, 'a': 'R' || s.w{due}.a, 'm': {_line(f"'{role}:' || s.text", f's.w{due}')}}}"
    kept = f"{{'c': {to}.c + s.more, 'a': 'K' || {to}.a, 'm': {_line("s.role || ':' || s.text", to)}}}"
    return f"list_min([{deleted}] || CASE WHEN s.go THEN [] ELSE [{given}] || CASE WHEN {keep} THEN [{kept}] ELSE [] END END) AS s{q}"


def _insert(q: int, role: str, after: str) -> str:
    made = f"'{role}:'"
    return f"list_min([s{q}, {{'c': {after}.c + 3, 'a': 'I' || {after}.a, 'm': {_line(made, after)}}}]) AS w{q}"


#: Conversations from the last row backwards, with the cheapest rest of each state as (cost, letters, messages).
OP13 = r"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS b FROM conversations),
coded AS (SELECT *, xor(4294967295, list_reduce([4294967295] || [CAST(('0x' || substr(hex(b), 2 * i + 1, 2)) AS BIGINT) FOR i IN range(octet_length(b))], lambda acc, v : list_reduce([xor(acc, v), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z : xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS code FROM given),
damaged AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) FROM coded WHERE code <> 0),
ordered AS (SELECT *, row_number() OVER o AS k, lag(left(role, 1)) OVER o || left(role, 1) AS pair FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text))),
judged AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS seen, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut_off FROM ordered),
faults AS (SELECT conv_id, k, role, text, pair, turn, left(role, 1) AS kind, blank OR seen AS go, CASE WHEN cut_off THEN 3 ELSE 0 END AS more, blank, NOT blank AND seen AS duplicate, NOT blank AND NOT seen AND cut_off AS truncated FROM judged),
counted AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY 1),
walk(conv_id, k, w0, w1, w2, w3) AS (SELECT conv_id, n + 1, {'c': 0, 'a': '', 'm': CAST(NULL AS VARCHAR)}, {'c': 6, 'a': 'II', 'm': 'user:' || chr(10) || 'assistant:'}, {'c': 3, 'a': 'I', 'm': 'assistant:'}, {'c': 0, 'a': '', 'm': CAST(NULL AS VARCHAR)} FROM counted
  UNION ALL SELECT conv_id, k, CLOSE0, CLOSE1, w2, w3 FROM (SELECT conv_id, k, s0, s1, CLOSE2, CLOSE3 FROM (
    SELECT conv_id, k, STEP0, STEP1, STEP2, STEP3 FROM (SELECT w.conv_id, f.k, w0, w1, w2, w3, f.role, f.text, f.kind, f.go, f.more FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k - 1) s)))
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.w0.c, 0) AS BIGINT) AS cost, coalesce(w.w0.a, '') AS audit, sha256(coalesce(w.w0.m, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN counted c ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN walk w ON w.k = 1 AND g.conv_id IS NOT DISTINCT FROM w.conv_id
"""
for _q, _due, _role in ((0, 2, "user"), (1, 2, "user"), (2, 3, "assistant"), (3, 2, "user")):
    OP13 = OP13.replace(f"STEP{_q}", _step(_q, _due, _role)).replace(f"CLOSE{_q}", _insert(_q, _role, "w2" if _q < 2 else f"s{_due}"))

ORACLE_SQL = {
    "op4_mixing": OP4,
    "op5_repetition": f"SELECT * EXCLUDE (longest) FROM ({OP5})",
    "op6_substrings": OP6,
    "op9_near_duplicates": OP9,
    "op10_lines": OP10,
    "op12_vector_codes": OP12,
    "op13_conversations": OP13,
}
