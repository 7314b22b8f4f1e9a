"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {}

ORACLE["op5_mixing"] = rf"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 'n') AS k, source, len({_WORDS}) AS size FROM documents),
s AS (SELECT k, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY k),
w AS (SELECT k, source_size, 2.0::DOUBLE * source_size AS lim,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight FROM s),
r AS (SELECT *, lim / weight AS ratio FROM w),
c AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
          - coalesce(sum(lim) OVER (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER (ORDER BY ratio, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate FROM r),
lam AS (SELECT rate FROM c WHERE rate <= ratio ORDER BY ratio, k LIMIT 1),
t AS (SELECT k, source_size, coalesce(least(lim, (SELECT rate FROM lam) * weight), lim) AS target FROM c),
p AS (SELECT d.doc_id, d.k, d.size, row_number() OVER (PARTITION BY d.k ORDER BY d.size DESC, d.doc_id) AS place FROM d),
x AS (SELECT p.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS per_doc,
        ('0x' || substr(md5('17:' || p.k), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u FROM p JOIN t USING (k)),
n AS (SELECT *, least(floor(place * per_doc + u) - floor((place - 1) * per_doc + u), 2)::BIGINT AS copies FROM x)
SELECT doc_id, size::BIGINT AS size, source_size, target, copies, copies * size AS taken FROM n"""

_FENCES = ", ".join(
    f"max(CASE WHEN measure = '{m}' THEN q3 + greatest(3 * (q3 - q1), least({most}, high - q3)) END) AS hi_{m}"
    + (f", max(CASE WHEN measure = '{m}' THEN q1 - greatest(3 * (q3 - q1), least({most}, q1 - low)) END) AS lo_{m}" if low else "")
    for m, most, low in [
        ("word_length", 400, True), ("symbol_rate", 40, False), ("dup_line_rate", 500, False), ("repeat_rate", 300, False),
    ]
)


def _bin(value: str) -> str:
    return f"{value} - {value} % (1::BIGINT << greatest(length(bin({value})) - 7, 0))"


ORACLE["op3_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS k FROM (
        SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (SELECT doc_id, sum(run)::BIGINT AS n FROM (
        SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS run FROM rep) GROUP BY doc_id),
b AS (SELECT d.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines FROM d LEFT JOIN cov USING (doc_id)),
m AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length,
        CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbol_rate,
        CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_rate,
        CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_rate FROM b),
u AS (UNPIVOT (SELECT lang, source, word_length, symbol_rate, dup_line_rate, repeat_rate FROM m
        WHERE n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words)
        ON word_length, symbol_rate, dup_line_rate, repeat_rate INTO NAME measure VALUE v),
sk AS (SELECT lang, source, measure, {_bin("v")} AS bin, count(*) AS n FROM u GROUP BY ALL),
al AS (SELECT measure, bin, sum(n) OVER (PARTITION BY measure ORDER BY bin) * 1000000 // sum(n) OVER (PARTITION BY measure) AS share
      FROM (SELECT measure, bin, sum(n) AS n FROM sk GROUP BY ALL)),
lg AS (SELECT lang, measure, sum(n) AS docs FROM sk GROUP BY ALL), lb AS (SELECT lang, measure, bin, sum(n) AS n FROM sk GROUP BY ALL),
bl AS (SELECT lg.lang, al.measure, al.bin,
        (sum(coalesce(lb.n, 0)) OVER (PARTITION BY lg.lang, al.measure ORDER BY al.bin) * 1000000 + 200 * share) // (docs + 200) AS share
      FROM lg JOIN al USING (measure) LEFT JOIN lb ON lb.lang IS NOT DISTINCT FROM lg.lang AND lb.measure = al.measure AND lb.bin = al.bin),
og AS (SELECT lang, source, measure, sum(n) AS docs FROM sk GROUP BY ALL),
ow AS (SELECT og.lang, og.source, og.measure, bl.bin, docs + 200 AS docs,
        sum(coalesce(sk.n, 0)) OVER (PARTITION BY og.lang, og.source, og.measure ORDER BY bl.bin) * 1000000 + 200 * share AS upto
      FROM og JOIN bl ON bl.lang IS NOT DISTINCT FROM og.lang AND bl.measure = og.measure
      LEFT JOIN sk ON sk.lang IS NOT DISTINCT FROM og.lang AND sk.source IS NOT DISTINCT FROM og.source
        AND sk.measure = og.measure AND sk.bin = bl.bin),
q AS (SELECT lang, source, measure, min(bin) FILTER (upto >= docs * 5000) AS low, min(bin) FILTER (upto >= docs * 250000) AS q1,
        min(bin) FILTER (upto >= docs * 750000) AS q3, min(bin) FILTER (upto >= docs * 995000) AS high FROM ow GROUP BY ALL),
f AS (SELECT lang, source, {_FENCES} FROM q GROUP BY lang, source),
j AS (SELECT m.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        {_bin("word_length")} > hi_word_length OR {_bin("word_length")} < lo_word_length OR {_bin("symbol_rate")} > hi_symbol_rate
          OR {_bin("dup_line_rate")} > hi_dup_line_rate OR {_bin("repeat_rate")} > hi_repeat_rate AS beyond
      FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(beyond, false) AS kept FROM j"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(rows: str, measure: str) -> str:
    """Start and end of all matches in ``rows (row, rule, txt, pattern)``, in units of ``measure(x)``."""
    return rf"""SELECT * EXCLUDE (txt, pattern, p, m, before),
        before + {measure.format("p[i]")} AS s, before + {measure.format("p[i]")} + {measure.format("m[i]")} AS e, m[i] AS got, i FROM (
      SELECT *, coalesce(list_sum(list_transform(m[:i - 1], lambda x: {measure.format("x")})), 0)
          + coalesce(list_sum(list_transform(p[:i - 1], lambda x: {measure.format("x")})), 0) AS before FROM (
        SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT *, string_split_regex(txt, pattern) AS p, regexp_extract_all(txt, pattern) AS m FROM ({rows}))))"""


def _secrets() -> str:
    from .secret_index import BASE_RULES, RULES

    found = " UNION ALL ".join(
        "SELECT doc_id, r, s, e, kind, {keep} AS keep FROM ({spans})".format(
            keep=f"length(regexp_extract(got, {_quoted(x.pattern)}, {x.group})) >= {x.least}" if x.least else "true",
            spans=_spans(
                f"SELECT doc_id, {r} AS r, '{x.kind}' AS kind, coalesce(text, '') AS txt, {_quoted(x.pattern)} AS pattern "
                f"FROM documents WHERE regexp_matches(text, {_quoted(x.pattern)})", "length({})",
            ),
        ) for r, x in enumerate(RULES)
    )
    n = len(BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (r = {i}) AS n_{x.kind}" for i, x in enumerate(BASE_RULES))
    zeros = ", ".join(f"coalesce(n_{x.kind}, 0) AS n_{x.kind}" for x in BASE_RULES)
    told = "string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, r)"
    return rf"""WITH f AS (SELECT * FROM ({found}) WHERE keep),
g AS (SELECT doc_id, {counts}, {told} FILTER (r < {n}) AS base, {told} AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN g USING (doc_id)"""


def _licenses() -> str:
    from .licenses import BASE, RULES, SEPARATORS, spaced

    words = "((length({0}) - length(replace({0}, ' ', ''))) // 2)"
    rules = ", ".join(f"({r.rule}, '{r.label}', {r.priority}, '{r.keyword}', {_quoted(r.pattern)})" for r in RULES)
    base = ", ".join(f"({i}, '{label}', {_quoted(spaced(phrase))})" for i, (label, phrase) in enumerate(BASE))
    first = "|".join(sorted({r.keyword.split()[0] for r in RULES}))
    return rf"""
WITH t AS (SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '{SEPARATORS}', ' ', 'g')) AS j FROM documents),
n AS (SELECT doc_id, CASE WHEN j = '' THEN '' ELSE ' ' || replace(j, ' ', '  ') || ' ' END AS txt FROM t),
rules(rule, label, priority, keyword, pattern) AS (VALUES {rules}), base(rule, label, pattern) AS (VALUES {base}),
g AS (SELECT * FROM n WHERE regexp_matches(txt, ' (?:{first}) ')),
b AS ({_spans("SELECT doc_id, label, txt, pattern FROM g JOIN base ON regexp_matches(txt, pattern)", words)}),
a AS ({_spans("SELECT doc_id, rule, label, priority, txt, pattern FROM g JOIN rules ON contains(txt, keyword) AND regexp_matches(txt, pattern)", words)}),
f AS (SELECT * FROM a x WHERE NOT EXISTS (SELECT 1 FROM a y WHERE y.doc_id = x.doc_id AND y.s <= x.s AND y.e >= x.e
        AND y.priority <= x.priority AND (y.s, -y.e, y.rule) < (x.s, -x.e, x.rule))),
c AS (SELECT doc_id, count(DISTINCT w) AS covered FROM (
        SELECT doc_id, unnest(range(s::BIGINT, e::BIGINT)) AS w FROM (SELECT doc_id, s, e FROM f UNION ALL SELECT doc_id, s, e FROM b)) GROUP BY doc_id),
bl AS (SELECT doc_id, count(*) AS n_base, min(s)::BIGINT AS first_word, max(s)::BIGINT AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
        SELECT doc_id, label FROM f UNION ALL SELECT doc_id, label FROM b) GROUP BY doc_id)
SELECT n.doc_id, {words.format("txt")}::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN txt = '' THEN 0 ELSE coalesce(covered, 0)::DOUBLE / {words.format("txt")} END AS score
FROM n LEFT JOIN c USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN l USING (doc_id)"""


ORACLE["op8_secrets"] = _secrets()
ORACLE["op10_licenses"] = _licenses()

# Pairs that share a shingle, over classes of equal sets; components by repeated smallest labels.
ORACLE["op9_near_duplicates"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM d),
m AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY s) ELSE doc_id END AS cls, s FROM sh),
c AS (SELECT cls, n, unnest(s) AS x FROM m WHERE doc_id = cls),
p AS (SELECT a.cls AS a, b.cls AS b FROM c a JOIN c b ON a.x = b.x AND a.cls < b.cls
      GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(node, comp) AS (SELECT DISTINCT cls, cls FROM m UNION SELECT e.b, r.comp FROM r JOIN e ON e.a = r.node WHERE r.comp < e.b),
g AS (SELECT node, min(comp) AS comp FROM r GROUP BY node)
SELECT m.doc_id, n::BIGINT AS n_shingles, g.comp AS component_id, m.doc_id = g.comp AS kept FROM m JOIN g ON g.node = m.cls"""

# Bytes as pairs of hexadecimal digits, so that positions and slices are by byte.
ORACLE["op2_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM (
        SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d)),
r AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1),
m AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER p + 200 OR lag(i) OVER p IS NULL THEN 1 ELSE 0 END AS fresh FROM r
      WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
s AS (SELECT doc_id, run, min(i) AS x, max(i) + 200 AS y FROM n GROUP BY doc_id, run),
g AS (SELECT s.doc_id, x, y, coalesce(lag(y) OVER (PARTITION BY s.doc_id ORDER BY x), 0) AS upto FROM s),
k AS (SELECT g.doc_id, sum(y - x)::BIGINT AS n_removed, count(*) AS n_spans, max(y) AS last,
        string_agg(substr(h, 2 * upto + 1, 2 * (x - upto)), '' ORDER BY x) AS kept FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""

ORACLE["op1_tool_calls"] = r"""
WITH RECURSIVE c AS (SELECT conv_id || ':' || turn AS call_id, conv_id, conv_id || ':' || (turn - 2) AS parent_id, text,
        regexp_extract(text, '[0-9]+') AS number, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
      FROM conversations WHERE role = 'user'),
a AS (SELECT *, CASE WHEN coalesce(number, '') <> '' THEN 'look_up' ELSE 'ask' END AS tool, coalesce(to_json(text)::VARCHAR, 'null') AS t FROM c),
j AS (SELECT *, '{' || CASE WHEN tool <> 'look_up' THEN '' WHEN number = '0' OR number NOT LIKE '0%' THEN '"number":' || number || ','
          ELSE '"number":"' || number || '",' END || '"text":' || t || ',"words":' || words || '}' AS arguments,
        CASE WHEN text IS NULL THEN '["missing:text"]' WHEN tool = 'look_up' AND number LIKE '0_%' THEN '["type:number"]' ELSE '[]' END AS problems FROM a),
n AS (SELECT call_id, min((conv_id, parent_id, tool, arguments, problems)) AS b, count(*) AS n_calls FROM j GROUP BY call_id),
u AS (SELECT call_id, b[1] AS conv_id, b[2] AS parent_id, b[3] AS tool, b[4] AS arguments, b[5] AS problems, n_calls FROM n),
l(call_id, level) AS (SELECT call_id, 0 FROM u WHERE parent_id NOT IN (SELECT call_id FROM u)
      UNION ALL SELECT u.call_id, l.level + 1 FROM u JOIN l ON u.parent_id = l.call_id),
r AS (SELECT conv_id || ':' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n_results FROM conversations
      WHERE role = 'assistant' GROUP BY 1)
SELECT u.conv_id, coalesce(u.call_id, r.call_id) AS call_id, u.parent_id, l.level::BIGINT AS level,
  CASE WHEN n_calls IS NULL THEN 'no_call' WHEN n_results IS NULL THEN 'no_result' ELSE 'linked' END AS status,
  coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results, problems = '[]' AS valid,
  '{"arguments":' || coalesce(arguments, 'null') || ',"id":' || to_json(coalesce(u.call_id, r.call_id))::VARCHAR || ',"problems":'
    || coalesce(problems, 'null') || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"tool":'
    || coalesce('"' || tool || '"', 'null') || '}' AS json
FROM u FULL JOIN r ON u.call_id = r.call_id LEFT JOIN l ON l.call_id = u.call_id"""

ORACLE["op12_hard_negatives"] = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INT AS rank,
  s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score QUALIFY rank <= 5"""

ORACLE["op13_cover_dedup"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS k FROM (
        SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
placed AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS txt, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def _turns() -> str:
    """Least edits row by row, forwards: every state keeps its cheapest audit, the ASCII-least of them."""
    steps = "(0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)"
    # Up to two rows inserted before a row: the state they start from and lead to, letters, cost and lines.
    inserts = "(0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []), " + ", ".join(
        f"({q}, {to}, 'I', 5, ['{line}']), ({q}, {then}, 'II', 10, ['{line}', '{more}'])"
        for q, to, line, then, more in [
            (0, 2, "user:", 3, "assistant:"), (1, 2, "user:", 3, "assistant:"), (2, 3, "assistant:", 2, "user:"), (3, 2, "user:", 3, "assistant:"),
        ]
    )
    return rf"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
        CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) x(i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
f AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS fault FROM k, tab),
m AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fault <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM m),
g AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut, left(role, 1) AS x,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS odd FROM o),
rows AS (SELECT conv_id, i, role, text, x, is_blank OR again AS forced, CASE WHEN cut THEN 5 ELSE 0 END AS late FROM g),
keeps(q, x, nxt) AS (VALUES {steps}), ins(q, mid, letters, cost, lines) AS (VALUES {inserts}),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM o
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT p.conv_id, r.i, e.q, p.cost + ins.cost + e.cost AS cost, p.audit || ins.letters || e.letter AS audit, p.lines || ins.lines || e.line AS lines
    FROM dp p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1 JOIN ins ON ins.q = p.q,
    LATERAL (SELECT ins.mid AS q, 2 AS cost, 'D' AS letter, []::VARCHAR[] AS line
      UNION ALL SELECT keeps.nxt, r.late, 'K', [r.role || ':' || r.text] FROM keeps WHERE NOT r.forced AND keeps.q = ins.mid AND keeps.x = r.x
      UNION ALL SELECT CASE WHEN ins.mid = 2 THEN 3 ELSE 2 END, r.late + 1, 'R', [CASE WHEN ins.mid = 2 THEN 'assistant:' ELSE 'user:' END || r.text]
        WHERE NOT r.forced) e)
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
ends AS (SELECT p.conv_id, p.cost + ins.cost AS cost, p.audit || ins.letters AS audit, array_to_string(p.lines || ins.lines, chr(10)) AS txt
  FROM dp p JOIN (SELECT conv_id, max(i) AS n FROM o GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.n = p.i
  JOIN ins ON ins.q = p.q WHERE ins.mid IN (0, 3) QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + ins.cost, p.audit || ins.letters) = 1),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
        count(*) FILTER (NOT is_blank AND again) AS duplicate, count(*) FILTER (NOT is_blank AND NOT again AND cut) AS truncated,
        count(*) FILTER (odd) AS illegal FROM g GROUP BY conv_id)
SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(txt, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM v.conv_id"""


ORACLE["op11_turn_repair"] = _turns()
