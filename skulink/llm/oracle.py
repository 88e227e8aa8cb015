"""DuckDB SQL of the corpus operators that SQL can express, written from the contracts."""

from __future__ import annotations

from skulink.llm.decontam import WINDOW
from skulink.llm.ngramjoin import PERCENT, SHINGLE
from skulink.llm import chatformat, merkle, urlgraph
from skulink.llm.quality import ALPHA, DELTA, GRID, RULES

SHARE = ALPHA / len(RULES)     # of one rule

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NOT_SPACE = r"'[^\x20\x09-\x0D]+'"
NORMAL_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def windows(words: str, size: str) -> str:
    """All windows of ``size`` words as texts, in order."""
    return (f"list_transform(range(1, len({words}) - {size} + 2), "
            f"lambda i: array_to_string({words}[i:i + {size} - 1], ' '))")


def op3_quality() -> str:
    scores = {"symbol_rate": "n_symbols / greatest(n_words, 1)",
              "word_length": "word_chars / greatest(n_words, 1)",
              "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
              "repeat_rate": "n_repeat_words / greatest(n_words, 1)"}
    rules = ", ".join(
        f"{{'rule': '{r}', 'lo': {a}::DOUBLE, 'width': {(b - a) / GRID!r}::DOUBLE, 'score': {scores[r]}}}"
        for r, (a, b) in RULES.items())
    return f"""
WITH d AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), {NOT_SPACE}) AS w, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest({windows('w', '3')}) AS t FROM d WHERE len(w) >= 3),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM win) WHERE c > 1),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep CROSS JOIN (SELECT unnest([0, 1, 2]) AS j) GROUP BY ALL),
m AS (SELECT d.doc_id, stratum, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(list_filter(lines, lambda x: regexp_matches(x, {NOT_SPACE})))
     - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, {NOT_SPACE})))))::BIGINT AS n_dup_lines,
    coalesce(hit.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
truth AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY ALL),
x AS (SELECT b.doc_id, stratum, good, unnest([{rules}]) AS r FROM b LEFT JOIN truth USING (doc_id)
      WHERE NOT base_failed),
h AS (SELECT stratum, good, r.rule AS rule, r.lo AS lo, r.width AS width,
    greatest(-1, least({GRID - 1}, ceil((r.score - r.lo) / r.width) - 1)) AS above FROM x WHERE good IS NOT NULL),
g AS (SELECT stratum, rule, any_value(lo) AS lo, any_value(width) AS width, sum(good) AS n_good,
    sum(1 - good) AS n_bad FROM h GROUP BY ALL),
t AS (SELECT g.stratum, g.rule, g.lo, g.width, s.step, n_good, n_bad,
    sum(CASE WHEN h.above >= s.step THEN good ELSE 0 END) AS k,
    sum(CASE WHEN h.above >= s.step THEN 1 - good ELSE 0 END) AS caught
  FROM g CROSS JOIN (SELECT unnest(range({GRID})) AS step) s
  JOIN h ON h.stratum IS NOT DISTINCT FROM g.stratum AND h.rule = g.rule GROUP BY ALL),
ok AS (SELECT * FROM t WHERE n_good > 0 AND k < n_good * {SHARE}
  AND list_sum(list_transform(range(0, k::BIGINT + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1)
      - lgamma(n_good - i + 1) + i * ln({SHARE}) + (n_good - i) * ln(1 - {SHARE}))))
      <= {DELTA} / (SELECT greatest(1, count(*) * {GRID}) FROM g)
  AND caught * n_good > 2 * k * n_bad),
cut AS (SELECT stratum, rule, min(lo + step * width) AS cutoff FROM ok GROUP BY ALL),
bad AS (SELECT DISTINCT x.doc_id FROM x JOIN cut ON cut.stratum IS NOT DISTINCT FROM x.stratum
  AND cut.rule = x.r.rule WHERE x.r.score > cut.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM b"""


def op4_ngram_join() -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, {NOT_SPACE}) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE {windows('w', str(SHINGLE))} END) AS s FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY ALL),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
      GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * c >= {PERCENT} * (nx.n + ny.n - c)),
links AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, links.y FROM r JOIN links ON links.x = r.y)
SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x"""


def op9_decontaminate() -> str:
    size = f"least({WINDOW}, len(w))"
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, {NORMAL_WORD}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, {NORMAL_WORD}) AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, {size} AS n, unnest({windows('w', size)}) AS t FROM b WHERE len(w) > 0),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest({windows('w', 'n')}) AS t
  FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.t = dw.t),
pos AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM
  (SELECT doc_id, i, unnest(range(0, n)) AS j FROM h) GROUP BY ALL),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY ALL)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)"""


def op7_url_filter() -> str:
    """Rules, then the two ranks iterated to the precision of doubles."""
    href = urlgraph.HREF.replace("'", "''")
    host = lambda u: f"translate(regexp_extract({after(u)}, '^([^/?#]*)', 1), '{urlgraph.UPPER}', '{urlgraph.LOWER}')"
    after = lambda u: f"CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"
    fits = [(v, h, p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')")
            for v, h, p in sorted(urlgraph.RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{h}{p}'" for _, h, p, c in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for v, _, _, c in fits) + " END"
    labels = "string_split(host, '.')"
    ctes = [f"""pg AS (SELECT page_id, {host("coalesce(url, '')")} AS host,
    regexp_extract({after("coalesce(url, '')")}, '^[^/?#]*([^?#]*)', 1) AS path, coalesce(html, '') AS html FROM pages),
v AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM pg),
lk AS (SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS u FROM pg),
li AS (SELECT host AS src, {host("CASE WHEN starts_with(u, '//') THEN 'http:' || u ELSE u END")} AS dst FROM lk),
l AS (SELECT src, dst, count(*)::DOUBLE AS w FROM li WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
hosts AS (SELECT DISTINCT host FROM (SELECT host FROM pg UNION ALL SELECT dst FROM l) WHERE host <> ''),
up AS (SELECT DISTINCT array_to_string({labels}[i:], '.') AS a, array_to_string({labels}[i + 1:], '.') AS b
  FROM (SELECT host, unnest(range(1, len({labels}) - 1)) AS i FROM hosts)),
e AS (SELECT src, dst, sum(w) AS w FROM (SELECT * FROM l UNION ALL SELECT a, b, {urlgraph.SITE_WEIGHT} FROM up
  UNION ALL SELECT b, a, {urlgraph.SITE_WEIGHT} FROM up) GROUP BY ALL),
st AS (SELECT 'good' AS kind, src AS host, dst AS nxt, w / sum(w) OVER (PARTITION BY src) AS p FROM e
  UNION ALL SELECT 'bad', dst, src, w / sum(w) OVER (PARTITION BY dst) FROM e),
per AS (SELECT host, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
  FROM v WHERE host <> '' GROUP BY ALL),
sd AS (SELECT 'good' AS kind, host, a / greatest(1, (SELECT sum(a) FROM per)) AS seed FROM per
  UNION ALL SELECT 'bad', host, b / greatest(1, (SELECT sum(b) FROM per)) FROM per),
st0 AS (SELECT kind, host, {1 - urlgraph.DAMPING!r} * seed AS rank FROM sd WHERE seed > 0),
r(i, kind, host, rank) AS (SELECT 1, kind, host, rank FROM st0 UNION ALL
  SELECT any_value(i) + 1, kind, host, sum(rank) FROM (
    SELECT r.i, r.kind, st.nxt AS host, {urlgraph.DAMPING} * st.p * r.rank AS rank
    FROM r JOIN st ON st.kind = r.kind AND st.host = r.host
    UNION ALL SELECT x.i, st0.kind, st0.host, st0.rank FROM st0 CROSS JOIN (SELECT max(i) AS i FROM r) x)
  WHERE i < {urlgraph.MAX_ROUNDS} GROUP BY kind, host)"""]
    return ("WITH RECURSIVE " + ",\n".join(ctes) + f""",
f AS (SELECT host, max(rank) FILTER (kind = 'good') AS trust, max(rank) FILTER (kind = 'bad') AS distrust
  FROM r WHERE i = {urlgraph.MAX_ROUNDS} GROUP BY ALL)
SELECT page_id, v.host, path, rule, coalesce(verdict, CASE WHEN coalesce(distrust, 0.0)
  > {urlgraph.RATIO} * coalesce(trust, 0.0) THEN 'block' ELSE 'allow' END) AS verdict
FROM v LEFT JOIN f ON f.host = v.host""")


# CRC-32 of an ASCII string: the table of 256 remainders, then byte by byte
CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i)))"""


def crc32(text: str) -> str:
    """For queries that also read ``crc``."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), "
            "lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)")


def op11_chat_format() -> str:
    esc = lambda c: f"regexp_replace({c}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
    start, sep, part, end = (len(m) for m in chatformat.MARKS)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '{chatformat.PROBE}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM c),
f AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY i) = role, false) AS joined FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({esc('text')}) + CASE WHEN joined THEN {part} ELSE length({esc('role')}) + {start + sep + end} END)::BIGINT
    AS formatted_chars
FROM f GROUP BY conv_id"""


def op12_merkle() -> str:
    part = lambda c: f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    k = merkle.FANOUT

    def tree(name, of, node):
        run = f"PARTITION BY k, level, pos // {k} ORDER BY pos ROWS BETWEEN"
        return f"""{name}(k, level, pos, h, n) AS (SELECT k, 0, pos, {node}, n FROM {of} UNION ALL
  SELECT k, any_value(level) + 1, pos // {k}, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + {k - 1}) // {k})
  FROM {name} WHERE n > 1 GROUP BY k, pos // {k}),
{name}_step AS (SELECT k, level, pos,
    coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1)"""

    def walk(name, tree_name, of):
        return f"""{name}(id, k, level, pos, cur, proof) AS ({of} UNION ALL
  SELECT f.id, f.k, f.level + 1, f.pos // {k}, sha256(s.l || f.cur || s.r), f.proof || s.l || s.r
  FROM {name} f JOIN {tree_name}_step s ON s.k = f.k AND s.level = f.level AND s.pos = f.pos),
{name}_end AS (SELECT f.* FROM {name} f JOIN {tree_name} t ON t.k = f.k AND t.level = f.level AND t.n = 1)"""

    return f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, coalesce('=' || source, '') AS k, {leaf('text')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS now
  FROM documents CROSS JOIN crc),
r AS (SELECT *, row_number() OVER (ORDER BY k, doc_id NULLS FIRST, leaf) AS id,
    row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY k) AS n FROM d),
{tree('lv', 'r', 'leaf')},
sub AS (SELECT k AS source_key, h AS subroot FROM lv WHERE n = 1),
tr AS (SELECT *, '' AS k, row_number() OVER (ORDER BY source_key) - 1 AS pos, count(*) OVER () AS n FROM sub),
{tree('tl', 'tr', 'subroot')},
{walk('f', 'lv', "SELECT id, k, 0, pos, coalesce(now, leaf), '' FROM r")},
{walk('g', 'tl', "SELECT f.id, '', 0, tr.pos, f.cur, f.proof FROM f_end f JOIN tr ON tr.source_key = f.k")}
SELECT r.doc_id, r.leaf, sub.subroot, top.h AS root, sha256(g.proof) AS proof_sha256, g.cur AS folded_root,
  g.cur = top.h AS verified
FROM r JOIN sub ON sub.source_key = r.k JOIN g_end g ON g.id = r.id CROSS JOIN (SELECT h FROM tl WHERE n = 1) top"""


def op13_repair() -> str:
    """Damage and faults by windows, then the cheapest edits row by row over the four last initials."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    inserts = """ins(s, t, c, a, x) AS (VALUES ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''),
  ('a', 'a', 0, '', ''), ('', 'u', 3, 'I', chr(10) || 'user:'), ('s', 'u', 3, 'I', chr(10) || 'user:'),
  ('a', 'u', 3, 'I', chr(10) || 'user:'), ('u', 'a', 3, 'I', chr(10) || 'assistant:'),
  ('', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  ('s', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'))"""
    return f"""
WITH RECURSIVE {CRC_TABLE}, {inserts},
edit(e, s, t, c) AS (SELECT 'D', s, s, 4 FROM (VALUES (''), ('s'), ('u'), ('a')) v(s)
  UNION ALL VALUES ('K', '', 's', 0), ('K', '', 'u', 0), ('K', 's', 'u', 0), ('K', 'u', 'a', 0), ('K', 'a', 'u', 0),
  ('R', '', 'u', 3), ('R', 's', 'u', 3), ('R', 'u', 'a', 3), ('R', 'a', 'u', 3)),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit FROM conversations CROSS JOIN crc),
b AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN ''
    WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE hit <> 0),
w AS (SELECT conv_id, turn, role, text, role[1] AS x, right(rtrim(text, {space}), 1) AS final,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM b),
q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  coalesce(lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au'), false) AS odd FROM w),
z AS (SELECT *, CASE WHEN final = '' THEN 'b' WHEN again THEN 'd' WHEN final IN ('.', '!', '?') THEN '-' ELSE 't' END AS f
  FROM q),
ids AS (SELECT DISTINCT conv_id FROM conversations),
m AS (SELECT ids.conv_id, count(z.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
    count(*) FILTER (odd) AS illegal FROM ids LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM ids.conv_id GROUP BY 1),
p(conv_id, i, s, best) AS (SELECT conv_id, 0::BIGINT, '', {{'c': 0, 'a': '', 'x': ''}} FROM ids UNION ALL
  SELECT p.conv_id, p.i + 1, edit.t, min({{'c': p.best.c + ins.c + edit.c + CASE WHEN edit.e <> 'D' AND z.f = 't' THEN 3 ELSE 0 END,
    'a': p.best.a || ins.a || edit.e, 'x': p.best.x || ins.x || CASE edit.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || z.role || ':' || z.text
    ELSE chr(10) || CASE edit.t WHEN 'u' THEN 'user:' ELSE 'assistant:' END || z.text END}})
  FROM p JOIN z ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.i = p.i + 1 JOIN ins ON ins.s = p.s JOIN edit ON edit.s = ins.t
  WHERE (edit.e = 'D' OR z.f IN ('-', 't')) AND (edit.e <> 'K' OR z.x = edit.t) GROUP BY p.conv_id, p.i, edit.t),
e AS (SELECT p.conv_id, min({{'c': p.best.c + ins.c, 'a': p.best.a || ins.a, 'x': p.best.x || ins.x}}) AS best
  FROM p JOIN m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.n = p.i JOIN ins ON ins.s = p.s AND ins.t IN ('', 'a')
  GROUP BY p.conv_id)
SELECT m.conv_id, gaps, blank, duplicate, truncated, illegal, e.best.c::BIGINT AS cost, e.best.a AS audit,
  sha256(substr(e.best.x, 2)) AS repaired_sha256
FROM m JOIN e ON e.conv_id IS NOT DISTINCT FROM m.conv_id"""


LLM_ORACLE = {f.__name__: f() for f in (op3_quality, op4_ngram_join, op7_url_filter, op9_decontaminate,
                                             op11_chat_format, op12_merkle, op13_repair)}
