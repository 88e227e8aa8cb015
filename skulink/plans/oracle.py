"""DuckDB SQL for every named query: the independent check.

Written as brute force on purpose: the scoring join is a plain cross
join of the two catalogues (fine at the check's scale), the cascade is
evaluated from its definition, and the exclusion policies are unrolled
round by round.  Only the driver tables are referenced.
"""

from __future__ import annotations

from skulink.functions.text import (AGREE_BOTH, AGREE_COLORS_ONLY, AGREE_NONE, COLOR_NAMES,
                                    ENGLISH_STOP_WORDS, NO_MATCH_NAME)
from skulink.plans.cascade import FIELDS, Grid

COLOR_ALT = "|".join(COLOR_NAMES)
STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"
# RE2 forms of the fixed patterns in skulink/functions/text.py
MEASURE_SQL_RE = r"(?i)\b\d+(\.\d+)?\s*(mL|mm)\b"
TOKEN_RE = (r"``|''''|\.\.\.|n''t|''\p{L}+|\p{N}+(?:[.,]\p{N}+)+"
            r"|[\p{L}\p{N}_]+(?:-[\p{L}\p{N}_]+)*|[^\s\p{L}\p{N}_]")


def clean_sql(x: str) -> str:
    s = f"coalesce({x}, '')"
    s = rf"regexp_replace({s}, '(?i)\b(?:{COLOR_ALT})\b', '', 'g')"
    s = f"regexp_replace({s}, '{MEASURE_SQL_RE}', '', 'g')"
    s = rf"regexp_replace({s}, '\b\d+\b', '', 'g')"
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def words_sql(x: str) -> str:
    return (rf"list_distinct(list_filter(regexp_split_to_array({clean_sql(x)}, '[^\p{{L}}\p{{N}}_]+'),"
            r" lambda w: w <> ''))")


def colors_sql(x: str) -> str:
    return (rf"array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(coalesce({x}, ''),"
            rf" '(?i)\b({COLOR_ALT})\b', 1), lambda c: lower(c)))), ',')")


def measures_sql(x: str) -> str:
    pat = f"'{MEASURE_SQL_RE}'"
    a = f"regexp_extract_all(coalesce({x}, ''), {pat}, 1)"
    b = f"regexp_extract_all(coalesce({x}, ''), {pat}, 2)"
    return (f"array_to_string(list_sort(list_distinct(list_transform(range(len({a})),"
            f" lambda i: coalesce({a}[i + 1], '') || '|' || coalesce({b}[i + 1], '')))), ',')")


def tokens_sql(x: str) -> str:
    s = f"regexp_replace(lower(coalesce({x}, '')), 'n''t', ' n''t', 'g')"
    s = rf"regexp_replace({s}, '\bcannot\b', 'can not', 'g')"
    s = rf"""regexp_replace({s}, '(^|[\s(\[{{<])"', '\1 `` ', 'g')"""
    s = f"""replace({s}, '"', ' '''' ')"""
    return f"regexp_extract_all({s}, '{TOKEN_RE}')"


def filtered_tokens_sql(x: str) -> str:
    return f"list_filter({tokens_sql(x)}, lambda t: NOT list_contains({STOP}, t))"


KEPT = "\ue000"        # a point inside a word, or an abbreviation's
POINTED_SQL_RE = r"(?s)^(.*[\p{L}\p{N}])\.([^\p{L}\p{N}.]*)$"
KEPT_TOKEN_RE = (rf"``|''''|\.\.\.|n''t|''\p{{L}}+|\p{{N}}+(?:[,{KEPT}]\p{{N}}+)+{KEPT}?"
                 rf"|[\p{{L}}\p{{N}}_{KEPT}]+(?:-[\p{{L}}\p{{N}}_{KEPT}]+)*|[^\s\p{{L}}\p{{N}}_{KEPT}]")


def pointed_types_ctes() -> str:
    """Words of all documents, their types, and each pointed type's score (table pt)."""
    return rf"""
sw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda w: w <> '') AS ws
       FROM documents),
tw AS (SELECT unnest(ws) AS w FROM sw),
ty AS (SELECT regexp_replace(regexp_extract(w, '{POINTED_SQL_RE}', 1), '^[^\p{{L}}\p{{N}}]+', '') AS pointed,
              regexp_replace(regexp_replace(w, '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}]+$', '') AS plain FROM tw),
tc AS (SELECT CASE WHEN pointed <> '' THEN pointed ELSE plain END AS type,
              count(*) FILTER (pointed <> '') AS n_pointed, count(*) FILTER (pointed = '') AS n_plain
       FROM ty GROUP BY 1 HAVING regexp_matches(type, '\p{{L}}')),
tp AS (SELECT sum(n_pointed) / sum(n_pointed + n_plain) AS p FROM tc),
pt AS (SELECT type, n_pointed, n_plain, greatest(0.0::DOUBLE,
              2 * (n_pointed * (ln(0.99) - ln(p)) + n_plain * (ln(0.01) - ln(1 - p)))
              * exp(-length(replace(type, '.', ''))) * (1 + length(type) - length(replace(type, '.', '')))
              * pow(length(replace(type, '.', ''))::DOUBLE, -n_plain)) AS score
       FROM tc, tp WHERE n_pointed > 0)"""


def sentence_tokens_sql() -> str:
    kept = (f"list_transform(ws, lambda w, i: CASE WHEN i < len(ws) AND list_contains(known, "
            rf"regexp_replace(regexp_extract(w, '{POINTED_SQL_RE}', 1), '^[^\p{{L}}\p{{N}}]+', '')) "
            rf"THEN regexp_replace(w, '{POINTED_SQL_RE}', '\1{KEPT}\2') ELSE w END)")
    s = f"array_to_string({kept}, ' ')"
    for _ in range(2):
        s = rf"regexp_replace({s}, '([\p{{L}}\p{{N}}_])\.([\p{{L}}\p{{N}}_])', '\1{KEPT}\2', 'g')"
    s = f"regexp_replace({s}, 'n''t', ' n''t', 'g')"
    s = rf"regexp_replace({s}, '\bcannot\b', 'can not', 'g')"
    s = rf"""regexp_replace({s}, '(^|[\s(\[{{<])"', '\1 `` ', 'g')"""
    s = f"""replace({s}, '"', ' '''' ')"""
    return f"list_transform(regexp_extract_all({s}, '{KEPT_TOKEN_RE}'), lambda t: replace(t, '{KEPT}', '.'))"


def subword_ctes() -> str:
    """Ids of every document (table ds: doc_id, ids without specials), word by word."""
    parts = " UNION ".join(f"SELECT substr(w, 1, {k}) AS p FROM tp UNION SELECT '##' || right(w, {k}) FROM tp"
                           for k in (1, 2, 3))
    return f"""
tk AS (SELECT doc_id, {filtered_tokens_sql('text')} AS t FROM documents),
tw AS (SELECT doc_id, unnest(t) AS w, unnest(range(len(t))) AS i FROM tk),
wc AS (SELECT w, count(*) AS n FROM tw GROUP BY w),
tp AS (SELECT w FROM wc ORDER BY n DESC, w LIMIT 5000),
vo AS (SELECT p, 3 + row_number() OVER (ORDER BY p) AS id FROM (SELECT w AS p FROM tp UNION {parts})),
pm AS (SELECT max(len(p)) AS longest FROM vo),
sp AS (SELECT w, s, unnest(range(1, 1 + least(len(w) - s + 1, CASE WHEN s = 1 THEN longest ELSE longest - 2 END))) AS n
       FROM (SELECT w, unnest(range(1, len(w) + 1)) AS s FROM wc WHERE len(w) <= 100), pm),
st AS (SELECT w, s, max(n) AS n, arg_max(id, n) AS id
       FROM sp JOIN vo ON p = CASE WHEN s = 1 THEN '' ELSE '##' END || substr(w, s, n) GROUP BY w, s),
wk AS (SELECT w, 1::BIGINT AS s, []::BIGINT[] AS ids FROM wc
       UNION ALL SELECT wk.w, wk.s + st.n, list_append(wk.ids, st.id) FROM wk JOIN st ON st.w = wk.w AND st.s = wk.s),
ws AS (SELECT wc.w, coalesce(any_value(wk.ids), [1]::BIGINT[]) AS ids
       FROM wc LEFT JOIN wk ON wk.w = wc.w AND wk.s = len(wc.w) + 1 GROUP BY wc.w),
ds AS (SELECT doc_id, coalesce(ids, []::BIGINT[]) AS ids FROM documents LEFT JOIN
       (SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM tw JOIN ws USING (w) GROUP BY doc_id) USING (doc_id))"""


def vec_sql(toks: str) -> str:
    """Mean-pooled hash vector of a token list (empty list -> empty vector)."""
    return (f"CASE WHEN len({toks}) = 0 THEN CAST([] AS DOUBLE[]) ELSE list_transform(range(16), lambda i: "
            f"list_avg(list_transform({toks}, lambda t: ((('0x' || substr(md5(t), 2 * i + 1, 2))::INTEGER)"
            f" - 127.5) / 127.5))) END")


def cos_sql(a: str, b: str) -> str:
    return (f"CASE WHEN len({a}) > 0 AND len({b}) > 0 AND list_dot_product({a}, {a}) > 0 "
            f"AND list_dot_product({b}, {b}) > 0 THEN list_dot_product({a}, {b}) / "
            f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) ELSE 0.0 END")


CAT = r"""
docw AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}_]+'), lambda w: w <> '') AS w
  FROM documents),
nd AS (SELECT greatest(1, count(*)) AS n FROM documents),
cat AS (
  SELECT p.p_partkey AS pos, 'P' || p.p_partkey AS product_id,
    concat_ws(' ',
      CASE WHEN p.p_partkey % 7 < 5 THEN p.p_name END,
      CASE WHEN p.p_partkey % 3 = 0 THEN lower(p.p_type) END,
      CASE p.p_partkey % 4 WHEN 0 THEN p.p_size || ' mL' WHEN 1 THEN p.p_size || '.5 mm'
                           WHEN 2 THEN 'No ' || p.p_size ELSE p.p_brand END,
      coalesce(array_to_string(list_slice(n.w, 1 + ((p.p_partkey // 2) * 31) % greatest(1, len(n.w) - 12) + p.p_partkey % 3,
        ((p.p_partkey // 2) * 31) % greatest(1, len(n.w) - 12) + p.p_partkey % 3 + 4 + p.p_partkey % 5), ' '), ''))
        AS product_name,
    CASE WHEN p.p_partkey % 11 <> 0 THEN d.text END AS product_desc,
    p.p_type AS product_category, p.p_brand AS product_sub_category,
    CAST(p.p_size AS VARCHAR) AS product_quantity,
    CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS product_price,
    'https://shop.example/p/' || p.p_partkey AS product_url,
    'https://img.example/p/' || p.p_partkey || '.jpg' AS image_url
  FROM part p CROSS JOIN nd LEFT JOIN docw n ON n.doc_id = (p.p_partkey // 2) % nd.n
       LEFT JOIN docw d ON d.doc_id = (p.p_partkey * 3) % nd.n)
"""


def base(n_vendors: int = 1) -> str:
    """Catalogues, word sets and the brute-force pair table ``pr``."""
    labels = "['Alpha', 'Beta', 'Gamma', 'Delta', 'Epsilon', 'Zeta']"
    vend = "'Alpha'" if n_vendors == 1 else f"{labels}[1 + (pos // 2) % {n_vendors}]"
    return f"""WITH {CAT},
cl AS (SELECT * FROM cat WHERE pos % 2 = 0),
cr AS (SELECT *, {vend} AS vendor FROM cat WHERE pos % 2 = 1),
lw AS (SELECT *, {words_sql('product_name')} AS w FROM cl),
rw AS (SELECT *, {words_sql('product_name')} AS w FROM cr),
pr AS (SELECT r.vendor, l.pos AS lpos, r.pos AS rpos, len(list_intersect(l.w, r.w)) AS inter,
              len(l.w) + len(r.w) - len(list_intersect(l.w, r.w)) AS uni
       FROM lw l CROSS JOIN rw r),
bst AS (SELECT vendor, lpos, rpos, inter, uni FROM (
          SELECT *, row_number() OVER (PARTITION BY vendor, lpos ORDER BY
            CASE WHEN uni > 0 THEN inter::DOUBLE / uni ELSE 0.0 END DESC, rpos DESC) AS rn FROM pr)
        WHERE rn = 1)"""


def grid_sql(grid: Grid) -> str:
    return "(SELECT unnest([" + ", ".join(str(k) for k in grid.ks) + "]) AS k)"


def band_list(grid: Grid) -> str:
    return "[" + ", ".join(str(k) for k in grid.band_ks) + "]"


HITS = """hits AS (
  SELECT 'Alpha' AS vendor, 'P' || p_partkey AS query_key, r AS rank,
         'P' || (2 * ((p_partkey * 7 + r * 13) % (SELECT greatest(1, count(*)) FROM part WHERE p_partkey % 2 = 1)) + 1)
           AS product_id
  FROM part CROSS JOIN (SELECT 0 AS r UNION ALL SELECT 1 UNION ALL SELECT 2) g
  WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 1)"""


def plain_k_cte(grid: Grid) -> str:
    band = band_list(grid)
    return f"""pk AS (
  SELECT b.vendor, b.lpos, b.rpos, b.inter, b.uni,
         CASE WHEN b.uni > 0 THEN b.inter::DOUBLE / b.uni ELSE 0.0 END AS plain_score,
         (SELECT max(g.k) FROM {grid_sql(grid)} g WHERE NOT list_contains({band}, g.k)
                 AND 100 * b.inter >= g.k * greatest(b.uni, 1)) AS plain_k
  FROM bst b)"""


def band_cands_cte(grid: Grid) -> str:
    band = band_list(grid)
    return f"""bc AS (
  SELECT p.vendor, p.lpos, (100 * p.inter) // p.uni AS k, min(p.rpos) AS first_pos, max(p.rpos) AS last_pos
  FROM pr p JOIN pk ON pk.vendor = p.vendor AND pk.lpos = p.lpos
  WHERE p.uni > 0 AND (100 * p.inter) % p.uni = 0 AND list_contains({band}, (100 * p.inter) // p.uni)
    AND (pk.plain_k IS NULL OR pk.plain_k < {min(grid.band_ks)})
  GROUP BY ALL)"""


def embed_ctes(pairs: str, sfx: str = "") -> str:
    """``pairs`` has l_name, l_desc, r_name, r_desc -> ``ps{sfx}`` with sim columns."""
    return f"""txt{sfx} AS (SELECT DISTINCT coalesce(t, '') AS text FROM (
    SELECT l_name AS t FROM {pairs} UNION ALL SELECT l_desc FROM {pairs}
    UNION ALL SELECT r_name FROM {pairs} UNION ALL SELECT r_desc FROM {pairs})),
tk{sfx} AS (SELECT text, {filtered_tokens_sql('text')}[1:126] AS toks FROM txt{sfx}),
tv{sfx} AS (SELECT text, {vec_sql('toks')} AS v FROM tk{sfx}),
ps{sfx} AS (SELECT x.*, {cos_sql('a.v', 'b.v')} AS title_sim, {cos_sql('c.v', 'd.v')} AS desc_sim,
              ({cos_sql('a.v', 'b.v')} + {cos_sql('c.v', 'd.v')}) / 2 AS sim
       FROM {pairs} x
       JOIN tv{sfx} a ON a.text = coalesce(x.l_name, '') JOIN tv{sfx} b ON b.text = coalesce(x.r_name, '')
       JOIN tv{sfx} c ON c.text = coalesce(x.l_desc, '') JOIN tv{sfx} d ON d.text = coalesce(x.r_desc, ''))"""


def direct_ctes(grid: Grid) -> str:
    return f"""{plain_k_cte(grid)},
{band_cands_cte(grid)},
dp AS (SELECT bc.vendor, bc.lpos, bc.k, bc.first_pos, l.product_name AS l_name, l.product_desc AS l_desc,
              r.product_name AS r_name, r.product_desc AS r_desc
       FROM bc JOIN cl l ON l.pos = bc.lpos JOIN cr r ON r.vendor = bc.vendor AND r.pos = bc.first_pos),
{embed_ctes('dp')},
ba AS (SELECT vendor, lpos, k, first_pos AS b_pos, sim AS b_score,
              row_number() OVER (PARTITION BY vendor, lpos ORDER BY k DESC) AS rn
       FROM ps WHERE sim >= k / 100.0),
res AS (
  SELECT pk.vendor, pk.lpos,
         CASE WHEN ba.k IS NOT NULL AND (pk.plain_k IS NULL OR ba.k > pk.plain_k) THEN ba.k ELSE pk.plain_k END AS match_k,
         CASE WHEN ba.k IS NOT NULL AND (pk.plain_k IS NULL OR ba.k > pk.plain_k) THEN ba.b_pos ELSE pk.rpos END AS match_pos,
         CASE WHEN ba.k IS NOT NULL AND (pk.plain_k IS NULL OR ba.k > pk.plain_k) THEN ba.b_score ELSE pk.plain_score END AS score
  FROM pk LEFT JOIN ba ON ba.vendor = pk.vendor AND ba.lpos = pk.lpos AND ba.rn = 1)"""


def after_sql(x: str, delimiter: str) -> str:
    return f"CASE WHEN contains({x}, '{delimiter}') THEN substr({x}, strpos({x}, '{delimiter}') + {len(delimiter)}) ELSE {x} END"


def assisted_ctes(grid: Grid, by_name: bool = False) -> str:
    key = "l.product_name" if by_name else "l.product_id"
    hits = HITS if not by_name else HITS.replace("hits AS (", "hits_by_id AS (") + """,
hits AS (SELECT h.vendor, l.product_name AS query_key, h.rank, h.product_id
         FROM hits_by_id h JOIN cl l ON l.product_id = h.query_key)"""
    return f"""{plain_k_cte(grid)},
{band_cands_cte(grid)},
{hits},
hr AS (SELECT h.vendor, h.query_key, r.product_name AS r_name, r.product_desc AS r_desc
       FROM hits h JOIN (SELECT *, row_number() OVER (PARTITION BY vendor, product_id ORDER BY pos) AS rn FROM cr) r
         ON r.vendor = h.vendor AND r.product_id = h.product_id AND r.rn = 1),
el AS (SELECT DISTINCT bc.vendor, bc.lpos FROM bc),
hp AS (SELECT el.vendor, el.lpos, l.product_name AS l_name, l.product_desc AS l_desc, hr.r_name, hr.r_desc
       FROM el JOIN cl l ON l.pos = el.lpos JOIN hr ON hr.vendor = el.vendor AND hr.query_key = {key}),
{embed_ctes('hp')},
hs AS (SELECT vendor, lpos, max(sim) AS hit_sim FROM ps GROUP BY ALL),
hh AS (SELECT DISTINCT vendor, query_key FROM hits),
bx AS (SELECT bc.*, hh.query_key IS NOT NULL AS has_hits, hs.hit_sim
       FROM bc JOIN cl l ON l.pos = bc.lpos
       LEFT JOIN hh ON hh.vendor = bc.vendor AND hh.query_key = {key}
       LEFT JOIN hs ON hs.vendor = bc.vendor AND hs.lpos = bc.lpos),
ba AS (SELECT vendor, lpos, k,
              CASE WHEN has_hits THEN first_pos ELSE last_pos END AS b_pos,
              CASE WHEN has_hits THEN hit_sim ELSE k / 100.0 END AS b_score,
              row_number() OVER (PARTITION BY vendor, lpos ORDER BY k DESC) AS rn
       FROM bx WHERE (has_hits AND hit_sim IS NOT NULL AND hit_sim >= k / 100.0) OR NOT has_hits),
res AS (
  SELECT pk.vendor, pk.lpos,
         CASE WHEN ba.k IS NOT NULL AND (pk.plain_k IS NULL OR ba.k > pk.plain_k) THEN ba.k ELSE pk.plain_k END AS match_k,
         CASE WHEN ba.k IS NOT NULL AND (pk.plain_k IS NULL OR ba.k > pk.plain_k) THEN ba.b_pos ELSE pk.rpos END AS match_pos,
         CASE WHEN ba.k IS NOT NULL AND (pk.plain_k IS NULL OR ba.k > pk.plain_k) THEN ba.b_score ELSE pk.plain_score END AS score
  FROM pk LEFT JOIN ba ON ba.vendor = pk.vendor AND ba.lpos = pk.lpos AND ba.rn = 1)"""


def none_ctes(grid: Grid) -> str:
    return f"""{plain_k_cte(Grid(start=grid.start, step=grid.step, band_lo=1.0, band_hi=1.0))},
res AS (SELECT vendor, lpos, plain_k AS match_k, rpos AS match_pos, plain_score AS score FROM pk)"""


def label(k: str) -> str:
    return f"printf('%.2f', {k} / 100.0)"


def cascade_view() -> str:
    return (f"SELECT lpos AS left_pos, match_pos, match_k, {label('match_k')} AS threshold, "
            f"round(score, 6) AS score FROM res")




def rounds_cte(grid: Grid) -> str:
    """I5 expansion of ``res``: ``rnd`` rows, sentinel before the match round."""
    return f"""rnd AS (
  SELECT res.vendor, res.lpos AS left_pos, g.k, {label('g.k')} AS threshold,
         l.product_id AS left_product_id, l.product_name AS left_product_name,
         CASE WHEN g.k = res.match_k THEN r.product_id ELSE '' END AS right_product_id,
         CASE WHEN g.k = res.match_k THEN r.product_name ELSE '{NO_MATCH_NAME}' END AS right_product_name,
         CASE WHEN g.k = res.match_k THEN res.score ELSE 0.0 END AS score
  FROM res JOIN {grid_sql(grid)} g ON res.match_k IS NULL OR g.k >= res.match_k
  JOIN cl l ON l.pos = res.lpos
  LEFT JOIN cr r ON r.vendor = res.vendor AND r.pos = res.match_pos)"""


def exclusion_sql(policy: str, grid: Grid, assisted: bool = False, n_vendors: int = 1) -> str:
    """Cascade with right-row exclusion, one group of CTEs per round over one written pair table."""
    content = FIELDS + ["product_desc"]
    band = grid.band_ks
    same = "md5(concat_ws(chr(1), " + ", ".join(f"coalesce({c}, '')" for c in content) + "))"
    exact = (f"uni > 0 AND (100 * inter) % uni = 0 AND 100 * inter >= {min(band)} * uni "
             f"AND 100 * inter <= {max(band)} * uni")
    ctes = [base(n_vendors), f"ct AS MATERIALIZED (SELECT vendor, pos AS rpos, {same} AS content FROM cr)",
            "pm AS MATERIALIZED (SELECT * FROM pr)",
            "a0 AS MATERIALIZED (SELECT DISTINCT vendor, lpos FROM pm)", "p0 AS MATERIALIZED (SELECT * FROM ct)"]
    if assisted:
        ctes += [HITS, """hr AS (SELECT h.vendor, h.query_key, r.product_name AS r_name, r.product_desc AS r_desc
  FROM hits h JOIN (SELECT *, row_number() OVER (PARTITION BY vendor, product_id ORDER BY pos) AS rn FROM cr) r
    ON r.vendor = h.vendor AND r.product_id = h.product_id AND r.rn = 1)""",
                 f"""hp AS (SELECT e.vendor, e.lpos, l.product_name AS l_name, l.product_desc AS l_desc, hr.r_name, hr.r_desc
  FROM (SELECT DISTINCT vendor, lpos FROM pm WHERE {exact}) e JOIN cl l ON l.pos = e.lpos
  JOIN hr ON hr.vendor = e.vendor AND hr.query_key = l.product_id)""", embed_ctes("hp"),
                 "hs AS MATERIALIZED (SELECT vendor, lpos, max(sim) AS hit_sim FROM ps GROUP BY ALL)",
                 """hh AS MATERIALIZED (SELECT DISTINCT h.vendor, l.pos AS lpos FROM hits h
  JOIN cl l ON l.product_id = h.query_key)"""]
    else:
        ctes += [f"""dp AS (SELECT x.vendor, x.lpos, x.rpos, l.product_name AS l_name, l.product_desc AS l_desc,
  r.product_name AS r_name, r.product_desc AS r_desc FROM pm x JOIN cl l ON l.pos = x.lpos
  JOIN cr r ON r.pos = x.rpos WHERE {exact})""", embed_ctes("dp"),
                 "sm AS MATERIALIZED (SELECT vendor, lpos, rpos, sim FROM ps)"]
    accs = []
    for j, k in enumerate(grid.ks):
        live = f"pm JOIN a{j} USING (vendor, lpos) JOIN p{j} USING (vendor, rpos)"
        last = f"(SELECT max(rpos) FROM p{j} q WHERE q.vendor = y.vendor)"
        if k in band:
            ctes.append(f"""c{j} AS MATERIALIZED (SELECT vendor, lpos, min(rpos) AS first_pos, max(rpos) AS last_pos FROM {live}
  WHERE uni > 0 AND 100 * inter = {k} * uni GROUP BY ALL)""")
            if assisted:
                y = f"""SELECT c.*, hh.lpos IS NOT NULL AS has_hits, hs.hit_sim FROM c{j} c LEFT JOIN hh USING (vendor, lpos)
    LEFT JOIN hs USING (vendor, lpos)"""
                rec = "match_pos" if policy == "matched" else f"CASE WHEN has_hits THEN match_pos ELSE {last} END"
                body = f"""SELECT vendor, lpos, match_pos, score, {rec} AS rec_pos FROM (SELECT vendor, lpos, has_hits,
    CASE WHEN has_hits THEN first_pos ELSE last_pos END AS match_pos, CASE WHEN has_hits THEN hit_sim ELSE {k} / 100.0 END AS score
    FROM ({y}) WHERE NOT has_hits OR hit_sim >= {k} / 100.0) y"""
            else:
                body = f"""SELECT vendor, lpos, first_pos AS match_pos, sim AS score, first_pos AS rec_pos
  FROM c{j} c JOIN sm USING (vendor, lpos) WHERE sm.rpos = c.first_pos AND sim >= {k} / 100.0"""
        else:
            rec = "match_pos" if policy == "matched" else last
            body = f"""SELECT vendor, lpos, match_pos, score, {rec} AS rec_pos FROM (SELECT vendor, lpos, rpos AS match_pos,
    CASE WHEN uni > 0 THEN inter::DOUBLE / uni ELSE 0.0 END AS score, row_number() OVER (PARTITION BY vendor, lpos ORDER BY
      CASE WHEN uni > 0 THEN inter::DOUBLE / uni ELSE 0.0 END DESC, rpos DESC) AS rn FROM {live}
    WHERE 100 * inter >= {k} * greatest(uni, 1)) y WHERE rn = 1"""
        ctes.append(f"m{j} AS MATERIALIZED ({body})")
        accs.append(f"SELECT vendor, lpos, match_pos, score, {k} AS match_k FROM m{j}")
        if k != grid.ks[-1]:
            ctes.append(f"""a{j + 1} AS MATERIALIZED (SELECT * FROM a{j} ANTI JOIN m{j} USING (vendor, lpos)),
p{j + 1} AS MATERIALIZED (SELECT * FROM p{j} ANTI JOIN (SELECT ct.vendor, ct.content FROM m{j}
  JOIN ct ON ct.vendor = m{j}.vendor AND ct.rpos = m{j}.rec_pos) g USING (vendor, content))""")
    ctes.append("res AS (SELECT a0.vendor, a0.lpos, m.match_pos, m.score, m.match_k FROM a0 LEFT JOIN ("
                + " UNION ALL ".join(accs) + ") m USING (vendor, lpos))")
    view = cascade_view()
    return ",\n".join(ctes) + "\n" + (view if n_vendors == 1 else view.replace("SELECT ", "SELECT vendor, ", 1))


def pages_links() -> str:
    return """SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href,
       unnest(generate_series(1, len(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)))) AS rank
FROM pages"""


AD_RE = r"""'(?s)<div\b[^>]*\bclass="(?:[^"]*\s)?ad(?:\s[^"]*)?"[^>]*>(.*?)</div>'"""


def element_text_sql(x: str) -> str:
    s = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]:
        s = f"replace({s}, '{ent}', '{ch}')"
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def pages_ids() -> str:
    return f"""SELECT page_id, unnest(regexp_extract_all(html, {AD_RE}, 1)) AS inner_html,
       unnest(generate_series(1, len(regexp_extract_all(html, {AD_RE}, 1)))) AS rank
FROM pages"""


def build() -> dict[str, str]:
    g = Grid()
    q: dict[str, str] = {}
    q["clean_name"] = f"WITH {CAT} SELECT pos, {clean_sql('product_name')} AS clean_name FROM cat"
    q["word_set"] = (f"WITH {CAT}, w AS (SELECT pos, {words_sql('product_name')} AS w FROM cat) "
                     "SELECT pos, array_to_string(list_sort(w), ' ') AS word_set, len(w) AS n_words FROM w")
    q["colors"] = f"WITH {CAT} SELECT pos, {colors_sql('product_name')} AS colors FROM cat"
    q["measures"] = f"WITH {CAT} SELECT pos, {measures_sql('product_name')} AS measures FROM cat"
    q["jaccard_pairs"] = (base() + " SELECT lpos AS left_pos, rpos AS right_pos, inter, uni, "
                          "round(inter::DOUBLE / uni, 6) AS score FROM pr WHERE inter > 0 AND 100 * inter >= 30 * uni")
    sel17 = ", ".join([f"l.{f} AS Base_{f}" for f in FIELDS] + [f"r.{f} AS Alpha_{f}" for f in FIELDS])
    q["best_match_floor"] = (base() + f" SELECT {sel17}, round(b.inter::DOUBLE / b.uni, 6) AS Alpha_Match_Score "
                             "FROM bst b JOIN cl l ON l.pos = b.lpos JOIN cr r ON r.pos = b.rpos "
                             "WHERE b.uni > 0 AND 100 * b.inter >= 41 * b.uni")
    agree = (f"CASE WHEN {colors_sql('l.product_name')} = {colors_sql('r.product_name')} AND "
             f"{measures_sql('l.product_name')} = {measures_sql('r.product_name')} THEN '{AGREE_BOTH}' "
             f"WHEN {colors_sql('l.product_name')} = {colors_sql('r.product_name')} THEN '{AGREE_COLORS_ONLY}' "
             f"ELSE '{AGREE_NONE}' END")
    q["agreement_label"] = (base() + f" SELECT b.lpos AS left_pos, b.rpos AS right_pos, {agree} AS agreement "
                            "FROM bst b JOIN cl l ON l.pos = b.lpos JOIN cr r ON r.pos = b.rpos")
    q["sentinel_left_outer"] = (base() + " SELECT b.lpos AS left_pos, "
                                "CASE WHEN ok THEN r.product_id ELSE '' END AS right_product_id, "
                                f"CASE WHEN ok THEN r.product_name ELSE '{NO_MATCH_NAME}' END AS right_product_name, "
                                "CASE WHEN ok THEN round(b.inter::DOUBLE / b.uni, 6) ELSE 0.0 END AS score "
                                "FROM (SELECT *, uni > 0 AND 100 * inter >= 50 * uni AS ok FROM bst) b "
                                "JOIN cr r ON r.pos = b.rpos")
    q["desc_lookup"] = (f"WITH {CAT}, f AS (SELECT product_id, product_desc FROM (SELECT *, row_number() OVER "
                        "(PARTITION BY product_id ORDER BY pos) AS rn FROM cat WHERE pos % 2 = 0) WHERE rn = 1) "
                        "SELECT c.pos, c.product_id, coalesce(f.product_desc, '') AS desc_by_id "
                        "FROM cat c JOIN f ON f.product_id = c.product_id WHERE c.pos % 2 = 0")
    exact = ("SELECT vendor, lpos, rpos, (100 * inter) // uni AS k FROM pr WHERE uni > 0 AND inter > 0 "
             "AND (100 * inter) % uni = 0 AND (100 * inter) // uni BETWEEN 30 AND 40")
    q["exact_score_band"] = base() + f" SELECT lpos AS left_pos, rpos AS right_pos, k::INTEGER AS k FROM ({exact})"
    q["first_in_band"] = (base() + f" SELECT lpos AS left_pos, k::INTEGER AS k, min(rpos) AS right_pos "
                          f"FROM ({exact}) GROUP BY ALL")
    q["last_in_band"] = (base() + f" SELECT lpos AS left_pos, k::INTEGER AS k, max(rpos) AS right_pos "
                         f"FROM ({exact}) GROUP BY ALL")
    q["stopword_filter"] = (f"SELECT doc_id, array_to_string(t, ' ') AS filtered, len(t) AS n_tokens FROM "
                            f"(SELECT doc_id, {filtered_tokens_sql('text')} AS t FROM documents)")
    ex = "SELECT vec_id, label, embedding, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding) AS value FROM embeddings"
    q["pool_mean"] = f"SELECT label, dim, round(avg(value::DOUBLE), 6) AS value FROM ({ex}) GROUP BY ALL"
    q["pool_max"] = f"SELECT label, dim, round(max(value::DOUBLE), 6) AS value FROM ({ex}) GROUP BY ALL"
    q["pool_cls"] = (f"SELECT label, dim, round(value::DOUBLE, 6) AS value FROM ({ex}) x WHERE vec_id = "
                     "(SELECT min(vec_id) FROM embeddings e WHERE e.label = x.label)")
    q["l2_normalize"] = (f"SELECT vec_id, dim, round(CASE WHEN n > 0 THEN value::DOUBLE / n ELSE 0.0 END, 6) AS value "
                         f"FROM (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n "
                         f"FROM ({ex}))")
    dbl = "list_transform({0}, lambda x: x::DOUBLE)"
    q["cosine_pairs"] = (f"SELECT a.vec_id, b.vec_id AS next_id, round({cos_sql(dbl.format('a.embedding'), dbl.format('b.embedding'))}, 6) "
                         "AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
    q["semantic_pair_score"] = (base() + ", sp AS (SELECT l.pos AS left_pos, r.pos AS right_pos, l.product_name AS l_name, "
                                "l.product_desc AS l_desc, r.product_name AS r_name, r.product_desc AS r_desc "
                                "FROM cl l JOIN cr r ON r.pos = l.pos + 1), " + embed_ctes("sp") +
                                " SELECT left_pos, right_pos, round(title_sim, 6) AS title_sim, round(desc_sim, 6) AS desc_sim, "
                                "round(sim, 6) AS score FROM ps")
    band_view = " SELECT lpos AS left_pos, match_k, match_pos, round(score, 6) AS score FROM res WHERE match_k BETWEEN 30 AND 40"
    q["direct_band"] = base() + ",\n" + direct_ctes(g) + band_view
    q["assisted_band"] = base() + ",\n" + assisted_ctes(g) + band_view
    q["nohit_fallback"] = (base() + ",\n" + assisted_ctes(g) + band_view +
                           " AND lpos NOT IN (SELECT CAST(substr(query_key, 2) AS BIGINT) FROM hits)")
    q["hit_lookup"] = (base() + ",\n" + HITS + " SELECT h.query_key, h.rank, h.product_id, r.pos AS right_pos, "
                       "r.product_name AS right_name FROM hits h JOIN (SELECT *, row_number() OVER "
                       "(PARTITION BY product_id ORDER BY pos) AS rn FROM cr) r ON r.product_id = h.product_id AND r.rn = 1")
    q["cascade_none"] = base() + ",\n" + none_ctes(g) + " " + cascade_view()
    q["cascade_none_banded"] = base() + ",\n" + direct_ctes(g) + " " + cascade_view()
    q["cascade_matched"] = exclusion_sql("matched", g)
    q["cascade_last_scanned"] = exclusion_sql("last_scanned", g)
    q["assisted_excluding"] = exclusion_sql("matched", g, assisted=True)
    q["multi_vendor_excluding"] = exclusion_sql("matched", g, n_vendors=6)
    q["round_output"] = (base() + ",\n" + direct_ctes(g) + ",\n" + rounds_cte(g) +
                         " SELECT left_pos, threshold, right_product_id, right_product_name, round(score, 6) AS score FROM rnd")
    q["consolidate_by_left"] = (base() + ",\n" + direct_ctes(g) + ",\n" + rounds_cte(g) +
                                " SELECT left_product_id, left_product_name, threshold, right_product_id, right_product_name, "
                                "round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY left_product_name, "
                                "left_product_id ORDER BY threshold, left_pos) AS rn FROM rnd) WHERE rn = 1")
    q["round_files_merge"] = (base() + ",\n" + direct_ctes(g) + ",\n" + rounds_cte(g) +
                              " SELECT left_product_id, threshold, right_product_id, round(score, 6) AS score FROM "
                              "(SELECT *, row_number() OVER (PARTITION BY left_product_name, left_product_id "
                              "ORDER BY threshold, left_pos) AS rn FROM rnd) WHERE rn = 1")
    q["consolidate_by_pair"] = (base() + ",\n" + direct_ctes(g) +
                                ", m AS (SELECT l.product_id AS left_product_id, r.product_id AS right_product_id, "
                                "res.lpos AS left_pos, res.match_k, res.score FROM res JOIN cl l ON l.pos = res.lpos "
                                "JOIN cr r ON r.pos = res.match_pos WHERE res.match_k IS NOT NULL) "
                                "SELECT left_product_id, right_product_id, left_pos, match_k, round(score, 6) AS score FROM "
                                "(SELECT *, row_number() OVER (PARTITION BY left_product_id, right_product_id "
                                "ORDER BY match_k DESC, left_pos) AS rn FROM m) WHERE rn = 1")
    eq = " AND ".join(f"q.{c} IS NOT DISTINCT FROM r.{c}" for c in ["vendor"] + FIELDS + ["product_desc"])
    q["right_exclusion"] = (base() + ", rec AS (SELECT r.* FROM bst b JOIN cr r ON r.pos = b.rpos "
                            "WHERE b.uni > 0 AND 100 * b.inter >= 41 * b.uni) "
                            f"SELECT q.pos, q.product_id FROM cr q WHERE NOT EXISTS (SELECT 1 FROM rec r WHERE {eq})")
    done = "(SELECT l.product_id, l.product_name FROM res JOIN cl l ON l.pos = res.lpos WHERE vendor = 'Alpha' AND match_k >= 50)"
    q["resume_skip"] = (base(2) + ",\n" + direct_ctes(g) + ",\n" + rounds_cte(g) +
                        " SELECT vendor, left_pos, threshold, right_product_id, round(score, 6) AS score FROM rnd "
                        f"WHERE vendor = 'Beta' OR (k < 50 AND left_product_id NOT IN (SELECT product_id FROM {done}) "
                        f"AND left_product_name NOT IN (SELECT product_name FROM {done}))")
    q["csv_roundtrip"] = (f"WITH {CAT} SELECT pos, product_id, product_name, coalesce(product_desc, '') AS product_desc "
                          "FROM cat WHERE pos % 2 = 1")
    q["csv_many_files"] = (f"WITH {CAT} SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, product_id, product_name, "
                           "coalesce(product_desc, '') AS product_desc FROM cat WHERE pos % 2 = 1")
    q["final_sink"] = (base(2) + ",\n" + direct_ctes(g) + " SELECT res.vendor, l.product_id AS left_product_id, "
                       "r.product_id AS right_product_id, round(res.score, 6) AS score FROM res JOIN cl l ON l.pos = res.lpos "
                       "JOIN cr r ON r.vendor = res.vendor AND r.pos = res.match_pos")
    q["round_file_count"] = (base(2) + ",\n" + direct_ctes(g) + ",\n" + rounds_cte(g) +
                             " SELECT count(DISTINCT vendor || threshold) AS n_files FROM rnd")
    q["score_text"] = (f"WITH {CAT} SELECT pos, CAST(regexp_extract(product_price, '\\d*\\.\\d*') AS DOUBLE) AS value FROM cat")
    q["truncated_tokens"] = (f"SELECT doc_id, array_to_string(t[1:126], ' ') AS kept, len(t) AS n_tokens FROM "
                             f"(SELECT doc_id, {tokens_sql('text')} AS t FROM documents)")
    q["assisted_by_name"] = (base() + ",\n" + assisted_ctes(g, by_name=True) + band_view)
    letters = ", ".join(f"list_avg(list_transform(w, lambda x: (len(x) - len(replace(x, '{c}', '')))::DOUBLE))" for c in "aeiost")
    q["encoder_udf"] = (f"WITH {CAT}, t AS (SELECT pos, {filtered_tokens_sql('product_name')} AS w FROM cat), "
                        f"v AS (SELECT pos, CASE WHEN len(w) = 0 THEN CAST([] AS DOUBLE[]) ELSE [{letters}] END AS v FROM t), "
                        "e AS (SELECT pos, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n, "
                        "unnest(range(len(v))) AS dim FROM v) "
                        "SELECT pos, dim::INTEGER AS dim, round(CASE WHEN n > 0 THEN v[dim + 1] / n ELSE 0.0 END, 6) AS value FROM e")
    li = "regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)"
    q["listing_rules"] = (
        f"WITH e AS (SELECT page_id, unnest({li}) AS t, unnest(generate_series(1, len({li}))) AS rank FROM pages), "
        "h AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t FROM pages) "
        f"SELECT page_id, 'contains' AS rule, rank, {element_text_sql('t')} AS value FROM e WHERE contains(t, '\"/th') "
        f"UNION ALL SELECT page_id, 'delimiter', 1, regexp_replace({after_sql(element_text_sql('t'), ' ')}, '^\\s+|\\s+$', '', 'g') FROM h "
        "UNION ALL SELECT page_id, 'nested', rank, "
        f"translate({element_text_sql('t')}, '()', '') FROM e")
    q["pointed_types"] = (f"WITH {pointed_types_ctes()} SELECT type, n_pointed, n_plain, round(score, 6) AS score, "
                          "score >= 0.3 AS abbreviation FROM pt")
    q["sentence_tokens"] = (
        f"WITH {pointed_types_ctes()}, kn AS (SELECT coalesce(list(type), []) AS known FROM pt WHERE score >= 0.3), "
        f"st AS (SELECT doc_id, {sentence_tokens_sql()} AS t FROM sw, kn) "
        "SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t) AS n_tokens FROM st")
    q["subword_limit"] = (
        f"WITH RECURSIVE {subword_ctes()} SELECT doc_id, "
        "array_to_string(list_concat([2], ids[1:126], [3]), ' ') AS ids, len(ids) AS n_subwords FROM ds")
    own = lambda j: f"(id * {2 * j + 3}) % 101 / 101.0 - 0.5"
    dims = " UNION ALL ".join(f"SELECT doc_id, {j} AS dim, max({own(j)}) + 0.5 * avg({own(j)}) AS v FROM pl GROUP BY doc_id"
                              for j in range(6))
    q["batched_encoder"] = (
        f"WITH RECURSIVE {subword_ctes()}, pl AS (SELECT doc_id, unnest(list_concat([2], ids[1:126], [3])) AS id FROM ds), "
        f"ev AS ({dims}) SELECT doc_id, dim, "
        "round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS value FROM ev")
    # what follows a start tag, up to the tag that ends the element, whether its own end tag or not
    block = "</(?:p|div|article|footer|nav|ul|body|html)>|<(?:article|div|footer|nav|ul|h1)[ >]|$"
    cut_at = lambda tag, ends: (
        f"SELECT page_id, unnest(list_transform(string_split(html, '<{tag}>')[2:], "
        f"lambda x: regexp_extract(x, '(?s)^(.*?)(?:{ends})', 1))) AS t, "
        f"unnest(range(1, len(string_split(html, '<{tag}>')))) AS rank FROM pages")
    q["listing_unclosed"] = (
        f"WITH p AS ({cut_at('p', block)}), b AS ({cut_at('b', '</b>|<p>|' + block)}), "
        f"n AS (SELECT page_id, rank, t FROM p WHERE contains(t, '<b>')) "
        f"SELECT page_id, 'p' AS rule, rank, {element_text_sql('t')} AS value FROM p "
        f"UNION ALL SELECT page_id, 'b', rank, {element_text_sql('t')} FROM b "
        "UNION ALL SELECT page_id, 'b in p', row_number() OVER (PARTITION BY page_id ORDER BY rank, i), "
        f"{element_text_sql('x')} "
        "FROM (SELECT page_id, rank, unnest(list_transform(string_split(t, '<b>')[2:], "
        "lambda x: regexp_extract(x, '(?s)^(.*?)(?:</b>|$)', 1))) AS x, "
        "unnest(range(1, len(string_split(t, '<b>')))) AS i FROM n)")
    q["listing_by_url"] = (f"WITH l AS ({pages_links()}), "
                           "d AS (SELECT page_id AS detail_page_id, 'https://shop.example/' || split_part(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), ' ', 1) AS key FROM pages), "
                           f"i AS (SELECT page_id AS detail_page_id, {element_text_sql('inner_html')} AS product_id FROM ({pages_ids()}) WHERE rank = 1) "
                           "SELECT l.page_id, l.rank, l.href, d.detail_page_id, i.product_id FROM l JOIN d ON d.key = 'https://shop.example' || l.href "
                           "JOIN i ON i.detail_page_id = d.detail_page_id")
    q["multi_vendor"] = (base(6) + ",\n" + direct_ctes(g) +
                         " SELECT vendor, lpos AS left_pos, match_pos, match_k, round(score, 6) AS score FROM res")
    q["listing_ids"] = (f"SELECT page_id, 'id' AS kind, rank, {element_text_sql('inner_html')} AS value FROM ({pages_ids()}) "
                        f"UNION ALL SELECT page_id, 'href' AS kind, rank, href AS value FROM ({pages_links()})")
    q["listing_two_hop"] = (f"WITH l AS ({pages_links()}), "
                            "d AS (SELECT page_id AS detail_page_id, '/' || split_part(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), ' ', 1) AS key FROM pages), "
                            f"i AS (SELECT page_id AS detail_page_id, {element_text_sql('inner_html')} AS product_id FROM ({pages_ids()}) WHERE rank = 1) "
                            "SELECT l.page_id, l.rank, l.href, d.detail_page_id, i.product_id FROM l JOIN d ON d.key = l.href "
                            "JOIN i ON i.detail_page_id = d.detail_page_id")
    return q


ORACLE = build()
