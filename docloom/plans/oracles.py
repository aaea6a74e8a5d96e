"""DuckDB SQL of the catalogue: written on its own, in plain SQL, from the definitions of the operators."""

from __future__ import annotations

NL = "chr(10)"


def norm_title(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(trim({x})), '^(the|a|an)\s+', ''), '[^a-z0-9]+', ' ', 'g'))"


def tokens(x: str) -> str:
    return rf"CAST(CASE WHEN coalesce({x}, '') = '' THEN 0 ELSE greatest(1, ceil(len(regexp_extract_all({x}, '\S+')) * 1.3::DOUBLE)) END AS INTEGER)"


def canonical_key(x: str) -> str:
    one = "CASE WHEN len(t) > 3 AND t LIKE '%ies' THEN t[:-4] || 'y' WHEN len(t) > 4 AND t LIKE '%es' AND t NOT LIKE '%ses' AND t NOT LIKE '%zes' THEN t[:-3] WHEN len(t) > 3 AND t LIKE '%s' AND t NOT LIKE '%ss' THEN t[:-2] ELSE t END"
    bare = rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({x}, ''))), '[''’]s\b', '', 'g'), '^(the|a|an)\s+', ''), '[^a-z0-9]+', ' ', 'g'))"
    return f"array_to_string(list_transform(list_filter(string_split({bare}, ' '), lambda w: w <> ''), lambda t: {one}), ' ')"


def slug(x: str) -> str:
    return f"coalesce(nullif(substr(lower(regexp_replace(regexp_replace({x}, '[^a-zA-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')), 1, 48), ''), 'section')"


def spec(rich: bool = True) -> str:
    number = "CAST({0} // 3 + 1 AS VARCHAR) || (['', '.1', '.1.1'])[{0} % 3 + 1]"
    body = f"{NL} || {NL} || line || ' See Section ' || dest || '.'"
    if rich:
        two = f"{NL} || {NL}"
        body = f"""CASE WHEN p % 9 = 8 THEN '' ELSE {body}
            || CASE WHEN p % 5 = 0 THEN {two} || 'Table ' || p || ': values of ' || title ELSE '' END
            || CASE WHEN p % 5 = 1 THEN {two} || 'Figure ' || p || ': view of ' || title || {two} || 'As Table ' || (p - 1) || ' says.' ELSE '' END
            || CASE WHEN p % 4 = 0 THEN {two} || '| name | value |' || {NL} || '| --- | --- |' || {NL} || '| ' || num || ' | a |' || {NL} || '| b | ' || dest || ' |' ELSE '' END
            || CASE WHEN p % 6 = 0 THEN {two} || 'It is defined in ' || title || '.' ELSE '' END
            || CASE WHEN p % 7 = 0 THEN {two} || 'The unit shall answer. It works.' ELSE '' END END"""
    return f"""
    l0 AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) - 1 AS p FROM documents),
    l1 AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM l0),
    l2 AS (SELECT doc_id, p, line, {number.format('p')} AS num, {number.format('((p * 7 + 3) % n)')} AS dest,
             'T' || array_to_string(list_filter(string_split(regexp_replace(line, '[^A-Za-z ]', '', 'g'), ' '), lambda w: w <> '')[1:3], ' ') || ' x' AS title FROM l1),
    spec AS (SELECT doc_id, 'Doc ' || doc_id AS doc_title, string_agg(repeat('#', CAST(p % 3 + 1 AS INTEGER)) || ' ' || num || ' ' || title || {body}, {NL} || {NL} ORDER BY p) AS md FROM l2 GROUP BY doc_id),"""


LINES = f"lines AS (SELECT doc_id, CAST(generate_subscripts(string_split(md, {NL}), 1) - 1 AS INTEGER) AS pos, unnest(string_split(md, {NL})) AS line FROM spec),"
HEADS = r"""
    heads AS (SELECT doc_id, pos AS sec_pos, len(regexp_extract(line, '^(#{1,6})\s+(.*\S)\s*$', 1)) AS level, regexp_extract(line, '^(#{1,6})\s+(.*\S)\s*$', 2) AS raw_title FROM lines WHERE regexp_matches(line, '^(#{1,6})\s+(.*\S)\s*$')),
    secs AS (SELECT *, nullif(regexp_extract(raw_title, '^\s*(\d+(?:\.\d+)*)\.?\s+(.*\S)\s*$', 1), '') AS number,
               coalesce(nullif(trim(regexp_extract(raw_title, '^\s*(\d+(?:\.\d+)*)\.?\s+(.*\S)\s*$', 2)), ''), raw_title) AS title FROM heads),"""
# the kinds of lines, then islands of equal kinds
BLOCKS = rf"""
    k0 AS (SELECT *, regexp_matches(line, '^(#{{1,6}})\s+(.*\S)\s*$') AS heading, contains(line, '|') AND NOT starts_with(trim(line), '#') AS bar,
             regexp_matches(line, '^\s*\|?\s*:?-{{2,}}:?\s*(\|\s*:?-{{2,}}:?\s*)*\|?\s*$') AS rule, trim(line) = '' AS blank FROM lines),
    k1 AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, bar ORDER BY pos) AS run, lead(bar) OVER w AND lead(rule) OVER w AND bar AS head FROM k0 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    k2 AS (SELECT *, bar AND pos >= min(CASE WHEN head THEN pos END) OVER (PARTITION BY doc_id, bar, run) AS in_table FROM k1),
    k3 AS (SELECT *, CASE WHEN heading THEN 'heading' WHEN in_table THEN 'table' WHEN blank THEN 'blank' ELSE 'text' END AS kind FROM k2),
    k4 AS (SELECT *, CASE WHEN kind = 'heading' OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY doc_id ORDER BY pos) THEN 1 ELSE 0 END AS starts FROM k3),
    k5 AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM k4),
    blocks AS (SELECT doc_id, min(pos) AS pos, any_value(kind) AS kind, string_agg(line, {NL} ORDER BY pos) AS text FROM k5 WHERE kind <> 'blank' GROUP BY doc_id, block),"""
# parents by definition, breadcrumbs by recursion
TREE = """
    up AS (SELECT s.doc_id, s.sec_pos, coalesce((SELECT max(b.sec_pos) FROM secs b WHERE b.doc_id = s.doc_id AND b.sec_pos < s.sec_pos AND b.level < s.level), -1) AS parent_pos FROM secs s),
    nodes AS (SELECT s.doc_id, s.sec_pos, CAST(s.level AS INTEGER) AS level, s.raw_title, s.title, s.number, CAST(u.parent_pos AS INTEGER) AS parent_pos FROM secs s JOIN up u ON s.doc_id = u.doc_id AND s.sec_pos = u.sec_pos),
    trail AS (SELECT doc_id, -1 AS sec_pos, doc_title AS crumbs FROM spec UNION ALL SELECT n.doc_id, n.sec_pos, t.crumbs || ' > ' || n.title FROM trail t JOIN nodes n ON n.doc_id = t.doc_id AND n.parent_pos = t.sec_pos),
    tree AS (SELECT n.*, t.crumbs FROM nodes n JOIN trail t ON n.doc_id = t.doc_id AND n.sec_pos = t.sec_pos
             UNION ALL SELECT doc_id, -1, 0, doc_title, doc_title, NULL, NULL, doc_title FROM spec),"""
CHUNKS = f"""
    owned AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'heading' THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS sec_pos FROM blocks),
    bodies AS (SELECT doc_id, sec_pos, string_agg(text, {NL} || {NL} ORDER BY pos) AS body FROM owned WHERE kind <> 'heading' AND trim(text) <> '' GROUP BY doc_id, sec_pos),
    c0 AS (SELECT t.*, trim('> Context: ' || t.crumbs || {NL} || {NL} || CASE WHEN level = 0 THEN '' ELSE repeat('#', level) || ' ' || raw_title || {NL} || {NL} END || body) AS text,
             CAST(row_number() OVER (PARTITION BY t.doc_id ORDER BY t.sec_pos) AS INTEGER) AS ord FROM tree t JOIN bodies b ON t.doc_id = b.doc_id AND t.sec_pos = b.sec_pos),
    chunks AS (SELECT doc_id, ord, lpad(CAST(ord AS VARCHAR), CAST(greatest(4, len(CAST(ord AS VARCHAR))) AS INTEGER), '0') || '__' || {slug("coalesce(number || '-', '') || title")} || '__' || substr(sha1(crumbs || '#p1'), 1, 6) AS chunk_id,
             title, crumbs AS breadcrumb, number AS section_no, level, {tokens('text')} AS token_count, text FROM c0),"""


def _numbered(detector: int, kind: str, pattern: str, index: str) -> str:
    return rf"""
    f{detector} AS (SELECT doc_id, ord, chunk_id, unnest(regexp_extract_all(text, '{pattern}', 0)) AS raw, unnest(regexp_extract_all(text, '{pattern}', 1)) AS number, generate_subscripts(regexp_extract_all(text, '{pattern}', 0), 1) AS occ FROM chunks),
    r{detector} AS (SELECT f.doc_id, f.ord, f.chunk_id, {detector} AS detector, occ, '{kind}' AS edge_type, trim(raw) AS raw, f.number, i.dest FROM f{detector} f LEFT JOIN {index} i ON f.doc_id = i.doc_id AND f.number = i.number),"""


def _caption(kind: str) -> str:
    return rf"""
    {kind}_cap AS (SELECT doc_id, number, arg_min(chunk_id, ord) AS dest FROM (SELECT doc_id, ord, chunk_id, unnest(regexp_extract_all(text, '(?im)^\s*{kind}\s+(\d+(?:[.\-]\d+)*)\s*[:.\-–—]', 1)) AS number FROM chunks) GROUP BY doc_id, number),"""


PHRASES = ["values of", "the unit", "view of"]
INDEXES = f"""
    sec_idx AS (SELECT doc_id, section_no AS number, arg_min(chunk_id, ord) AS dest FROM chunks WHERE section_no IS NOT NULL GROUP BY doc_id, section_no),
    title_idx AS (SELECT doc_id, norm, arg_min(chunk_id, ord) AS dest FROM (SELECT *, {norm_title('title')} AS norm FROM chunks) WHERE norm <> '' GROUP BY doc_id, norm),{_caption('figure')}{_caption('table')}"""
CUES = rf"""
    q0 AS (SELECT doc_id, ord, chunk_id, generate_subscripts(m, 1) AS occ, rtrim(trim(unnest(m)), '.,;:') AS raw FROM (SELECT *, regexp_extract_all(text, '\b(?:see|refer to|refer|defined in|specified in|described in|listed in)\s+([A-Z][A-Za-z0-9][A-Za-z0-9 ,/()\-]{{2,60}})', 1) AS m FROM chunks)),
    q1 AS (SELECT *, {norm_title('raw')} AS norm, string_split({norm_title('raw')}, ' ') AS words FROM q0),
    q2 AS (SELECT doc_id, ord, chunk_id, occ, raw, norm AS tried, 1000 AS size FROM q1 UNION ALL SELECT doc_id, ord, chunk_id, occ, raw, array_to_string(words[1:k], ' '), k FROM (SELECT *, unnest(range(2, len(words) + 1)) AS k FROM q1)),
    r4 AS (SELECT q.doc_id, q.ord, q.chunk_id, 4 AS detector, occ, 'references_named' AS edge_type, raw, NULL AS number, arg_max(dest, size) AS dest FROM q2 q JOIN title_idx i ON q.doc_id = i.doc_id AND q.tried = i.norm GROUP BY q.doc_id, q.ord, q.chunk_id, occ, raw),"""
NAMED = f"""
    given(i, raw) AS (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(PHRASES))}),
    r3 AS (SELECT c.doc_id, c.ord, c.chunk_id, 3 AS detector, g.i AS occ, 'references_named' AS edge_type, g.raw, NULL AS number, t.dest FROM chunks c JOIN given g ON contains({norm_title('c.text')}, {norm_title('g.raw')}) LEFT JOIN title_idx t ON t.doc_id = c.doc_id AND t.norm = {norm_title('g.raw')}),"""
REFS = (
    _numbered(0, "references_section", r"(?i)\b(?:section|clause|subclause|§)\s*(\d+(?:\.\d+)*)", "sec_idx")
    + _numbered(1, "references_figure", r"(?i)\bfigure\s+(\d+(?:[.\-]\d+)*)", "figure_cap")
    + _numbered(2, "references_table", r"(?i)\btable\s+(\d+(?:[.\-]\d+)*)", "table_cap")
)


def edges(detectors: str) -> str:
    parts = " UNION ALL ".join(f"SELECT doc_id, ord, chunk_id, detector, occ, edge_type, raw, CAST(number AS VARCHAR) AS number, dest FROM r{d}" for d in detectors)
    return f"""
    e0 AS ({parts}),
    e1 AS (SELECT * FROM e0 QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_id, edge_type, coalesce(dest, lower(raw)) ORDER BY detector, occ) = 1),
    edges AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord, detector, occ) AS BIGINT) AS edge_ord, chunk_id AS src_chunk_id, CASE WHEN dest <> chunk_id THEN dest END AS dst_chunk_id, edge_type, raw AS ref_text,
               coalesce(dest <> chunk_id, false) AS resolved, CAST(CASE edge_type WHEN 'references_section' THEN 1.0 WHEN 'references_named' THEN 0.8 ELSE 0.9 END AS DOUBLE) AS weight FROM e1),"""


PARSED = spec() + LINES + HEADS + BLOCKS + TREE
CHUNKED = PARSED + CHUNKS
LINKED = CHUNKED + INDEXES + REFS + CUES + NAMED + edges("01234")


# titles as runs of pieces (words and what stands between them); the spans that count, one after the other, by recursion
_PIECES = r"regexp_extract_all({0}, '[\pL\pN_]+|[^\pL\pN_]+')"
MENTIONED = rf"""
    voc AS (SELECT doc_id, lower(title) AS gram, len({_PIECES.format('title')}) AS size, min((-len(norm), title)) AS rank FROM (SELECT *, {norm_title('title')} AS norm FROM chunks) WHERE len(norm) >= 6 AND norm NOT IN ('introduction', 'overview', 'scope', 'general', 'notes', 'definitions', 'description', 'references', 'requirements') GROUP BY ALL),
    cut AS (SELECT doc_id, chunk_id, {_PIECES.format('text')} AS p FROM chunks),
    sized AS (SELECT c.*, s.size FROM cut c JOIN (SELECT DISTINCT doc_id, size FROM voc) s ON c.doc_id = s.doc_id),
    placed AS (SELECT doc_id, chunk_id, size, i - 1 AS place, array_to_string(p[i:i + size - 1], '') AS name FROM (SELECT *, unnest(range(1, len(p) - size + 2)) AS i FROM sized)
               WHERE (i > 1 OR regexp_matches(p[i], '^[\pL\pN_]')) AND (i + size - 1 < len(p) OR regexp_matches(p[i + size - 1], '^[\pL\pN_]'))),
    cands AS (SELECT p.doc_id, p.chunk_id, p.place, arg_min(p.size, v.rank) AS size, arg_min(p.name, v.rank) AS name FROM placed p JOIN voc v ON p.doc_id = v.doc_id AND p.size = v.size AND lower(p.name) = v.gram GROUP BY p.doc_id, p.chunk_id, p.place),
    following AS (SELECT c.doc_id, c.chunk_id, c.place, c.name, c.place + c.size AS stop, (SELECT min(d.place) FROM cands d WHERE d.doc_id = c.doc_id AND d.chunk_id = c.chunk_id AND d.place >= c.place + c.size) AS nxt FROM cands c),
    walk AS (SELECT * FROM following f WHERE f.place = (SELECT min(d.place) FROM cands d WHERE d.doc_id = f.doc_id AND d.chunk_id = f.chunk_id) UNION ALL SELECT f.* FROM walk w JOIN following f ON f.doc_id = w.doc_id AND f.chunk_id = w.chunk_id AND f.place = w.nxt),
    m0 AS (SELECT w.doc_id, w.chunk_id, w.place, w.name, {norm_title('w.name')} AS norm, {norm_title('c.title')} AS own FROM walk w JOIN chunks c ON c.doc_id = w.doc_id AND c.chunk_id = w.chunk_id),
    m1 AS (SELECT doc_id, chunk_id, norm, min(place) AS place, arg_min(name, place) AS name FROM m0 WHERE norm <> '' AND norm <> own GROUP BY doc_id, chunk_id, norm),
    m2 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_id ORDER BY place) AS pos FROM m1 QUALIFY pos <= 40),
    m3 AS (SELECT src_chunk_id AS chunk_id, doc_id, dst_chunk_id AS dest, row_number() OVER (PARTITION BY doc_id, src_chunk_id ORDER BY edge_ord) AS ref_pos, ref_text, resolved FROM edges),
    mentioned AS (SELECT m2.doc_id, m2.chunk_id, CAST(pos AS INTEGER) AS mention_pos, name, 'title_vocab' AS source, t.dest AS canonical_id FROM m2 LEFT JOIN title_idx t ON t.doc_id = m2.doc_id AND t.norm = m2.norm
                  UNION ALL SELECT doc_id, chunk_id, CAST(40 + min(ref_pos) AS INTEGER), arg_min(ref_text, ref_pos), 'xref', dest FROM m3 WHERE resolved GROUP BY doc_id, chunk_id, dest),"""


def with_(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip().rstrip(',')} {select}"


GRAPH = """
    owned_by AS (SELECT 'C' || o_custkey AS c, 'P' || l_partkey AS p, 'S' || l_suppkey AS s, l_returnflag <> 'R' AS ok FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    g0 AS (SELECT c AS src, p AS dst, 'references_section' AS edge_type, ok, 1.0::DOUBLE AS weight FROM owned_by UNION ALL SELECT p, s, 'references_named', ok, 0.8::DOUBLE FROM owned_by),
    g1 AS (SELECT src, dst, edge_type, weight, bool_or(ok) AS resolved, 'ref ' || dst AS via, CAST('0x' || substr(md5(src || '/' || dst), 1, 12) AS BIGINT) AS edge_ord FROM g0 GROUP BY src, dst, edge_type, weight),
    g2 AS (SELECT src AS node, dst AS nb, 0 AS dir, edge_ord, via, edge_type, weight FROM g1 WHERE resolved UNION ALL SELECT dst, src, 1, edge_ord, via, edge_type, weight FROM g1 WHERE resolved),
    seeds AS (SELECT c_nationkey AS query_id, 'C' || c_custkey AS node, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS pos FROM customer QUALIFY pos <= 20),
    h1a AS (SELECT query_id, nb AS chunk_id, dir, edge_ord, via, edge_type, s.pos AS ppos, (21 - s.pos)::DOUBLE * 0.5 * weight AS score FROM seeds s JOIN g2 ON g2.node = s.node),
    h1b AS (SELECT * FROM h1a h WHERE NOT EXISTS (SELECT 1 FROM seeds s WHERE s.query_id = h.query_id AND s.node = h.chunk_id) QUALIFY row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY ppos, dir, edge_ord) = 1),
    h1 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ppos, dir, edge_ord) AS found_pos, 1 AS hop FROM h1b),
    h2a AS (SELECT h.query_id, nb AS chunk_id, g2.dir, g2.edge_ord, g2.via, g2.edge_type, h.found_pos AS ppos, h.score * 0.25 * weight AS score FROM h1 h JOIN g2 ON g2.node = h.chunk_id),
    h2b AS (SELECT * FROM h2a h WHERE NOT EXISTS (SELECT 1 FROM seeds s WHERE s.query_id = h.query_id AND s.node = h.chunk_id) AND NOT EXISTS (SELECT 1 FROM h1 WHERE h1.query_id = h.query_id AND h1.chunk_id = h.chunk_id)
            QUALIFY row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY ppos, dir, edge_ord) = 1),
    h2 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ppos, dir, edge_ord) AS found_pos, 2 AS hop FROM h2b),
    hits AS (SELECT query_id, chunk_id, hop, CASE dir WHEN 0 THEN 'xref_out' ELSE 'xref_in' END AS direction, via, edge_type, score, found_pos FROM h1 UNION ALL SELECT query_id, chunk_id, hop, CASE dir WHEN 0 THEN 'xref_out' ELSE 'xref_in' END, via, edge_type, score, found_pos FROM h2),"""
NAMES = """
    n0 AS (SELECT DISTINCT p_name AS n FROM part),
    n1 AS (SELECT n, unnest([n, 'the ' || n, upper(string_split(n, ' ')[1][1]) || lower(string_split(n, ' ')[1][2:]) || CASE WHEN contains(n, ' ') THEN ' ' || upper(string_split(n, ' ')[2][1]) || lower(string_split(n, ' ')[2][2:]) ELSE '' END, n || 's', n || '''s', replace(n, ' ', '-'), string_split(n, ' ')[-1]]) AS name, unnest(range(0, 7)) AS v FROM n0),
    names AS (SELECT name, arg_min(n || '/' || v, (n, v)) AS ord, md5(name) AS id FROM n1 GROUP BY name),"""
