"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from .common import LOWER, UPPER

SPACE_CHARS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
WORD_RE = r"[^\x20\x09-\x0D]+"
TOKEN_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = f"'{UPPER}', '{LOWER}'"

ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM d),
k AS (SELECT *, translate(trim(line, {SPACE_CHARS}), {_LOWER}) AS line_key FROM l),
common AS (SELECT line_key FROM k WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.doc_id, k.i, k.line, common.line_key IS NOT NULL AS gone FROM k LEFT JOIN common ON k.line_key = common.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

ORACLES["op3_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{TOKEN_RE}') AS w FROM documents),
t AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{TOKEN_RE}') AS w FROM benchmark),
i0 AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM t WHERE len(w) > 0),
i1 AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g FROM i0),
sizes AS (SELECT DISTINCT n FROM i1),
d0 AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT d0.doc_id, d0.s, d0.n, i1.item_id FROM (SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g FROM d0) d0
  JOIN i1 ON d0.g = i1.g AND d0.n = i1.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN names ON d.doc_id = names.doc_id"""

_ESCAPES = r"\\|<s>|</s>|<\|turn\|>|<\|text\|>|\[INST\]|\[/INST\]"
ORACLES["op6_chat_formatting"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, 20 + length(role) + len(regexp_extract_all(role, '{_ESCAPES}')) + length(text) + len(regexp_extract_all(text, '{_ESCAPES}')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars))::BIGINT AS formatted_chars FROM s GROUP BY conv_id"""

ORACLES["op7_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD_RE}') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 34), ' ')) AS g FROM g),
twice AS (SELECT g FROM h GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 35)) AS p FROM h JOIN twice ON h.g = twice.g)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT words.doc_id, count(*) AS n_words, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS body
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

ORACLES["op9_url_filters"] = f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), {_LOWER}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT q.page_id, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY q.page_id ORDER BY length(r.host || r.path) DESC) AS place
  FROM q JOIN rules r ON (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path))
SELECT q.page_id, q.host, q.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM q LEFT JOIN (SELECT * FROM fits WHERE place = 1) f ON q.page_id = f.page_id"""

ORACLES["op10_mixing"] = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_RE}'))::BIGINT AS size,
  ('0x' || substr(md5('mix0|' || doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight, source_size * 2::DOUBLE AS cap FROM s),
r AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap/weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap/weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY cap/weight, source) AS place FROM w),
f AS (SELECT level FROM r WHERE level * weight < cap ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN level * weight >= cap THEN cap ELSE least(cap, (SELECT level FROM f) * weight) END AS target FROM r),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, b.source_size, b.target, b.whole::BIGINT AS whole, b.target - b.whole * b.source_size AS budget,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  size * (whole + CASE WHEN whole < 2 AND (upto < budget OR upto - size < budget AND (budget - upto + size) * 2 >= size) THEN 1 ELSE 0 END) END::BIGINT AS taken FROM c"""

ORACLES["op2_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, s, substr(x, 2 * s + 1, 100) AS g FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS s FROM d WHERE length(x) >= 100)),
least_ids AS (SELECT g, min(doc_id) AS least_id FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
r AS (SELECT w.doc_id, w.s, w.s > lag(w.s) OVER (PARTITION BY w.doc_id ORDER BY w.s) + 50 AS apart FROM w JOIN least_ids ON w.g = least_ids.g WHERE w.doc_id > least_id),
i AS (SELECT doc_id, s, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM r),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM i GROUP BY doc_id, island),
gaps AS (SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte, a AS to_byte FROM spans
  UNION ALL SELECT doc_id, NULL, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (SELECT gaps.doc_id, string_agg(substr(x, 2 * from_byte + 1, 2 * (coalesce(to_byte, length(x) // 2) - from_byte)), '' ORDER BY from_byte) AS k
  FROM gaps JOIN d ON gaps.doc_id = d.doc_id GROUP BY gaps.doc_id),
n AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id"""

ORACLES["op8_near_dedup"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{WORD_RE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM
  (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
k AS (SELECT x, y FROM p JOIN n nx ON p.x = nx.doc_id JOIN n ny ON p.y = ny.doc_id WHERE 100 * common >= 85 * (nx.n + ny.n - common)),
e AS (SELECT x, y FROM k UNION ALL SELECT y, x FROM k),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON c.doc_id = n.doc_id"""

ORACLES["op11_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
    WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(list_slice(u, 1, least(x, y)), '') AS prefix, array_to_string(list_slice(u, least(x, y) + 1, greatest(x, y)), '') AS middle,
  array_to_string(list_slice(u, greatest(x, y) + 1, n), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

ORACLES["op13_warc_revisits"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p),
v AS (SELECT *, list_transform(range(8), lambda g: ('0x' || substr(h, (g * 5 + 1)::BIGINT, 5))::BIGINT) AS v FROM h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(list_transform(range(32),
  lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[(i // 4 + 1)::BIGINT] >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM v"""
