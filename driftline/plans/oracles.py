"""DuckDB SQL for the rows of ``catalogue``."""

from __future__ import annotations

from driftline.operators import work
from driftline.plans import workspace
from driftline.schema import STORY_LABELS

_PACKAGES = """docs AS (SELECT CAST(doc_id AS VARCHAR) AS uid, doc_id, sha256(coalesce(text, '')) AS jp FROM documents),
one AS (SELECT uid, CASE WHEN doc_id % 6 = 0 THEN jp || 'x' ELSE jp END AS src, CASE WHEN doc_id % 9 = 0 THEN '' ELSE 'p' || uid END AS value FROM docs WHERE doc_id % 3 = 0),
two AS (SELECT uid, jp AS src, 'f' || uid AS value FROM docs WHERE doc_id % 5 = 0)"""
_STATUS = f"""{_PACKAGES},
items AS (SELECT uid, coalesce(nullif(one.value, ''), two.value, '') AS existing_cn, CASE WHEN coalesce(one.value, '') = '' THEN two.src ELSE one.src END AS old, jp FROM docs LEFT JOIN one USING (uid) LEFT JOIN two USING (uid)),
status AS (SELECT uid, existing_cn, CASE WHEN existing_cn <> '' AND coalesce(old <> jp, false) THEN 'changed' WHEN existing_cn <> '' THEN 'existing' ELSE 'new' END AS status FROM items)"""
_TURNS = r"""turns AS (SELECT CAST(conv_id AS VARCHAR) AS file, CAST(turn + 1 AS INT) AS line, translate(coalesce(role, ''), '=[]{}', '＝［］｛｝') AS role, translate(trim(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n|\r|\n', '\\n', 'g'), '[^\x20-\x{10FFFF}]', ' ', 'g'), ' '), '=[]{}', '＝［］｛｝') AS said FROM conversations)"""
_WORK = """w AS (SELECT conv_id || ':' || turn AS uid, conv_id, turn, role, sha256(coalesce(text, '')) AS jp, CASE WHEN conv_id % 5 = 0 THEN 'master:' || conv_id WHEN conv_id % 2 = 0 AND coalesce(role, '') <> '' THEN 'resource:' || conv_id ELSE 'resource:flat' END AS gk FROM conversations),
b AS (SELECT *, row_number() OVER (PARTITION BY gk ORDER BY CASE WHEN gk LIKE 'resource:%' THEN turn ELSE 0 END, conv_id * 1000 + turn) - 1 AS pos FROM w),
p AS (SELECT *, pos // 3 AS batch FROM b)"""
_DOC_PAIRS = r"""d AS (SELECT doc_id, string_split(translate(coalesce(text, ''), '<>\' || chr(13), '‹›＼ '), chr(10)) AS parts, upper(translate(coalesce(lang, ''), '<>\' || chr(13), '‹›＼ ')) AS lang FROM documents)"""


def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _prompt() -> str:
    nl = "chr(10)"
    head = f"{_sql(work.HEAD[0])} || {nl} || {_sql(work.HEAD[1])} || min(conv_id) || {nl} || {_sql(work.HEAD[2])} || arg_min(role, pos) || {nl} || {_sql(work.HEAD[3] + STORY_LABELS['dear'])} || {nl} || {_sql(work.HEAD[4])} || arg_min(conv_id, pos) || {nl} || {nl} || "
    rules = f"{_sql(work.RULES[0].split('{n}')[0])} || count(*) || {_sql(work.RULES[0].split('{n}')[1])} || {nl} || " + "".join(f"{_sql(r)} || {nl} || " for r in work.RULES[1:])
    speech = f"CASE WHEN bool_or(turn % 2 = 0 AND coalesce(role, '') <> '') THEN {_sql(work.SPEECH)} || {nl} ELSE '' END || "
    said = f"string_agg('[' || uid || '] ' || CASE WHEN turn % 2 = 0 AND coalesce(role, '') <> '' THEN '(' || role || ') ' ELSE '' END || jp, {nl} ORDER BY pos)"
    tail = "".join(f" || {nl} || {_sql(x)}" for x in ("", *work.OUTPUT, "", "输出:"))
    return f"WITH {_WORK} SELECT gk, batch, sha256(CASE WHEN arg_min(conv_id % 2, pos) = 0 AND coalesce(arg_min(role, pos), '') <> '' THEN {head} '' ELSE '' END || {rules} {speech} {nl} || {_sql(work.INPUT)} || {nl} || {said} {tail}) AS prompt_sha256, count(*) AS n FROM p GROUP BY gk, batch"


ORACLES = {
    "status_items": f"WITH {_STATUS} SELECT * FROM status",
    "status_counts": f"WITH {_STATUS} SELECT status, count(*) AS n FROM status GROUP BY status",
    "export_new": f"WITH {_STATUS} SELECT uid FROM status WHERE status = 'new'",
    "export_changed": f"WITH {_STATUS} SELECT uid FROM status WHERE status = 'changed'",
    "pending_items": f"WITH {_STATUS} SELECT uid, status FROM status WHERE status IN ('new', 'changed') AND uid NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)",
    "pending_by_source": f"WITH {_PACKAGES} SELECT uid FROM docs WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.uid = docs.uid AND one.src = docs.jp)",
    "fallback_union": f"WITH {_PACKAGES} SELECT uid, value FROM one UNION ALL SELECT uid, value FROM two WHERE uid NOT IN (SELECT uid FROM one)",
    "fallback_by_emptiness": f"WITH {_PACKAGES} SELECT uid, coalesce(nullif(one.value, ''), nullif(two.value, ''), '') AS value FROM docs LEFT JOIN one USING (uid) LEFT JOIN two USING (uid)",
    "fallback_by_presence": f"WITH {_PACKAGES} SELECT uid, CASE WHEN one.src IS NOT NULL THEN one.value WHEN two.src IS NOT NULL THEN two.value ELSE '' END AS value FROM docs LEFT JOIN one USING (uid) LEFT JOIN two USING (uid)",
    "checkpoint_precedence": f"WITH {_PACKAGES} SELECT coalesce(two.uid, one.uid) AS uid, coalesce(two.value, one.value) AS cn FROM two FULL JOIN (SELECT * FROM one WHERE value <> '') one ON two.uid = one.uid",
    "snapshot_changed": f"WITH {_PACKAGES} SELECT uid, CASE WHEN two.value IS NULL THEN 'new' WHEN one.src IS NOT NULL AND one.src <> jp THEN 'changed' ELSE 'existing' END AS status FROM docs LEFT JOIN one USING (uid) LEFT JOIN two USING (uid)",
    "snapshot_upsert": f"WITH {_PACKAGES} SELECT uid, jp FROM docs WHERE doc_id % 5 = 0 UNION ALL SELECT uid, src FROM one WHERE uid NOT IN (SELECT uid FROM two)",
    "snapshot_deltas": f"WITH {_PACKAGES} SELECT uid, CASE WHEN doc_id % 100 = 0 THEN 'b' WHEN doc_id % 7 = 0 THEN 'a' ELSE '' END || jp AS jp FROM docs UNION ALL SELECT 'n' || uid, 'b' || jp FROM docs WHERE doc_id % 100 = 0 UNION ALL SELECT 'version 1', CAST(count(*) AS VARCHAR) FROM docs UNION ALL SELECT 'version 2', CAST(count(*) AS VARCHAR) FROM docs WHERE doc_id % 7 = 0 UNION ALL SELECT 'version 3', CAST(2 * count(*) AS VARCHAR) FROM docs WHERE doc_id % 100 = 0 UNION ALL SELECT 'version 4', '0'",
    "dup_id_index_join": "WITH last AS (SELECT p_name, arg_max(p_brand, p_partkey) FILTER (p_partkey % 2 = 0) AS a, arg_max(p_brand, p_partkey) AS b FROM part GROUP BY p_name) SELECT 'master:part:' || p_partkey || ':' || p_name || ':name' AS uid, CAST(p_partkey AS INT) AS rec_idx, p_type AS jp, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE coalesce(a, b) END AS existing_cn FROM part JOIN last USING (p_name)",
    "script_lines": r"WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS file, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS l FROM documents) SELECT file, CAST(i AS INT) AS line, l[i] AS text FROM (SELECT file, l, unnest(range(1, len(l) + 1)) AS i FROM d)",
    "command_parse": f"WITH {_TURNS} SELECT file, line, 'message' AS command, 'text' AS field, said AS jp FROM turns UNION ALL SELECT file, line, 'message', 'name', role FROM turns WHERE role <> ''",
    "choice_indexed": f"WITH {_TURNS} SELECT file, line, 'choice' AS command, 'text[0]' AS field, said AS jp FROM turns UNION ALL SELECT file, line, 'choice', 'text[1]', role FROM turns",
    "speaker_for_text": f"WITH {_TURNS} SELECT a.file, a.line, a.said AS jp, nullif(b.role, '') AS speaker FROM turns a JOIN turns b ON a.file = b.file AND a.line = b.line",
    "batch_plan": f"WITH {_WORK} SELECT uid, gk, pos, batch FROM p",
    "batch_prompt": _prompt(),
    "response_parse": f"WITH {_WORK} SELECT uid, 't' || uid AS cn FROM p",
    "batch_ledger": f"WITH {_WORK} SELECT uid, upper(jp) AS cn, CAST(1 AS BIGINT) AS n_paid FROM w",
    "translate_totals": f"WITH {_WORK}, f AS (SELECT gk, batch, count(*) AS n, bool_or(conv_id % 7 < 2) AS bad FROM p GROUP BY gk, batch) SELECT count(*) AS n_batches, count(*) FILTER (bad) AS n_failed, CAST(coalesce(sum(n) FILTER (NOT bad), 0) AS BIGINT) AS n_texts FROM f",
    "reply_texts": "SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE (conv_id + turn) % 6 WHEN 0 THEN sha256(coalesce(text, '')) WHEN 3 THEN sha256(coalesce(text, '')) WHEN 1 THEN 'error: no choices' WHEN 2 THEN 'error: no text in the first choice' ELSE 'error: no text block' END AS said FROM conversations",
    "translate_merge": "SELECT conv_id || ':' || turn AS uid, CASE WHEN turn = 0 THEN 'old' ELSE upper(sha256(coalesce(text, ''))) END AS cn FROM conversations",
    "source_normalise": r"SELECT page_id, sha256(replace(regexp_replace(html, '</?(?:b|p)(?:\\=[^>]*)?>', '', 'g'), '—', '―')) AS plain_sha256 FROM pages",
    "source_equal": r"SELECT page_id, true AS same, replace(regexp_replace(html, '</?(?:b|p)(?:\\=[^>]*)?>', '', 'g'), '—', '―') = replace(regexp_replace(url, '</?(?:b|p)(?:\\=[^>]*)?>', '', 'g'), '—', '―') AS other FROM pages",
    "hashtag_kana_filter": r"SELECT doc_id, regexp_matches(text, '[À-ÿ]') AS has, regexp_matches(regexp_replace(text, '#[^\s#]+', '', 'g'), '[À-ÿ]') AS looks FROM documents",
    "wrap_multiline": rf"WITH {_DOC_PAIRS} SELECT doc_id, sha256(array_to_string(list_transform(parts, lambda x: '<r\=' || x || '>' || lang || length(x) || '</r>'), '\r\n')) AS wrapped_sha256 FROM d",
    "split_wrapped": rf"WITH {_DOC_PAIRS} SELECT doc_id, sha256(array_to_string(parts, '\n')) AS src_sha256, array_to_string(list_transform(parts, lambda x: lang || length(x)), '\n') AS dst FROM d",
    "first_name_match": "SELECT r_regionkey, (SELECT arg_min(n_name, n_nationkey) FROM nation WHERE contains(n_name, substr(r_name, 2, 2))) AS n_name FROM region",
    "first_container": "WITH q AS (SELECT p_partkey, substr(p_name, 2, (p_partkey % 10)::INT) AS piece FROM part), d AS (SELECT DISTINCT piece FROM q WHERE piece IS NOT NULL), f AS (SELECT piece, arg_min(p_name, p_partkey) AS name FROM d JOIN part ON contains(p_name, piece) WHERE p_name <> '' GROUP BY piece) SELECT p_partkey, piece, name FROM q LEFT JOIN f USING (piece)",
    "context_from_stem": "WITH s AS (SELECT p_partkey, lower(p_brand) AS b, ['hski', 'ttmr', 'none'][p_partkey % 3 + 1] AS k, CAST(p_size AS VARCHAR) AS z FROM part) SELECT p_partkey, CASE WHEN k = 'none' THEN b || '_none-' || z ELSE b END AS story_type, CASE WHEN k = 'none' THEN '' ELSE k END AS \"character\", CASE WHEN k = 'none' THEN '' ELSE z END AS chapter FROM s",
    "prefix_label": "SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1-%' THEN 'first' WHEN o_orderpriority LIKE '2-%' THEN 'second' WHEN o_orderpriority LIKE '3-%' THEN 'third' ELSE o_orderpriority END AS label FROM orders",
    "json_flatten": "SELECT conv_id, turn AS k, 'turn.role' AS path, sha256(role) AS text_sha256 FROM conversations WHERE role IS NOT NULL UNION ALL SELECT conv_id, turn, 'turn.said[0]', sha256(text) FROM conversations WHERE text IS NOT NULL UNION ALL SELECT conv_id, turn, 'turn.said[1]', sha256(role) FROM conversations WHERE role IS NOT NULL",
    "json_path_set": """SELECT event_id, '{"event_type":"' || event_type || '","n":{"l":["' || user_id || '"]}}' AS tree FROM events""",
    "generic_explode": "SELECT 'generic:' || event_id || ':' || k AS uid, CAST(event_id AS VARCHAR) AS file, k AS field, k AS jp, v AS existing_cn, 'existing' AS status FROM (SELECT event_id, unnest(['é', 'à b']) AS k, unnest([event_type, CAST(user_id AS VARCHAR)]) AS v FROM events)",
    "localization_leaves": "WITH c AS (SELECT conv_id || ':' || turn AS file, role FROM conversations) SELECT file, 'localization:turn.said[1]' AS uid, 'turn.said[1]' AS field, 'é#à ' || role AS jp, 'new' AS status FROM c UNION ALL SELECT file, 'localization:turn.said[2]', 'turn.said[2]', '#é ' || role, 'existing' FROM c",
    "choice_rebuild": r"WITH c AS (SELECT conv_id, turn, sha256(coalesce(text, '')) AS jp FROM conversations) SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '[choicegroup text=<r\=' || jp || '>A</r> text=b' || jp || ']' ELSE '[choicegroup text=' || jp || ' text=<r\=b' || jp || '>B</r>]' END AS line FROM c",
    "prior_texts": "WITH d AS (SELECT doc_id, doc_id % 5 AS k, sha256(coalesce(text, '')) AS jp FROM documents) SELECT doc_id, CASE k WHEN 3 THEN 'か' || jp WHEN 4 THEN 'answer' ELSE jp END AS src, CASE k WHEN 0 THEN 'T' WHEN 1 THEN 'answer' WHEN 2 THEN jp ELSE '' END AS dst FROM d",
    "known_names": "WITH p AS (SELECT p_partkey, p_type, p_partkey % 4 = 0 AS own, p_partkey % 2 = 1 AS is_name, p_brand AS jp, CASE WHEN p_partkey % 3 = 0 THEN 'had' ELSE '' END AS had FROM part) SELECT p_partkey, CASE WHEN own THEN '{user}' WHEN is_name AND had = '' THEN CASE WHEN contains('SMALL BRUSHED TIN', jp) THEN 'SMALL BRUSHED TIN' WHEN contains('Brand#11 and Brand#12', jp) THEN 'Brand#11 and Brand#12' WHEN contains('PROMO', jp) THEN 'PROMO' ELSE jp END ELSE had END AS existing_cn, CASE WHEN own OR is_name THEN 'existing' ELSE 'new' END AS status, CASE p_type WHEN 'PROMO' THEN 'promoted' WHEN 'ECONOMY' THEN 'cheap' ELSE p_type END AS label FROM p",
    "record_updates": """SELECT CAST(p_partkey AS INT) AS rec_idx, 'size=' || p_size || ';id="k' || p_partkey || '";name="' || CASE WHEN p_partkey % 4 < 2 THEN p_brand ELSE 'old' END || '"' || CASE WHEN p_partkey % 4 = 2 THEN ';more="' || p_brand || '"' ELSE '' END AS rec, CASE WHEN p_partkey % 4 = 3 THEN 0 ELSE 1 END AS applied FROM part""",
    "package_files": """WITH p AS (SELECT *, replace(p_brand, '#', '_') AS tab, p_brand LIKE '%1%' AS held, p_partkey % 2 = 0 AS put FROM part),
r AS (SELECT tab, held, put, p_partkey, CASE WHEN held THEN '  {' || chr(10) || '   "z": ' || p_size || ',' || chr(10) || '   "id": "k' || p_partkey || '",' || chr(10) || '   "name": "' || CASE WHEN put THEN p_name ELSE 'old' END || '",' || chr(10) || '   "a": [' || chr(10) || '    1,' || chr(10) || '    2' || chr(10) || '   ]' || chr(10) || '  }'
  ELSE '  {' || chr(10) || '   "id": "k' || p_partkey || '",' || chr(10) || '   "name": "' || p_name || '"' || chr(10) || '  }' END AS rec FROM p WHERE held OR put)
SELECT tab AS "table", sha256('{' || chr(10) || ' "rules": {' || chr(10) || '  "primaryKeys": [' || chr(10) || '   "id"' || chr(10) || '  ]' || chr(10) || ' },' || chr(10) || CASE WHEN held THEN ' "more": 1,' || chr(10) ELSE '' END || ' "data": [' || chr(10) || string_agg(rec, ',' || chr(10) ORDER BY p_partkey) || chr(10) || ' ]' || chr(10) || '}') AS content_sha256, count(*) FILTER (put) AS applied FROM r GROUP BY tab, held""",
    "failed_batches": f"WITH {_WORK}, f AS (SELECT *, bool_or(conv_id % 7 = 0) OVER (PARTITION BY gk, batch) AS broken, bool_or(conv_id % 7 = 1) OVER (PARTITION BY gk, batch) AS short FROM p) SELECT uid, CASE WHEN broken OR short THEN NULL ELSE upper(jp) END AS cn, CASE WHEN broken THEN 'RuntimeError' WHEN short THEN 'some missing' END AS error FROM f",
    "record_pivot": """WITH f AS (SELECT p_name AS record_id, p_brand AS field, arg_max(p_type, p_partkey) AS t FROM part GROUP BY 1, 2) SELECT record_id, '{' || string_agg('"' || field || '":"' || t || '"', ',' ORDER BY field) || '}' AS fields FROM f GROUP BY 1""",
    "script_rebuild": rf"WITH {_TURNS}, l AS (SELECT file, line, '[message text=' || CASE WHEN line % 2 = 0 AND said <> '' THEN '<r\=' || said || '>T' || line || '</r>' ELSE said END || ' name=' || role || ']' AS x FROM turns) SELECT file, sha256(string_agg(x, chr(10) ORDER BY line)) AS content_sha256 FROM l GROUP BY file",
    "manifest_filter": "SELECT page_id, 'https://store.example.com/' || page_id || '?x' AS object_url FROM pages WHERE url LIKE 'https%' AND url NOT LIKE '%#top' AND page_id % 4 <> 0",
    "category_union": "SELECT 'resource:' || n_nationkey AS uid, 'resource' AS category, n_name AS jp, 1 AS line FROM nation UNION ALL SELECT 'master:' || p_partkey, 'master', p_name, -1 FROM part UNION ALL SELECT 'generic:' || c_custkey, 'generic', c_name, -1 FROM customer UNION ALL SELECT 'localization:' || s_suppkey, 'localization', s_name, -1 FROM supplier",
    "apply_generic": """SELECT CAST(event_id AS VARCHAR) AS file, '{"a":"' || CASE WHEN event_id % 2 = 0 THEN 'T' ELSE event_type END || '","b":"y"}' AS value, CAST(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS applied FROM events""",
    "crypto_hash": "SELECT doc_id, sha256(coalesce(text, '')) AS sha256, true AS round_trip, true AS cache_round_trip FROM documents",
} | workspace.ORACLES
