"""DuckDB SQL twins of the registered queries.

Queries on printed pages are checked against the tables the pages were printed from:
the SQL below never looks at page text.
"""

from __future__ import annotations

from leafmill.plans.render import REPEAT_AT, SLOTS

ORACLES: dict[str, str] = {}

BASE = f"""
b AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS ks,
    CASE WHEN o_orderkey % 3 = 0 THEN 'vol-b' ELSE 'vol-a' END AS doc_id,
    o_orderkey * {SLOTS} AS p0, {REPEAT_AT} + o_orderkey * {SLOTS} AS prep,
    c_name, c_mktsegment AS segment, o_orderstatus AS status,
    c_name AS make, replace(o_orderpriority, '-', ' - ') AS model, n_name AS manufacturer,
    CASE WHEN o_orderkey % 3 <> 0 THEN c_mktsegment END AS level,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS type,
    CASE WHEN o_orderkey % 11 <> 0 THEN r_name END AS country,
    CASE o_orderstatus WHEN 'F' THEN 'Restricted' WHEN 'O' THEN 'Antique' ELSE 'Prohibited' END
      AS legal_classification,
    CASE WHEN o_orderkey % 9 <> 0 THEN 'serial ' || o_orderkey
         WHEN o_orderkey % 5 <> 0 THEN 'See Note' END AS serial_numbering,
    CAST(year(o_orderdate) AS VARCHAR) AS year_dates,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'Importer ' || o_custkey END AS importer,
    o_orderkey % 2 = 0 AS two, o_orderkey % 97 = 0 AS rep
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

# Parent pages in document order: first page, second page, repeat of the first page.
PARENT_PAGES = """
pp AS (
  SELECT *, p0 AS page_idx, 1 AS face FROM b
  UNION ALL SELECT *, p0 + 1, 2 FROM b WHERE two
  UNION ALL SELECT *, prep, 1 FROM b WHERE rep
)"""

# Bullets and references of the second pages.
NOTES = """
bul AS (
  SELECT *, CASE WHEN k % 10 = 4 THEN ['again', status] ELSE ['marked ' || c_name] END AS make_b,
    list_transform(range(0, (k // 2) % 4 + 1), lambda i:
      (CASE WHEN i = 0 THEN 'first' ELSE 'bullet ' || i || ' of ' || k END)
      || (CASE WHEN i = (k // 2) % 4 THEN ' wrapped tail' ELSE '' END)) AS law_b
  FROM b WHERE two
),
nt AS (
  SELECT *, 0 AS pos, 'make' AS note_key, unnest(make_b) AS note_value,
    CAST(unnest(range(0, len(make_b))) AS INTEGER) AS bullet_index FROM bul
  UNION ALL
  SELECT *, 1, 'legalLawComments', unnest(law_b), CAST(unnest(range(0, len(law_b))) AS INTEGER) FROM bul
)"""

XREFS = """
xr AS (
  SELECT *, 0 AS pos, CAST(k + 1 AS VARCHAR) AS ref_frn, c_name AS description FROM b WHERE two
  UNION ALL SELECT *, 1, CAST(k + 2 AS VARCHAR), segment FROM b WHERE two
)"""

SUBS = """
sb AS (
  SELECT *, CAST(i - 1 AS INTEGER) AS pos, k || '-' || i AS sub_frn,
    CASE (k + i) % 4 WHEN 1 THEN '38' WHEN 2 THEN '308 WIN' WHEN 3 THEN segment ELSE '' END AS calibre,
    CAST(i + k % 10 AS VARCHAR) AS shots, CAST(100 + k % 500 AS VARCHAR) AS barrel_length,
    CASE (k + i) % 4 WHEN 0 THEN 'Antique' WHEN 1 THEN 'Restricted' WHEN 2 THEN 'CC 84(3) Exempted'
      ELSE '' END AS sub_class
  FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM b)
)"""

FIELDS = ("make", "model", "manufacturer", "level", "type", "action", "country",
          "legal_classification", "serial_numbering", "year_dates", "importer")
GLOBAL_ACTION = "CASE WHEN two AND NOT rep THEN 'second ' ELSE 'first ' END || status"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _dropped(text: str) -> str:
    """Search-text cleaning in SQL: dash word, dropped characters, trimmed blanks."""
    # the dash word and the dropped characters, stated here independently of the engine's list
    chars = "()[]{}.,;:/|!?@#$%^&*+=~`\"''<>"
    return f"trim(translate(replace({text}, '-', 'DSH'), '{chars}', ''), ' ')"


def _full(text: str) -> str:
    c = _dropped(text)
    return f"CASE WHEN {c} = '' THEN '' ELSE {c} || ' ' || reverse({c}) END"


def _tokens(cleaned: str) -> str:
    return f"list_filter(list_distinct(string_split_regex(lower({cleaned}), '[ \\n]+')), lambda t: t <> '')"


# ------------------------------------------------------------------- pages
ORACLES["paged_text"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, page_idx, md5(t) AS text_md5 FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS t,
    unnest(range(0, len(string_split(text, chr(10))))) AS page_idx FROM documents) WHERE t <> ''"""

ORACLES["paged_text_files"] = """
SELECT row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS page_idx, md5(text) AS text_md5 FROM documents"""

ORACLES["text_lines"] = """
SELECT doc_id, CAST(i AS INTEGER) AS line_idx, md5(t) AS line_md5 FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS t,
    unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents)"""

ORACLES["page_head"] = "SELECT doc_id, substring(text, 1, 400) AS head FROM documents"

ORACLES["page_keys"] = _with(BASE, PARENT_PAGES) + """
SELECT doc_id, page_idx, ks AS page_key, ks AS parent_key, 0 AS is_sub_entry FROM pp
UNION ALL SELECT doc_id, p0 + 3, NULL, NULL, 0 FROM b WHERE k % 60 = 0
UNION ALL SELECT doc_id, p0 + 4, ks || '-1', ks, 1 FROM b WHERE k % 70 = 0"""

_first = {"action": "CASE WHEN face = 1 THEN 'first ' ELSE 'second ' END || status AS action"}
ORACLES["labelled_fields"] = _with(BASE, PARENT_PAGES) + (
    "SELECT doc_id, page_idx, ks AS frn, ks AS printed_key, "
    + ", ".join(_first.get(f, f"CASE WHEN face = 1 THEN {f} END AS {f}") for f in FIELDS)
    + " FROM pp")

ORACLES["indirect_values"] = _with(BASE, PARENT_PAGES) + """
SELECT doc_id, page_idx, ks AS frn, year_dates, serial_numbering FROM pp WHERE face = 1"""

ORACLES["sub_entries"] = """
WITH j AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 0 AS pos,
  l_orderkey || '-' || l_linenumber AS sub_frn,
  CASE WHEN l_partkey % 4 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_type END AS calibre,
  CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS shots, CAST(l_suppkey AS VARCHAR) AS barrel_length,
  CASE l_returnflag WHEN 'A' THEN 'Antique' WHEN 'N' THEN 'Restricted' ELSE 'CC 84(3) Exempted' END
    AS legal_classification
FROM j
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1, l_orderkey || '-99', NULL,
  CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), NULL FROM j"""

ORACLES["notes_bullets"] = _with(BASE, NOTES) + """
SELECT doc_id, p0 + 1 AS page_idx, ks AS frn, pos, note_key, bullet_index, note_value FROM nt"""

ORACLES["cross_refs"] = _with(BASE, XREFS) + """
SELECT doc_id, p0 + 1 AS page_idx, ks AS frn, pos, ref_frn, description FROM xr"""

ORACLES["camel_case"] = """
SELECT p_partkey, list_aggregate(list_transform(string_split(p_name, ' '), lambda w, i:
  CASE WHEN i = 1 THEN lower(w) ELSE upper(w[1]) || lower(w[2:]) END), 'string_agg', '') AS camel FROM part"""

ORACLES["whitespace_collapse"] = r"""
SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'), ' ')) AS collapsed_md5 FROM documents"""

# ---------------------------------------------------------------- assembly
_COUNTS = """
  CASE WHEN {two} THEN 2 ELSE 0 END AS n_notes, CAST(k % 4 AS INTEGER) AS n_sub_entries,
  CASE WHEN {two} THEN 2 ELSE 0 END AS n_cross_references"""


def _summary(first, n_pages, action, two, where="") -> str:
    fields = ", ".join(f"{action} AS action" if f == "action" else f for f in FIELDS)
    return (f"SELECT doc_id, {first} AS first_page_idx, CAST({n_pages} AS BIGINT) AS n_pages, ks AS frn, "
            f"{fields}, {_COUNTS.format(two=two)} FROM b {where}")


_TWO = "CASE WHEN two THEN 1 ELSE 0 END"
ORACLES["assemble_global"] = _with(BASE) + _summary(
    "p0", f"1 + {_TWO} + CASE WHEN rep THEN 1 ELSE 0 END", GLOBAL_ACTION, "two")
ORACLES["assemble_runs"] = _with(BASE) + _summary(
    "p0", f"1 + {_TWO}", "CASE WHEN two THEN 'second ' ELSE 'first ' END || status", "two",
) + "\nUNION ALL\n" + _summary("prep", "1", "'first ' || status", "false", "WHERE rep")

# Pages whose head shows the key, and the runs they form.
KEYED = """
kp AS (
  SELECT doc_id, ks, k, page_idx, CASE WHEN face = 1 AND page_idx = prep THEN 2 ELSE 0 END AS r FROM pp
  UNION ALL
  SELECT doc_id, ks, k, p0 + 4, CASE WHEN k % 50 = 0 OR k % 60 = 0 THEN 1 ELSE 0 END
  FROM b WHERE k % 70 = 0
),
rn AS (
  SELECT doc_id, ks AS frn, r, min(page_idx) AS run_start, max(page_idx) AS run_end, count(*) AS n_pages,
    string_agg(CAST(page_idx AS VARCHAR), ',' ORDER BY page_idx) AS page_indices
  FROM kp GROUP BY doc_id, ks, r
),
lr AS (SELECT * FROM rn QUALIFY row_number() OVER (PARTITION BY doc_id, frn ORDER BY r DESC) = 1)"""

_RUNS = _with(BASE, PARENT_PAGES, KEYED)
ORACLES["page_runs"] = _RUNS + "SELECT doc_id, frn, run_start, run_end, n_pages FROM rn"
ORACLES["last_runs"] = _RUNS + "SELECT doc_id, frn, run_start, run_end, n_pages FROM lr"
_LISTS = """
SELECT doc_id, frn, run_start, (page_idx - run_start) // 2 AS part, count(*) AS n_pages,
  string_agg(CAST(page_idx AS VARCHAR), ',' ORDER BY page_idx) AS page_indices
FROM kp JOIN {runs} g ON kp.doc_id = g.doc_id AND kp.ks = g.frn AND kp.r = g.r
GROUP BY kp.doc_id, g.doc_id, frn, run_start, part"""
ORACLES["page_manifest"] = _RUNS + _LISTS.format(runs="lr").replace("SELECT doc_id", "SELECT kp.doc_id")
ORACLES["page_manifest_all_runs"] = _RUNS + _LISTS.format(runs="rn").replace("SELECT doc_id", "SELECT kp.doc_id")
ORACLES["key_pages"] = _RUNS + """
SELECT kp.doc_id, frn, run_start, page_idx,
  CASE page_idx % 8 WHEN 0 THEN 'Header of volume ' || kp.doc_id
    WHEN 1 THEN 'Firearm Reference Number (FRN): ' || frn
    ELSE 'Firearm Reference Number (FRN): ' || frn || ' - 1' END AS first_line
FROM kp JOIN lr ON kp.doc_id = lr.doc_id AND kp.ks = lr.frn AND kp.r = lr.r"""

ORACLES["event_runs"] = """
WITH e AS (
  SELECT event_id // 5000 AS part, event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 < 2 THEN ''
    ELSE event_type[1] END AS kind FROM events
), c AS (
  SELECT *, CASE WHEN kind IS NOT DISTINCT FROM lag(kind) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c
  FROM e WINDOW w AS (PARTITION BY part ORDER BY event_id)
), r AS (SELECT *, sum(c) OVER (PARTITION BY part ORDER BY event_id) AS r FROM c)
SELECT part, kind, min(event_id) AS run_start, max(event_id) AS run_end, count(*) AS n_events
FROM r WHERE kind IS NOT NULL GROUP BY part, kind, r"""

# ------------------------------------------------------------ ranges, order
ORACLES["first_pages"] = "SELECT conv_id, turn, role FROM conversations WHERE turn < 3"
ORACLES["first_pages_ranked"] = """
SELECT lang, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 100"""
ORACLES["first_events_ranked"] = """
SELECT event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 1500"""
ORACLES["page_range"] = "SELECT conv_id, turn, role FROM conversations WHERE turn >= 1 AND turn < 4"
ORACLES["page_chunks"] = """
SELECT conv_id, turn, CAST(floor(turn / greatest(1, ceil(
  (max(turn) OVER (PARTITION BY conv_id) + 1) / 3))) AS BIGINT) AS chunk FROM conversations"""
ORACLES["union_pages"] = """
SELECT 'd' || doc_id AS doc_id, CAST(0 AS BIGINT) AS page_idx, lang, md5(text) AS text_md5
FROM documents
UNION ALL SELECT 'c' || conv_id, turn, NULL, md5(text) FROM conversations"""
ORACLES["row_ids"] = """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders"""

# ------------------------------------------------------------------ tables
ORACLES["keyed_records"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS frn, o_orderstatus AS status FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')"""

_FIELD_TEXT = {f: f"coalesce({f}, '')" for f in FIELDS}
_FIELD_TEXT["action"] = GLOBAL_ACTION
_SEARCHED = ["ks"] + [_FIELD_TEXT[f] for f in FIELDS if f != "serial_numbering"]
_RECORD_TEXT = " || ' ' || ".join(_SEARCHED)
ORACLES["table_frn"] = _with(BASE) + (
    "SELECT ks AS frn, " + ", ".join(f"{_FIELD_TEXT[f]} AS {f}" for f in FIELDS)
    + f", {_full(_RECORD_TEXT)} AS \"fullText\" FROM b")

_sub = "ks || ' ' || sub_frn || ' ' || calibre || ' ' || shots || ' ' || barrel_length || ' ' || sub_class"
ORACLES["table_frn_sub_entry"] = _with(BASE, SUBS) + f"""
SELECT p0 AS first_page_idx, pos, ks AS frn, sub_frn, calibre, shots, barrel_length,
  sub_class AS legal_classification, {_full(_sub)} AS "fullText" FROM sb"""

ORACLES["table_frn_note"] = _with(BASE, NOTES) + f"""
SELECT ks AS frn, note_key, bullet_index, note_value,
  {_full("note_value || ' ' || bullet_index")} AS "fullText" FROM nt"""

ORACLES["table_frn_cross_reference"] = _with(BASE, XREFS) + f"""
SELECT p0 AS first_page_idx, pos, ks AS frn, ref_frn, description,
  {_full("ref_frn || ' ' || description")} AS "fullText" FROM xr"""

ORACLES["table_ids"] = _with(BASE, NOTES) + """
SELECT row_number() OVER (ORDER BY doc_id, p0, pos, bullet_index) AS id, ks AS frn, note_key, bullet_index
FROM nt"""

ORACLES["blob_base64"] = """
SELECT 'v1.' || doc_id AS frn, md5(to_base64(encode(text))) AS pdf64_md5,
  CAST(length(to_base64(encode(text))) AS INTEGER) AS n_chars FROM documents"""
ORACLES["table_frn_pdf"] = """
SELECT CAST(doc_id AS VARCHAR) AS frn, md5(to_base64(encode(text))) AS pdf64_md5 FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels)"""

ORACLES["file_blobs"] = """
SELECT CAST(page_id AS VARCHAR) AS frn, md5(c) AS pdf64_md5, CAST(length(c) AS INTEGER) AS n_chars
FROM (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '' ELSE coalesce(to_base64(encode(html)), '') END AS c FROM pages)"""
ORACLES["file_list"] = """
SELECT row_number() OVER (ORDER BY folder || '/' || page_id || '.pdf') AS id, CAST(page_id AS VARCHAR) AS frn, folder, length FROM (
  SELECT page_id, 'a' AS folder, CASE WHEN page_id % 7 = 0 THEN 0 ELSE coalesce(octet_length(encode(html)), 0) END AS length FROM pages
  UNION ALL SELECT page_id, 'b', octet_length(encode('second ' || page_id)) FROM pages WHERE page_id % 10 = 0)"""

_CHANGED = "CASE WHEN level IS NULL THEN 'changed-' || ks ELSE make END"
ORACLES["upserted_search_text"] = _with(BASE) + f"""
SELECT ks AS frn, {_CHANGED} AS make,
  {_full(_RECORD_TEXT.replace(_FIELD_TEXT["make"], _CHANGED))} AS "fullText" FROM b"""


def _updates(source: str, keep: str, gone: str, changed: dict[str, str], first: str, added: dict[str, str]) -> str:
    """Rows of a child table after a merge: without ``gone`` ones, with changed columns, and with added rows."""
    def columns(values: dict[str, str], when: str | None) -> str:
        return ", ".join(f"CASE WHEN {when} THEN {values[c]} ELSE {c} END AS {c}" if c in values and when
                         else f"{values[c]} AS {c}" if c in values else c for c in keep.split(", "))

    return f"""
up AS (
  SELECT {columns(changed, "k % 5 = 0")} FROM (SELECT *, ks AS frn FROM {source}) WHERE NOT (k % 7 = 0 AND {gone})
  UNION ALL SELECT {columns(added, None)} FROM (SELECT *, ks AS frn FROM {source}) WHERE k % 11 = 0 AND {first}
)"""


_NOTE_UP = _updates("nt", "frn, note_key, bullet_index, note_value", "bullet_index = 1", {"note_value": "note_value || ' amended'"},
                    "bullet_index = 0", {"bullet_index": "100", "note_value": "'An added note'"})
ORACLES["updated_notes"] = _with(BASE, NOTES, _NOTE_UP) + f"""
SELECT frn, note_key, bullet_index, note_value, {_full("note_value || ' ' || bullet_index")} AS "fullText" FROM up"""
_SUB_UP = _updates("(SELECT *, sub_class AS sub_legal FROM sb)", "p0, frn, pos, sub_frn, calibre, shots, barrel_length, sub_legal", "pos = 0",
                   {"shots": "'9 shots'"}, "pos = 0", {"pos": "100", "calibre": "'new'"})
ORACLES["updated_sub_entries"] = _with(BASE, SUBS, _SUB_UP) + f"""
SELECT p0 AS first_page_idx, frn, pos, sub_frn, calibre, shots, barrel_length, sub_legal AS legal_classification,
  {_full("frn || ' ' || sub_frn || ' ' || calibre || ' ' || shots || ' ' || barrel_length || ' ' || sub_legal")} AS "fullText" FROM up"""
_XREF_UP = _updates("xr", "p0, frn, pos, ref_frn, description", "pos = 0", {"description": "'see ' || description"},
                    "pos = 0", {"pos": "100", "description": "'added'"})
ORACLES["updated_cross_references"] = _with(BASE, XREFS, _XREF_UP) + f"""
SELECT p0 AS first_page_idx, frn, pos, ref_frn, description, {_full("ref_frn || ' ' || description")} AS "fullText" FROM up"""
ORACLES["updated_note_lookup"] = _with(BASE, NOTES, _NOTE_UP) + """
SELECT frn, note_key, bullet_index, state FROM up, (VALUES ('parts'), ('compact')) AS s(state) WHERE note_value LIKE '% wrapped tail%'
UNION ALL SELECT frn, note_key, bullet_index, state FROM up, (VALUES ('parts'), ('compact')) AS s(state) WHERE note_value LIKE '% amended'
UNION ALL SELECT frn, note_key, bullet_index, state FROM up, (VALUES ('parts'), ('compact')) AS s(state) WHERE note_value = 'An added note'"""
ORACLES["table_lookup"] = _with(BASE) + """
SELECT ks AS frn, country, type, make FROM b WHERE country = 'ASIA' AND type = 'F'"""
ORACLES["clustered_lookup"] = _with(BASE) + """
SELECT ks AS frn, country, legal_classification, make FROM b WHERE country = 'EUROPE' AND legal_classification = 'Antique'"""
ORACLES["sub_entry_lookup"] = _with(BASE, SUBS) + """
SELECT ks AS frn, sub_frn, shots, barrel_length FROM sb WHERE calibre = '308 WIN' AND sub_class = 'CC 84(3) Exempted'"""
ORACLES["note_lookup"] = _with(BASE, NOTES) + """
SELECT ks AS frn, note_key, bullet_index, note_value FROM nt WHERE ks = '34' AND note_key = 'legalLawComments'"""
ORACLES["cross_reference_lookup"] = _with(BASE, XREFS) + """
SELECT ks AS frn, ref_frn, description FROM xr WHERE ks = '34'"""
ORACLES["blob_lookup"] = """
SELECT 'v1.' || doc_id AS frn, md5(to_base64(encode(text))) AS pdf64_md5 FROM documents WHERE doc_id = 17"""
ORACLES["appended_records"] = _with(BASE) + f"""
SELECT ks AS frn, make, {_full(_RECORD_TEXT)} AS "fullText" FROM b"""
ORACLES["replaced_key_pages"] = f"""
SELECT doc_id, frn, run_start, page_idx, CASE WHEN CAST(frn AS BIGINT) % 5 = 0 THEN 'again ' ELSE '' END || first_line AS first_line
FROM ({ORACLES["key_pages"]}) WHERE NOT (CAST(frn AS BIGINT) % 5 = 0 AND page_idx <> run_start)"""
ORACLES["json_roundtrip"] = ORACLES["table_frn_note"]
ORACLES["json_array_roundtrip"] = ORACLES["json_mixed_layouts"] = ORACLES["table_frn_note"]

_REPORT = """
SELECT 'dbo_frn' AS table_name, (SELECT count(*) FROM b){rep_b} AS n_rows
UNION ALL SELECT 'dbo_frnSubEntry', (SELECT count(*) FROM sb){rep_sb}
UNION ALL SELECT 'dbo_frnNote', (SELECT count(*) FROM nt)
UNION ALL SELECT 'dbo_frnCrossReference', (SELECT count(*) FROM xr)"""
ORACLES["load_report"] = _with(BASE, SUBS, NOTES, XREFS) + _REPORT.format(rep_b="", rep_sb="")
ORACLES["full_load_by_runs"] = _with(BASE, SUBS, NOTES, XREFS) + _REPORT.format(
    rep_b=" + (SELECT count(*) FROM b WHERE rep)", rep_sb=" + (SELECT count(*) FROM sb WHERE rep)")

ORACLES["flow_report"] = _with(BASE) + """
, f AS (
  SELECT o_orderkey * 3 AS key, CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END AS n FROM orders
), known AS (SELECT f.* FROM f SEMI JOIN b ON f.key = b.k)
SELECT 'pages_processed' AS measure, CAST(sum(1 + CAST(two AS INT) + CAST(k % 50 = 0 AS INT) + CAST(k % 60 = 0 AS INT)
  + CAST(k % 70 = 0 AS INT) + CAST(rep AS INT)) AS BIGINT) AS n FROM b
UNION ALL SELECT 'records_loaded', count(*) FROM b
UNION ALL SELECT 'records_skipped', CAST(0 AS BIGINT)
UNION ALL SELECT 'blobs_loaded', (SELECT count(*) FROM known)
UNION ALL SELECT 'blobs_repeated', (SELECT CAST(sum(n) - count(*) AS BIGINT) FROM known)
UNION ALL SELECT 'blobs_skipped', CAST((SELECT sum(n) FROM f) - (SELECT sum(n) FROM known) AS BIGINT)"""

# --------------------------------------------------------------- integrity
ORACLES["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
ORACLES["duplicate_record_keys"] = _with(BASE) + """
SELECT ks AS frn, CAST(2 AS BIGINT) AS n_rows FROM b WHERE rep"""
ORACLES["known_only"] = """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"""
ORACLES["orphans"] = """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
ORACLES["referential_violations"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, {col} AS frn, count(*) AS n_rows FROM {src} "
    f"WHERE {col} NOT IN (SELECT doc_id FROM labels) GROUP BY {col}"
    for name, src, col in (
        ("dbo_frnSubEntry", "orders", "o_custkey"), ("dbo_frnNote", "lineitem", "l_orderkey"),
        ("dbo_frnCrossReference", "conversations", "conv_id"), ("dbo_frnPdf", "documents", "doc_id")))
ORACLES["blob_report"] = """
SELECT count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS n_loaded,
  CAST(0 AS BIGINT) AS n_repeated, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_skipped FROM documents"""
ORACLES["first_errors"] = """
WITH r AS (SELECT 'order ' || o_orderkey || ' has no line items' AS message FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
SELECT * FROM (SELECT message, CAST(NULL AS BIGINT) AS n_more FROM r ORDER BY message LIMIT 20)
UNION ALL SELECT '... and more', count(*) - 20 FROM r HAVING count(*) > 20"""

# ------------------------------------------------------------------ search
_PART = "p_name || ' ' || p_brand || ' ' || p_type"
ORACLES["search_text_sql"] = f"SELECT p_partkey, {_full(_PART)} AS \"fullText\" FROM part"
ORACLES["search_text"] = f"SELECT doc_id, md5({_full('text')}) AS full_text_md5 FROM documents"


def _postings(key: str, text: str, source: str) -> str:
    return f"""p AS (
  SELECT 'f' AS side, unnest({_tokens("c")}) AS token, {key} FROM (SELECT {key}, {_dropped(text)} AS c FROM {source})
  UNION ALL
  SELECT 'm', unnest({_tokens("reverse(c)")}), {key} FROM (SELECT {key}, {_dropped(text)} AS c FROM {source}))"""


_DOC_P = _with(_postings("doc_id", "text", "documents"))
_PART_P = _with(_postings("p_partkey", _PART, "part"))
ORACLES["token_index"] = _DOC_P + """
SELECT token, side, count(*) AS n_rows, min(doc_id) AS min_key, max(doc_id) AS max_key FROM p GROUP BY token, side"""
ORACLES["token_postings"] = _PART_P + "SELECT token, side, p_partkey FROM p"

_DOC_HIT = "SELECT doc_id, lang FROM documents SEMI JOIN ({}) h USING (doc_id)"
ORACLES["term_search"] = _DOC_P + _DOC_HIT.format(
    "SELECT doc_id FROM p WHERE side = 'f' AND token IN ('the', 'on') GROUP BY doc_id HAVING count(*) = 2")
ORACLES["prefix_search"] = _DOC_P + _DOC_HIT.format(
    "SELECT doc_id FROM p WHERE side = 'f' AND token LIKE 'ment%'")
ORACLES["suffix_search"] = _DOC_P + _DOC_HIT.format(
    "SELECT doc_id FROM p WHERE side = 'f' AND token LIKE '%sch'")
ORACLES["term_lookup"] = _PART_P + """
SELECT p_partkey FROM p WHERE side = 'f' AND token IN ('small', 'ring') GROUP BY p_partkey HAVING count(*) = 2"""
ORACLES["prefix_lookup"] = _PART_P + """
SELECT DISTINCT p_partkey FROM p WHERE side = 'f' AND token LIKE 'brand1%'"""
ORACLES["suffix_lookup"] = _PART_P + """
SELECT DISTINCT p_partkey FROM p WHERE side = 'f' AND token LIKE '%ing'"""


_NOTE_P = _with(BASE, NOTES, _postings("ks, note_key, bullet_index", "note_value || ' ' || bullet_index", "nt"))
_NOTE_KEY = "SELECT DISTINCT ks AS frn, note_key, bullet_index FROM p"
ORACLES["note_term_lookup"] = _NOTE_P + """
SELECT ks AS frn, note_key, bullet_index FROM p WHERE side = 'f' AND token IN ('bullet', 'of', 'tail')
GROUP BY ALL HAVING count(DISTINCT token) = 3"""
ORACLES["note_block_lookup"] = _NOTE_P + """
SELECT ks AS frn, note_key, bullet_index FROM p WHERE side = 'f' AND token IN ('bullet', 'of', '34')
GROUP BY ALL HAVING count(DISTINCT token) = 3"""
ORACLES["note_prefix_lookup"] = _NOTE_P + _NOTE_KEY + " WHERE side = 'f' AND token LIKE 'mark%'"
ORACLES["note_suffix_lookup"] = _NOTE_P + _NOTE_KEY + " WHERE side = 'f' AND token LIKE '%ail'"

# ------------------------------------------------------------------- links
_LINKS = r"""
WITH l AS (
  SELECT page_id, split_part(url, '/en/', 1) AS base, list_filter(
    regexp_extract_all(html, '<a href="([^"]*)"', 1),
    lambda h: regexp_full_match(h, '(?:.*/)?[A-Za-z]{4,}\.?')) AS hs
  FROM pages)"""
ORACLES["html_links"] = _LINKS + r"""
SELECT page_id, CAST(i AS INTEGER) AS pos, h AS href, regexp_replace(h, '^.*/', '') AS file_name,
  CASE WHEN starts_with(h, 'http') THEN h ELSE base || h END AS abs_url
FROM (SELECT page_id, base, unnest(hs) AS h, unnest(range(0, len(hs))) AS i FROM l)"""
ORACLES["first_link"] = _LINKS + r"""
SELECT page_id, hs[1] AS href,
  CASE WHEN starts_with(hs[1], 'http') THEN hs[1] ELSE base || hs[1] END AS abs_url FROM l"""
