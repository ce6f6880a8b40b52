"""DuckDB twins of those queries that SQL can express."""

SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

_PROBE = "chr(92) || '### Assistant: </turn> ok'"

_SPACES = "'[' || chr(32) || chr(9) || '-' || chr(13) || ']+'"


def _best(choices: list[tuple[str, str]]) -> str:
    """The least (cost, audit) of choices given as two expressions; a null cost is no choice."""
    made = ", ".join(f"CASE WHEN {cost} IS NOT NULL THEN {{'c': {cost}, 'a': {audit}}} END" for cost, audit in choices)
    return f"list_sort(list_filter([{made}], lambda x: x IS NOT NULL))[1]"


def _edits(state: int) -> str:
    """A turn's edits but insertion, in a grammar state: d0 to d3 are the best of the turns behind it."""
    on = (2, 2, 3, 2)[state]
    keep = [("CASE WHEN NOT gone AND initial = 's' THEN d1.c + more END", "'K' || d1.a")] if state == 0 else []
    says = "a" if state == 2 else "u"
    keep.append((f"CASE WHEN NOT gone AND initial = '{says}' THEN d{on}.c + more END", f"'K' || d{on}.a"))
    return _best([(f"d{state}.c + 4", f"'D' || d{state}.a"), (f"CASE WHEN NOT gone THEN d{on}.c + more + 3 END", f"'R' || d{on}.a"), *keep])


def _inserts(state: int) -> str:
    """The same with up to two insertions before it: more lead to a state that was passed."""
    on = (2, 2, 3, 2)[state]
    return _best([(f"e{state}.c", f"e{state}.a"), (f"e{on}.c + 3", f"'I' || e{on}.a"), (f"e{5 - on}.c + 6", f"'II' || e{5 - on}.a")])


# a search of its own: the best (cost, audit) of all four states, from each conversation's last turn to its first
_REPAIR = f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), bits AS (
  SELECT name, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc
  FROM (SELECT DISTINCT name FROM named)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM (SELECT named.*, xor(crc, 4294967295::BIGINT) % 20 AS kind FROM named JOIN bits USING (name)) WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos, substr(role, 1, 1) AS initial,
         rtrim(text, {SPACE}) AS cut
  FROM damaged
), judged AS (
  SELECT *, cut = '' AS blank, cut <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
         lead(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS after
  FROM placed
), turns AS (
  SELECT *, NOT blank AND NOT duplicate AND right(cut, 1) NOT IN ('.', '!', '?') AS truncated, blank OR duplicate AS gone,
         CASE WHEN right(cut, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS more
  FROM judged
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (after IS NOT NULL AND initial || after NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
), best AS (
  SELECT conv_id, n AS pos, {{'c': 0, 'a': ''}} AS d0, {{'c': 6, 'a': 'II'}} AS d1, {{'c': 3, 'a': 'I'}} AS d2, {{'c': 0, 'a': ''}} AS d3 FROM counted
  UNION ALL
  SELECT conv_id, pos - 1, {", ".join(_inserts(k) for k in range(4))}
  FROM (SELECT turns.conv_id, turns.pos, {", ".join(f"{_edits(k)} AS e{k}" for k in range(4))}
        FROM best JOIN turns ON turns.conv_id IS NOT DISTINCT FROM best.conv_id AND turns.pos = best.pos)
), solved AS (
  SELECT conv_id, d0.c AS cost, d0.a AS audit FROM best WHERE pos = 0
), edits AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos,
         count(*) FILTER (edit <> 'D') OVER w AS place
  FROM (SELECT conv_id, generate_subscripts(string_split(audit, ''), 1) AS step, unnest(string_split(audit, '')) AS edit FROM solved WHERE audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY step)
), said AS (
  SELECT edits.conv_id, step, edit, CASE WHEN edit <> 'I' THEN role END AS role, CASE WHEN edit <> 'I' THEN text ELSE '' END AS text,
         place + CASE WHEN max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY edits.conv_id) = 1 THEN 1 ELSE 0 END AS place
  FROM edits LEFT JOIN turns ON turns.conv_id IS NOT DISTINCT FROM edits.conv_id AND turns.pos = edits.pos AND edit <> 'I'
  WHERE edit <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                                    chr(10) ORDER BY step)) AS sha
  FROM said GROUP BY conv_id
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

ORACLES = {
    "op3_chat_formatting": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_PROBE} UNION ALL SELECT -7, 1, 'assistant', {_PROBE}
), sized AS (
  SELECT *, 15 + length(role) + length(text)
    + length(regexp_replace(role, '[^' || chr(92) || chr(92) || '#<:]', '', 'g'))
    + length(regexp_replace(text, '[^' || chr(92) || chr(92) || '#<]', '', 'g')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op4_warc_zstandard": """
WITH payloads AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), copies AS (
  SELECT payload_digest, max(page_id) AS last_page FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last_page THEN last_page END AS refers_to
FROM payloads LEFT JOIN copies USING (payload_digest)
""",
    "op6_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {SPACE}), {UPPER}, {LOWER}) AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, common.key IS NOT NULL AND doc_id < last_doc AS dropped
  FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_quality_rules": f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row, generate_subscripts(w, 1) AS pos, unnest(w) AS word
  FROM (SELECT row, list_filter(regexp_split_to_array(text, {_SPACES}), lambda x: x <> '') AS w FROM docs)
), windows AS (
  SELECT *, lead(word) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d, lead(word, 4) OVER o AS e
  FROM words WINDOW o AS (PARTITION BY row ORDER BY pos)
), twice AS (
  SELECT *, e IS NOT NULL AND count(*) OVER (PARTITION BY row, word, b, c, d, e) > 1 AS again FROM windows
), covered AS (
  SELECT row, word, bool_or(again) OVER (PARTITION BY row ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS repeated FROM twice
), counts AS (
  SELECT row, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (repeated) AS n_repeat_words FROM covered GROUP BY row
), lines AS (
  SELECT row, doc_id, host, unnest(string_split(text, chr(10))) AS line FROM docs
), inked AS (
  SELECT *, trim(regexp_replace(translate(line, {UPPER}, {LOWER}), {_SPACES}, ' ', 'g')) AS normal
  FROM lines WHERE regexp_matches(line, '[^ ' || chr(9) || '-' || chr(13) || ']')
), dups AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM inked GROUP BY row
), hosts AS (
  SELECT host, count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS host_docs FROM docs GROUP BY host
), frequent AS (
  SELECT host, normal, count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS n_docs FROM inked GROUP BY host, normal
), above AS (
  SELECT host, normal FROM frequent JOIN hosts USING (host) WHERE n_docs > 5 AND 100 * n_docs > host_docs
), lost AS (
  SELECT row, sum(length(normal) - length(replace(normal, ' ', '')) + 1) AS n_removed_words FROM inked JOIN above USING (host, normal) GROUP BY row
), measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(n_removed_words, 0) AS BIGINT) AS n_removed_words
  FROM docs LEFT JOIN counts USING (row) LEFT JOIN dups USING (row) LEFT JOIN lost USING (row)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words - n_removed_words >= 10 AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept
FROM measured
""",
    "op12_conversation_repair": _REPAIR,
}
