"""DuckDB SQL for the queries whose rows SQL can express."""

from __future__ import annotations

from acctlens.llm.license_texts import PHRASES, TEMPLATES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def line_dedup(documents: str = "documents") -> str:
    """CTEs ending in ``deduped``: every row of ``documents`` with its lines before and after."""
    return f"""
    docs AS (SELECT row_number() OVER () AS rid, * FROM {documents}),
    line_rows AS (
        SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
        FROM (SELECT rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM docs)
    ),
    keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_LOWER}') AS line_key FROM line_rows),
    common AS (
        SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 40
        GROUP BY line_key HAVING count(DISTINCT rid) >= 5
    ),
    marked AS (
        SELECT k.*, c.line_key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone
        FROM keyed k LEFT JOIN common c USING (line_key)
    ),
    deduped AS (
        SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
        FROM marked GROUP BY rid
    )"""


OP6 = f"""WITH {line_dedup()}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM deduped"""

_MD5_32 = "('0x' || substr(md5({0}), 1, 8))::BIGINT"

# 32 shards take turns in a table of 4099 slots.
OP1 = f"""WITH RECURSIVE orders AS (
    SELECT i, 1 + {_MD5_32.format("name || '/step'")} % 4098 AS a, {_MD5_32.format("name || '/start'")} % 4099 AS b, name
    FROM (SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS name FROM range(32) t(i))
),
steps AS (
    SELECT 0 AS turn, -1::BIGINT AS slot, range(4099) AS free
    UNION ALL
    SELECT turn + 1, best, list_filter(free, lambda s: s <> best)
    FROM (
        SELECT turn, free, list_min(list_transform(free, lambda s: ((a * s + b) % 4099) * 4099 + s)) % 4099 AS best
        FROM steps JOIN orders ON i = turn % 32 WHERE turn < 4099
    )
),
filled AS (SELECT s.slot, o.name FROM steps s JOIN orders o ON o.i = (s.turn - 1) % 32 WHERE s.turn > 0)
SELECT doc_id, f.slot::INTEGER AS slot, f.name AS shard
FROM documents d JOIN filled f ON f.slot = {_MD5_32.format("coalesce(d.doc_id::VARCHAR, '')")} % 4099"""

_TITLE = "CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' WHEN 'tool' THEN 'Tool' END"
_ESCAPE = r"replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#')"
_HEADER = "### (System|User|Assistant|Tool|@[0-9A-F]*): "
OP2 = rf"""WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, n, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, role)
),
sized AS (
    SELECT *,
        4 + coalesce(length({_TITLE}), 1 + length(hex(role))) + 2 + 8
        + length(CASE WHEN regexp_matches(text, '\\.', 's') OR contains(text, '</turn>') OR regexp_matches(text, '{_HEADER}', 's')
                      THEN {_ESCAPE} ELSE text END) AS n
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

OP7 = """WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
        AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.e, x.e)::BIGINT AS score
    FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_RUNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_RUNS}')"


# Windows of twice the power of two that holds a notice, 16 words at least; four fifths of its words needed. No phrase has over 4 words.
OP11 = f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS words FROM documents),
notices AS (
    SELECT tid, label, words, n, (4 * n + 4) // 5 AS need, greatest(16, 2 * pow(2, ceil(log2(len(words))))::BIGINT) AS size
    FROM (SELECT *, len(list_distinct(words)) AS n FROM (
        SELECT tid, label, {_words("notice")} AS words
        FROM (VALUES {", ".join(f"({i}, {_text(label)}, {_text(notice)})" for i, (label, notice) in enumerate(TEMPLATES))}) v(tid, label, notice)))
),
notice_words AS (SELECT DISTINCT tid, label, n, need, size, unnest(words) AS word FROM notices),
placed AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM docs),
said AS (SELECT rid, place, list(word) OVER (PARTITION BY rid ORDER BY place ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS ahead FROM placed),
held AS (
    SELECT rid, tid, label, n, need, k, word FROM (
        SELECT p.rid, w.*, p.place // (size // 2) AS k0 FROM placed p JOIN notice_words w USING (word)
    ), LATERAL (SELECT k0 - back AS k FROM (VALUES (0), (1)) b(back)) WHERE k >= 0
),
met AS (
    SELECT rid, label, count(DISTINCT word) / any_value(n)::DOUBLE AS containment
    FROM held GROUP BY rid, tid, label, k HAVING count(DISTINCT word) >= any_value(need)
),
phrases AS (
    SELECT label, string_split(phrase, ' ') AS words
    FROM (VALUES {", ".join(f"({_text(phrase)}, {_text(label)})" for phrase, label in PHRASES)}) v(phrase, label)
),
places AS (
    SELECT rid, label, place FROM said JOIN phrases ON ahead[1] = words[1] AND ahead[: len(words)] = words
),
base AS (
    SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY rid
),
labelled AS (
    SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT rid, label FROM met UNION ALL SELECT rid, label FROM places) GROUP BY rid
),
best AS (SELECT rid, max(containment) AS score FROM met GROUP BY rid)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM docs d LEFT JOIN base USING (rid) LEFT JOIN labelled USING (rid) LEFT JOIN best USING (rid)"""
