"""DuckDB SQL of the conversation operators (11 and 13)."""

from __future__ import annotations

# the CRC-32 table by its rule; crc(s) folds the bytes of an ASCII string
CRC_TABLE = """crc_table AS (
    SELECT list(v ORDER BY i) AS crcs FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i)
    )
)"""


def crc(s: str) -> str:
    codes = f"list_transform(string_split({s}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"


def _least(*options: str) -> str:
    """The least (cost, audit) of states; a state's text follows from those two."""
    return f"list_min([{', '.join(options)}])"


def _edit(state: str, cost: str, edit: str, line: str, when: str = "TRUE") -> str:
    return f"CASE WHEN {when} AND {state}.c < 1000000000 THEN {{'c': {state}.c + {cost}, 'p': {state}.p || '{edit}', 'o': {state}.o || {line}}} ELSE far END"


def _inserts(table: str) -> str:
    """States after insertions before the next row."""
    new_user, new_assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    u = _least("u", *(_edit(s, "5", "I", new_user) for s in "esa"))
    a = _least("a", _edit("w", "5", "I", new_assistant))
    return f"SELECT * EXCLUDE (u, a, w), w AS u, {a} AS a FROM (SELECT *, {u} AS w FROM {table})"


_KEEP = "(CASE WHEN r.fault = 't' THEN 5 ELSE 0 END)"
_REROLE = "(CASE WHEN r.fault = 't' THEN 6 ELSE 1 END)"
_STAYS = "r.fault IN ('', 't')"
_LINE = "chr(10) || r.role || ':' || r.text"


def _turned(role: str) -> str:
    return f"chr(10) || '{role}:' || r.text"


OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
source AS (
    SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
           {crc("concat(COALESCE(conv_id::VARCHAR, ' '), ':', COALESCE(turn::VARCHAR, ' '))")} % 20 AS k
    FROM conversations, crc_table
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM source, range(CASE WHEN k = 3 THEN 2 ELSE 1 END) WHERE k <> 0
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
rows AS MATERIALIZED (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                   WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault,
           i > 1 AND COALESCE(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), FALSE) AS illegal
    FROM placed
),
dp AS (
    {_inserts("""(SELECT conv_id, 0 AS i, {'c': 0, 'p': '', 'o': ''} AS e, far AS s, far AS u, far AS a, far FROM
        (SELECT DISTINCT conv_id, {'c': 1000000000, 'p': '', 'o': ''} AS far FROM conversations))""")}
    UNION ALL
    {_inserts(f'''(SELECT dp.conv_id, (dp.i + 1)::INTEGER AS i,
        {_edit("e", "2", "D", "''")} AS e,
        {_least(_edit("s", "2", "D", "''"), _edit("e", _KEEP, "K", _LINE, f"{_STAYS} AND left(r.role, 1) = 's'"))} AS s,
        {_least(_edit("u", "2", "D", "''"), *(_edit(x, _KEEP, "K", _LINE, f"{_STAYS} AND left(r.role, 1) = 'u'") for x in "esa"),
                *(_edit(x, _REROLE, "R", _turned("user"), _STAYS) for x in "esa"))} AS u,
        {_least(_edit("a", "2", "D", "''"), _edit("u", _KEEP, "K", _LINE, f"{_STAYS} AND left(r.role, 1) = 'a'"),
                _edit("u", _REROLE, "R", _turned("assistant"), _STAYS))} AS a,
        far FROM dp JOIN rows r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1)''')}
),
best AS (SELECT conv_id, arg_max({_least("e", "a")}, i) AS b FROM dp GROUP BY conv_id),
counts AS (
    SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'b') AS blank,
           COUNT(*) FILTER (fault = 'd') AS duplicate, COUNT(*) FILTER (fault = 't') AS truncated, COUNT(*) FILTER (illegal) AS illegal
    FROM rows GROUP BY conv_id
)
SELECT best.conv_id, COALESCE(gaps, 0)::BIGINT AS gaps, COALESCE(blank, 0)::BIGINT AS blank, COALESCE(duplicate, 0)::BIGINT AS duplicate,
       COALESCE(truncated, 0)::BIGINT AS truncated, COALESCE(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.p AS audit, sha256(substr(b.o, 2)) AS repaired_sha256
FROM best LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM best.conv_id"""

OP13_SQL = f"""
WITH {CRC_TABLE},
turns AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
           unhex(md5(concat(octet_length(encode(COALESCE(role, ''))), ':', COALESCE(role, ''), COALESCE(text, '')))) AS x
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, left(text, 100), x) AS seq FROM turns GROUP BY conv_id
),
heads AS (SELECT conv_id, seq, {crc("conv_id::VARCHAR")} % 6 AS h FROM own, crc_table),
rebuilt AS (
    SELECT a.conv_id, list_concat(COALESCE(b.seq[1:a.h], []), a.seq[a.h + 1:]) AS seq
    FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100
),
members AS (SELECT conv_id, d, seq[1:d] AS pre, len(seq) = d AS ends FROM rebuilt, unnest(range(len(seq) + 1)) u(d)),
nodes AS MATERIALIZED (
    SELECT d, pre, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, bool_and(ends) AS leaf,
           CASE WHEN d > 0 THEN length(pre[d].text) ELSE 0 END AS size,
           sha256(COALESCE(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY d, pre
),
above AS (
    SELECT pre[1:x] AS pre, x AS d, COUNT(*) FILTER (leaf) AS n_leaves, COUNT(*) FILTER (nodes.d = x + 1) AS n_children, SUM((n_convs - 1) * size) AS saved
    FROM nodes, unnest(range(d + 1)) u(x) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN above ON above.d = n.d AND above.pre = n.pre LEFT JOIN nodes p ON p.d = n.d - 1 AND p.pre = n.pre[1:n.d - 1]"""
