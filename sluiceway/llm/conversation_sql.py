"""DuckDB SQL for the two queries over conversations."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: its definition, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i, 1))::BIGINT)"
    step = "list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


#: Paths are lists of (role, text); a node is a path with the conversations that begin with it.
PREFIX_TRIE = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT conv_id, turns, {crc32("conv_id::VARCHAR")} % 6 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(o.turns[1:h], []), c.turns[h + 1:]) AS turns
  FROM cut c LEFT JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100),
members AS (SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY d, path),
kids AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.path = n.path),
sums AS (
  SELECT a AS d, path[1:a] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(coalesce((n_convs - 1) * length(path[d].t), 0)) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY 1, 2)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON s.d = n.d AND s.path = n.path LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""


def _after(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _least(*options: str) -> str:
    """The least of values (cost, audit), some of which may be missing."""
    return f"list_min(list_filter([{', '.join(options)}], lambda v: v.c IS NOT NULL))"


def _inserted(table: str) -> str:
    """The states of `table` after insertions: an inserted user, then an inserted assistant."""
    user = _least("u", *(_after(s, "5", "I") for s in "xsa"))
    return f"SELECT conv_id, i, x, s, u, {_least('a', _after('u', '5', 'I'))} AS a FROM (SELECT conv_id, i, x, s, {user} AS u, a FROM {table})"


def _edited() -> str:
    """The states x (nothing said), s, u, a after one row."""
    drop = {q: _after(f"q.{q}", "2", "D") for q in "xsua"}
    stay = "(CASE fault WHEN 'truncated' THEN 5 ELSE 0 END)"
    free = "fault IS DISTINCT FROM 'blank' AND fault IS DISTINCT FROM 'duplicate'"

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN {free} AND initial = '{initial}' THEN {_after(f'q.{state}', stay, 'K')} END"

    def rerole(state: str) -> str:
        return f"CASE WHEN {free} THEN {_after(f'q.{state}', f'1 + {stay}', 'R')} END"

    said = [o for state in "xsa" for o in (keep(state, "u"), rerole(state))]
    return (
        f"SELECT q.conv_id, q.i + 1 AS i, {drop['x']} AS x, {_least(drop['s'], keep('x', 's'))} AS s, {_least(drop['u'], *said)} AS u, "
        f"{_least(drop['a'], keep('u', 'a'), rerole('u'))} AS a FROM q JOIN judged r ON r.conv_id IS NOT DISTINCT FROM q.conv_id AND r.i = q.i + 1"
    )


_CLASS = r"[^\x20\x09-\x0D]"

#: One step of the recursion for each row: the cheapest edits that lead to each state of the pattern; then one step for each edit of the cheapest.
STRUCTURE_REPAIR = f"""
WITH RECURSIVE spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) FROM spaced WHERE kind <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '{_CLASS}') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault
  FROM placed),
measured AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) AS n
  FROM judged GROUP BY conv_id),
pairs AS (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM judged),
wrong AS (SELECT conv_id, count(*) AS illegal FROM pairs WHERE pair NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
q AS (
  SELECT * FROM ({_inserted("(SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS x, NULL::STRUCT(c BIGINT, a VARCHAR) AS s, NULL::STRUCT(c BIGINT, a VARCHAR) AS u, NULL::STRUCT(c BIGINT, a VARCHAR) AS a FROM ids)")})
  UNION ALL SELECT * FROM ({_inserted(f"({_edited()})")})),
best AS (
  SELECT q.conv_id, {_least("q.x", "q.a")} AS v FROM q LEFT JOIN measured m ON m.conv_id IS NOT DISTINCT FROM q.conv_id WHERE q.i = coalesce(m.n, 0)),
steps AS (
  SELECT conv_id, v.a AS audit, 0::BIGINT AS k, 0::BIGINT AS i, '' AS before, []::VARCHAR[] AS lines FROM best
  UNION ALL
  SELECT conv_id, audit, k + 1, read, CASE WHEN role IS NULL THEN before ELSE substr(role, 1, 1) END, CASE WHEN role IS NULL THEN lines ELSE list_append(lines, role || ':' || said) END
  FROM (
    SELECT t.conv_id, audit, k, before, lines, t.i + CASE e WHEN 'I' THEN 0 ELSE 1 END AS read, CASE e WHEN 'I' THEN '' ELSE r.text END AS said,
      CASE e WHEN 'D' THEN NULL WHEN 'K' THEN r.role ELSE CASE before WHEN 'u' THEN 'assistant' ELSE 'user' END END AS role
    FROM (SELECT *, substr(audit, k + 1, 1) AS e FROM steps WHERE k < length(audit)) t
    LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i + 1)),
done AS (SELECT conv_id, audit, lines FROM steps WHERE k = length(audit))
SELECT b.conv_id, coalesce(m.gaps, 0)::BIGINT AS gaps, coalesce(m.blank, 0)::BIGINT AS blank, coalesce(m.duplicate, 0)::BIGINT AS duplicate, coalesce(m.truncated, 0)::BIGINT AS truncated,
  coalesce(w.illegal, 0)::BIGINT AS illegal, b.v.c::BIGINT AS cost, d.audit, sha256(array_to_string(d.lines, chr(10))) AS repaired_sha256
FROM best b JOIN done d ON d.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN measured m ON m.conv_id IS NOT DISTINCT FROM b.conv_id
  LEFT JOIN wrong w ON w.conv_id IS NOT DISTINCT FROM b.conv_id
"""
