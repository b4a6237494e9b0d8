"""SQL for another engine that gives the rows of the repair and manifest queries."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text, bit by bit."""
    data = f"list_transform(range(1, length({text}) + 1), lambda p: ascii(substr({text}, p, 1))::BIGINT)"
    shift = "CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END"
    byte = f"list_reduce(range(0, 8), lambda d, k: {shift}, xor(c, b))"
    return f"xor(list_reduce({data}, lambda c, b: {byte}, 4294967295::BIGINT), 4294967295)"


def _spend(state: str, cost: str, initial: str) -> str:
    """A path as its cost in nine digits and its initials, so that the least text is the best path; 'x' is none."""
    paid = f"lpad((substr({state}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0')"
    return f"CASE WHEN {state} = 'x' THEN 'x' ELSE {paid} || substr({state}, 10) || '{initial}' END"


def _insert(state: str) -> str:
    return _spend(state, "5", "I")


def _fitting(letter: str, states: str) -> list[str]:
    """Keep and Rerole from the given states; a turn of another initial, or one that must go, is not kept."""
    late = "(CASE WHEN cut THEN 5 ELSE 0 END)"
    kept = [f"CASE WHEN gone OR initial <> '{letter}' THEN 'x' ELSE {_spend('w' + s, late, 'K')} END" for s in states]
    changed = [f"CASE WHEN gone THEN 'x' ELSE {_spend('w' + s, f'1 + {late}', 'R')} END" for s in states]
    return kept if letter == "s" else [*kept, *changed]


def turn_repair() -> str:
    deleted = [_spend(f"w{s}", "2", "D") for s in range(4)]
    after = [
        deleted[0],
        f"least({', '.join([deleted[1], *_fitting('s', '0')])})",
        f"least({', '.join([deleted[2], *_fitting('u', '013')])})",
        f"least({', '.join([deleted[3], *_fitting('a', '2')])})",
    ]
    twice = [_insert(f"({_insert(f'v{s}')})") for s in range(4)]
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(f'({key})')} % 20 AS fault
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE fault <> 0
), o AS (
  SELECT *, substr(role, 1, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS ended,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
  FROM d
), f AS (
  SELECT conv_id, turn, role, text, initial, i, ended = '' AS blank,
         ended <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         right(ended, 1) NOT IN ('.', '!', '?') AS unfinished,
         i > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS misplaced
  FROM o
), g AS (
  SELECT *, blank OR again AS gone, NOT blank AND NOT again AND unfinished AS cut FROM f
), dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS v0, 'x' AS v1, 'x' AS v2, 'x' AS v3 FROM g
  UNION ALL
  SELECT conv_id, i, {after[0]}, {after[1]}, {after[2]}, {after[3]}
  FROM (
    SELECT g.conv_id, g.i, g.initial, g.gone, g.cut, v0 AS w0, v1 AS w1,
           least(v2, {_insert('v0')}, {_insert('v1')}, {_insert('v3')}) AS w2,
           least(v3, {_insert('v2')}, {twice[0]}, {twice[1]}) AS w3
    FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND g.i = dp.i + 1
  )
), s AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (misplaced) AS illegal
  FROM g GROUP BY conv_id
), e AS (
  SELECT s.*, least(v0, v3, {_insert('v2')}, {twice[1]}) AS best
  FROM s JOIN dp ON dp.conv_id IS NOT DISTINCT FROM s.conv_id AND dp.i = s.n
), edits AS (
  SELECT conv_id, p, substr(best, (9 + p)::INT, 1) AS edit FROM e, LATERAL (SELECT unnest(range(1, length(best) - 8)) AS p)
), placed AS (
  SELECT conv_id, p, edit, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS line,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) AS lines
  FROM edits
), said AS (
  SELECT placed.conv_id, p,
         CASE WHEN edit = 'K' THEN g.role WHEN (line - lines % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN edit = 'I' THEN '' ELSE g.text END AS line
  FROM placed LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM placed.conv_id AND g.i = placed.i
  WHERE edit <> 'D'
), r AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS repaired FROM said GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(substr(best, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""


def merkle(leaf_levels: int = 8, source_levels: int = 8) -> str:
    """Levels are written out; 16 to their number is the most leaves of a source, and the most sources."""

    def digest(text: str) -> str:
        fields = [f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(fields)})"

    steps = []

    def climb(first: str, levels: int, name: str) -> None:
        """Tables of nodes (tree, pos, h, n); a tree with one node stays as it is."""
        steps.append(f"{name}0 AS ({first})")
        for level in range(1, levels + 1):
            below = f"{name}{level - 1}"
            steps.append(f"""{name}{level} AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (
    SELECT tree, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
    FROM {below} GROUP BY tree, pos // 16)
)""")

    climb("SELECT tree, pos, h, n FROM leaves", leaf_levels, "a")
    climb(
        f"""SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS n, tree AS source
  FROM a{leaf_levels}""",
        source_levels,
        "b",
    )

    def fold(name: str, levels: int, rows: str) -> str:
        """Adds to (tree, place, proof, now) the siblings of each level, and what the claimed node becomes."""
        for level in range(levels):
            following = f"{name}_{level}"
            steps.append(f"""{name}r{level} AS (
  SELECT tree, pos // 16 AS run, any_value(n) AS n, list(h ORDER BY pos) AS hs FROM {name}{level} GROUP BY tree, pos // 16
), {following} AS (
  SELECT p.* REPLACE (
           place // 16 AS place,
           proof || CASE WHEN r.n = 1 THEN '' ELSE coalesce(array_to_string(list_concat(hs[:(place % 16)::INT], hs[(place % 16 + 2)::INT:]), ''), '') END AS proof,
           CASE WHEN r.n = 1 THEN now ELSE sha256(array_to_string(list_concat(list_append(hs[:(place % 16)::INT], now), hs[(place % 16 + 2)::INT:]), '')) END AS now)
  FROM {rows} p JOIN {name}r{level} r ON r.tree IS NOT DISTINCT FROM p.tree AND r.run = p.place // 16
)""")
            rows = following
        return rows

    steps.append("start AS (SELECT id, row, tree, h AS leaf, pos AS place, '' AS proof, claim AS now FROM leaves)")
    last = fold("a", leaf_levels, "start")
    steps.append(f"""middle AS (
  SELECT p.id, p.row, 0 AS tree, leaf, b.pos AS place, proof, now, b.h AS subroot FROM {last} p
  JOIN b0 b ON b.source IS NOT DISTINCT FROM p.tree
)""")
    last = fold("b", source_levels, "middle")
    return f"""
WITH facts AS (
  SELECT doc_id, source, {digest('text')} AS h, doc_id IS NOT NULL AND {crc32_sql('doc_id::VARCHAR')} % 5 = 0 AS hit,
         {digest("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered
  FROM documents
), leaves AS (
  SELECT doc_id AS id, row_number() OVER () AS row, source AS tree, h, CASE WHEN hit THEN lowered ELSE h END AS claim,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM facts
), {', '.join(steps)}
SELECT id AS doc_id, leaf, subroot, (SELECT any_value(h) FROM b{source_levels}) AS root, sha256(proof) AS proof_sha256,
       now AS folded_root, now = (SELECT any_value(h) FROM b{source_levels}) AS verified
FROM {last}
"""
