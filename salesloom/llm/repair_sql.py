"""The repair of conversations in SQL: the cheapest edits so far for each last role, row by row."""

from __future__ import annotations


def step(state: str, cost: object, letter: str, added: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {added}}}"


def put(state: str, said: str) -> str:
    return f"CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {said}"


def least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def insert(state: str, role: str) -> str:
    return step(state, 5, "I", put(state, f"'{role}:'"))


def keep(state: str, initial: str) -> str:
    allowed = f"initial = '{initial}' AND fault NOT IN ('blank', 'duplicate')"
    return step(state, f"CASE WHEN {allowed} THEN CASE fault WHEN 'truncated' THEN 5 ELSE 0 END ELSE 1000000000 END", "K", put(state, "role || ':' || text"))


def rerole(state: str, role: str) -> str:
    return step(state, "CASE fault WHEN 'truncated' THEN 6 WHEN 'sound' THEN 1 ELSE 1000000000 END", "R", put(state, f"'{role}:' || text"))


def delete(state: str) -> str:
    return step(state, 2, "D")


FAR = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''}"
USER = least("w.u", *[insert(f"w.{state}", "user") for state in "nsa"])

REPAIR = rf"""
WITH RECURSIVE crc AS (
    SELECT list(c ORDER BY b) AS of_byte FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE c & 1 WHEN 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS bytes(b)
    )
),
drawn AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(4294967295, [ord(x) FOR x IN string_split(
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
            lambda c, x: xor(c >> 8, of_byte[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS draw
    FROM conversations, crc
),
damaged AS (
    SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
        CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE draw WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM drawn WHERE draw <> 0
),
placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said
    FROM damaged
),
judged AS (
    SELECT conv_id, turn, role, text, initial, place,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN said > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'sound' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS neighbours
    FROM placed
),
counted AS (
    SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
),
-- The cheapest edits so far for each last role: n(one), s(ystem), u(ser), a(ssistant).
walked(conv_id, done, n, s, u, a) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}}, {FAR}, {FAR}, {FAR} FROM conversations
    UNION ALL
    SELECT conv_id, done + 1, {delete("n")},
        {least(delete("s"), keep("n", "s"))},
        {least(delete("u"), *[f(x, r) for x in ("n", "s", "a") for f, r in ((keep, "u"), (rerole, "user"))])},
        {least(delete("a"), keep("u", "a"), rerole("u", "assistant"))}
    FROM (
        SELECT conv_id, done, n, s, u, {least("a", insert("u", "assistant"))} AS a, role, text, initial, fault
        FROM (
            SELECT w.conv_id, done, w.n, w.s, w.a, role, text, initial, fault, {USER} AS u
            FROM walked w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.place = w.done + 1
        )
    )
),
ended AS (
    SELECT conv_id, done, {least("n", "a", insert("u", "assistant"))} AS best FROM (
        SELECT conv_id, done, n, a, {USER} AS u FROM walked w
    )
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(best.t) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
WHERE done = coalesce(n_rows, 0)
"""
