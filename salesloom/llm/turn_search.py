"""Cheapest edits that give a conversation a legal order of roles, by depth-first
branch-and-bound.

A conversation is a string of codes, one byte a row: the class of its role's initial and
its fault. A node is a place in it and the last role kept. Its branches are the edits, tried
in the order of their initials, so prefixes of the audit are met in ASCII order: of two
equally dear ways to a node the earlier one is the lesser, and a table of the least cost a
node was reached at tells which prefixes cannot lead to anything better. An explicit stack
holds the path. What remains is bounded from below by a relaxation: exact within windows
of rows, with the roles forgotten where one window meets the next. A first descent along
the bounds limits the cost; the search ends, with optimality proved, when no branch is
left whose cost and bound are below the best answer found.
"""

from __future__ import annotations

from array import array

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
# Classes of a role's initial; a code is 4 * class + fault.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
NONE = 0  # nothing kept yet
WINDOW, WINDOWS = 64, 16
_DEAR = 1 << 40
# The role that may be put after one: a user's after none, the system's, an assistant's.
NEXT = (USER, USER, ASSISTANT, USER)
_LEGAL = {(NONE, SYSTEM), (NONE, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)}
_FINAL = (0, 10, 5, 0)  # inserts that complete the conversation


def _edits(code: int, last: int) -> tuple[tuple[str, int, int, int], ...]:
    """(initial, cost, rows taken, role after it) in ASCII order."""
    role, fault = divmod(code, 4)
    edits = [("D", 2, 1, last), ("I", 5, 0, NEXT[last])]
    if fault not in (BLANK, DUPLICATE):
        more = 5 if fault == TRUNCATED else 0
        if (last, role) in _LEGAL:
            edits.append(("K", more, 1, role))
        edits.append(("R", 1 + more, 1, NEXT[last]))
    return tuple(edits)


EDITS = tuple(tuple(_edits(code, last) for last in range(4)) for code in range(16))
AT_END = tuple((("I", 5, 0, NEXT[last]),) for last in range(4))


def bounds(codes: bytes) -> array:
    """Least cost of what remains from each place and last role, 4 numbers a place."""
    n = len(codes)
    window = max(WINDOW, -(-n // WINDOWS))
    least = array("q", bytes(32 * n)) + array("q", _FINAL)
    after = _FINAL
    for place in range(n - 1, -1, -1):
        if (place + 1) % window == 0:
            after = (min(after),) * 4  # the role is forgotten between windows
        taken = [min(cost + after[role] for _, cost, rows, role in edits if rows) for edits in EDITS[codes[place]]]
        after = tuple(
            min(taken[last], 5 + taken[NEXT[last]], 10 + taken[NEXT[NEXT[last]]]) for last in range(4)
        )
        least[4 * place : 4 * place + 4] = array("q", after)
    return least


def _descent(codes: bytes, least: array) -> int:
    """Cost of the way that follows the bounds."""
    place, last, spent = 0, NONE, 0
    while place < len(codes) or _FINAL[last]:
        edits = EDITS[codes[place]][last] if place < len(codes) else AT_END[last]
        _, cost, rows, role = min(edits, key=lambda edit: (edit[1] + least[4 * (place + edit[2]) + edit[3]], -edit[2]))
        place, last, spent = place + rows, role, spent + cost
    return spent


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit."""
    n = len(codes)
    if not n:
        return 0, ""
    least = bounds(codes)
    limit = _descent(codes, least)
    reached = array("q", [_DEAR]) * (4 * n + 4)
    audit, path = "", []
    stack = [(0, NONE, 0, iter(EDITS[codes[0]][NONE]))]
    while stack:
        place, last, spent, edits = stack[-1]
        for initial, cost, rows, role in edits:
            at, total = place + rows, spent + cost
            node = 4 * at + role
            if total + least[node] > limit or total >= reached[node]:
                continue
            reached[node] = total
            if at == n and not _FINAL[role]:
                audit, limit = "".join(path) + initial, total - 1  # only a cheaper one is better
                continue
            path.append(initial)
            stack.append((at, role, total, iter(EDITS[codes[at]][role] if at < n else AT_END[role])))
            break
        else:
            stack.pop()
            if path:
                path.pop()
    return limit + 1, audit


def roles_after(audit: str, codes: bytes):
    """(row or None, role's class) of what the audit leaves, in order."""
    last, row = NONE, 0
    for edit in audit:
        if edit != "D":
            last = codes[row] // 4 if edit == "K" else NEXT[last]
            yield None if edit == "I" else row, last
        row += edit != "I"
