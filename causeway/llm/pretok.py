"""Pre-token boundaries of byte-level BPE without a regular expression.

Each code point becomes a class; look-ahead (the next character after white space, the letters after an apostrophe) is
folded into the class by comparing shifted arrays. What remains is a finite automaton. Its transition functions under
composition form a small monoid, so the states at all positions come from an associative scan over monoid elements: the
text is cut into equal rows, all rows are scanned side by side, and the rows' totals are then chained.

The boundaries equal those of ``public_tokenizers.PATTERN``.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

# Classes. L letter, N number, O other, T1 / T2 apostrophe before a contraction of one / two letters,
# B blank before a visible character, W white space before white space or an end, V other white space before a visible
# character, E the first position of a text (added in front of its class as a reset of the state).
L, N, O, T1, T2, B, W, V = range(8)
CLASSES = 8
# States: S nothing open, l / n / o / w a run of letters / numbers / others / white space, p a blank that the next character
# joins, 1 / 2 letters of a contraction still to come.
S, IN_L, IN_N, IN_O, IN_W, IN_P, LEFT_1, LEFT_2 = range(8)
STATES = 8

#: White space of Unicode (property White_Space).
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a pre-token starts at this character."""
    if state == LEFT_2:
        return LEFT_1, False
    if state == LEFT_1:
        return S, False
    if kind == L:
        return IN_L, state not in (IN_L, IN_P)
    if kind == N:
        return IN_N, state not in (IN_N, IN_P)
    if kind == O or kind in (T1, T2) and state in (IN_O, IN_P):
        return IN_O, state not in (IN_O, IN_P)
    if kind == T1:
        return LEFT_1, True
    if kind == T2:
        return LEFT_2, True
    if kind == B:
        return IN_P, True
    if kind == V:
        return S, True
    return IN_W, state != IN_W


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Generator of each (class, first of a text), table of products (first, then second), and each element as a function."""
    generators = []
    for reset in (False, True):
        for kind in range(CLASSES):
            generators.append(tuple(_step(S if reset else s, kind)[0] for s in range(STATES)))
    elements = {tuple(range(STATES)): 0}
    todo = [tuple(range(STATES))]
    while todo:
        f = todo.pop()
        for g in generators:
            h = tuple(g[x] for x in f)
            if h not in elements:
                elements[h] = len(elements)
                todo.append(h)
    functions = np.array(list(elements), np.uint8)
    product = np.array([[elements[tuple(b[x] for x in a)] for b in elements] for a in elements], np.uint16)
    return np.array([elements[g] for g in generators], np.uint16), product, functions


_GENERATOR, _PRODUCT, _FUNCTION = _monoid()
_FLAT = _PRODUCT.reshape(-1)
_SIZE = np.uint32(len(_PRODUCT))
_STARTS = np.array([[_step(s, k)[1] for k in range(CLASSES)] for s in range(STATES)])

_table: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """L, N, O or W of every code point."""
    if not _table:
        out = np.full(sys.maxunicode + 1, O, np.uint8)
        category = unicodedata.category
        kinds = {"L": L, "N": N}
        for c in range(sys.maxunicode + 1):
            if (k := kinds.get(category(chr(c))[0])) is not None:
                out[c] = k
        out[list(WHITE_SPACE)] = W
        _table.append(out)
    return _table[0]


def classes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes with look-ahead. ``first`` marks the first position of each text (one longer than ``points``)."""
    n = len(points)
    out = class_table()[points]
    white = out == W
    ends = first[1:]
    visible_next = np.zeros(n, bool)
    visible_next[:-1] = ~white[1:]
    visible_next &= ~ends
    at = np.flatnonzero(white & visible_next)
    out[at] = np.where(points[at] == 32, B, V)
    at = np.flatnonzero(points == 39)
    if len(at):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        ended = np.concatenate([ends, np.ones(2, bool)])
        a, b = padded[at + 1], padded[at + 2]
        one = ~ended[at] & np.isin(a, [ord(x) for x in "stmd"])
        two = ~ended[at] & ~ended[at + 1] & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        out[at[one]] = T1
        out[at[two]] = T2
    return out


def starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens start, over all texts of a chunk (``offsets`` in code points)."""
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    kind = classes(points, first)
    rows = max(1, min(4096, n // 64))
    width = -(-n // rows)
    element = np.zeros(rows * width, np.uint16)
    element[:n] = _GENERATOR[kind + CLASSES * first[:n].view(np.uint8)]
    element = np.ascontiguousarray(element.reshape(rows, width).T)
    for k in range(1, width):  # inclusive scan along each row
        element[k] = _FLAT.take(element[k - 1] * _SIZE + element[k])
    entry = np.zeros(rows, np.uint8)
    state = S
    for r, total in enumerate(element[-1].tolist()):
        entry[r] = state
        state = _FUNCTION[total, state]
    after = _FUNCTION.reshape(-1).take(element * np.uint16(STATES) + entry).T.reshape(-1)[:n]
    before = np.empty(n, np.uint8)
    before[0] = S
    before[1:] = after[:-1]
    before[first[:n]] = S
    return np.flatnonzero(_STARTS.reshape(-1).take(before * np.uint8(CLASSES) + kind))


def pretokens(text: str, points: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The pre-tokens of a chunk in order, the start of each, and for each text where its pre-tokens begin and end."""
    at = starts(points, offsets)
    bounds = np.append(at, len(points)).tolist()
    pieces = [text[a:b] for a, b in zip(bounds, bounds[1:])]
    return pieces, at, np.searchsorted(at, offsets)
