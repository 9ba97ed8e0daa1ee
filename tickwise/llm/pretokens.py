"""Boundaries of pre-tokens, found without regular expressions.

The pattern of byte-level BPE vocabularies (``public_tokenizers.PATTERN``) is read as a finite
automaton over classes of code points:

* a token is a run of letters, of numbers or of other signs, with at most one space before it;
* an apostrophe that begins a token takes s, t, m, d, re, ve or ll with it, and no more;
* a run of white space is one token, but its last character stands alone when a visible
  character follows: a space then joins that character's token, any other is a token.

Each code point's class is a function from the state before it to the state after it.  The
functions and their products are a small monoid, closed once into a table, so the states at
all positions come from an associative scan: prefix products inside blocks, then over the
blocks' products.  The two facts that lie ahead of a code point (what follows an apostrophe or
a white space) go into its class, by comparing shifted arrays.  The first code point of a text
has a constant function, so many texts are scanned as one array.

Classes come from a library's own idea of letters, numbers and white space (see
``class_ranges``), so boundaries agree with that library on every code point.

Defined cases.  An empty text has no pre-tokens.  A null is for the caller to make empty.
Texts must be valid UTF-8.  A text of any length is one array; callers cut long ones with
``pieces``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
#: Classes of the automaton: the first three above, an apostrophe with one or two letters to
#: take, white space inside a run, the last space of a run, another last white space.
TAKE1, TAKE2, INNER, LAST_SPACE, LAST_WHITE = range(3, 8)
CLASSES = 8
#: States: a token has ended; inside letters, numbers, other signs; after a space that will
#: join; inside white space; one or two letters still belong to an apostrophe.
END, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOIN, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8
BLOCK = 64


def step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point of class ``kind``, and whether it begins a token."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return END, False
    if kind in (LETTER, NUMBER):
        inside = IN_LETTERS if kind == LETTER else IN_NUMBERS
        return inside, state not in (inside, JOIN)
    if kind in (OTHER, TAKE1, TAKE2):
        if state in (IN_OTHERS, JOIN):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, TAKE1: ONE_LEFT, TAKE2: TWO_LEFT}[kind], True
    if kind == INNER:
        return IN_WHITE, state != IN_WHITE
    return (JOIN if kind == LAST_SPACE else END), True


@cache
def _monoid():
    """The element of each class (those of a text's first code point after the others), the
    table of products, and each element's function as states after."""
    import numpy as np

    plain = [tuple(step(s, k)[0] for s in range(STATES)) for k in range(CLASSES)]
    first = [(step(END, k)[0],) * STATES for k in range(CLASSES)]
    known = {f: i for i, f in enumerate(dict.fromkeys(plain + first))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in plain:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    functions = list(known)
    products = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    return (np.array([known[f] for f in plain + first], np.uint16), products,
            np.array(functions, np.uint8))


@cache
def _begins():
    import numpy as np

    return np.array([[step(s, k)[1] for s in range(STATES)] for k in range(CLASSES)], bool)


def _scan(elements):
    """The products of all elements up to and with each one."""
    import numpy as np

    _, products, _ = _monoid()
    size = len(products)
    flat, n = products.reshape(-1), len(elements)
    if n <= BLOCK:
        out = elements.copy()
        for i in range(1, n):
            out[i] = products[out[i - 1], out[i]]
        return out
    rows = -(-n // BLOCK)
    grid = np.zeros(rows * BLOCK, np.uint16)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    for i in range(1, BLOCK):
        grid[i] = flat[grid[i - 1].astype(np.int32) * size + grid[i]]
    before = _scan(grid[-1])[:-1].astype(np.int32) * size
    grid[:, 1:] = flat[before[None, :] + grid[:, 1:]]
    return grid.T.reshape(-1)[:n]


def states_before(kinds, first):
    """The automaton's state before each code point, given classes and first-of-text flags."""
    import numpy as np

    elements, _, after = _monoid()
    out = np.full(len(kinds), END, np.uint8)
    if len(kinds):
        out[1:] = after[_scan(elements[kinds + np.uint8(CLASSES) * first]), END][:-1]
        out[first] = END
    return out


def boundaries(points, first, table):
    """Whether each code point begins a pre-token.

    ``points`` are the code points of texts one after the other, ``first`` marks each text's
    first one, ``table`` gives a code point's class (``class_table``).
    """
    import numpy as np

    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = table[points]
    last = np.append(first[1:], True)
    follows = np.append(kind[1:], np.uint8(SPACE))
    white = kind >= SPACE
    closes = white & ~last & (follows < SPACE)
    out = np.where(white, np.uint8(INNER), kind)
    out[closes & (kind == SPACE)] = LAST_SPACE
    out[closes & (kind == WHITE)] = LAST_WHITE
    at = np.flatnonzero((points == ord("'")) & ~last)
    if len(at):
        one, two = points[at + 1], points[np.minimum(at + 2, n - 1)]
        out[at[np.isin(one, [ord(c) for c in "stmd"])]] = TAKE1
        ahead = ~last[at + 1]
        pair = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        out[at[pair & ahead]] = TAKE2
    state = states_before(out, first)
    # a text's first code point always begins a token, whatever the text before ended in
    return _begins()[out, state] | first


def class_ranges(members: Callable[[str], set[int]]) -> list[tuple[int, int, int]]:
    """(first, last, class) of every run of code points that are no ``OTHER`` signs.

    ``members(name)`` gives the code points of a regular-expression class (``\\p{L}``,
    ``\\p{N}``, ``\\s``) as the library in question has them.
    """
    import numpy as np

    kinds = np.full(0x110000, OTHER, np.uint8)
    for name, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        kinds[sorted(members(name))] = kind
    kinds[ord(" ")] = SPACE
    edge = np.flatnonzero(np.diff(kinds)) + 1
    starts, ends = np.append(0, edge), np.append(edge, len(kinds))
    return [(int(a), int(b) - 1, int(kinds[a])) for a, b in zip(starts, ends, strict=True) if kinds[a] != OTHER]


def class_table(ranges: list[tuple[int, int, int]]):
    import numpy as np

    table = np.full(0x110000, OTHER, np.uint8)
    for a, b, kind in ranges:
        table[a:b + 1] = kind
    return table


def all_characters() -> str:
    return "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))


def pre_tokens(bodies: list[bytes], table):
    """Pre-tokens of texts (valid UTF-8): the joined bytes, the byte offset where each token
    begins with one more for the end, and the index of each text's first token with one more."""
    import numpy as np

    joined = b"".join(bodies)
    points = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), "<u4")
    data = np.frombuffer(joined, np.uint8)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    text_at = np.cumsum([0, *map(len, bodies)])
    first = np.zeros(len(points), bool)
    filled = text_at[:-1][np.diff(text_at) > 0]
    first[np.searchsorted(lead, filled)] = True
    begins = lead[boundaries(points, first, table)]
    return joined, np.append(begins, len(joined)), np.searchsorted(begins, text_at)


def pieces(body: bytes, table, size: int) -> Iterator[bytes]:
    """A text cut at pre-token boundaries into parts of at most ``size`` bytes, or of one
    pre-token where that is longer."""
    at, room = 0, size
    while len(body) - at > room:
        end = at + room
        while body[end] & 0xC0 == 0x80:
            end -= 1
        part = body[at:end]
        # what follows decides on the last two code points, so a cut stays before them
        _, begins, _ = pre_tokens([part], table)
        safe = begins[(begins > 0) & (begins <= len(part) - 12)]
        # white space would be another token at a text's end, so a cut does not follow any
        cut = next((b for b in map(int, safe[::-1])
                    if table[ord(part[max(0, b - 4):b].decode("utf-8", "ignore")[-1])] < SPACE), 0)
        if not cut:
            room *= 2
            continue
        yield body[at:at + cut]
        at, room = at + cut, size
    yield body[at:]


def slices(joined: bytes, begins):
    """The pre-tokens as an Arrow array over the same bytes."""
    import pyarrow as pa

    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [
        None, pa.py_buffer(begins.astype("<i8").tobytes()), pa.py_buffer(joined)])


__all__ = ["all_characters", "boundaries", "class_ranges", "class_table", "pieces", "pre_tokens", "slices"]
