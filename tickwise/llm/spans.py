"""Windows of many texts, cut into spans that a content anchor owns.

A window is ``size`` consecutive tokens.  Among the ``gram``-token pieces inside it, the one
with the smallest hash (the leftmost of equals) is its anchor.  Equal windows have the same
anchor at the same place, so whatever repeats can be found among the spans of one anchor.
A span is a run of consecutive window starts with one anchor: about half a window long, and
each window of a text belongs to exactly one span.

Where a text repeats itself every few tokens, so do its spans: in a run of one letter each
window has its own anchor, and all spans are alike.  Spans of one text with the same anchor and
content that follow each other at one step of at most a window are kept as one row, with their
number and step (``folded``), so such a stretch gives as many rows as its period is long.

Defined cases.  Texts of fewer than ``size`` tokens have no spans, so neither have empty ones.
Any bytes are tokens.  Equal texts have equal spans.

Tokens are slices of one byte buffer, given by the offsets where they begin and end.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

#: An odd multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; longer texts are cut into pieces that overlap by a window.
PIECE = 1 << 16


def _powers(base: int, n: int):
    import numpy as np

    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class SliceHash:
    """64-bit hashes of many slices of a byte buffer."""

    def __init__(self):
        import numpy as np

        self.letters = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little")
                                 for b in range(256)], np.uint64)
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, buffer, begins, ends):
        import numpy as np

        n = len(buffer)
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, 2 * n + 1), _powers(_BACK, 2 * n + 1)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(self.letters[buffer] * self.up[:n], out=prefix[1:])
        h = (prefix[ends] - prefix[begins]) * self.down[begins]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


def sliding_min(v, width: int):
    """min(v[i:i + width]) for every i that has them all."""
    import numpy as np

    have, m = 1, v
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:len(v) - width + 1], m[width - have:]) if width > have else m


@dataclass
class Spans:
    """Spans of a buffer: the text each is in, its first window start and the number of
    starts (in tokens of the text), the hashes of its anchor and of its content, and how
    often it comes again at which step."""

    text: object
    first: object
    starts: object
    anchor: object
    content: object
    repeat: object = None
    step: object = None


def folded(spans: Spans, size: int) -> Spans:
    """``spans`` with rows that follow each other at one step put together."""
    import numpy as np

    n = len(spans.text)
    if not n:
        spans.repeat = spans.step = np.zeros(0, np.int64)
        return spans
    order = np.lexsort((spans.first, spans.starts, spans.content, spans.anchor, spans.text))
    text, anchor, content, starts, first = (
        x[order] for x in (spans.text, spans.anchor, spans.content, spans.starts, spans.first))
    gap = np.diff(first)
    alike = ((text[1:] == text[:-1]) & (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
             & (starts[1:] == starts[:-1]) & (gap <= size))
    # a row goes on with the run before it if its step is the run's, or the run is one row long
    goes_on = alike.copy()
    goes_on[1:] &= (gap[1:] == gap[:-1]) | ~alike[:-1]
    new = np.flatnonzero(np.append(True, ~goes_on))
    repeat = np.diff(np.append(new, n))
    step = np.where(repeat > 1, gap[np.minimum(new, n - 2)] if n > 1 else 0, 0)
    return Spans(text[new], first[new], starts[new], anchor[new], content[new], repeat, step)


def cut(buffer: bytes, begins, ends, first_token, size: int, gram: int, hasher: SliceHash) -> Spans:
    """The spans of the texts in ``buffer``.

    ``begins`` and ``ends`` are the tokens' byte offsets; ``first_token[t]`` is the first
    token of text t, with one more entry for the end.
    """
    import numpy as np

    none = np.zeros(0, np.int64)
    n_texts, n = len(first_token) - 1, len(begins)
    if n < size:
        return Spans(none, none, none, none, none)
    data = np.frombuffer(buffer, np.uint8)
    h = hasher(data, begins[:n - gram + 1], ends[gram - 1:])
    ranked = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    low = sliding_min(ranked, size - gram + 1)
    # window starts that end inside their text
    room = np.diff(first_token) - size + 1
    fits = np.flatnonzero(room > 0)
    if not len(fits):
        return Spans(none, none, none, none, none)
    count = room[fits]
    jump = np.ones(int(count.sum()), np.int64)
    at = np.cumsum(count) - count
    jump[0] = first_token[fits[0]]
    jump[at[1:]] = first_token[fits[1:]] - (first_token[fits[:-1]] + count[:-1] - 1)
    starts = np.cumsum(jump)
    owner = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # an anchor lies inside its window, so windows of two texts never share one
    new = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    anchor = owner[new]
    text = np.searchsorted(first_token, first, side="right") - 1
    text = np.minimum(text, n_texts - 1)
    digest = hashlib.blake2b
    content = np.frombuffer(b"".join(
        [digest(buffer[a:b], digest_size=8).digest()
         for a, b in zip(begins[first].tolist(), ends[last + size - 1].tolist(), strict=True)]), np.uint64)
    content = content + (anchor - first).astype(np.uint64) * np.uint64(_BASE)
    return Spans(text, first - first_token[text], last - first + 1, h[anchor].view(np.int64),
                 content.view(np.int64))


def byte_tokens(bodies: list[bytes]):
    """Buffer, token offsets and first tokens of texts whose tokens are their bytes."""
    import numpy as np

    begins = np.arange(sum(map(len, bodies)))
    return b"".join(bodies), begins, begins + 1, np.cumsum([0, *map(len, bodies)])


def word_tokens(bodies: list[list[bytes]]):
    """The same for texts that are lists of words, joined by one space."""
    import numpy as np

    buffer = b" ".join([b" ".join(b) for b in bodies if b])
    gaps = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32)
    begins, ends = np.append(0, gaps + 1), np.append(gaps, len(buffer))
    if not buffer:
        begins = ends = np.zeros(0, np.int64)
    return buffer, begins, ends, np.cumsum([0, *map(len, bodies)])


def span_batches(bodies, tokens, weigh, size: int, gram: int):
    """(index of the text, Spans) for an iterator of texts, some 64 KB at a time.

    ``weigh`` gives a text's length in tokens; a text longer than ``PIECE`` tokens is cut
    into parts that overlap by a window less one token.  A span may be cut at such a part's
    end: both halves keep the anchor, and equal windows still meet there.
    """
    import numpy as np

    hasher, held, where, room = SliceHash(), [], [], 0

    def close():
        spans = folded(cut(*tokens(held), size, gram, hasher), size)
        index = np.array([i for i, _ in where], np.int64)[spans.text]
        offset = np.array([o for _, o in where], np.int64)[spans.text]
        spans.first = spans.first + offset
        return index, spans

    for i, body in enumerate(bodies):
        n = weigh(body)
        for at in range(0, max(1, n - size + 1), PIECE):
            part = body if n <= PIECE + size else body[at:at + PIECE + size - 1]
            held.append(part)
            where.append((i, at))
            room += len(part)
            if room >= PIECE:
                yield close()
                held, where, room = [], [], 0
            if n <= PIECE + size:
                break
    if held:
        yield close()
