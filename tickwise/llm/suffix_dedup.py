"""Suffix-array deduplication with a run-length index.

Removes every byte covered by a ``SIZE``-byte string that also starts anywhere else in the
corpus.  Texts are cut into anchored spans and spans are counted by content (``recurrence``);
that settles exact copies.  The differing contents of one anchor, say near copies, are a
repetitive text: a group of them is indexed by a run-compressed Burrows-Wheeler transform.

For the text T of a group, the suffix array gives the transform and its runs.  Only at run
boundaries are suffix-array samples kept and longest common prefixes computed: inside a run
the match of a suffix is that of the one before it in T, less one.  One pass over T therefore
streams the matching statistics, the longest match of each position with any other place,
from the samples alone; positions with ``SIZE`` or more are marked.

Defined cases.  Null and empty texts have no bytes.  Texts shorter than ``SIZE`` lose
nothing.  Equal rows are copies of each other: all of them lose what they share, and none is
spared.  A text is its bytes, valid UTF-8 or not.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm import recurrence

SIZE = 400
#: Bytes of the pieces that anchor a window.
GRAM = 64


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of spans, with the samples at its run ends."""

    def __init__(self, bodies: list[bytes]):
        import numpy as np

        # 0 ends each span; bytes are 1 to 256
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int(sizes.sum()) + len(bodies), np.uint64)
        inside = np.ones(len(text), bool)
        inside[self.begins + sizes] = False
        text[inside] = np.frombuffer(b"".join(bodies), np.uint8)
        text[inside] += np.uint64(1)
        self.text, self.n = text, len(text)
        order, self.ranks = self._sorted()
        before = np.where(order > 0, text[order - 1], np.uint64(300))
        # boundaries between runs, and the samples on both sides
        edge = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.runs = len(edge) + 1
        self.upper, self.lower = order[edge - 1], order[edge]
        self.match = self._common(self.upper, self.lower)

    def _sorted(self):
        """The suffix array by prefix doubling, and the ranks of every round (for prefixes
        of 4, 8, 16, ... symbols)."""
        import numpy as np

        n = self.n
        width = np.uint64(max(1, n.bit_length()))
        place = np.arange(n, dtype=np.uint64)
        key = np.zeros(n, np.uint64)
        for k in range(4):
            key <<= np.uint64(9)
            key[:n - k] |= self.text[k:]
        ranks, have = [], 4
        mask = np.uint64((1 << int(width)) - 1)
        while True:
            packed = np.sort((key << width) | place)
            order = (packed & mask).astype(np.int64)
            packed >>= width
            new = np.empty(n, bool)
            new[:1] = True
            np.not_equal(packed[1:], packed[:-1], out=new[1:])
            number = np.cumsum(new, dtype=np.uint64)  # 1, 2, ...; 0 is past the end
            rank = np.empty(n, np.uint64)
            rank[order] = number
            ranks.append(rank.astype(np.int32))
            if n == 0 or int(number[-1]) == n:
                return order, ranks
            key = rank << width
            if have < n:
                key[:n - have] |= rank[have:]
            have *= 2

    def _common(self, a, b):
        """Longest common prefixes of suffix pairs."""
        import numpy as np

        length = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[k], 4 << k
            x, y = a + length, b + length
            ok = np.maximum(x, y) < self.n
            same = np.zeros(len(a), bool)
            same[ok] = rank[x[ok]] == rank[y[ok]]
            length[same] += step
        for _ in range(4):
            x, y = a + length, b + length
            ok = np.maximum(x, y) < self.n
            same = np.zeros(len(a), bool)
            same[ok] = self.text[x[ok]] == self.text[y[ok]]
            length[same] += 1
        return length

    def matching_statistics(self):
        """For each place of the text, the longest match with a suffix that starts elsewhere."""
        import numpy as np

        reach = np.zeros(self.n, np.int64)  # match + place, known at run ends
        above, below = reach.copy(), reach
        above[self.lower] = self.match + self.lower
        below[self.upper] = self.match + self.upper
        best = np.maximum(np.maximum.accumulate(above), np.maximum.accumulate(below))
        return best - np.arange(self.n)


def repeated_starts(group: list[tuple]) -> Iterator[tuple]:
    """Marks for the windows of a group that occur in another of its spans."""
    import numpy as np

    index = RunLengthIndex([row[4] for row in group])
    long = index.matching_statistics() >= SIZE
    for (a, c, least, starts, _), at in zip(group, index.begins.tolist(), strict=True):
        change = np.flatnonzero(np.diff(np.concatenate(([0], long[at:at + starts].view(np.int8), [0]))))
        for lo, hi in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            yield a, c, lo, hi, least


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, h and cuts: the bytes of each text that repeat elsewhere."""
    spans = recurrence.spans_of(docs, "bytes", SIZE, GRAM)
    found = recurrence.contents(spans)
    narrow, wide = recurrence.rivals(docs, found, "bytes", SIZE)
    whole = found.filter("n > 1").select("a", "c", F.lit(0).cast("bigint").alias("lo"),
                                         F.col("starts").alias("hi"), "least")
    marks = whole.unionByName(recurrence.compare(narrow, repeated_starts)).unionByName(
        recurrence.by_digest(wide, "bytes", SIZE))
    return recurrence.intervals(spans, marks.withColumn("least", F.lit(0).cast("bigint")), found, SIZE, False)


def _summary(body: bytes, cuts: list[list[int]]) -> tuple:
    kept = hashlib.sha256()
    at = 0
    for lo, hi in cuts:
        kept.update(body[at:lo])
        at = hi
    kept.update(body[at:])
    return len(body), sum(hi - lo for lo, hi in cuts), len(cuts), kept.hexdigest(), cuts


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and removed (byte spans) of each row."""
    return recurrence.apply_cuts(
        docs, removals(docs), "bytes",
        "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<array<bigint>>",
        _summary)
