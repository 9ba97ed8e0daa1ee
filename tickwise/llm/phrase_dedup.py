"""Substring deduplication with automata of repeated phrases.

Removes every word covered by a ``SIZE``-word window that also starts in a document with a
smaller doc_id.  Texts are cut into anchored spans and spans are counted by content
(``recurrence``), which confirms the passages that recur as a whole.  The differing contents
of one anchor may still share windows: those that occur in two contents are confirmed, and
compiled into an Aho-Corasick automaton for that group of anchors, one shard of the phrases.
The group's contents stream through their shard, which locates every occurrence; what holds
for a content holds for all documents that have it.

An automaton's alphabet is its shard's vocabulary, one character per word, so a window has
``SIZE`` nodes at most, and a shard at most ``SHARD_WINDOWS`` windows.

Defined cases.  Null, empty and blank texts have no words.  Texts of fewer than ``SIZE``
words lose nothing.  A null doc_id comes after all others.  Rows with equal doc_id never
remove from each other.  Words are bytes, so ill-formed UTF-8 needs no rule.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm import recurrence

SIZE = 50
#: Words of the pieces that anchor a window.
GRAM = 8
SHARD_WINDOWS = 20_000


def automaton(phrases: dict[str, int]):
    """Finds phrases (one character per word); a match gives its value."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        machine.add_word(phrase, value)
    machine.make_automaton()
    return machine


def locate(shard: list[tuple], phrases: dict[str, int]) -> Iterator[tuple]:
    """Marks for every occurrence of the phrases in the shard's contents."""
    machine = automaton(phrases)
    for a, c, letters in shard:
        lo = hi = 0
        value = None
        for end, least in machine.iter(letters):
            at = end + 1 - SIZE
            if at == hi and least == value:
                hi += 1
                continue
            if value is not None:
                yield a, c, lo, hi, value
            lo, hi, value = at, at + 1, least
        if value is not None:
            yield a, c, lo, hi, value


def shared_windows(group: list[tuple]) -> Iterator[tuple]:
    """Marks for the windows that occur in two contents of a group."""
    alphabet: dict[bytes, str] = {}

    def letter(word: bytes) -> str:
        n = len(alphabet) + 1
        return alphabet.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    by_anchor = defaultdict(list)
    for a, c, least, starts, body in group:
        by_anchor[a].append((c, least, starts, "".join(map(letter, body.split()))))
    shard, phrases = [], {}
    for a, rows in by_anchor.items():
        seen: dict[str, int] = {}
        common: dict[str, int] = {}
        for _, least, starts, letters in rows:
            for i in range(starts):
                w = letters[i:i + SIZE]
                old = seen.get(w)
                if old is None:
                    seen[w] = least
                else:
                    seen[w] = common[w] = min(old, least)
        if not common:
            continue
        if phrases and len(phrases) + len(common) > SHARD_WINDOWS:
            yield from locate(shard, phrases)
            shard, phrases = [], {}
        # windows of different anchors differ
        phrases |= common
        shard += [(a, c, letters) for c, _, _, letters in rows]
    if phrases:
        yield from locate(shard, phrases)


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, h and cuts: the words of each text that an earlier document has."""
    spans = recurrence.spans_of(docs, "words", SIZE, GRAM)
    found = recurrence.contents(spans)
    narrow, wide = recurrence.rivals(docs, found, "words", SIZE)
    whole = found.filter("n > 1").select("a", "c", F.lit(0).cast("bigint").alias("lo"),
                                         F.col("starts").alias("hi"), "least")
    marks = whole.unionByName(recurrence.compare(narrow, shared_windows)).unionByName(
        recurrence.by_digest(wide, "words", SIZE))
    return recurrence.intervals(spans, marks, found, SIZE, True)


def _summary(body: list[bytes], cuts: list[list[int]]) -> tuple:
    kept, at = [], 0
    for lo, hi in cuts:
        kept += body[at:lo]
        at = hi
    kept += body[at:]
    return len(body), len(body) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), cuts


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and removed (word spans) of each row."""
    return recurrence.apply_cuts(
        docs, removals(docs), "words",
        "n_words bigint, n_removed bigint, kept_sha256 string, removed array<array<bigint>>", _summary)
