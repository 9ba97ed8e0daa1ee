"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised (A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``)
and cut into windows of 13 words; a shorter text is one window.  All windows go into one
automaton whose alphabet is the benchmark's vocabulary, one character per word, so a window
costs 13 nodes at most.  Every document's normalised words stream through it once.  A match
gives word positions, and those give the span of the original text.

The benchmark is a stated query set.  It is read in blocks of at most ``BLOCK_BYTES`` of
text; each block is one broadcast and one automaton, and the documents pass the blocks one
after the other in the same stage, with no shuffle.

Defined cases.  Null, empty and wordless texts have no words and are clean.  An item without
words has no window.  An item with a null id marks words and is not counted among the items.
Repeated documents are judged one by one; repeated items count once.  An empty benchmark
leaves every document clean.  Each ill-formed part of a text counts as U+FFFD.  Columns of ``docs`` with the names of results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import texts_of

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
ONE_IN = 20
#: Benchmark text compiled into one automaton.
BLOCK_BYTES = 512 << 10

#: Over UTF-8 bytes: separators to a space, A-Z to a-z, all else (so every byte of a
#: non-ASCII character) unchanged.
_NORMAL = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32
    for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Stands for every word outside the benchmark's vocabulary.
_OTHER = "\0"


def normalised(text: str | None) -> list[bytes]:
    """The words of a text."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(text: str | None) -> list[tuple[bytes, ...]]:
    """The windows of an item."""
    found = normalised(text)
    return [tuple(found[i:i + WINDOW]) for i in range(max(1, len(found) - WINDOW + 1))] if found else []


class Automaton:
    """All windows of some items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        import ahocorasick

        owners: dict[tuple, set] = {}
        for item, text in items:
            for w in windows(text):
                owners.setdefault(w, set()).add(item)
        self.letters: dict[bytes, str] = {}
        self.machine = ahocorasick.Automaton()
        for w, ids in owners.items():
            self.machine.add_word("".join(map(self._letter, w)), (len(w), frozenset(ids)))
        self.machine.make_automaton()
        self.empty = not owners

    def _letter(self, word: bytes) -> str:
        n = len(self.letters) + 1
        return self.letters.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    def scan(self, found: list[bytes]) -> tuple[list[list[int]], set]:
        """Merged (start, end) spans of the words that windows cover, and their items."""
        spans: list[list[int]] = []
        items: set = set()
        if self.empty:
            return spans, items
        text = "".join(map(self.letters.get, found, repeat(_OTHER)))
        for end, (size, ids) in self.machine.iter(text):
            items |= ids
            start = end + 1 - size
            while spans and spans[-1][0] >= start:
                spans.pop()
            if spans and start <= spans[-1][1]:
                spans[-1][1] = end + 1
            else:
                spans.append([start, end + 1])
        return spans, items


def union(a: list, b: list) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def original_spans(text: str, spans: list[list[int]]) -> list[list[int]]:
    """Spans of words as character spans of the original text."""
    if not spans:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [[places[a][0], places[b - 1][1]] for a, b in spans]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The query set in blocks of at most ``block_bytes`` of text (one item at least)."""
    block: list = []
    room = block_bytes
    for row in benchmark.select("item_id", "text").filter("text IS NOT NULL").toLocalIterator():
        need = len(row["text"].encode("utf-8", "surrogatepass"))
        if block and need > room:
            yield block
            block, room = [], block_bytes
        block.append((row["item_id"], row["text"]))
        room -= need
    yield block


_SPANS = T.ArrayType(T.ArrayType(T.LongType()))
_STATE = {"_spans": _SPANS, "_items": T.ArrayType(T.LongType())}
_RESULT = {"n_words": T.LongType(), "n_hit": T.LongType(), "items": T.ArrayType(T.StringType()),
           "spans": _SPANS, "contaminated": T.BooleanType()}


def _pass(df: DataFrame, block, text: str, columns: list[str], last: bool) -> DataFrame:
    """Adds the hits of one block to the state; the last pass turns it into the result."""
    schema = T.StructType([df.schema[c] for c in columns])
    for name, kind in (_RESULT if last else _STATE).items():
        schema = schema.add(name, kind)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        machine = Automaton(block.value)
        kinds = {n: to_arrow_type(schema[n].dataType) for n in (_RESULT if last else _STATE)}
        for batch in batches:
            new: dict[str, list] = {n: [] for n in kinds}
            old = zip(texts_of(batch.column(text)), batch.column("_spans").to_pylist(),
                      batch.column("_items").to_pylist(), strict=True)
            for body, spans, items in old:
                found = normalised(body)
                hits, ids = machine.scan(found)
                if hits:
                    spans = union(spans, hits)
                    items = [*{*items, *(i for i in ids if i is not None)}]
                if not last:
                    new["_spans"].append(spans)
                    new["_items"].append(items)
                    continue
                hit = sum(b - a for a, b in spans)
                new["n_words"].append(len(found))
                new["n_hit"].append(hit)
                new["items"].append(sorted(map(str, items)))
                new["spans"].append(original_spans(body, spans))
                new["contaminated"].append(hit > 0 and ONE_IN * hit >= len(found))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *(pa.array(new[n], kinds[n]) for n in kinds)],
                [*columns, *kinds])

    return df.mapInArrow(run, schema)


def find(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES,
         text: str = "text") -> DataFrame:
    """``docs`` plus n_words, n_hit, items (as strings, sorted), spans (character offsets in
    the original text) and contaminated."""
    columns = [c for c in docs.columns if c not in _RESULT and c not in _STATE]
    df = docs.select(*[F.col(f"`{c}`") for c in columns],
                     *[F.array().cast(kind).alias(n) for n, kind in _STATE.items()])
    blocks = benchmark_blocks(benchmark, block_bytes)
    block, done = next(blocks), False
    while not done:
        following = next(blocks, None)
        done = following is None
        df = _pass(df, docs.sparkSession.sparkContext.broadcast(block), text, columns, done)
        block = following
    return df


def items_digest(items):
    """Hex digest of the item ids, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.col(text).alias("_body"))
    return find(row, benchmark, text="_body").filter("NOT contaminated").select("_row.*")


__all__ = ["Automaton", "benchmark_blocks", "clean", "find", "items_digest", "normalised",
           "original_spans", "union", "windows"]
