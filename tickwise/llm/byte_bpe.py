"""Byte-level BPE encoding and decoding of whole texts.

``encode`` cuts texts into pre-tokens with the transition-function scan of ``pretokens``, many
texts at a time.  The slices become a dictionary-coded Arrow array, so each distinct slice of a
batch is looked up once; a slice that the task has not met is merged pair by pair (lowest rank
first, the leftmost of equals) and remembered.  Ids of all occurrences are then one gather.

A row keeps, beside the ids, the byte offset where each token ends.  ``decode`` turns ids, or
any range of a row's tokens, back into bytes: the offsets say where a range's bytes lie in the
text without decoding what stands before it.

Memory of a task: ``ROOM`` bytes of text are cut at a time (a longer text between pre-tokens),
``ROWS`` rows are handed on together, and some ``MEMORY`` slices are remembered.  There is no shuffle.

Defined cases.  A null or empty text has no tokens.  A text that is no valid UTF-8 first gets
U+FFFD for each ill-formed part; its decoded bytes are those of that text.  A string of a
special token is ordinary text.  Rows are independent, so ties, repeated rows and an empty
table need no rule, and other columns of the input are left out, whatever their names.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tickwise.llm import pretokens
from tickwise.llm.common import Memory

#: Bytes of text that are cut at a time.
ROOM = 1 << 20
#: Rows that are handed on together.
ROWS = 512
#: Distinct slices whose ids a task remembers.
MEMORY = 1 << 18
#: Up to this many bytes a slice's pairs are looked over, beyond it they are kept in a heap.
SHORT = 32
NEVER = 1 << 62
ENCODED = "doc_id bigint, n_tokens bigint, ids binary, ends binary"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file: base64 of the bytes, a space, the rank."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tiktoken_classes() -> list[tuple[int, int, int]]:
    """Classes of code points as the tiktoken library matches them."""
    import tiktoken

    single, every = {bytes([b]): b for b in range(256)}, pretokens.all_characters()

    def members(name: str) -> set[int]:
        only = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        return set(map(ord, bytes(only.encode_ordinary(every)).decode("utf-8")))

    return pretokens.class_ranges(members)


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ranks that ``piece`` is merged into, by looking over all its pairs at each step."""
    get = ranks.get
    edges = list(range(len(piece) + 1))
    pairs = [get(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) != NEVER:
        i = pairs.index(low)
        del edges[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[edges[i]:edges[i + 2]], NEVER)
        if i:
            pairs[i - 1] = get(piece[edges[i - 1]:edges[i + 1]], NEVER)
    return [ranks[piece[a:b]] for a, b in zip(edges, edges[1:], strict=False)]


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ranks that ``piece`` is merged into.

    Slices beyond ``SHORT`` bytes keep their pairs in a heap by (rank, place), and links skip
    merged parts, so n bytes take O(n log n) steps.  Every single byte must have a rank.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n <= SHORT:
        return merge_short(piece, ranks)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        # a pair whose left part is gone, or that no longer ends there, has changed since
        if not live[i] or end[i] == n or end[end[i]] != stop:
            continue
        gone = end[i]
        live[gone] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i:end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def slice_coder(ranks: dict[bytes, int]) -> Callable[[list[bytes]], list[bytes]]:
    """Slices to their ids as little-endian u32, remembering ``MEMORY`` of them."""
    def code(piece: bytes) -> bytes:
        ids = merge_pairs(piece, ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    known = Memory(code, MEMORY)
    return lambda slices: [known[s] for s in slices]


def texts_in_groups(bodies: Iterator[bytes], table, room: int) -> Iterator[tuple[list[bytes], list[int]]]:
    """Parts of texts, some ``room`` bytes at a time, with the number of the text of each."""
    held, owner, weight = [], [], 0
    for number, body in enumerate(bodies):
        for part in pretokens.pieces(body, table, room):
            if held and weight + len(part) > room:
                yield held, owner
                held, owner, weight = [], [], 0
            held.append(part)
            owner.append(number)
            weight += len(part)
    if held:
        yield held, owner


def code_texts(bodies: list[bytes], table, code: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
    """The ids of each text as little-endian u32; ``code`` gives those of distinct slices."""
    import numpy as np
    import pyarrow as pa

    out = [b""] * len(bodies)
    for parts, owner in texts_in_groups(iter(bodies), table, ROOM):
        joined, begins, first = pretokens.pre_tokens(parts, table)
        coded = pretokens.slices(joined, begins).dictionary_encode()
        ids = pa.array(code(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[ids.offset + first].tolist() if len(ids) else [0] * len(first)
        data = b"" if data is None else data.to_pybytes()
        for i, number in enumerate(owner):
            out[number] = out[number] + data[at[i]:at[i + 1]] if out[number] else data[at[i]:at[i + 1]]
    return out


def in_slices(batches: Iterator) -> Iterator:
    """Arrow batches of at most ``ROWS`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def valid_bodies(column) -> list[bytes]:
    return [b.as_py() or b"" for b in column]


def encode(docs: DataFrame, ranks_path: Callable[[], str], classes: list[tuple[int, int, int]]) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian u32) and ends (the byte offset where each token
    ends, the same way) for doc_id and text.

    ``ranks_path()`` is asked on each executor, where the rank file must lie.
    """
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ranks, table = load_ranks(ranks_path()), pretokens.class_table(classes)
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            length[rank] = len(token)
        code = slice_coder(ranks)
        for batch in in_slices(batches):
            coded = code_texts(valid_bodies(batch.column("body")), table, code)
            ends = [np.cumsum(length[np.frombuffer(ids, "<u4")]).astype("<u4").tobytes() for ids in coded]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                 pa.array(coded, pa.binary()), pa.array(ends, pa.binary())],
                ["doc_id", "n_tokens", "ids", "ends"])

    return docs.select("doc_id", F.make_valid_utf8("text").cast("binary").alias("body")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, ranks_path: Callable[[], str], first: int = 0, count: int | None = None) -> DataFrame:
    """The rows of ``encoded`` with ``body``: the bytes of ``count`` tokens from number
    ``first`` on, all by default, and ``at``: the byte offset in the text where they begin.
    A range beyond a row's tokens is cut to them."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        ranks = load_ranks(ranks_path())
        tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        vocabulary = pa.array(tokens, pa.large_binary())
        del ranks, tokens
        for batch in in_slices(batches):
            bodies, starts = [], []
            for ids, ends in zip(batch.column("ids"), batch.column("ends"), strict=True):
                ids = np.frombuffer(ids.as_py() or b"", "<u4")
                ends = np.frombuffer(ends.as_py() or b"", "<u4")
                lo = min(first, len(ids))
                hi = len(ids) if count is None else min(lo + count, len(ids))
                start, stop = (int(ends[i - 1]) if i else 0 for i in (lo, hi))
                found = vocabulary.take(pa.array(ids[lo:hi])) if hi > lo else None
                bodies.append(b"" if found is None else found.buffers()[2].to_pybytes()[:stop - start])
                starts.append(start)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bodies, pa.binary()), pa.array(starts, pa.int64())],
                [*batch.schema.names, "body", "at"])

    schema = StructType([*encoded.schema.fields, StructField("body", BinaryType()), StructField("at", LongType())])
    return encoded.mapInArrow(run, schema)
