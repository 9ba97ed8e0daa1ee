"""Token-id output in Simple-8b words.

A store is a Parquet table of shards' blocks.  Each row is one block of up to
``BLOCK_DOCS`` consecutive documents or ``BLOCK_IDS`` ids, whichever is reached first (one
document at least): the documents' ids and token counts, and a payload:

    payload = lanes u32 | lane length u32 | words before each lane u32[lanes] | words u64[]

A block's ids are cut into lanes of ``LANE`` ids.  Each lane is coded on its own, and the
offsets say where its words begin, so lanes are coded and decoded side by side with vector
operations.  A word has a selector in its top 4 bits.  Selectors 0-13 pack 60, 30, 20, 15,
12, 10, 8, 7, 6, 5, 4, 3, 2 or 1 values into the other 60 bits, the first value lowest.
Selector 15 is the escape: the value does not fit 60 bits and is the whole next word.
Selector 14 is not used.

The documents are range-partitioned and sorted by doc_id, so the blocks in order of (shard,
block) hold the documents in ascending doc_id.  Spark's Parquet writer commits the shards,
so a retried task leaves no half-written file and any file system works.

Defined cases.  A null or empty text has only the end id.  A text that is no valid UTF-8 is
encoded with U+FFFD for each ill-formed part.  A null doc_id sorts first.  Rows
with one doc_id are ordered by a hash of their text; identical rows stand in any order.  A
document longer than a block is a block of its own.  An empty table makes an empty store.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm import pretokens
from tickwise.llm.byte_bpe import MEMORY, code_texts, in_slices, valid_bodies
from tickwise.llm.common import staged

LANE = 1024
BLOCK_DOCS = 4096
BLOCK_IDS = 1 << 18
#: Fixed values: (values per word, bits per value) by selector.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
         (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15


# ---------------------------------------------------------------- coding

def _bits(ids):
    """Bits of the narrowest pack that holds each value; 64 for those that need an escape."""
    import numpy as np

    steps = np.array(sorted(b for _, b in PACKS), np.uint8)
    needs = np.append(steps, np.uint8(64))
    limits = np.uint64(1) << steps.astype(np.uint64)
    small = needs[np.searchsorted(limits, np.arange(1 << 16, dtype=np.uint64), side="right")]
    low = ids < np.uint64(1 << 16)
    if low.all():
        return small[ids]
    return needs[np.searchsorted(limits, ids, side="right")]


def encode(ids) -> bytes:
    """The payload for a vector of unsigned ids."""
    import numpy as np

    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    lanes = -(-n // LANE)
    if not n:
        return struct.pack("<II", 0, LANE)
    # past the end of a lane no value may be taken: pad each lane with wide values
    wide = np.full((lanes, LANE + 60), 255, np.uint8)
    flat = np.full(lanes * LANE, 255, np.uint8)
    flat[:n] = _bits(ids)
    wide[:, :LANE] = flat.reshape(lanes, LANE)
    # widest of the next 1, 2, 3, ... values; where more values fit, fewer fit too, so the
    # number of packs that fit gives the selector for every position
    widest, have = wide, 1
    fit = np.zeros(wide.shape, np.uint8)
    for count, bits in reversed(PACKS):
        while have < count:
            step = min(have, count - have)
            grown = np.full_like(widest, 255)
            np.maximum(widest[:, :-step], widest[:, step:], out=grown[:, :-step])
            widest, have = grown, have + step
        good = widest <= bits
        if not good.any():
            break
        fit += good
    best = np.where(fit > 0, len(PACKS) - fit, ESCAPE)
    taken = np.array([c for c, _ in PACKS] + [0, 1], np.int64)
    # all lanes step from word to word together
    lengths = np.full(lanes, LANE, np.int64)
    lengths[-1] = n - (lanes - 1) * LANE
    place, live = np.zeros(lanes, np.int64), np.arange(lanes)
    steps = []
    while len(live):
        at = place[live]
        row = np.full(lanes, -1, np.int64)
        row[live] = at
        steps.append(row)
        place[live] = at + taken[best[live, at]]
        live = live[place[live] < lengths[live]]
    every = np.stack(steps, axis=1)
    lane, step = np.nonzero(every >= 0)
    at = every[lane, step]
    sel = best[lane, at]
    size = np.where(sel == ESCAPE, 2, 1)
    where = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    start = lane * LANE + at
    for s, (count, bits) in enumerate(PACKS):
        rows = np.flatnonzero(sel == s)
        if not len(rows):
            continue
        word = np.full(len(rows), s << 60, np.uint64)
        for k in range(count):
            word |= ids[start[rows] + k] << np.uint64(k * bits)
        words[where[rows]] = word
    rows = np.flatnonzero(sel == ESCAPE)
    words[where[rows]] = np.uint64(ESCAPE << 60)
    words[where[rows] + 1] = ids[start[rows]]
    before = where[np.searchsorted(lane, np.arange(lanes))]
    return struct.pack("<II", lanes, LANE) + before.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def decode(payload: bytes, n: int):
    """The ``n`` ids of a payload."""
    import numpy as np

    lanes, lane_length = struct.unpack_from("<II", payload)
    if not lanes:
        return np.zeros(0, np.uint64)
    before = np.frombuffer(payload, "<u4", lanes, 8).astype(np.int64)
    words = np.frombuffer(payload, "<u8", -1, 8 + 4 * lanes)
    sel = (words >> np.uint64(60)).astype(np.uint8)
    head = np.ones(len(words), bool)
    if (sel == ESCAPE).any():
        # a word after an escape is a value; an escaped value may itself look like an escape
        at, ends = before.copy(), np.append(before[1:], len(words))
        head[:] = False
        while len(at):
            head[at] = True
            at = at + np.where(sel[at] == ESCAPE, 2, 1)
            keep = at < ends
            at, ends = at[keep], ends[keep]
    heads = np.flatnonzero(head)
    sel = sel[heads]
    taken = np.array([c for c, _ in PACKS] + [0, 1], np.int64)[sel]
    out = np.empty(int(taken.sum()), np.uint64)
    start = np.cumsum(taken) - taken
    for s, (count, bits) in enumerate(PACKS):
        rows = np.flatnonzero(sel == s)
        for k in range(count if len(rows) else 0):
            out[start[rows] + k] = (words[heads[rows]] >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)
    rows = np.flatnonzero(sel == ESCAPE)
    out[start[rows]] = words[heads[rows] + 1]
    return out[:n]


# ---------------------------------------------------------------- tokenizing

@cache
def library_classes(path: str) -> tuple[tuple[int, int, int], ...]:
    """Classes of code points as the tokenizers library matches them."""
    from tokenizers import Regex, pre_tokenizers

    every = pretokens.all_characters()

    def members(name: str) -> set[int]:
        only = pre_tokenizers.Split(Regex(name), "removed", invert=True)
        return {ord(c) for text, _ in only.pre_tokenize_str(every) for c in text}

    return tuple(pretokens.class_ranges(members))


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level file: itself where it prints, the
    next free one above U+00FF elsewhere."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in own else chr(next(others)) for b in range(256)}


@cache
def byte_level_encoder(path: str, end_id: int = 0, room: int = 2 * MEMORY) -> Callable:
    """Texts (UTF-8) to their ids (little-endian u32 bytes) with a tokenizer file of the tokenizers
    library, ``end_id`` appended to each.

    The library's model encodes every pre-token of a byte-level file on its own, so each distinct
    one is given to it once, and the ids of all texts are gathered from what it returned.  Where
    the pre-tokens lie is found by ``pretokens``, with the library's own classes of code points.
    A text that holds the string of an added token, and every text of a file with a normalizer
    or another pre-tokenizer, is given to the library whole.  One encoder is made in a worker.
    """
    import json
    import os

    import numpy as np
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
    tokenizer = Tokenizer.from_file(path)
    about = json.loads(tokenizer.to_str())
    before = about["pre_tokenizer"] or {}
    cuts = (before.get("type") == "ByteLevel" and before.get("use_regex") is True
            and not before.get("add_prefix_space") and about["normalizer"] is None
            and about["post_processor"] is None and not about["truncation"] and not about["padding"])
    added = [t["content"].encode() for t in about["added_tokens"]]
    table = pretokens.class_table(library_classes(path)) if cuts else None
    end, model, letters = struct.pack("<I", end_id), tokenizer.model, byte_letters()
    known: dict[bytes, bytes] = {}
    old: dict[bytes, bytes] = {}

    def whole(bodies: list[bytes]) -> list[bytes]:
        coded = tokenizer.encode_batch([b.decode("utf-8") for b in bodies], add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def slices(pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pre-tokens; those of the last ``room`` or more are remembered."""
        nonlocal known, old
        out = [known.get(p) or old.get(p) for p in pieces]
        for i in (i for i, ids in enumerate(out) if ids is None):
            ids = [t.id for t in model.tokenize(pieces[i].decode("latin-1").translate(letters))]
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        if len(known) > room:
            old, known = known, {}
        known.update((p, ids) for p, ids in zip(pieces, out, strict=True) if len(p) <= 64)
        return out

    def run(bodies: list[bytes]) -> list[bytes]:
        apart = [not cuts or any(t in b for t in added) for b in bodies]
        coded = code_texts([b"" if a else b for a, b in zip(apart, bodies, strict=True)], table, slices) \
            if cuts else [b""] * len(bodies)
        for i in (i for i, a in enumerate(apart) if a):
            coded[i] = whole([bodies[i]])[0]
        return [ids + end for ids in coded]

    return run


# ---------------------------------------------------------------- the store

BLOCK_SCHEMA = ("shard int, block int, doc_ids array<bigint>, counts array<bigint>, n_ids bigint, "
                "payload binary")


def blocks(docs: DataFrame, encoder: Callable[[], Callable], shards: int | None = None) -> DataFrame:
    """The store's rows for ``docs`` (doc_id, text).  ``encoder()`` gives, in a task, a function
    from texts to their ids as little-endian u32 bytes."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"),
                        F.monotonically_increasing_id().alias("_row"))
    # the row number spreads rows that share an id and a text
    dealt = keyed.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "_h", "_row") \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h").select(
            "doc_id", F.make_valid_utf8("text").cast("binary").alias("body"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        encode_texts, ids, counts, data = encoder(), [], [], []
        held = 0

        def closed():
            payload = encode(np.frombuffer(b"".join(data), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(counts)], pa.list_(pa.int64())),
                 pa.array([sum(counts)], pa.int64()), pa.array([payload], pa.binary())],
                ["shard", "block", "doc_ids", "counts", "n_ids", "payload"])

        for batch in in_slices(batches):
            coded = encode_texts(valid_bodies(batch.column("body")))
            for doc, new in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                if ids and (held + len(new) // 4 > BLOCK_IDS or len(ids) == BLOCK_DOCS):
                    yield closed()
                    block, held = block + 1, 0
                    ids, counts, data = [], [], []
                ids.append(doc)
                counts.append(len(new) // 4)
                data.append(new)
                held += len(new) // 4
        if ids:
            yield closed()

    return dealt.mapInArrow(run, BLOCK_SCHEMA)


def write_store(docs: DataFrame, path: str, encoder: Callable[[], Callable],
                shards: int | None = None) -> None:
    blocks(docs, encoder, shards).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian u32 bytes) of each document of a store."""
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row per shard in the first window, one per block of a shard in the second
    shard = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        F.col("shard").alias("s_shard"),
        (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    heads = stored.select("shard", "block", "n_ids").withColumn(
        "inside", F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids"))
    starts = staged(heads.join(shard, heads["shard"] == shard["s_shard"]).select(
        F.col("shard").alias("b_shard"), F.col("block").alias("b_block"),
        (F.col("before") + F.col("inside")).alias("start")), "token-starts")
    rows = stored.join(starts, (F.col("shard") == F.col("b_shard")) & (F.col("block") == F.col("b_block"))) \
        .select("doc_ids", "counts", "n_ids", "payload", "start")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.array(batch.column("counts")[i].as_py(), np.int64)
                flat = decode(batch.column("payload")[i].as_py(), batch.column("n_ids")[i].as_py())
                ends = np.cumsum(counts)
                data = flat.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values,
                     pa.array(batch.column("start")[i].as_py() + ends - counts),
                     pa.array(counts),
                     pa.array([data[4 * (e - c):4 * e] for e, c in zip(ends, counts, strict=True)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def id_checksum(ids):
    """CRC-32 of the ids as little-endian u32."""
    return F.crc32(ids)


__all__ = ["blocks", "byte_level_encoder", "decode", "encode", "id_checksum", "read_store", "write_store"]
