"""Finding equal windows of texts: the steps that byte and word deduplication share.

1. ``spans_of``: every text is cut into anchored spans (see ``spans``), a few dozen bytes each.
2. ``contents``: spans are counted by (anchor, content).  Exact copies meet here, pre-
   aggregated before the shuffle, and are settled without their text.
3. ``rivals``: only anchors with several contents can hide more repetition.  One span of each
   content is fetched, with its text, and the anchor's contents are compared by the caller's
   method, groups of anchors at a time.  An anchor whose contents would not fit one group is
   settled by counting its windows' digests instead (``by_digest``), which has no hot key.
4. ``intervals``: what was found for a content holds for all its spans.

Texts are known by (doc_id, hash of the text): rows that share both are the same text, and
so share their result.  A null text has no tokens, nor has an empty one; a text is its bytes,
valid UTF-8 or not; a null doc_id comes after all others; an empty table has no spans and so
no cuts.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import bodies_of, staged
from tickwise.llm.spans import byte_tokens, span_batches, word_tokens

#: Bytes of spans that are compared in one group.
GROUP_BYTES = 1 << 18
#: Contents of one anchor that are compared in one group; the rest goes by digests.
GROUP_CONTENTS = 2500


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the hash h that, with doc_id, names a text."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("h"))


def split_words(body: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text's bytes."""
    return (body or b"").split()


def split_bytes(body: bytes | None) -> bytes:
    return body or b""


KINDS = {"bytes": (split_bytes, byte_tokens), "words": (split_words, word_tokens)}


def spans_of(docs: DataFrame, kind: str, size: int, gram: int) -> DataFrame:
    """doc_id, h, a (anchor), c (content), first, starts, repeat and step of all spans, staged."""
    split, tokens = KINDS[kind]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bodies = map(split, bodies_of(batch.column("text")))
            for index, s in span_batches(bodies, tokens, len, size, gram):
                if not len(index):
                    continue
                at = pa.array(index)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("h").take(at), pa.array(s.anchor),
                     pa.array(s.content), *[pa.array(x, pa.int64()) for x in (s.first, s.starts, s.repeat, s.step)]],
                    ["doc_id", "h", "a", "c", "first", "starts", "repeat", "step"])

    return staged(keyed(docs).mapInArrow(
        run, "doc_id bigint, h bigint, a bigint, c bigint, first bigint, starts bigint, repeat bigint, step bigint"),
        f"spans-{kind}")


def contents(spans: DataFrame) -> DataFrame:
    """One row per (a, c) that has several spans or shares its anchor with another content: n
    spans, the least doc_id that has one (null last), a span of it, and ``mixed``, whether the
    anchor has other contents; staged.

    Copies of a span meet map-side, so no anchor's copies come together in one task.
    """
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    each = spans.groupBy("a", "c").agg(
        F.sum("repeat").alias("n"),
        F.min(F.struct(order.alias("d"), "doc_id", "h", "first", "starts")).alias("one"))
    several = each.groupBy(F.col("a").alias("a2")).agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    found = each.join(several, F.col("a") == F.col("a2"), "left").withColumn("mixed", F.col("a2").isNotNull())
    return staged(found.filter("mixed OR n > 1").select(
        "a", "c", "mixed", "n", F.col("one.d").alias("least"), F.col("one.doc_id"), F.col("one.h"),
        F.col("one.first"), F.col("one.starts")), "contents")


def rivals(docs: DataFrame, found: DataFrame, kind: str, size: int) -> tuple[DataFrame, DataFrame]:
    """a, c, least, starts and body (the span's tokens) of one span of each content of the
    anchors that have several; apart, those of anchors with more than ``GROUP_CONTENTS``.

    Rows that repeat a document give their spans again; the readers skip those.
    """
    split, _ = KINDS[kind]
    mixed = found.filter("mixed")
    counts = mixed.groupBy("a").count().filter(F.col("count") > GROUP_CONTENTS).select(F.col("a").alias("a3"))
    wide = mixed.join(counts, F.col("a") == F.col("a3"), "left").withColumn("wide", F.col("a3").isNotNull())
    wanted = wide.groupBy(F.col("doc_id").alias("w_id"), F.col("h").alias("w_h")).agg(
        F.collect_list(F.struct("a", "c", "least", "first", "starts", "wide")).alias("want"))
    texts = keyed(docs).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("h") == F.col("w_h"))).select("text", "want")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["a", "c", "least", "starts", "wide", "body"]
        for batch in batches:
            for text, want in zip(bodies_of(batch.column("text")), batch.column("want"), strict=True):
                body = split(text)
                rows = []
                for w in want.as_py():
                    part = body[w["first"]:w["first"] + w["starts"] + size - 1]
                    rows.append((w["a"], w["c"], w["least"], w["starts"], w["wide"],
                                 part if kind == "bytes" else b" ".join(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, t) for col, t in zip(
                        zip(*rows, strict=True),
                        (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)],
                    names)

    rows = staged(texts.mapInArrow(
        run, "a bigint, c bigint, least bigint, starts bigint, wide boolean, body binary"), f"rivals-{kind}")
    return rows.filter("NOT wide"), rows.filter("wide")


#: A content with more than one in ``HOT`` of all spans is dealt over ``SALTS`` salts.
HOT, SALTS = 1000, 64
MARKS = "a bigint, c bigint, lo bigint, hi bigint, least bigint"


def compare(rows: DataFrame, method: Callable) -> DataFrame:
    """Marks (a, c, lo, hi, least): window starts lo to hi - 1 of content c also occur in
    another content of anchor a; ``least`` is the least doc_id of all that have them.

    ``method(group)`` gets whole anchors, (a, c, least, starts, body) rows sorted by a, and
    yields marks.  A task holds one group of some ``GROUP_BYTES`` at a time.
    """
    limit = GROUP_BYTES

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(group):
            marks = [*method(group)]
            if marks:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*marks, strict=True)],
                                                 ["a", "c", "lo", "hi", "least"])

        group, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("a", "c", "least", "starts", "body")),
                           strict=True):
                if group and row[:2] == group[-1][:2]:
                    continue
                if held >= limit and row[0] != group[-1][0]:
                    yield from out(group)
                    group, held = [], 0
                group.append(row)
                held += len(row[4])
        if group:
            yield from out(group)

    return rows.select("a", "c", "least", "starts", "body").repartition("a").sortWithinPartitions("a", "c") \
        .mapInArrow(run, MARKS)


def by_digest(rows: DataFrame, kind: str, size: int) -> DataFrame:
    """The marks of ``compare`` from digests of every window: for anchors with so many
    contents that one task should not see them all."""
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for a, c, least, starts, body in zip(
                    *(batch.column(x).to_pylist() for x in ("a", "c", "least", "starts", "body")), strict=True):
                part = body if kind == "bytes" else body.split()
                glue = (lambda x: x) if kind == "bytes" else b" ".join
                digests = [hashlib.blake2b(glue(part[i:i + size]), digest_size=16).digest() for i in range(starts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a] * starts), pa.array([c] * starts), pa.array([least] * starts),
                     pa.array(range(starts), pa.int64()), pa.array(digests, pa.binary())],
                    ["a", "c", "least", "lo", "w"])

    windows = rows.dropDuplicates(["a", "c"]).mapInArrow(run, "a bigint, c bigint, least bigint, lo bigint, w binary")
    shared = windows.groupBy(F.col("w").alias("w2")).agg(F.count(F.lit(1)).alias("k"), F.min("least").alias("g")) \
        .filter("k > 1")
    return windows.join(shared, F.col("w") == F.col("w2")).select(
        "a", "c", "lo", (F.col("lo") + 1).alias("hi"), F.col("g").alias("least"))


def salted(spans: DataFrame, marks: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with ``salt``: 0, but for contents that hold more than one in ``HOT`` of all spans.
    Their spans are dealt over ``SALTS`` salts, and their marks repeated for each.

    There are at most ``HOT`` such contents, so their list may be broadcast.
    """
    most = found.filter(F.col("n") * HOT > spans.agg(F.sum("repeat")).scalar()).select(
        F.col("a").alias("x_a"), F.col("c").alias("x_c"))

    def hot(df: DataFrame, a: str, c: str) -> DataFrame:
        return df.join(F.broadcast(most), (F.col(a) == F.col("x_a")) & (F.col(c) == F.col("x_c")), "left")

    dealt = hot(spans, "a", "c").withColumn("salt", F.when(
        F.col("x_a").isNotNull(), F.pmod(F.xxhash64("doc_id", "h", "first"), F.lit(SALTS))).otherwise(0))
    every = F.when(F.col("x_a").isNotNull(), F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))) \
        .otherwise(F.array(F.lit(0).cast("bigint")))
    copied = hot(marks, "m_a", "m_c").withColumn("m_salt", F.explode(every))
    return dealt.drop("x_a", "x_c"), copied.drop("x_a", "x_c")


def intervals(spans: DataFrame, marks: DataFrame, found: DataFrame, size: int, earlier_only: bool) -> DataFrame:
    """doc_id, h and cuts: the token intervals that marked windows cover, in order.

    With ``earlier_only`` a window is cut only from documents after the least that has it.
    Spans that repeat at a step of at most ``size`` cover one interval together.
    """
    by_content = marks.groupBy(F.col("a").alias("m_a"), F.col("c").alias("m_c")).agg(
        F.collect_set(F.struct("lo", "hi", "least")).alias("marks"))
    dealt, copied = salted(spans, by_content, found)
    hit = dealt.join(copied, (F.col("a") == F.col("m_a")) & (F.col("c") == F.col("m_c"))
                     & (F.col("salt") == F.col("m_salt")))
    own = F.filter("marks", lambda m: F.coalesce("doc_id", F.lit((1 << 63) - 1)) > m["least"]) \
        if earlier_only else F.col("marks")
    cuts = hit.select("doc_id", "h", F.transform(own, lambda m: F.struct(
        (F.col("first") + m["lo"]).alias("lo"),
        (F.col("first") + (F.col("repeat") - 1) * F.col("step") + m["hi"] + size - 1).alias("hi"))).alias("part")).filter(F.size("part") > 0)
    return cuts.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("part")).alias("cuts"))


def apply_cuts(docs: DataFrame, cuts: DataFrame, kind: str, schema: str, summarise: Callable) -> DataFrame:
    """``summarise(tokens, merged cuts)`` for every row of ``docs``, after doc_id."""
    split, _ = KINDS[kind]
    c = cuts.select(F.col("doc_id").alias("c_id"), F.col("h").alias("c_h"), "cuts")
    joined = keyed(docs).join(
        c, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left").select(
        "doc_id", "text", "cuts")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, parts in zip(bodies_of(batch.column("text")), batch.column("cuts"), strict=True):
                merged: list[list[int]] = []
                if parts.is_valid:
                    flat = parts.values
                    lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
                    order = np.argsort(lo, kind="stable")
                    for s, e in zip(lo[order].tolist(), hi[order].tolist(), strict=True):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                rows.append(summarise(split(text), merged))
            frame = pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=names), preserve_index=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *frame.columns], ["doc_id", *names])

    names = [part.split()[0] for part in schema.split(",")]
    return joined.mapInArrow(run, f"doc_id bigint, {schema}")
