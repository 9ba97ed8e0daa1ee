"""N-gram Jaccard join with a MinHash LSH forest.

Texts are sets of five-word shingles (all words of a shorter text are one).  Each tree of
the forest keys a set by a sequence of MinHash values, a path in its prefix trie.  Paths are
shortened level by level until two sets at the threshold share a path in some tree with the
target recall; sets that then share a path are candidates.

Exact verification follows.  Sets that candidates connect form a neighbourhood, and all
pairs within it are compared, so nothing that shares a path is missed.  A neighbourhood is
cut into blocks; a task compares two blocks by counting common shingles (products of 0/1
matrices for frequent shingles, lists for rare ones) and returns no pairs: only the number
of links of each set and the classes inside.  Classes of large neighbourhoods are joined by
their connections.  Texts with equal sets are one class member throughout.

Defined cases.  Null, empty and blank texts have no shingles and are similar to nothing, not
even to each other.  Repeated rows are copies.  A null doc_id takes part; class ids are the
least non-null doc_id of a class.  Words are bytes, so ill-formed UTF-8 needs no rule.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import bodies_of, staged
from tickwise.llm.components import components
from tickwise.llm.recurrence import keyed, split_words
from tickwise.llm.spans import SliceHash, word_tokens

SHINGLE = 5
TREES = 20
#: The longest path a tree has.
DEEPEST = 10
TARGET_RECALL = 0.999
#: Sets a task compares with as many others.
BLOCK = 3000
#: Similarity: at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 4, 5
#: Texts shingled at a time, in bytes.
_CHUNK = 1 << 16


def path_length(threshold: float, trees: int = TREES, target: float = TARGET_RECALL,
                deepest: int = DEEPEST) -> int:
    """The longest path at which two sets of similarity ``threshold`` share one of ``trees``
    with probability ``target``; 1 if none is short enough."""
    length = deepest
    while length > 1 and 1 - (1 - threshold ** length) ** trees < target:
        length -= 1
    return length


def shingle_sets(bodies: list[list[bytes]], hasher: SliceHash) -> list:
    """Sorted distinct 64-bit shingle hashes of each text."""
    import numpy as np

    buffer, begins, ends, first = word_tokens(bodies)
    sizes = np.diff(first)
    count = np.where(sizes > 0, np.maximum(1, sizes - SHINGLE + 1), 0)
    total = int(count.sum())
    if not total:
        return [np.zeros(0, np.uint64) for _ in bodies]
    text = np.repeat(np.arange(len(bodies)), count)
    after = np.cumsum(count)
    start = np.arange(total) - np.repeat(after - count, count) + first[text]
    stop = np.minimum(start + SHINGLE, first[text + 1])
    h = hasher(np.frombuffer(buffer, np.uint8), begins[start], ends[stop - 1])
    return [np.unique(part) for part in np.split(h, after[:-1])]


def _hash_family(n: int):
    import numpy as np

    raw = b"".join(hashlib.blake2b(i.to_bytes(4, "little"), digest_size=16).digest() for i in range(n))
    pairs = np.frombuffer(raw, np.uint64).reshape(n, 2)
    return pairs[:, 0], pairs[:, 1] | np.uint64(1)


def tree_paths(sets: list, trees: int, length: int):
    """The hashed path of every non-empty set in every tree, (sets, trees)."""
    import numpy as np

    sizes = np.array([len(s) for s in sets])
    flat, at = np.concatenate(sets), np.cumsum(sizes) - sizes
    masks, factors = _hash_family(trees * length)
    out = np.empty((len(sets), trees), np.uint64)
    for t in range(trees):
        path = np.full(len(sets), t + 1, np.uint64)
        for k in range(t * length, (t + 1) * length):
            path = (path ^ np.minimum.reduceat((flat ^ masks[k]) * factors[k], at)) * np.uint64(0xD6E8FEB86659FD93)
            path ^= path >> np.uint64(32)
        out[:, t] = path
    return out.view(np.int64)


def _chunks(texts) -> Iterator[tuple[int, list]]:
    """First index and word lists of some texts at a time."""
    held, room, first = [], 0, 0
    for i, text in enumerate(texts):
        body = split_words(text)
        held.append(body)
        room += sum(map(len, body)) + len(body)
        if room >= _CHUNK:
            yield first, held
            held, room, first = [], 0, i + 1
    if held:
        yield first, held


def signatures(docs: DataFrame, trees: int = TREES, length: int | None = None) -> DataFrame:
    """doc_id, h, fa and fb (fingerprint of the set; null without shingles), paths; staged."""
    length = length or path_length(NUMERATOR / DENOMINATOR, trees)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = SliceHash()
        for batch in batches:
            for first, bodies in _chunks(bodies_of(batch.column("text"))):
                sets = shingle_sets(bodies, hasher)
                full = [i for i, s in enumerate(sets) if len(s)]
                marks = np.frombuffer(b"".join(
                    hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest() for i in full), np.int64)
                empty = np.ones(len(sets), bool)
                empty[full] = False
                fa, fb = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                fa[full], fb[full] = marks[::2], marks[1::2]
                paths = np.zeros((len(sets), trees), np.int64)
                if full:
                    paths[full] = tree_paths([sets[i] for i in full], trees, length)
                own = batch.slice(first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("h"), pa.array(fa, mask=empty), pa.array(fb, mask=empty),
                     pa.ListArray.from_arrays(np.arange(0, paths.size + 1, trees, dtype=np.int32), paths.ravel())],
                    ["doc_id", "h", "fa", "fb", "paths"])

    return staged(keyed(docs).mapInArrow(
        run, "doc_id bigint, h bigint, fa bigint, fb bigint, paths array<bigint>"), "signatures")


def _similar_blocks(left: list, right: list | None):
    """Boolean matrix: which sets of ``left`` are similar to which of ``right`` (None: of
    ``left`` itself, each but itself)."""
    import numpy as np

    every = left + (right or [])
    sizes = np.array([len(s) for s in every], np.int64)
    row = np.repeat(np.arange(len(every)), sizes)
    names, column, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    nl = len(left)
    nr = len(right) if right is not None else nl
    common = np.zeros((nl, nr), np.float32)
    order = np.argsort(column, kind="stable")
    ends = np.cumsum(count)
    # a product costs a column as much as listing the pairs of some 4 % of the sets
    frequent = 500 * count * count > nl * nr
    # frequent shingles: matrix products, some columns at a time
    chosen = np.flatnonzero(frequent)
    for at in range(0, len(chosen), 2048):
        part = chosen[at:at + 2048]
        place = np.full(len(names), -1, np.int64)
        place[part] = np.arange(len(part))
        inside = place[column] >= 0
        matrix = np.zeros((len(every), len(part)), np.float32)
        matrix[row[inside], place[column[inside]]] = 1
        common += matrix[:nl] @ (matrix[nl:] if right is not None else matrix).T
    # rare ones: the few sets that have each, pair by pair, grouped by how many they are
    rare = np.flatnonzero(~frequent & (count > 1))
    for k in np.unique(count[rare]).tolist():
        own = rare[count[rare] == k]
        step = max(1, (1 << 20) // (k * k))
        for at in range(0, len(own), step):
            part = own[at:at + step]
            members = row[order[(ends[part] - k)[:, None] + np.arange(k)]]
            i, j = np.repeat(members, k, axis=1).ravel(), np.tile(members, (1, k)).ravel()
            if right is not None:
                keep = (i < nl) & (j >= nl)
                i, j = i[keep], j[keep] - nl
            flat = i * nr + j
            if 20 * len(flat) > nl * nr:
                common += np.bincount(flat, minlength=nl * nr).reshape(nl, nr)
            else:
                cells, times = np.unique(flat, return_counts=True)
                common.ravel()[cells] += times
    both = sizes[:nl, None] + (sizes[nl:] if right is not None else sizes)[None, :]
    # I / (a + b - I) >= p / q
    out = (NUMERATOR + DENOMINATOR) * common.astype(np.int64) >= NUMERATOR * both
    if right is None:
        np.fill_diagonal(out, False)
    return out


def _labels(similar):
    """The least member each set is connected to, for a symmetric relation."""
    import numpy as np

    n = len(similar)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(similar, label[None, :], n).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare_blocks(rows: list[tuple]) -> Iterator[tuple]:
    """(node, links, partner) of a group's sets; rows are (node, block side, set)."""
    import numpy as np

    left = [(n, s) for n, side, s in rows if side == 0]
    right = [(n, s) for n, side, s in rows if side == 1]
    if not right:
        if len(left) < 2:
            return
        similar = _similar_blocks([s for _, s in left], None)
        links, label = similar.sum(axis=1).tolist(), _labels(similar).tolist()
        for (node, _), k, root in zip(left, links, label, strict=True):
            if k:
                yield node, k, left[root][0]
        return
    if not left:
        return
    similar = _similar_blocks([s for _, s in left], [s for _, s in right])
    n = len(left)
    square = np.zeros((n + len(right),) * 2, bool)
    square[:n, n:] = similar
    square[n:, :n] = similar.T
    both = left + right
    for (node, _), k, root in zip(both, square.sum(axis=1).tolist(), _labels(square).tolist(), strict=True):
        if k:
            yield node, k, both[root][0]


def neighbourhoods(sets: DataFrame) -> DataFrame:
    """node and hood for the sets that share a path with another one."""
    paths = sets.select("node", F.explode("paths").alias("path"))
    heads = paths.groupBy(F.col("path").alias("p")).agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("k")) \
        .filter("k > 1")
    edges = paths.join(heads, F.col("path") == F.col("p")).select(F.col("node").alias("u"), F.col("head").alias("v"))
    found = components(edges)
    return staged(found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
                  .select("node", F.col("root").alias("hood")), "neighbourhoods")


def verified(docs: DataFrame, sets: DataFrame, hoods: DataFrame, block: int = BLOCK) -> DataFrame:
    """node, links and partner (a set of the same class) from each comparison of blocks; staged."""
    # staged, so that Spark knows how few neighbourhoods have more than one block and need not
    # deal the sets by neighbourhood
    large = staged(hoods.groupBy(F.col("hood").alias("s_hood")).agg(
        F.ceil(F.count(F.lit(1)) / block).alias("n")).filter("n > 1"), "large-hoods")
    blocks = F.coalesce("n", F.lit(1).cast("bigint"))
    placed = hoods.join(large, F.col("hood") == F.col("s_hood"), "left").select(
        F.col("node").alias("h_node"), "hood", blocks.alias("blocks"),
        F.pmod(F.xxhash64(F.lit(3), "node"), blocks).alias("own"))
    chosen = sets.join(placed, F.col("node") == F.col("h_node")).select(
        F.col("doc_id").alias("c_id"), F.col("h").alias("c_h"), "node", "hood", "blocks", "own")
    texts = keyed(docs).join(chosen, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")))
    # every block meets itself once and every other block once
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = texts.select("node", "hood", "own", "text", other.alias("other")).select(
        "node", "hood", "text", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = SliceHash()

        def out(group):
            sets = []
            for first, bodies in _chunks(t for _, _, t in group):
                del first
                sets += shingle_sets(bodies, hasher)
            found = [*compare_blocks([(n, side, s) for (n, side, _), s in zip(group, sets, strict=True)])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)],
                                                 ["node", "links", "partner"])

        key, group = None, []
        for batch in batches:
            for hood, i, j, node, side, text in zip(*(batch.column(c).to_pylist() for c in (
                    "hood", "i", "j", "node", "side")), bodies_of(batch.column("text")), strict=True):
                if (hood, i, j) != key:
                    yield from out(group)
                    key, group = (hood, i, j), []
                if not group or group[-1][0] != node:  # rows that repeat a document come together
                    group.append((node, side, text))
        yield from out(group)

    rows = dealt.repartition("hood", "i", "j").sortWithinPartitions("hood", "i", "j", "node") \
        .select("hood", "i", "j", "node", "side", "text")
    return staged(rows.mapInArrow(run, "node bigint, links bigint, partner bigint"), "links")


def join_similar(docs: DataFrame, trees: int = TREES, block: int = BLOCK) -> DataFrame:
    """doc_id, h, root (key of the class; null without shingles), class_id, n_links (other
    texts, as sets, of similarity 0.8 or more) and n_copies (other rows with the same set)
    for every row of ``docs``."""
    signed = signatures(docs, trees)
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    sets = staged(signed.filter("fa IS NOT NULL").groupBy("fa", "fb").agg(
        F.min(F.struct(order.alias("d"), "doc_id", "h", "paths")).alias("one"), F.count(F.lit(1)).alias("n"))
        .select(F.xxhash64("fa", "fb").alias("node"), "fa", "fb", "n", "one.doc_id", "one.h", "one.paths"), "sets")
    hoods = neighbourhoods(sets)
    links = verified(docs, sets, hoods, block)
    roots = components(links.select(F.col("node").alias("u"), F.col("partner").alias("v")))
    counted = links.groupBy(F.col("node").alias("l_node")).agg(F.sum("links").alias("links"))
    classed = sets.join(counted, F.col("node") == F.col("l_node"), "left").join(
        roots.select(F.col("node").alias("r_node"), "root"), F.col("node") == F.col("r_node"), "left").select(
        "fa", "fb", "n", "doc_id", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("root", "node").alias("root"))
    least = classed.groupBy(F.col("root").alias("k_root")).agg(F.min("doc_id").alias("class_id"))
    named = classed.join(least, F.col("root") == F.col("k_root")).select(
        F.col("fa").alias("n_fa"), F.col("fb").alias("n_fb"), "class_id", "root", "links", "n")
    return signed.join(named, (F.col("fa") == F.col("n_fa")) & (F.col("fb") == F.col("n_fb")), "left").select(
        "doc_id", "h", "root", F.when(F.col("fa").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        (F.coalesce("n", F.lit(1)) - 1).alias("n_copies"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: that of the least doc_id
    (null last; of several texts with it, the least hash).  Rows without shingles stay."""
    joined = join_similar(docs, **options)
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    heads = joined.filter("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(order.alias("d"), "doc_id", "h")).alias("one")).select(
        F.col("one.doc_id").alias("j_id"), F.col("one.h").alias("j_h"), F.lit(True).alias("head"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"),
                       (~F.coalesce("text", F.lit("")).rlike("[^ \\t-\\r]")).alias("_blank"))
    found = rows.join(heads, F.col("_id").eqNullSafe(F.col("j_id")) & (F.col("_h") == F.col("j_h")), "left") \
        .filter("_blank OR head")
    # rows that repeat a head's id and text
    again = F.row_number().over(Window.partitionBy("_id", "_h").orderBy("_blank"))
    return found.withColumn("_n", again).filter("_blank OR _n = 1").select("_row.*")
