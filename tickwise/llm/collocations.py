"""Phrase collocations of two and three words, mined with stripes.

A *stripe* is a prefix with an associative array that counts the words that follow it.  The
prefix of no words has the word counts of a language; each prefix of two words has its next
words, and ``END`` where a piece ends.  So one structure holds everything the scores need:

* an element of a two-word stripe is a three-word phrase's count (an extension);
* a stripe's total is the count of its own phrase of two words;
* a stripe's largest element is the largest count of a phrase that extends it to the right,
  and the largest element with one last pair is the same to the left (subsumption).

Map: a task cuts texts into words, some ``WORDS`` at a time, and sorts word numbers into
stripes, so repeats inside such a batch are counted before the shuffle.  Stripes go to
``parts`` hash parts by their prefix, all stripes of a batch and part packed into one row.
Merge: a task adds up the stripes of one part elementwise and keeps what reaches ``least``.

Skew.  The stripe of no words is dealt out by its elements.  So is a two-word stripe with more
than ``WIDE`` elements in a batch; a mark goes to the prefix's own part, and from every part
that prefix's elements leave as partial counts, which a grouping by (prefix, word) adds up.
So no part has more than ``WIDE`` elements of one prefix from one batch.  The shuffle carries
what the texts hold, in proportion to them; what follows the merge holds frequent phrases only.

Scores are exact: products are decimals of 38 digits, enough for counts up to 10^15.

Defined cases.  A null or blank text has no words.  A null language is ``und`` and meets the
rows that say ``und``.  Each ill-formed part of a text is U+FFFD, a sign like any other.
Repeated rows count each time.  Equal scores and counts are ordered by the phrase's bytes.  An
empty table gives no rows.  A text is cut at separators into stretches of some ``STRETCH``
bytes (longer where none comes), whatever its length.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import staged
from tickwise.llm.spans import SliceHash

#: Words whose stripes are built together; three of their numbers fit 63 bits.
WORDS = 1 << 19
#: Bytes of text that are cut into words together.
STRETCH = 1 << 21
#: Elements beyond which a stripe is dealt out by its elements.
WIDE = 1 << 12
#: Parts for each shuffle partition: a task merges one part at a time.
PARTS = 4
#: Shares in which a language's phrases are ranked first.
SHARES = 256
#: What ends a piece, and what else ends a word.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
_MIX = 0x9E3779B97F4A7C15


def _letters() -> bytes:
    """For each byte what it counts as: A-Z lower-cased, a newline where a piece ends, a space
    where a word does."""
    out = bytearray(range(256))
    out[ord("A"):ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    for b in PIECE_ENDS:
        out[b] = ord("\n")
    for b in WORD_ENDS:
        out[b] = ord(" ")
    return bytes(out)


LETTERS = _letters()


def stretches(bodies: Iterator[bytes]) -> Iterator[bytes]:
    """Texts as ``LETTERS`` has them, joined by newlines and cut at newlines again."""
    held, weight = [], 0
    for body in bodies:
        body = body.translate(LETTERS)
        at = 0
        while at < len(body):
            end = len(body)
            if end - at > STRETCH:
                cut = body.rfind(b"\n", at, at + STRETCH)
                cut = cut if cut > at else body.find(b"\n", at + STRETCH)
                end = end if cut < 0 else cut + 1
            held.append(body[at:end])
            weight += end - at
            at = end
            if weight >= STRETCH:
                yield b"\n".join(held)
                held, weight = [], 0
    if held:
        yield b"\n".join(held)


def words_of(stretch: bytes):
    """The words' bytes without gaps, their offsets, and the number of each word's piece."""
    import numpy as np

    data = np.frombuffer(stretch, np.uint8)
    inside = (data != 32) & (data != 10)
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return data[inside], np.append(0, np.cumsum(ends - begins)), np.searchsorted(np.flatnonzero(data == 10), begins)


def stripes(letters, offsets, piece, own: int, hasher: SliceHash, parts: int, wide: int):
    """The stripes of a run of words, of which the first ``own`` begin phrases, as Arrow columns (part, prefixes, sizes, split, nexts,
    counts), one row for each part: prefixes end with a newline and next words with a space."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(piece)
    words = pa.Array.from_buffers(pa.large_binary(), n, [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]).dictionary_encode()
    ids = words.indices.to_numpy().astype(np.int64)
    known = words.dictionary
    at = np.frombuffer(known.buffers()[1], np.int64)[known.offset:known.offset + len(known) + 1]
    text = np.frombuffer(known.buffers()[2], np.uint8)
    base = int(at[0])
    hashes = np.append(hasher(text[base:int(at[-1])], at[:-1] - base, at[1:] - base), np.uint64(0))
    v = len(known)
    end = v  # one number past the words: END as a next word, no word as a prefix
    one = np.flatnonzero((piece[1:] == piece[:-1])[:own])
    third = np.full(len(one), end, np.int64)
    if n > 2:
        more = (one + 2 < n) & (piece[np.minimum(one + 2, n - 1)] == piece[one])
        third[more] = ids[one[more] + 2]
    pair = (ids[one] * (v + 1) + ids[one + 1]) * (v + 1) + third
    element, count = np.unique(pair, return_counts=True)
    total = np.bincount(ids[:own], minlength=v)
    seen = np.flatnonzero(total)
    # the stripe of no words comes last, as the pair (end, end)
    prefix = np.concatenate((element // (v + 1), np.full(len(seen), end * (v + 1) + end, np.int64)))
    following = np.concatenate((element % (v + 1), seen))
    count = np.concatenate((count, total[seen])).astype(np.int64)
    first, second = prefix // (v + 1), prefix % (v + 1)
    name = hashes[first] * np.uint64(_MIX) + hashes[second]
    new = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
    size = np.diff(np.append(new, len(prefix)))
    split = np.repeat((size > wide) | (first[new] == end), size)
    name = np.where(split, name ^ (hashes[following] * np.uint64(_MIX) + np.uint64(1)), name)
    # a mark, a stripe without elements, tells a split prefix's own part
    marks = new[(size > wide) & (first[new] != end)]
    owner = hashes[first[marks]] * np.uint64(_MIX) + hashes[second[marks]]

    def part_of(h):
        h = h ^ (h >> np.uint64(29))
        return ((h * np.uint64(_MIX)) >> np.uint64(33)) % np.uint64(parts)

    part = np.concatenate((part_of(name), part_of(owner))).astype(np.int64)
    is_mark = np.concatenate((np.zeros(len(prefix), bool), np.ones(len(marks), bool)))
    prefix = np.concatenate((prefix, prefix[marks]))
    split = np.concatenate((split, np.ones(len(marks), bool)))
    following = np.concatenate((following, np.full(len(marks), end)))
    count = np.concatenate((count, np.zeros(len(marks), np.int64)))
    order = np.argsort(part, kind="stable")
    part, prefix, split, following, count, is_mark = (x[order] for x in (
        part, prefix, split, following, count, is_mark))
    new = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])))
    row = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    row_of_stripe = np.searchsorted(new, row)
    blank = pa.array([b""], pa.large_binary())
    names = pa.concat_arrays([known, blank])
    a, b = names.take(pa.array(prefix[new] // (v + 1))), names.take(pa.array(prefix[new] % (v + 1)))
    space, line = (pa.scalar(x, pa.large_binary()) for x in (b" ", b"\n"))
    lines = pc.binary_join_element_wise(pc.binary_join_element_wise(a, b, space), blank[0], line)
    nexts = pc.binary_join_element_wise(names.take(pa.array(following)), blank[0], space)
    sizes = np.diff(np.append(new, len(prefix))).astype("<u4")

    def sliced(values, starts):
        """One binary value for each row from an array of binary values."""
        o = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
        return cut(values.buffers()[2], o[np.append(starts, len(values))])

    def cut(data, o):
        return pa.Array.from_buffers(pa.large_binary(), len(o) - 1, [None, pa.py_buffer(o.astype(np.int64)), data]) \
            .cast(pa.binary())

    def fixed(values, starts):
        return cut(pa.py_buffer(values.tobytes()), np.append(starts, len(values)) * values.itemsize)

    return [pa.array(part[row], pa.int32()), sliced(lines, row_of_stripe), fixed(sizes, row_of_stripe),
            fixed(split[new].astype(np.uint8), row_of_stripe), sliced(nexts, row), fixed(count.astype("<u4"), row)]


PACKED = "lang string, part int, prefixes binary, sizes binary, split binary, nexts binary, counts binary"


def packed_stripes(docs: DataFrame, parts: int) -> DataFrame:
    """The stripes of all texts of ``docs`` (text, lang), packed by language and part."""
    wide, most = WIDE, WORDS

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, hasher = [c.split()[0] for c in PACKED.split(", ")], SliceHash()

        def coded(lang, bodies):
            for stretch in stretches(bodies):
                letters, offsets, piece = words_of(stretch)
                for at in range(0, len(piece), most):
                    own = min(most, len(piece) - at)
                    end = min(at + own + 2, len(piece))  # phrases that begin here may end there
                    lo, hi = int(offsets[at]), int(offsets[end])
                    cols = stripes(letters[lo:hi], offsets[at:end + 1] - lo, piece[at:end], own, hasher, parts, wide)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cols[0]), pa.string()), *cols], names)

        held: dict[str, list[bytes]] = {}
        weight: dict[str, int] = {}
        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body"), strict=True):
                held.setdefault(lang, []).append(body.as_py())
                weight[lang] = weight.get(lang, 0) + len(held[lang][-1])
                if sum(weight.values()) > 4 * STRETCH:
                    heavy = max(weight, key=weight.get)
                    yield from coded(heavy, held.pop(heavy))
                    del weight[heavy]
        for lang, bodies in held.items():
            yield from coded(lang, bodies)

    lang = F.make_valid_utf8(F.coalesce("lang", F.lit("und")))
    return docs.select(lang.alias("lang"), F.coalesce(F.make_valid_utf8("text").cast("binary"), F.lit(b"")).alias("body")) \
        .filter(F.length("body") > 0).mapInArrow(run, PACKED)


#: What a merged part says: a language's words, a word, a pair with its largest extension, a
#: phrase of three, an element of a split stripe.
TOTAL, WORD, PAIR, TRIPLE, PARTIAL = range(5)
MERGED = "lang string, kind int, prefix binary, next binary, n bigint, extension bigint"


def _terminated(data: bytes, mark: int):
    """The values of a column in which each one ends with ``mark``, dictionary-coded with it."""
    import numpy as np
    import pyarrow as pa

    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == mark) + 1
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [
        None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()


def merge_part(lang: str, rows: list[tuple], least: int):
    """The sums of one part's stripes as ``MERGED`` columns."""
    import numpy as np
    import pyarrow as pa

    prefixes, nexts = (_terminated(b"".join(r[i] for r in rows), mark) for i, mark in ((0, 10), (3, 32)))
    sizes = np.frombuffer(b"".join(r[1] for r in rows), "<u4")
    split = np.zeros(len(prefixes.dictionary), bool)
    line = prefixes.indices.to_numpy()
    split[line[np.frombuffer(b"".join(r[2] for r in rows), np.uint8) > 0]] = True
    counts = np.frombuffer(b"".join(r[4] for r in rows), "<u4").astype(np.int64)
    m = len(nexts.dictionary)
    key = np.repeat(line.astype(np.int64), sizes) * m + nexts.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sums = np.add.reduceat(counts[order], new)
    prefix, following = key[new] // m, key[new] % m
    endless = np.array([w != b" " for w in nexts.dictionary.to_pylist()], bool)[following]
    stripe = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
    total = np.add.reduceat(sums, stripe)
    largest = np.maximum.reduceat(np.where(endless, sums, 0), stripe)
    names = pa.array([p[:-1] for p in prefixes.dictionary.to_pylist()], pa.binary())
    of_none = np.array([len(p) == 1 for p in names.to_pylist()], bool)  # the prefix of no words is " "
    words = pa.array([w[:-1] for w in nexts.dictionary.to_pylist()], pa.binary())
    frequent, whole = sums >= least, ~split[prefix]
    pair = np.flatnonzero((total >= least) & whole[stripe])

    def rows_of(kind, at, n, more=None, named=True, following_of=None):
        return pa.RecordBatch.from_arrays([
            pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.int32()),
            names.take(pa.array(prefix[at])) if named else pa.array([b""] * len(at), pa.binary()),
            words.take(pa.array(following[at])) if following_of is None else pa.array([b""] * len(at), pa.binary()),
            pa.array(n, pa.int64()), pa.array(np.zeros(len(at), np.int64) if more is None else more, pa.int64())],
            [c.split()[0] for c in MERGED.split(", ")])

    root = of_none[prefix]
    at = np.flatnonzero(root)
    if len(at):
        yield rows_of(TOTAL, at[:1], [int(sums[at].sum())], named=False, following_of=False)
    for kind, at in ((WORD, np.flatnonzero(root & frequent)), (TRIPLE, np.flatnonzero(whole & frequent & endless)),
                     (PARTIAL, np.flatnonzero(~whole & ~root & (sums > 0)))):
        if len(at):
            yield rows_of(kind, at, sums[at], named=kind != WORD)
    if len(pair):
        yield rows_of(PAIR, stripe[pair], total[pair], largest[pair], following_of=False)


def merged(packed: DataFrame, least: int, tasks: int) -> DataFrame:
    """What is left of the stripes once each part's are added up; staged."""
    def run(batches: Iterator) -> Iterator:
        group, rows = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                at = (columns[0][i].as_py(), columns[1][i].as_py())
                if rows and at != group:
                    yield from merge_part(group[0], rows, least)
                    rows = []
                group = at
                rows.append(tuple(c[i].as_py() for c in columns[2:]))
        if rows:
            yield from merge_part(group[0], rows, least)

    # parts are dealt in turn, so every task has as many; a hash of them would not be as even
    return staged(packed.repartitionById(tasks, F.col("part") % tasks).sortWithinPartitions("lang", "part")
                  .mapInArrow(run, MERGED), "stripes")


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n), words (lang, w, n), pairs (lang, w1, w2, n, extension) and triples
    (lang, w1, w2, w3, n) that occur ``least`` times or more."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = merged(packed_stripes(docs, PARTS * tasks), least, tasks)
    text = [F.col(c).cast("string").alias(c) for c in ("prefix", "next")]
    rows = found.select("lang", "kind", *text, "n", "extension")
    split = rows.filter(F.col("kind") == PARTIAL).groupBy("lang", "prefix", "next").agg(F.sum("n").alias("n"))
    wide = split.groupBy("lang", "prefix").agg(
        F.sum("n").alias("n"), F.max(F.when(F.col("next") != "", F.col("n")).otherwise(0)).alias("extension"))
    cut = F.split("prefix", " ")
    pairs = rows.filter(F.col("kind") == PAIR).select("lang", "prefix", "n", "extension").unionByName(wide)
    triples = rows.filter(F.col("kind") == TRIPLE).select("lang", "prefix", "next", "n").unionByName(
        split.filter("next != ''"))
    return (rows.filter(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("n").alias("n")),
            rows.filter(F.col("kind") == WORD).select("lang", F.col("next").alias("w"), "n"),
            pairs.filter(F.col("n") >= least).select("lang", cut[0].alias("w1"), cut[1].alias("w2"), "n", "extension"),
            triples.filter(F.col("n") >= least).select(
                "lang", cut[0].alias("w1"), cut[1].alias("w2"), F.col("next").alias("w3"), "n"))


def score(a, left, right):
    """floor(1000000 * a * a / (left * right)), exactly."""
    a, left, right = (x.cast("decimal(16,0)") for x in (a, left, right))
    return F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases.

    A phrase's score is that of its lowest-scoring cut (the earliest of equals).  Dropped are
    phrases that some longer one holds with ``percent`` per cent of their count or more.
    """
    totals, words, pairs, triples = phrase_counts(docs, least)

    def named(df: DataFrame, *columns: str) -> DataFrame:
        """A count table under names of its own for a join."""
        return df.select(F.col("lang").alias("k_lang"), *[F.col(c).alias(f"k_{c}") for c in columns],
                         F.col("n").alias("k_n"))

    def looked_up(df: DataFrame, table: DataFrame, on: dict[str, str], name: str) -> DataFrame:
        match = [F.col("lang") == F.col("k_lang"), *[F.col(a) == F.col(f"k_{b}") for a, b in on.items()]]
        return df.join(table, match).select(*df.columns, F.col("k_n").alias(name))

    one, two = named(words, "w"), named(pairs, "w1", "w2")
    held_left = triples.groupBy(F.col("lang").alias("h_lang"), F.col("w2").alias("h1"), F.col("w3").alias("h2")).agg(
        F.max("n").alias("before"))
    of_two = pairs.join(held_left, [F.col("lang") == F.col("h_lang"), F.col("w1") == F.col("h1"),
                                    F.col("w2") == F.col("h2")], "left")
    longer = F.greatest(F.coalesce("before", F.lit(0)), F.when(F.col("extension") >= least, F.col("extension"))
                        .otherwise(0))
    of_two = of_two.filter(100 * longer < percent * F.col("n")).select("lang", "w1", "w2", F.col("n").alias("a"))
    of_two = looked_up(looked_up(of_two, one, {"w1": "w"}, "l"), one, {"w2": "w"}, "r").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r",
        score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    of_three = triples.withColumnRenamed("n", "a")
    for table, on, name in ((one, {"w1": "w"}, "l1"), (two, {"w2": "w1", "w3": "w2"}, "r1"),
                            (two, {"w1": "w1", "w2": "w2"}, "l2"), (one, {"w3": "w"}, "r2")):
        of_three = looked_up(of_three, table, on, name)
    cuts = of_three.withColumn("s1", score(F.col("a"), F.col("l1"), F.col("r1"))) \
        .withColumn("s2", score(F.col("a"), F.col("l2"), F.col("r2")))
    first = F.col("s1") <= F.col("s2")
    of_three = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                           *[F.when(first, F.col(f"{x}1")).otherwise(F.col(f"{x}2")).alias(y)
                             for x, y in (("l", "l"), ("r", "r"), ("s", "score"))])
    # a language's best are among the best of its shares, so no task ranks all its phrases
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = of_two.unionByName(of_three).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    best = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")) \
        .filter(F.col("rank") <= top)
    return best.join(named(totals), F.col("lang") == F.col("k_lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("k_n").alias("n"), "score")
