"""The trie of conversation prefixes, measured along an Euler tour.

A node is a distinct sequence of first turns.  Its subtree's leaves and savings are found
without walking the tree:

1. Every turn gets its place in its conversation from one distributed sort (``placed``).
2. A prefix is named by the XOR of 64-bit hashes of its (depth, role, text) triples, in three
   lanes.  The running XOR is taken in blocks of ``BLOCK`` turns with a carry for each block, so
   a conversation of any length is spread over tasks.  One lane numbers the nodes; the others
   prove that it names no two prefixes alike (if it does, the next lane is taken).
3. Each node has an arc that enters it and one that leaves it.  An arc's successor on the tour
   comes from sibling links: children are chained in ``SHARES`` shares of their parent and the
   shares are chained to each other, so a parent of any number of children is spread too.
4. The tour is list-ranked by contraction (``tour_sums``): in each round a hash flips a coin for
   every arc, and an arc with tails absorbs a successor with heads.  The tour shrinks by a
   quarter a round, so all rounds together move a small multiple of it.  When ``BASE`` arcs are
   left, one task walks them; then absorbed arcs get their sums back, round by round.
5. What stands before an arc is a prefix sum at its position of the tour.  A subtree's sum is
   the difference of the sums at its two arcs.

Defined cases.  Turns are ordered by turn (null first), then role, then text (by bytes); a null
role or text is empty.  Repeated rows are turns of their own.  Rows without a conv_id belong to
no conversation.  An empty table has no nodes.  A rebuilt conversation without turns is a member
of the root only.  Other columns are not looked at, whatever their names.  A node's digest of
ends is one running SHA-256, which only one task can take; what it reads are strings of up to
``BLOCK`` ids, so its memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import staged

#: Turns of a conversation that one window scans, and ids in one string of a digest.
BLOCK = 4096
#: Shares in which a node's children are chained.
SHARES = 1024
#: Arcs that one task walks when the tour has been contracted to them.
BASE = 1 << 15
LANES = ("k1", "k2", "k3")
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def placed(df: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``place``, each row's number from 0 among the rows of its key in order.

    The rows are range-partitioned by key and order, so the rows of one key may lie in several
    partitions; their counts there, one row for each key and partition, give the offsets.
    Rows that agree in everything are told apart by where they were read.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    in_order = staged(tied.repartitionByRange(n, key, *order, "_tie").sortWithinPartitions(key, *order, "_tie")
                      .drop("_tie").withColumn("_at", F.monotonically_increasing_id())
                      .withColumn("_segment", F.shiftright("_at", 33)), name)
    held = in_order.groupBy(F.col(key).alias("_key"), F.col("_segment").alias("_s")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_key").orderBy("_s")) - F.col("_n")
    return in_order.join(held.withColumn("_before", before),
                         (F.col(key) == F.col("_key")) & (F.col("_segment") == F.col("_s"))) \
        .withColumn("place", F.col("_at") - F.col("_first") + F.col("_before")) \
        .drop("_key", "_s", "_first", "_n", "_before", "_at", "_segment")


def kept_turns(conv: Column) -> Column:
    """How many turns of its base a conversation begins with: CRC-32 of its id in decimal, mod 9."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(9))


def base_of(conv: Column) -> Column:
    return conv - conv % 5


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, depth from 1, digest, n_bytes, last: whether it is the last one) and
    the conversations (conv, depth of the last turn); both staged.

    A conversation takes the first ``kept_turns`` turns of the conversation that ``base_of``
    names and goes on with its own turns after as many.
    """
    text, role = (F.coalesce(F.col(c).cast("binary"), F.lit(b"")) for c in ("text", "role"))
    known = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    rows = placed(known, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "turns").select(
        "conv", "place", F.length("text").cast("bigint").alias("n_bytes"),
        # the lengths keep a role's end from being taken for a text's beginning
        F.sha2(F.concat(F.length("role").cast("string").cast("binary"), F.lit(b":"), "role", "text"), 256)
        .alias("digest"))
    rows = staged(rows, "places")
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    kept = kept_turns(F.col("conv"))
    bases = sizes.select(F.col("conv").alias("b_conv"), F.col("n").alias("b_n"))
    convs = sizes.join(bases, base_of(F.col("conv")) == F.col("b_conv"), "left").select(
        "conv", "n", kept.alias("kept"), F.least(kept, F.coalesce("b_n", F.lit(0))).alias("taken"))
    convs = staged(convs.withColumn("depth", F.col("taken") + F.greatest(F.col("n") - F.col("kept"), F.lit(0))),
                   "conversations")
    # a conversation's facts are repeated for each block of its turns, so long ones are no hot key
    facts = convs.select(F.col("conv").alias("c_conv"), "kept", "taken", "depth",
                         F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / BLOCK))).alias("c_block"))
    own = rows.filter(F.col("place") >= kept_turns(F.col("conv"))).join(
        facts, (F.col("conv") == F.col("c_conv")) & (F.floor(F.col("place") / BLOCK) == F.col("c_block"))).select(
        "conv", (F.col("taken") + F.col("place") - F.col("kept") + 1).alias("at"), "digest", "n_bytes", "depth")
    near = F.explode(F.transform(F.sequence(F.lit(-4), F.lit(4)), lambda k: F.col("conv") + k))
    lent = rows.filter((F.col("conv") % 5 == 0) & (F.col("place") < 8)).select(
        "conv", "place", "digest", "n_bytes", near.alias("to")).filter(
        (base_of(F.col("to")) == F.col("conv")) & (F.col("place") < kept_turns(F.col("to"))))
    takers = convs.select(F.col("conv").alias("t_conv"), "depth")
    taken = lent.join(takers, F.col("to") == F.col("t_conv")).select(
        F.col("to").alias("conv"), (F.col("place") + 1).alias("at"), "digest", "n_bytes", "depth")
    every = own.unionByName(taken).select("conv", F.col("at").alias("d"), "digest", "n_bytes",
                                          (F.col("at") == F.col("depth")).alias("last"))
    return every, convs.select("conv", "depth")


def members(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Each rebuilt conversation's prefixes: conv, d, lanes and the parent's lanes, n_bytes of
    the last text and ``last``; staged.  Depth 0 is the root."""
    own = [F.xxhash64(F.lit(i), "d", "digest") for i in range(len(LANES))]
    cut = turns.withColumn("block", F.floor((F.col("d") - 1) / BLOCK)) \
        .withColumns({f"h{i}": h for i, h in enumerate(own)})
    run = Window.partitionBy("conv", "block").orderBy("d")
    inside = cut.withColumns({k: F.bit_xor(f"h{i}").over(run) for i, k in enumerate(LANES)})
    whole = cut.groupBy(F.col("conv").alias("b_conv"), "block").agg(
        *[F.bit_xor(f"h{i}").alias(f"b{i}") for i in range(len(LANES))])
    ahead = Window.partitionBy("b_conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = whole.select("b_conv", F.col("block").alias("b_block"), *[
        F.bit_xor(f"b{i}").over(ahead).alias(f"c{i}") for i in range(len(LANES))]).filter("b_block > 0")
    joined = inside.join(carry, (F.col("conv") == F.col("b_conv")) & (F.col("block") == F.col("b_block")), "left")
    lanes = {k: F.col(k).bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i, k in enumerate(LANES)}
    deep = joined.withColumns(lanes).select(
        "conv", "d", *LANES, *[F.col(k).bitwiseXOR(F.col(f"h{i}")).alias(f"p{i}") for i, k in enumerate(LANES)],
        "n_bytes", "last")
    zero = F.lit(0).cast("bigint")
    root = convs.select("conv", zero.alias("d"), *[zero.alias(k) for k in LANES],
                        *[F.lit(None).cast("bigint").alias(f"p{i}") for i in range(len(LANES))],
                        zero.alias("n_bytes"), (F.col("depth") == 0).alias("last"))
    return staged(deep.unionByName(root), "members")


def arc_number(lane: Column) -> Column:
    """A lane as a node's number: its low 62 bits, so twice it and one more is still a long."""
    return lane.bitwiseAND(F.lit((1 << 62) - 1))


def numbered_nodes(found: DataFrame) -> tuple[DataFrame, int]:
    """The nodes (node, parent, d, conv_id, n_convs, n_bytes), staged, and the lane that numbers
    them: the first that gives no two of them one number."""
    grouped = staged(found.groupBy("d", *LANES).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        *[F.max(f"p{i}").alias(f"p{i}") for i in range(len(LANES))]), "prefixes")
    for i, lane in enumerate(LANES):
        if grouped.groupBy(arc_number(F.col(lane)).alias("node")).count().filter("count > 1").isEmpty():
            return grouped.select(arc_number(F.col(lane)).alias("node"), arc_number(F.col(f"p{i}")).alias("parent"),
                                  "d", "conv_id", "n_convs", "n_bytes"), i
    raise RuntimeError("every lane gives two prefixes one number")


def siblings(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Children (node, parent, share, next child of its share) and shares (parent, share, first
    and last child, the next share's first child, whether it is the parent's first share)."""
    share = F.pmod(F.xxhash64("node"), F.lit(SHARES))
    children = nodes.filter("parent IS NOT NULL").select("node", "parent", share.alias("share"))
    linked = children.withColumn("next", F.lead("node").over(
        Window.partitionBy("parent", "share").orderBy("node")))
    shares = children.groupBy("parent", "share").agg(F.min("node").alias("first"), F.max("node").alias("last"),
                                                     F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("parent").orderBy("share")
    shares = shares.withColumn("next", F.lead("first").over(order)).withColumn(
        "heads", F.lag("first").over(order).isNull())
    return linked, staged(shares, "shares")


def arcs(nodes: DataFrame, linked: DataFrame, shares: DataFrame) -> DataFrame:
    """The tour: arc, next (null at its end), leaves and saved, the weights of the arc.  Node x
    is entered by arc 2x, which has its weights, and left by arc 2x + 1."""
    def enter(c):
        return F.col(c) * 2

    def leave(c):
        return F.col(c) * 2 + 1

    inner = shares.groupBy(F.col("parent").alias("s_node")).agg(
        F.min(F.when(F.col("heads"), F.col("first"))).alias("child"))
    zero = F.lit(0).cast("bigint")
    entered = nodes.join(inner, F.col("node") == F.col("s_node"), "left").select(
        enter("node").alias("arc"), F.when(F.col("child").isNull(), leave("node")).otherwise(enter("child"))
        .alias("next"), F.when(F.col("child").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    within = linked.filter("next IS NOT NULL").select(
        leave("node").alias("arc"), enter("next").alias("next"), zero.alias("leaves"), zero.alias("saved"))
    between = shares.select(leave("last").alias("arc"), F.coalesce(enter("next"), leave("parent")).alias("next"),
                            zero.alias("leaves"), zero.alias("saved"))
    end = nodes.filter("parent IS NULL").select(leave("node").alias("arc"), F.lit(None).cast("bigint").alias("next"),
                                                zero.alias("leaves"), zero.alias("saved"))
    return staged(entered.unionByName(within).unionByName(between).unionByName(end), "tour")


SUMS = "arc bigint, leaves bigint, saved bigint"


def _walk(batches: Iterator) -> Iterator:
    """The sums before each arc of a short list (arc, next, leaves, saved)."""
    import pandas as pd

    frames = [f for f in batches if len(f)]
    if not frames:
        return
    rows = pd.concat(frames)
    after = {a: (n, x, y) for a, n, x, y in zip(rows["arc"].tolist(), rows["next"].tolist(), rows["leaves"].tolist(),
                                                rows["saved"].tolist(), strict=True)}
    at = next(iter(set(after) - {n for n, _, _ in after.values()}))
    out, leaves, saved = [], 0, 0
    while at in after:
        out.append((at, leaves, saved))
        at, x, y = after[at]
        leaves, saved = leaves + x, saved + y
    yield pd.DataFrame(out, columns=["arc", "leaves", "saved"])


def tour_sums(tour: DataFrame, base: int | None = None) -> DataFrame:
    """For each arc the sums of leaves and saved over the arcs before it; staged.

    In a round, an arc whose coin is 0 absorbs its successor if that one's coin is 1: it takes
    over the successor's weights and successor.  What it weighed before is kept as the absorbed
    arc's distance from it.
    """
    base = BASE if base is None else base
    rounds, live, left = [], tour, tour.count()
    while left > base:
        def coin(arc: str, number: int = len(rounds)) -> Column:
            return F.pmod(F.xxhash64(F.lit(number), arc), F.lit(2))

        takes = F.col("next").isNotNull() & (coin("arc") == 0) & (coin("next") == 1)
        takers = live.filter(takes).select(F.col("arc").alias("t_arc"), F.col("next").alias("t_next"),
                                           F.col("leaves").alias("t_leaves"), F.col("saved").alias("t_saved"))
        met = live.withColumn("takes", F.coalesce(takes, F.lit(False))).join(
            takers, F.col("arc") == F.col("t_next"), "left").filter(F.col("t_arc").isNotNull() | ~F.col("takes"))
        taken = F.col("t_arc").isNotNull()
        done = staged(met.select(
            F.coalesce("t_arc", "arc").alias("arc"), "next",
            (F.col("leaves") + F.coalesce("t_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("t_saved", F.lit(0))).alias("saved"),
            F.when(taken, F.col("arc")).alias("gone"), F.col("t_leaves").alias("gone_leaves"),
            F.col("t_saved").alias("gone_saved")), "contracted")
        rounds.append(done.filter("gone IS NOT NULL").select("gone", F.col("arc").alias("owner"), "gone_leaves",
                                                             "gone_saved"))
        live = done.select("arc", "next", "leaves", "saved")
        left = live.count()
    # at most ``base`` arcs
    sums = live.withColumn("next", F.coalesce("next", F.lit(-1))).coalesce(1).mapInPandas(_walk, SUMS)
    for absorbed in reversed(rounds):
        sums = staged(sums, "ranked")
        back = absorbed.join(sums, F.col("owner") == F.col("arc")).select(
            F.col("gone").alias("arc"), (F.col("leaves") + F.col("gone_leaves")).alias("leaves"),
            (F.col("saved") + F.col("gone_saved")).alias("saved"))
        sums = sums.unionByName(back)
    return staged(sums, "ranked")


def end_digests(found: DataFrame, lane: int) -> DataFrame:
    """node and ends_sha256 of the nodes at which conversations end: SHA-256 of their ids in
    decimal, ascending, joined by commas.  Conversations have one end, so no id comes twice."""
    ends = found.filter("last").select(arc_number(F.col(LANES[lane])).alias("node"), "conv",
                                       F.floor(F.col("conv") / BLOCK).alias("block"))
    strings = ends.groupBy("node", "block").agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pandas as pd

        node, state = None, None
        for frame in batches:
            out = []
            for at, ids in zip(frame["node"], frame["ids"], strict=True):
                if at == node:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["node", "sha"])
        if state is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "sha"])

    return strings.repartition("node").sortWithinPartitions("node", "block").select("node", "ids") \
        .mapInPandas(run, "node bigint, sha string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id (the least member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    rows, convs = rebuilt(turns)
    found = members(rows, convs)
    nodes, lane = numbered_nodes(found)
    linked, shares = siblings(nodes)
    sums = tour_sums(arcs(nodes, linked, shares))
    sign = F.when(F.col("arc") % 2 == 1, 1).otherwise(-1)
    below = sums.groupBy(F.shiftright("arc", 1).alias("b_node")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"))
    counts = shares.groupBy(F.col("parent").alias("c_node")).agg(F.sum("n").alias("n_children"))
    digests = end_digests(found, lane).withColumnRenamed("node", "e_node")
    # parents are looked up once for each share of their children
    names = nodes.select(F.col("node").alias("p_node"), F.col("conv_id").alias("parent_conv_id"))
    heads = shares.join(names, F.col("parent") == F.col("p_node")).select(
        F.col("parent").alias("h_parent"), F.col("share").alias("h_share"), "parent_conv_id")
    share = F.pmod(F.xxhash64("node"), F.lit(SHARES))
    return nodes.join(heads, (F.col("parent") == F.col("h_parent")) & (share == F.col("h_share")), "left") \
        .join(below, F.col("node") == F.col("b_node")) \
        .join(counts, F.col("node") == F.col("c_node"), "left") \
        .join(digests, F.col("node") == F.col("e_node"), "left") \
        .select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs",
                F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
                F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
