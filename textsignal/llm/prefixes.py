"""The prefix trie of conversations: one node for each distinct sequence of first turns.

A conversation is written as positional columns of turn ids, BLOCK turns a row. One ROLLUP over these columns gives all
prefixes of a row at once; the grouping id tells the depth. Long conversations continue in further rows, keyed by the node that
the prior block ends in. A node's id is the exclusive or of its turns' 128-bit hashes, salted with their places, so
the key of every block is known beforehand and all blocks of all conversations share one ROLLUP.

What a node says of its whole subtree comes from its members. Each node belongs to its smallest member; a conversation owns
the nodes from some depth on, which the first ROLLUP finds. Summing over members what they own below a node counts every
node of the subtree once, which the second ROLLUP does.
"""
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from textsignal.llm.common import written

# Turns of a row; blocks of one conversation whose running sums one task takes; ids joined into one piece of text.
BLOCK = 8
CHUNK = 512
PIECE = 20_000
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()


def _count(batches):
    """Places of sorted rows inside their conversation, and whether it is the first one of the partition."""
    last, seen, head = None, 0, True
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        if not len(conv):
            continue
        new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
        begin = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
        place = np.arange(len(conv)) - begin + 1
        place[begin < 0] = seen + np.arange(1, 1 + int((begin < 0).sum()))
        heads = (begin < 0 if last is not None else conv == conv[0]) & head
        head = bool(heads[-1])
        last, seen = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("range", "conv_id")), pa.array(place), *(batch.column(c) for c in ("id", "words")), pa.array(heads)],
                                         names=["range", "conv_id", "place", "id", "words", "head"])


def turns(conversations, conv_id="conv_id", turn="turn", role="role", text="text"):
    """(conv_id, place, id, words): turns in order, null turns first, equal ones by id, which is the MD5 of role and text.

    Null roles and texts count as empty. Rows without a conversation take no part. Rows are numbered in sorted ranges, not by
    conversation, so that one conversation may hold any share of the rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = ["conv_id", "turn", "id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged.mapInArrow(_count, "range int, conv_id long, place long, id binary, words long, head boolean"), "turns")
    # Only the first conversation of a range can go on from the one before: at most one row for each range.
    across = ranged.filter("head").select("conv_id").distinct()
    parts = ranged.join(F.broadcast(across), "conv_id", "left_semi").groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.sum("n").over(before)).filter("before is not null").drop("n")
    return ranged.join(F.broadcast(parts), ["conv_id", "range"], "left").select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "id", "words")


def branched(turns, source, head, most):
    """(turns, conversations) of rebuilt conversations: the first `head` turns of conversation `source`, then their own after the first `head`.

    source, head: columns over conv_id; head is at most `most`. A source with fewer turns gives all, a missing one none. Every
    conversation is in `conversations`, even if no turn is left.
    """
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n")).select("conv_id", "n", source.alias("source"), head.alias("head"))
    heads = turns.filter(F.col("place") <= most).groupBy(F.col("conv_id").alias("source")).agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "words"))).alias("given"))
    convs = written(convs.join(heads, "source", "left").select("conv_id", "n", "head", F.slice(F.coalesce("given", F.array()), 1, F.col("head").cast("int")).alias("given")), "conversations")
    first = convs.select("conv_id", F.explode("given").alias("t")).select("conv_id", "t.*")
    # Where the source is too short, what follows moves up.
    short = convs.filter(F.size("given") < F.col("head")).select("conv_id", (F.col("head") - F.size("given")).alias("missing"))
    own = turns.filter(F.col("place") > head).join(short, "conv_id", "left").withColumn("place", F.col("place") - F.coalesce("missing", F.lit(0)))
    return first.union(own.select(*first.columns)), convs.select("conv_id")


def _blocks(turns, convs):
    """Rows of BLOCK positional turn ids with the node, words and turns before them, and the words and turns of the whole conversation."""
    marks = convs.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in (("place", "long"), ("id", "binary"), ("words", "long"))])
    empty = marks.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    at = F.coalesce(F.col("place") - 1, F.lit(0))
    rows = turns.select("conv_id", "place", "id", "words").union(empty).select(
        "conv_id", F.floor(at / (BLOCK * CHUNK)).alias("chunk"), F.floor(at / BLOCK).alias("block"), (at % BLOCK).alias("slot"), "words",
        F.when(F.col("id").isNotNull(), F.xxhash64("place", "id")).alias("x"), F.when(F.col("id").isNotNull(), F.xxhash64("id", "place")).alias("y"))
    slots = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{c[0]}{i}") for i in range(BLOCK) for c in ("x", "y", "words")]
    rows = written(rows.repartition("conv_id", "chunk").groupBy("conv_id", "chunk", "block").agg(
        *slots, F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.count("x").alias("n")), "rows")
    parts = {"x": "bit_xor({})", "y": "bit_xor({})", "words": "sum({})", "n": "sum({})"}
    running = {c: F.expr(f"coalesce({e.format(c)}, 0)") for c, e in parts.items()}

    def sums(frame, group, order):
        # Before each row, and over all rows of its group.
        group = Window.partitionBy(*group)
        before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.select("*", *[F.coalesce(F.expr(e.format(c)).over(before), F.lit(0)).alias(f"{c}_before") for c, e in parts.items()],
                            *[F.sum(c).over(group).alias(f"{c}_all") for c in ("words", "n")])

    blocks = sums(rows, ["conv_id", "chunk"], "block")
    # Conversations of several chunks: what lies in other chunks comes from sums by chunk.
    several = rows.filter("chunk > 0").select("conv_id").distinct()
    chunks = rows.join(several, "conv_id", "left_semi").groupBy("conv_id", "chunk").agg(*[e.alias(c) for c, e in running.items()])
    chunks = sums(chunks, ["conv_id"], "chunk").select("conv_id", "chunk", *[F.col(f"{c}_{w}").alias(f"{c}_far_{w}") for c, w in (
        ("x", "before"), ("y", "before"), ("words", "before"), ("words", "all"), ("n", "all"))])
    far = lambda c: F.coalesce(c, F.lit(0))
    blocks = blocks.join(chunks, ["conv_id", "chunk"], "left").select(
        "conv_id", "block", *[f"{c}{i}" for i in range(BLOCK) for c in "xyw"], "n",
        F.col("x_before").bitwiseXOR(far("x_far_before")).alias("x"), F.col("y_before").bitwiseXOR(far("y_far_before")).alias("y"),
        (F.col("words_before") + far("words_far_before")).alias("words_before"), F.coalesce("words_far_all", "words_all").alias("words_all"), F.coalesce("n_far_all", "n_all").alias("length"))
    return written(blocks.withColumn("words_left", F.col("words_all") - F.col("words_before")).drop("words_all"), "blocks")


def _rollup(blocks, sums):
    """Nodes of all depths with their ids, their parents' ids and the given aggregates."""
    turn = ", ".join(f"(x{i}, y{i}, w{i})" for i in range(BLOCK))
    nodes = blocks.sparkSession.sql(
        f"SELECT block, x, y, {turn.replace('(', '').replace(')', '')}, CAST({BLOCK} - bit_count(grouping_id()) / 3 AS INT) AS level, {sums} "
        f"FROM {{blocks}} GROUP BY block, x, y, ROLLUP({turn})", blocks=blocks)
    # The root stands once; other blocks start below the node that keys them. Shorter rows have no turn at this level.
    present = sum((F.col(f"x{i}").isNotNull().cast("int") for i in range(BLOCK)), F.lit(0))
    nodes = nodes.filter((F.col("level") == present) & ((F.col("level") > 0) | (F.col("block") == 0)))

    def folded(c):
        out = F.col(c)
        for i in range(BLOCK):
            out = out.bitwiseXOR(F.coalesce(f"{c}{i}", F.lit(0)))
        return out

    last = lambda c: F.coalesce(*[F.col(f"{c}{i}") for i in reversed(range(BLOCK))], F.lit(0))
    keys = {"block", "x", "y", "level"} | {f"{c}{i}" for c in "xyw" for i in range(BLOCK)}
    return nodes.select((F.col("block") * BLOCK + F.col("level")).cast("long").alias("depth"), folded("x").alias("x"), folded("y").alias("y"),
                        folded("x").bitwiseXOR(last("x")).alias("px"), folded("y").bitwiseXOR(last("y")).alias("py"), last("w").alias("words"),
                        (sum((F.coalesce(f"w{i}", F.lit(0)) for i in range(BLOCK)), F.lit(0)) - last("w")).alias("words_here"), *[c for c in nodes.columns if c not in keys])


def _pieces(batches):
    """Sorted ended conversations as pieces: node, first id, and the ids of a stretch joined by commas."""
    for batch in batches:
        node = [batch.column(c).to_numpy() for c in ("depth", "x", "y")]
        ids = batch.column("conv_id").to_pylist()
        new = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in node], 0)])) if len(ids) else np.zeros(0, "int64")
        ends = np.append(new[1:], len(ids))
        cut = [(b, min(b + PIECE, e)) for s, e in zip(new.tolist(), ends.tolist()) for b in range(s, e, PIECE)]
        begin = pa.array([b for b, _ in cut], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(begin) for c in ("depth", "x", "y", "conv_id")), pa.array([",".join(map(str, ids[b:e])) for b, e in cut], pa.string())],
                                         names=["depth", "x", "y", "first", "ids"])


def _hash_pieces(batches):
    """One digest for each node, over its pieces as they come in order."""
    node, digest, first, out = None, None, None, []
    schema = pa.schema([("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("first", pa.int64()), ("sha", pa.string())])
    for batch in batches:
        for *here, start, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "x", "y", "first", "ids"))):
            if here != node:
                if node is not None:
                    out.append((*node, first, digest.hexdigest()))
                node, first, digest = here, start, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)
        out = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, first, digest.hexdigest()), schema)], schema=schema)


def ended(blocks):
    """(depth, x, y, first, sha): of the conversations that end in a node the smallest id, and the digest of all ids in order."""
    last = blocks.filter(F.col("block") * BLOCK + F.col("n") == F.col("length"))
    folded = [F.col(c).bitwiseXOR(F.expr(" ^ ".join(f"coalesce({c}{i}, 0L)" for i in range(BLOCK)))).alias(c) for c in "xy"]
    rows = last.select(F.col("length").alias("depth"), *folded, "conv_id")
    order = ["depth", "x", "y", "conv_id"]
    # Sorted ranges cut a node with very many conversations; its pieces then pass through one task as a stream of text.
    pieces = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "depth long, x long, y long, first long, ids string")
    return pieces.repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "first").mapInArrow(_hash_pieces, "depth long, x long, y long, first long, sha string")


def trie(turns, convs=None):
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: (conv_id, place from 1 without gaps, id, words). convs: all conversations, where some may have no turns. Members are
    the conversations that start with the node's turns; the root has all. saved_tokens is the sum over the node's subtree of
    (members - 1) times words; ends_sha256 digests the ids of the conversations that end here. No conversations, no nodes.
    """
    blocks = _blocks(turns, turns.select("conv_id").distinct() if convs is None else convs)
    nodes = _rollup(blocks, "min(conv_id) AS conv_id, max(length) AS longest, min(words_before) AS words_before")
    nodes = nodes.select("depth", "x", "y", "px", "py", "conv_id", "words", (F.col("words_before") + F.col("words_here")).alias("before"),
                         (F.col("longest") == F.col("depth")).cast("long").alias("leaf"))
    nodes = written(nodes, "nodes")
    # Where each conversation's own nodes begin, what they hold, and the node they hang on.
    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth"), F.sum("words").alias("owned"), F.max("leaf").alias("leaf"),
                                          F.min_by(F.struct("px", "py", "before"), "depth").alias("top"))
    owners = written(owners.select("conv_id", "depth", "owned", "leaf", "top.*"), "owners")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent"))
    hung = written(owners.filter("depth > 0").join(parents, ["depth", "px", "py"]), "hung")
    owners = hung.unionByName(owners.filter("depth = 0"), allowMissingColumns=True).select("conv_id", F.col("depth").alias("from_depth"), "owned", "leaf", F.col("before").alias("from_words"), "parent")
    members = blocks.join(owners, "conv_id", "left")
    full = _rollup(members, "min(conv_id) AS conv_id, count(*) AS n_convs, sum(words_left) AS words_left, sum(owned) AS owned, sum(leaf) AS n_leaves, "
                            "min(from_depth) AS from_depth, min(from_words) AS from_words, min(parent) AS parent, min(words_before) AS words_before")
    branches = hung.groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("branches"))
    notes = ended(blocks).unionByName(branches, allowMissingColumns=True).groupBy("depth", "x", "y").agg(
        F.max("first").alias("first"), F.max("sha").alias("sha"), F.max("branches").alias("branches"))
    full = full.join(written(notes, "notes"), ["depth", "x", "y"], "left")
    before = F.col("words_before") + F.col("words_here")
    # The smallest member's next turn is a child of its own, the others' are the branches that hang here.
    goes_on = F.when(F.col("first") == F.col("conv_id"), 0).otherwise(1)
    return full.select(
        "conv_id", "depth", F.when(F.col("depth") == 0, None).when(F.col("from_depth") < F.col("depth"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", (F.coalesce("branches", F.lit(0)) + goes_on).cast("long").alias("n_children"), "n_leaves",
        (F.col("words_left") - F.col("n_convs") * F.col("words_here") - F.col("owned") + before - F.col("from_words")).alias("saved_tokens"),
        F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"))
