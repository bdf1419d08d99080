"""SimHash fingerprints of whole texts, and all links within two bits by anchor points of a covering code.

The anchors are the words of a product code on the fingerprint's bits: two perfect binary Golay codes
(23 bits, covering radius 3), one perfect Hamming code (15 bits, radius 1), three free bits. In a perfect
code each point lies within the covering radius of exactly one anchor. Two fingerprints at most two bits
apart have a point between them that is at most one bit from either, so both lie within covering radius
plus one of that point's anchor: replicating every fingerprint to all anchors within radius + ceil(threshold / 2),
block by block, makes every linked pair meet, with about 17 copies of 16 bytes for each distinct fingerprint.
"""
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import popcount, slices, written
from textsignal.llm.components import components

# Generator polynomials of the cyclic codes, fixed values: Golay (23, 12) and Hamming (15, 11).
BLOCKS = ((23, 0b101011100011, 3), (23, 0b101011100011, 3), (15, 0b10011, 1))
THRESHOLD = 2
SHINGLE_WORDS = 3
SEED = 42
# Fingerprints compared in one piece; an anchor with more is cut into blocks, and each pair of blocks is a piece.
PIECE = 4096


def _remainder(n, generator):
    """Remainder of each single-bit polynomial: the syndrome of a word is the xor of those of its bits."""
    top = generator.bit_length() - 1
    out, r = [], 1
    for _ in range(n):
        out.append(r)
        r <<= 1
        if r >> top & 1:
            r ^= generator
    return np.array(out, "uint64")


class Code:
    """A perfect cyclic code: for each syndrome, the error to its one anchor within the radius, and all errors of radius + 1 bits."""

    def __init__(self, n, generator, radius):
        self.n, self.bits = n, _remainder(n, generator)
        size = 1 << (generator.bit_length() - 1)
        self.near = np.zeros(size, "uint64")
        beyond = [[] for _ in range(size)]
        for weight in range(radius + 2):
            for places in combinations(range(n), weight):
                syndrome = int(np.bitwise_xor.reduce(self.bits[list(places)])) if places else 0
                error = sum(1 << p for p in places)
                if weight <= radius:
                    self.near[syndrome] = error
                else:
                    beyond[syndrome].append(error)
        width = max(map(len, beyond))
        self.beyond = np.array([b + [0] * (width - len(b)) for b in beyond], "uint64")

    def syndrome(self, words):
        s = np.zeros(len(words), "int64")
        for i, bit in enumerate(self.bits):
            s ^= ((words >> np.uint64(i)) & np.uint64(1)).astype("int64") * int(bit)
        return s


_CODES = {}


def anchors(prints):
    """(row of each copy, anchor of each copy) of uint64 fingerprints."""
    if not _CODES:
        _CODES.update({b: Code(*b) for b in set(BLOCKS)})
    shift, base, extra, mask = 0, np.zeros(len(prints), "uint64"), [], 0
    for block in BLOCKS:
        code = _CODES[block]
        word = (prints >> np.uint64(shift)) & np.uint64((1 << code.n) - 1)
        s = code.syndrome(word)
        base |= (word ^ code.near[s]) << np.uint64(shift)
        extra.append(((word[:, None] ^ code.beyond[s]) << np.uint64(shift), code.beyond[s] != 0, shift, code.n))
        mask |= ((1 << code.n) - 1) << shift
        shift += code.n
    rows, found = [np.arange(len(prints))], [base]
    for words, real, at, n in extra:
        row, col = np.nonzero(real)
        rest = base[row] & np.uint64(mask ^ ((1 << n) - 1) << at)
        rows.append(row)
        found.append(rest | words[row, col])
    return np.concatenate(rows), np.concatenate(found)


def fingerprint(text):
    """64-bit SimHash of one text as a Python integer."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS))))
    total = np.zeros(64, "int64")
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "uint64")
    for part in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[part:part + (1 << 15)].view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        # Counts of 8 rows at a time stay in a byte, summed as 64-bit lanes.
        lanes = bits.view("uint64")
        whole = len(lanes) // 128 * 128
        sums = lanes[:whole].reshape(-1, 128, 8).sum(1).view("uint8").astype("int64").sum(0)
        total += sums + bits[whole:].sum(0, dtype="int64")
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("uint64")[0])


def with_fingerprint(docs, text="text", name="fp"):
    """Add a long column with the fingerprint's bits; null or blank text gives zero. No shuffle."""
    from pyspark.sql import types as T
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType(kept + [T.StructField(name, T.LongType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 2 << 20, text):
                prints = np.array([fingerprint(t) for t in batch.column(text).to_pylist()], "uint64").view("int64")
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(prints)], names=schema.names)
    return docs.mapInArrow(run, schema)


def _copies(batches):
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view("uint64")
        for at in range(0, len(prints), 1 << 15):
            part = prints[at:at + (1 << 15)]
            rows, found = anchors(part)
            yield pa.RecordBatch.from_arrays([pa.array(found.view("int64")), pa.array(part[rows].view("int64"))], names=["anchor", "fp"])


def _linked(prints):
    """Index of the smallest linked member, over chains, for each fingerprint of one piece.

    Links are kept as packed bits, and labels are lowered block by block until nothing changes, so a piece in which
    nearly all are linked takes no more memory than one without links.
    """
    step, n = 256, len(prints)
    near = [np.packbits(popcount(prints[at:at + step, None] ^ prints[None]) <= THRESHOLD, axis=1) for at in range(0, n, step)]
    label = np.arange(n, dtype="int32")
    while True:
        new = np.concatenate([np.where(np.unpackbits(part, axis=1, count=n).view(bool), label[None], np.int32(n)).min(1) for part in near])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(batches):
    """Links of each piece, as a forest: one row per member that is not the smallest of its chain. Rows are sorted by piece."""
    def flush(keys, prints):
        edge = np.flatnonzero(np.any(keys[1:] != keys[:-1], 1)) + 1
        begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(keys)]])
        many = end - begin > 1
        left, right = [np.zeros(0, "uint64")], [np.zeros(0, "uint64")]
        two = begin[many & (end - begin == 2)]
        near = two[popcount(prints[two] ^ prints[two + 1]) <= THRESHOLD]
        left.append(prints[near])
        right.append(prints[near + 1])
        for b, e in zip(begin[end - begin > 2], end[end - begin > 2]):
            part = prints[b:e]
            label = _linked(part)
            moved = label != np.arange(len(part))
            left.append(part[moved])
            right.append(part[label[moved]])
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.RecordBatch.from_arrays([pa.array(a.view("int64")), pa.array(b.view("int64"))], names=["a", "b"])

    keys, prints = np.zeros((0, 3), "int64"), np.zeros(0, "uint64")
    for batch in batches:
        new = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "i", "j")], 1)
        keys = np.concatenate([keys, new])
        prints = np.concatenate([prints, batch.column("fp").to_numpy(zero_copy_only=False).view("uint64")])
        cut = np.flatnonzero(np.any(keys != keys[-1], 1)) if len(keys) else []
        if len(cut):
            at = cut[-1] + 1
            yield flush(keys[:at], prints[:at])
            keys, prints = keys[at:], prints[at:]
    if len(keys):
        yield flush(keys, prints)


def links(prints):
    """Links (a, b) that connect all fingerprints of the column `fp` that lie within two bits of each other, over chains.

    Every distinct fingerprint is sent to its anchors; an anchor with more than PIECE members is cut into
    hashed blocks, and each pair of blocks is compared by itself, so no task holds more than two blocks and
    no comparison is lost.
    """
    nodes = prints.select("fp").distinct()
    copies = written(nodes.mapInArrow(_copies, "anchor long, fp long"), "anchors")
    crowded = (copies.groupBy("anchor").count().filter(F.col("count") > PIECE)
               .select("anchor", F.ceil(F.col("count") * 2 / PIECE).cast("int").alias("blocks")))
    crowded = written(crowded, "crowded")
    rows = copies.join(crowded, "anchor", "left").withColumn("mine", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"))
    # Sequence partners: with more than one block, every other block and the own one by itself.
    partner = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other")
    pieces = rows.select("anchor", "fp", "mine", partner).select(
        "anchor", F.least("mine", "other").cast("long").alias("i"), F.greatest("mine", "other").cast("long").alias("j"), "fp")
    pieces = pieces.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return pieces.mapInArrow(_compare, "a long, b long")


def group(docs, doc_id="doc_id", text="text"):
    """(doc_id, fp, component_id, root) for each row: component_id is the smallest id that can be reached over links of at most two bits.

    Rows with equal fingerprints, copies and blank texts included, are one node. A row with a null id takes
    part and counts last. Repeated rows come out as often as they came in. An empty table gives none.
    """
    prints = written(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("text"), "prints")
    return prints.join(labels(prints), "fp", "left").select("doc_id", "fp", "component_id", "root")


def labels(prints):
    """(fp, root, component_id) for each distinct fingerprint of (doc_id, fp)."""
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    roots = written(components(links(first)).select(F.col("node").alias("fp"), "root"), "roots")
    named = first.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = written(named.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    return written(named.select("fp", "root").join(smallest, "root"), "labels")


def one_of_each(docs):
    """The rows of documents with one row of each group of near copies: the one with the smallest id."""
    marked = with_fingerprint(docs, name="_fp")
    prints = written(marked.select("doc_id", F.col("_fp").alias("fp")), "prints")
    groups = labels(prints).select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("component_id").alias("_first"))
    kept = marked.join(groups, "_fp", "left").filter(F.col("doc_id").eqNullSafe(F.col("_first")))
    return kept.dropDuplicates(["_root"]).select(*docs.columns)
