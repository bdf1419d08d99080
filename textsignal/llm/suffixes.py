"""Repeated 200-byte windows over all documents, by digit passes over suffixes that go no deeper than a window.

Of the suffixes, only those at anchors are sorted: the anchor of a window is the position of its smallest
hashed K-gram, so equal windows have equal anchors at equal offsets, and an anchor stands for the run of windows
that share it (about 85). The passes take ever more bytes around an anchor, most significant digit first, and keep
only groups that can still hold equal windows: (1) the K-gram, (2) the whole run of windows, whose copies are
settled at once, (3) single windows, where runs with the same K-gram differ; only one run of each kind is
opened for that. The groups left are exactly the
repeated windows. Digits are hashes; the last two passes compare 128 bits.
"""
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import RangeHash, byte_codes, mix, ragged, slices, string_buffer, written

WINDOW = 200
GRAM = 32
SLICE_BYTES = 1 << 20
# Runs of one K-gram that a task compares; a K-gram with more different runs is counted window by window in Spark.
CROWD = 20_000
PIECE_RUNS = 1_000
CODES = (byte_codes(1), byte_codes(2))


def runs(data, offsets, window=WINDOW, gram=GRAM):
    """Runs of windows with one anchor: (document, anchor, first start, last start) as positions in `data`, and its hash object."""
    hashed = RangeHash(CODES[0][data])
    span = window - gram + 1
    n = len(data) - gram + 1
    none = np.zeros(0, "int64")
    if n < span:
        return none, none, none, none, hashed
    at = np.arange(n)
    # The smallest hash in a span, ties to the left: the position fills the low bits. Minima of spans come
    # from running minima inside blocks, forwards and backwards.
    packed = (hashed.of(at, at + gram) & ~np.uint64(0xFFFFFFFF)) | at.astype("uint64")
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.iinfo("uint64").max, "uint64")
    padded[:n] = packed
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    lowest = np.minimum(back[:n - span + 1], ahead[span - 1:n])
    starts = ragged(offsets[:-1], np.maximum(np.diff(offsets) - window + 1, 0))
    if not len(starts):
        return none, none, none, none, hashed
    chosen = (lowest[starts] & np.uint64(0xFFFFFFFF)).astype("int64")
    edge = np.flatnonzero((chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first, last = starts[np.concatenate([[0], edge])], starts[np.concatenate([edge, [len(starts)]]) - 1]
    return np.searchsorted(offsets, first, "right") - 1, chosen[np.concatenate([[0], edge])], first, last, hashed


def _anchor_rows(batches):
    for whole in batches:
        for batch in slices(whole, SLICE_BYTES):
            data, offsets = string_buffer(batch.column("text"))
            doc, anchor, first, last, hashed = runs(data, offsets)
            key = batch.column("key").to_numpy(zero_copy_only=False)
            where = mix((anchor - first).astype("uint64") << np.uint64(32) | (last - first).astype("uint64"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                key[doc], (first - offsets[doc]).astype("int32"), (last - first).astype("int32"),
                hashed.of(anchor, anchor + GRAM).view("int64"), (hashed.of(first, last + WINDOW) ^ where).view("int64"))],
                names=["key", "first", "more", "gram", "run"])


ANCHORS = "key long, first int, more int, gram long, run long"


def _pack(batches):
    import zstandard
    packer = zstandard.ZstdCompressor(level=3)
    for whole in batches:
        for batch in slices(whole, SLICE_BYTES):
            packed = [packer.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(f) for f in batch.schema.names if f != "text"] + [pa.array(packed, pa.binary())],
                                             names=[f for f in batch.schema.names if f != "text"] + ["packed"])


def _unpacked(value):
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), "uint8")


def _open_runs(batches):
    """The bytes of each run that is still open."""
    for batch in batches:
        for k, packed, found in zip(batch.column("key").to_pylist(), batch.column("packed"), batch.column("found").to_pylist()):
            data = _unpacked(packed.as_py()).tobytes()
            names = ("gram", "crowded", "first", "more", "n")
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(found), pa.int64()), *(pa.array([r[c] for r in found], t) for c, t in zip(names, (pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64()))),
                 pa.array([data[r["first"]:r["first"] + r["more"] + WINDOW] for r in found], pa.binary())], names=["key", *names, "bytes"])


RUNS = "key long, gram long, crowded boolean, first int, more int, n long, bytes binary"


def _hashes(batch):
    """Of every window in the runs of a batch: run, offset in the run, both hashes. Hashed piece by piece, since that takes many times the bytes."""
    parts = [(np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, "uint64"), np.zeros(0, "uint64"))]
    for at in range(0, batch.num_rows, PIECE_RUNS):
        piece = batch.slice(at, PIECE_RUNS)
        data, offsets = string_buffer(piece.column("bytes"))
        more = piece.column("more").to_numpy(zero_copy_only=False).astype("int64")
        start = ragged(offsets[:-1], more + 1)
        run = np.repeat(np.arange(len(more)), more + 1)
        parts.append((run + at, start - offsets[run], *(RangeHash(codes[data]).of(start, start + WINDOW) for codes in CODES)))
    return [np.concatenate(p) for p in zip(*parts)]


def _settle(batches):
    """Ranges of repeated windows among runs that are sorted by K-gram; only whole groups are compared."""
    def settled(batch):
        run, offset, h1, h2 = _hashes(batch)
        n, first, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "first", "key"))
        order = np.lexsort((h2, h1))
        new = np.flatnonzero(np.concatenate([[True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])]))
        total = np.repeat(np.add.reduceat(n[run[order]], new), np.diff(np.append(new, len(order))))
        twice = np.zeros(len(order), bool)
        twice[order] = total > 1
        at = np.flatnonzero(twice & (n[run] == 1))
        begin = at[np.concatenate([[True], (run[at][1:] != run[at][:-1]) | (at[1:] != at[:-1] + 1)])] if len(at) else at
        end = at[np.concatenate([(run[at][1:] != run[at][:-1]) | (at[1:] != at[:-1] + 1), [True]])] if len(at) else at
        place = lambda x: (first[run[x]] + offset[x]).astype("int32")
        return pa.RecordBatch.from_arrays([pa.array(key[run[begin]]), pa.array(place(begin)), pa.array(place(end) + np.int32(WINDOW))], names=["key", "begin", "end"])

    held = None
    for batch in batches:
        held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        gram = held.column("gram").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(gram != gram[-1]) if len(gram) else []
        if len(cut):
            yield settled(held.slice(0, cut[-1] + 1))
            held = held.slice(cut[-1] + 1)
    if held is not None and held.num_rows:
        yield settled(held)


def _windows(batches):
    """Both hashes of every window of the given runs, as rows."""
    for batch in batches:
        run, offset, h1, h2 = _hashes(batch)
        key, first, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "first", "n"))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[run], (first[run] + offset).astype("int32"), n[run], h1.view("int64"), h2.view("int64"))],
                                         names=["key", "start", "n", "h1", "h2"])


def merge(begin, end):
    """Maximal runs of covered bytes, from ranges in any order."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]])) if len(begin) else np.zeros(0, "int64")
    return begin[new], end[np.concatenate([new[1:] - 1, [len(end) - 1]])] if len(begin) else end


def _cut(batches):
    for batch in batches:
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for packed, ranges in zip(batch.column("packed"), batch.column("ranges").to_pylist()):
            data = _unpacked(packed.as_py())
            begin, end = merge(*(np.array([r[c] for r in ranges or []], "int64") for c in ("begin", "end")))
            keep = np.ones(len(data), bool)
            for b, e in zip(begin, end):
                keep[b:e] = False
            kept = data[keep]
            for name, value in zip(out, (len(data), len(data) - len(kept), len(begin), hashlib.sha256(kept.tobytes()).hexdigest())):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.string() if c == "kept_sha256" else pa.int64()) for c, v in out.items())],
                                         names=["doc_id", *out])


def keyed(docs):
    """Rows with a 64-bit key of id and text, so that ids may be null or repeat; equal rows share it and their result."""
    return docs.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))).alias("key"), "doc_id", "text")


def repeated_ranges(docs):
    """(key, begin, end): byte ranges of `keyed` documents whose windows all occur a second time somewhere.

    Passes join written tables on a digit, so that a digit shared by a third of all documents can be split.
    """
    long_enough = docs.filter(F.octet_length("text") >= WINDOW)
    rows = long_enough.select("key", "text").mapInArrow(_anchor_rows, ANCHORS)
    grams = written(rows.groupBy("gram").count().filter("count > 1").select("gram"), "grams")
    shared = written(rows.join(grams, "gram", "left_semi").select("key", "first", "more", "gram", "run"), "shared")
    groups = shared.groupBy("gram", "run").agg(F.count("*").alias("n"), F.min(F.struct("key", "first", "more")).alias("at"))
    groups = written(groups, "groups")
    copied = shared.join(groups.filter("n > 1").select("gram", "run"), ["gram", "run"], "left_semi")
    whole = copied.select("key", F.col("first").alias("begin"), (F.col("first") + F.col("more") + WINDOW).alias("end"))
    # Runs that share the K-gram but not all bytes: one of each kind is opened. Equal rows of documents share a key
    # and are read once; they already count in n.
    mixed = groups.groupBy("gram").count().filter("count > 1").select("gram", (F.col("count") > CROWD).alias("crowded"))
    unsettled = groups.join(written(mixed, "mixed"), "gram").select("at.key", F.struct("gram", "crowded", "at.first", "at.more", "n").alias("one"))
    wanted = unsettled.groupBy("key").agg(F.collect_list("one").alias("found"))
    texts = docs.mapInArrow(_pack, "key long, doc_id long, packed binary").select("key", "packed")
    once = texts.join(wanted, "key").dropDuplicates(["key"])
    opened = written(once.select("key", "packed", "found").mapInArrow(_open_runs, RUNS), "opened")
    few = opened.filter("not crowded").repartition("gram").sortWithinPartitions("gram").mapInArrow(_settle, "key long, begin int, end int")
    windows = written(opened.filter("crowded").mapInArrow(_windows, "key long, start int, n long, h1 long, h2 long"), "windows")
    twice = written(windows.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2"), "twice")
    many = windows.filter("n = 1").join(twice, ["h1", "h2"], "left_semi").select("key", F.col("start").alias("begin"), (F.col("start") + WINDOW).alias("end"))
    return whole.union(few).union(many)


def cut_repeats(docs):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row: bytes covered by a window that starts anywhere else go.

    Null and short texts lose nothing. Repeated rows repeat each other, so both lose all their windows. An empty table gives none.
    """
    docs = keyed(docs)
    ranges = written(repeated_ranges(docs), "ranges")
    each = ranges.groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    texts = docs.mapInArrow(_pack, "key long, doc_id long, packed binary")
    return texts.join(each, "key", "left").select("doc_id", "packed", "ranges").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
