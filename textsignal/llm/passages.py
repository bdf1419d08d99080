"""Passages that repeat word for word, by seed and extend.

Every window of MIN_WORDS words has an anchor: its seed (a sequence of half as many words) with the smallest hash, so
equal windows have equal anchors at equal places. Documents are joined on these winnowed anchors. An occurrence of a
seed stands for the run of windows that it anchors; occurrences with the same run are one class, settled at once. Where
a seed has several classes, each is extended to the left and to the right, word by word, against the seed's leader
(its occurrence in the smallest document): the match found is a maximal repeat, and the windows inside it are settled.
What the leader does not share goes on with longer seeds (the words that a few neighbouring windows have in common) and
their own leaders, and at last with whole windows. So an occurrence meets one leader a round, never all others.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import RangeHash, byte_codes, mix, ragged, slices, string_buffer, written
from textsignal.llm.suffixes import _pack, _unpacked

MIN_WORDS = 50
SLICE_BYTES = 1 << 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
CODES = byte_codes(3)
LAST = 2 ** 63 - 1


class Shape:
    """Seed length and widths of the rounds for one window length. An offset is the place of the seed in a window."""

    def __init__(self, window):
        if window < 2:
            raise ValueError("a window has two words at least")
        # Offsets are bits of a long, so a seed is at most 60 words shorter than the window.
        self.window, self.seed = window, max(window // 2, window - 60)
        self.span = window - self.seed
        side = int(np.ceil(np.sqrt(self.span + 1)))
        self.children = [(o, min(o + side - 1, self.span)) for o in range(0, self.span + 1, side)]
        self.width = self.span + window
        self.coefficients = np.random.default_rng(4).integers(1, 2 ** 64 - 1, self.width, dtype="uint64") | np.uint64(1)

    def core(self, low, high):
        """Places in a context of the words that the windows with offsets low to high have in common."""
        return slice(self.span - low, self.span - high + self.window)

    def hash(self, contexts, low, high):
        part = contexts[:, self.core(low, high)]
        return mix((part * self.coefficients[:part.shape[1]]).sum(1, dtype="uint64")).view("int64")


def bits(low, high):
    """Masks with the bits low to high; none where high < low."""
    one = np.int64(1)
    low, high = np.asarray(low, "int64"), np.asarray(high, "int64")
    return np.where(high < low, 0, (one << np.maximum(high + 1, 0)) - (one << low))


def word_bounds(data, offsets):
    """First and last byte (exclusive) of each word, and the first word of each text."""
    solid = ~BLANK[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edge] = solid[edge]
    closes[edge - 1] = solid[edge - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data, starts, ends):
    """A 64-bit hash of each word, never zero; in pieces, since hashing takes many times the bytes."""
    out = np.zeros(len(starts), "uint64")
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE_BYTES)))
        begin = starts[at]
        out[at:to] = RangeHash(CODES[data[begin:ends[to - 1]]]).of(starts[at:to] - begin, ends[at:to] - begin)
        at = to
    out[out == 0] = 1
    return out


def runs(words, first, shape):
    """Occurrences of winnowed seeds: (text, seed's word, first and last window that it anchors), words counted over all texts, and the hash object."""
    hashed = RangeHash(words)
    n, width = len(words) - shape.seed + 1, shape.span + 1
    starts = ragged(first[:-1], np.maximum(np.diff(first) - shape.window + 1, 0))
    if not len(starts):
        return *[np.zeros(0, "int64")] * 4, hashed
    at = np.arange(n)
    values = hashed.of(at, at + shape.seed)
    # Smallest value of each window, the leftmost of equal ones: minima from the blocks' ends, then the first place that has it.
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo("uint64").max, "uint64")
    padded[:n] = values & ~np.uint64(0xFFFFFFFF) | at.astype("uint64")
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    anchor = (np.minimum(back[starts], ahead[starts + width - 1]) & np.uint64(0xFFFFFFFF)).astype("int64")
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)])
    begin, end = starts[new], starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    return np.searchsorted(first, begin, "right") - 1, anchor[new], begin, end, hashed


SEEDS = "key binary, doc long, place int, low int, high int, seed long, run long"


def _seeds(shape):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, SLICE_BYTES):
                data, offsets = string_buffer(batch.column("text"))
                starts, ends, first = word_bounds(data, offsets)
                text, anchor, begin, end, hashed = runs(word_hashes(data, starts, ends), first, shape)
                low, high = anchor - end, anchor - begin
                where = mix((low << 32 | high).astype("uint64"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(text)), batch.column("doc").take(pa.array(text)), *(pa.array(x) for x in (
                        (anchor - first[text]).astype("int32"), low.astype("int32"), high.astype("int32"),
                        hashed.of(anchor, anchor + shape.seed).view("int64"), (hashed.of(begin, end + shape.window) ^ where).view("int64")))],
                    names=["key", "doc", "place", "low", "high", "seed", "run"])
    return run


ITEMS = "seed long, run long, doc long, low int, hash long, open long, context binary"


def _contexts(shape):
    """The hashed words around each open seed: as many as the windows reach, zero beyond the text."""
    def run(batches):
        for batch in batches:
            for packed, found in zip(batch.column("packed"), batch.column("found").to_pylist()):
                data = _unpacked(packed.as_py())
                starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
                words = np.concatenate([np.zeros(shape.span, "uint64"), word_hashes(data, starts, ends), np.zeros(shape.span, "uint64")])
                place, low, high = (np.array([f[c] for f in found], "int64") for c in ("place", "low", "high"))
                near = words[place[:, None] + np.arange(shape.width)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([f[c] for f in found], pa.int64()) for c in ("seed", "run", "doc")), pa.array(np.zeros(len(found), "int32")), pa.array(np.zeros(len(found), "int64")),
                     pa.array(bits(low, high)), pa.array([c.tobytes() for c in near], pa.binary())], names=["seed", "run", "doc", "low", "hash", "open", "context"])
    return run


STEPS = "seed long, run long, doc long, low int, hash long, open long, context binary, found boolean"


def _extend(shape, intervals, children, keep):
    """One round: each item against its leader. Gives the windows found to repeat a smaller document, and items with longer seeds for the rest."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            seed, run_, doc, low, open_, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "run", "doc", "low", "open", "first"))
            mine, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "uint64").reshape(-1, shape.width) for c in ("context", "leader"))
            same = (mine == other) & (mine != 0)
            settled = np.zeros(len(seed), "int64")
            for start, end in intervals:
                here = np.flatnonzero(low == start)
                core = shape.core(start, end)
                more = end - start
                left = np.cumprod(same[here, core.start - more:core.start][:, ::-1], 1).sum(1)
                right = np.cumprod(same[here, core.stop:core.stop + more], 1).sum(1)
                settled[here] = open_[here] & bits(np.maximum(end - right, start), np.minimum(start + left, end))
            out = [(seed, run_, doc, low, np.zeros(len(seed), "int64"), np.where(first < doc, settled, 0), None)]
            rest = open_ & ~settled
            for start, end in children:
                part = rest & bits(start, end)
                here = np.flatnonzero(part)
                out.append((seed[here], run_[here], doc[here], np.full(len(here), start, "int32"), shape.hash(mine[here], start, end), part[here],
                            mine[here] if keep else None))
            for i, (s, r, d, o, h, m, c) in enumerate(out):
                use = m != 0
                packed = pa.nulls(int(use.sum()), pa.binary()) if c is None else pa.array([x.tobytes() for x in c[use]], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(s[use]), pa.array(r[use]), pa.array(d[use]), pa.array(o[use]), pa.array(h[use]), pa.array(m[use]), packed,
                                                  pa.array(np.full(int(use.sum()), i == 0))], names=["seed", "run", "doc", "low", "hash", "open", "context", "found"])
    return run


def _round(items, shape, intervals, children, keep, name):
    """(found, rest) of items against their leaders. Items whose seed stands in one document only fall out: nothing repeats there."""
    group = ["seed", "low", "hash"]
    leaders = items.groupBy(*group).agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min_by("context", F.struct("doc", "run")).alias("leader"))
    leaders = written(leaders.filter("first < last").drop("last"), f"{name}-leaders")
    steps = written(items.join(leaders, group).mapInArrow(_extend(shape, intervals, children, keep), STEPS), name)
    return steps.filter("found").select("seed", "run", "open"), steps.filter("not found").drop("found")


def keyed(docs, doc_id="doc_id", text="text"):
    """(key, doc, text): key is a 128-bit digest of id and text, so that ids may be null or repeat; rows without an id come after all others."""
    return docs.select(F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(" "), F.coalesce(text, F.lit(""))))).alias("key"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def repeated_windows(docs, min_words=MIN_WORDS):
    """(key, place, offsets) of `keyed` documents: windows that also stand in a document with a smaller id, as bits `place - start`."""
    shape = Shape(min_words)
    seeds = docs.filter(F.octet_length("text") >= 2 * min_words - 1).select("key", "doc", "text").mapInArrow(_seeds(shape), SEEDS)
    # Only seeds of more than one document go on.
    wide = seeds.groupBy("seed").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").select("seed")
    shared = written(seeds.join(written(wide, "seeds"), "seed", "left_semi"), "shared")
    classes = shared.groupBy("seed", "run").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min(F.struct("doc", "key", "place", "low", "high")).alias("one"))
    classes = written(classes, "classes")
    # Seeds with several classes: one occurrence of each class is opened and extended.
    mixed = classes.groupBy("seed").agg(F.min("first").alias("a"), F.max("first").alias("b")).filter("a < b").select("seed")
    opened = classes.join(written(mixed, "mixed"), "seed", "left_semi")
    wanted = opened.groupBy("one.key").agg(F.collect_list(F.struct("seed", "run", "one.doc", "one.place", "one.low", "one.high")).alias("found"))
    texts = docs.select("key", "text").mapInArrow(_pack, "key binary, packed binary")
    once = texts.join(written(wanted, "wanted"), "key").dropDuplicates(["key"])
    items = written(once.select("packed", "found").mapInArrow(_contexts(shape), ITEMS), "contexts")
    found, rest = _round(items, shape, [(0, shape.span)], shape.children, True, "extended")
    singles = [(o, o) for o in range(shape.span + 1)]
    again, rest = _round(rest, shape, shape.children, singles, False, "further")
    ends = rest.groupBy("seed", "low", "hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    last = rest.join(written(ends.drop("last"), "ends"), ["seed", "low", "hash"]).filter("doc > first").select("seed", "run", "open")
    verdicts = found.union(again).union(last).groupBy("seed", "run").agg(F.expr("bit_or(open)").alias("offsets"))
    # The whole run goes where the class began in a smaller document, else what its first occurrence was found to repeat.
    ruled = classes.join(written(verdicts, "verdicts"), ["seed", "run"], "left").filter("first < last or offsets is not null").select("seed", "run", "first", "offsets")
    whole = F.expr("shiftleft(1L, high + 1) - shiftleft(1L, low)")
    marks = shared.join(written(ruled, "ruled"), ["seed", "run"]).select("key", "place", F.when(F.col("doc") > F.col("first"), whole).otherwise(F.col("offsets")).alias("offsets"))
    return marks.filter("offsets is not null")


KEPT = "doc_id long, n_words long, n_removed long, repeats array<struct<begin:int,end:int>>, kept string"


def _keep(window):
    def cut(packed, marks):
        data = _unpacked(packed)
        starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
        level = np.zeros(len(starts) + 1, "int64")
        if marks:
            place, offsets = (np.array([m[c] for m in marks], "int64") for c in ("place", "offsets"))
            which, offset = np.nonzero(offsets[:, None] >> np.arange(62) & 1)
            np.add.at(level, place[which] - offset, 1)
            np.add.at(level, place[which] - offset + window, -1)
        gone = np.cumsum(level)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype("int8")))
        size = (ends - starts)[~gone] + 1
        kept = np.append(data, np.uint8(0x20))[ragged(starts[~gone], size)]
        kept[np.cumsum(size) - 1] = 0x20
        return len(starts), int(gone.sum()), [{"begin": b, "end": e} for b, e in zip(edge[::2].tolist(), edge[1::2].tolist())], kept[:-1].tobytes()

    def rows(doc_ids, out):
        n_words, n_removed, repeats, kept = zip(*out)
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(repeats, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "repeats", "kept"])

    def run(batches):
        for batch in batches:
            out, size, begin = [], 0, 0
            for at, (packed, marks) in enumerate(zip(batch.column("packed"), batch.column("marks"))):
                out.append(cut(packed.as_py(), marks.as_py()))
                size += len(out[-1][3])
                if size > SLICE_BYTES or at == batch.num_rows - 1:
                    yield rows(batch.column("doc_id").slice(begin, len(out)), out)
                    out, size, begin = [], 0, at + 1
    return run


def cut_passages(docs, doc_id="doc_id", text="text", min_words=MIN_WORDS):
    """(doc_id, n_words, n_removed, repeats, kept) of each row: words of passages that stand in a row with a smaller id go.

    Words are what lies between blanks, tabs and line ends. A passage is a run of at least `min_words` words; `repeats` holds
    the removed runs as word positions, end exclusive, and `kept` the other words joined by one space. Null and empty texts have
    no words. Rows with equal ids do not cut each other, rows without an id count as later than all others and do not cut each
    other either. Other columns are not read. An empty table gives none.
    """
    docs = keyed(docs, doc_id, text)
    marks = repeated_windows(docs, min_words)
    each = written(marks.groupBy("key").agg(F.collect_set(F.struct("place", "offsets")).alias("marks")), "marks")
    texts = docs.select("key", "doc_id", "text").mapInArrow(_pack, "key binary, doc_id long, packed binary")
    return texts.join(each, "key", "left").select("doc_id", "packed", "marks").mapInArrow(_keep(min_words), KEPT)
