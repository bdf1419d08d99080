"""Benchmark passages in documents: SimHash of item-sized windows finds candidates, weighted shingles decide.

Each item is given the largest window size of a fixed ladder that it can fill, and a fingerprint for every window
of that size in it. Every window of that size in every document is fingerprinted too. A fingerprint is cut into
RADIUS + 1 blocks: two that differ in at most RADIUS bits agree on one block, so looking each block up finds all of
them. A candidate's words are then laid over the item's, and shared five-word shingles, weighted by their letters,
give the similarity.

An edited word flips more than RADIUS bits of most windows that hold it, so five-word windows are looked up as well:
the rarest of an item's that together weigh more than 1 - SIMILARITY of it. A text that is similar enough holds one
of them unchanged, wherever the edits are, and all places around it are weighed.
"""
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import RangeHash, byte_codes, popcount, ragged, slices

RADIUS = 3
SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Similarities are rounded to six digits, so bounds on them have this to spare.
SLACK = 1e-6
# Bits of the table that is asked first whether a five-word window can be a seed.
SEEN_BITS = 20
# Items held by a task at a time; a larger benchmark takes several passes over the row.
ITEM_BLOCK = 20_000
SLICE_BYTES = 128 << 10
CODES = byte_codes(4)
# Window sizes in words: each about a sixth more than the one before; counts stay below 128 in a byte.
SIZES = sorted({int(round(1.17 ** i)) for i in range(1, 31)} | set(range(1, 9)))
# Letters and digits of ASCII, and all other characters' bytes, make words.
IS_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
# A byte's bits as eight counters in one 64-bit lane.
SPREAD = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], "uint64")


class Words:
    """The words of some texts, lower-cased: hashes, sizes, and the range of each text."""

    def __init__(self, texts):
        data = [(t or "").lower().encode() for t in texts]
        flat = np.frombuffer(b" ".join(data) + b" ", "uint8")
        inside = IS_WORD[flat]
        turn = np.flatnonzero(np.diff(inside, prepend=False))
        begin, end = turn[::2], turn[1::2]
        self.hash = RangeHash(CODES[flat]).of(begin, end)
        self.size = end - begin
        edge = np.cumsum([0] + [len(d) + 1 for d in data])
        self.first = np.searchsorted(begin, edge)
        self.sums = np.zeros((len(begin) + 1, 8), "uint64")
        np.cumsum(SPREAD[self.hash.view("uint8").reshape(-1, 8)], 0, out=self.sums[1:])

    def prints(self, width):
        """Fingerprint of `width` words from every word on; windows may run over the end of a text."""
        counts = self.sums[width:] - self.sums[:-width]
        counts += np.uint64(0x0101010101010101 * (127 - width // 2))
        counts &= np.uint64(0x8080808080808080)
        counts >>= np.arange(7, -1, -1, dtype="uint64")
        return np.bitwise_or.reduce(counts, 1)

    def starts(self, width):
        """First words of the windows that lie in one text, and the text of each."""
        room = np.maximum(np.diff(self.first) - width + 1, 0)
        return ragged(self.first[:-1], room), np.repeat(np.arange(len(room)), room)

    def weights(self):
        """Letters of the five-word window from every word on."""
        sums = np.concatenate([[0], np.cumsum(self.size)])
        return sums[SHINGLE_WORDS:] - sums[:-SHINGLE_WORDS]


def shingles(hashes, sizes):
    """Weighted multiset of five-word shingles as a dict; shorter sequences are one shingle."""
    k = max(1, min(SHINGLE_WORDS, len(hashes)))
    out = Counter()
    for i in range(len(hashes) - k + 1):
        out[hashes[i:i + k].tobytes()] += int(sizes[i:i + k].sum())
    return out


class Items:
    """Benchmark items with their window fingerprints, indexed by blocks."""

    def __init__(self, ids, texts):
        self.ids, self.words = list(ids), Words(texts)
        length = np.diff(self.words.first)
        fit = np.searchsorted(SIZES, length, "right") - 1
        self.index, self.shingles = {}, {}
        block = 64 // (RADIUS + 1)
        for f in np.unique(fit[fit >= 0]):
            width = SIZES[f]
            start, item = self.words.starts(width)
            mine = fit[item] == f
            start, item = start[mine], item[mine]
            prints = self.words.prints(width)[start]
            parts = prints[:, None] >> np.arange(0, 64, block, dtype="uint64") & np.uint64((1 << block) - 1)
            seen = np.zeros((RADIUS + 1, 1 << block), bool)
            for b in range(RADIUS + 1):
                seen[b, parts[:, b]] = True
            order = [np.argsort(parts[:, b], kind="stable") for b in range(RADIUS + 1)]
            self.index[width] = (prints, item, start - self.words.first[item], parts, seen, order)
        self._seed()

    def _seed(self):
        """Seeds: of each item's five-word windows the rarest, until what is left weighs too little for SIMILARITY."""
        start, item = self.words.starts(SHINGLE_WORDS)
        self.short = self.words.prints(SHINGLE_WORDS)
        prints, weight = self.short[start], self.words.weights()[start]
        self.weight = np.bincount(item, weight, len(self.ids))
        _, which, often = np.unique(prints, return_inverse=True, return_counts=True)
        order = np.lexsort((prints, often[which], item))
        prints, weight, item = prints[order], weight[order], item[order]
        before = np.cumsum(weight) - weight
        before -= before[np.searchsorted(item, item)]
        chosen = before <= (1 - SIMILARITY + 10 * SLACK) * self.weight[item]
        prints, item = prints[chosen], item[chosen]
        order = np.lexsort((item, prints))
        prints, item = prints[order], item[order]
        new = np.ones(len(prints), bool)
        new[1:] = (prints[1:] != prints[:-1]) | (item[1:] != item[:-1])
        self.seeds, self.seed_item = prints[new], item[new]
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[self.seeds & np.uint64((1 << SEEN_BITS) - 1)] = True

    def seeded(self, prints):
        """(window, item) of the five-word windows that are a seed of an item."""
        hit = np.flatnonzero(self.seen[prints & np.uint64((1 << SEEN_BITS) - 1)])
        low, high = np.searchsorted(self.seeds, prints[hit], "left"), np.searchsorted(self.seeds, prints[hit], "right")
        return np.repeat(hit, high - low), self.seed_item[ragged(low, high - low)]

    def candidates(self, prints, width):
        """(window, item, offset of the window in the item) within RADIUS bits."""
        mine, item, offset, parts, seen, order = self.index[width]
        block = 64 // (RADIUS + 1)
        found = []
        for b in range(RADIUS + 1):
            part = (prints >> np.uint64(b * block) & np.uint64((1 << block) - 1)).astype("int64")
            hit = np.flatnonzero(seen[b][part])
            values = parts[order[b], b]
            low, high = np.searchsorted(values, part[hit], "left"), np.searchsorted(values, part[hit], "right")
            window, partner = np.repeat(hit, high - low), order[b][ragged(low, high - low)]
            near = popcount(prints[window] ^ mine[partner]) <= RADIUS
            found.append(np.stack([window[near], item[partner[near]], offset[partner[near]]]))
        return np.unique(np.concatenate(found, 1), axis=1)

    def similarity(self, item, hashes, sizes):
        if item not in self.shingles:
            a, b = self.words.first[item:item + 2]
            self.shingles[item] = shingles(self.words.hash[a:b], self.words.size[a:b])
        one, two = self.shingles[item], shingles(hashes, sizes)
        both = sum((one & two).values())
        return both / (sum(one.values()) + sum(two.values()) - both)


def _seeded_runs(items, words):
    """(item, text, first begin, last begin): all begins at which a place as long as the item holds one of its seeds."""
    start, text = words.starts(SHINGLE_WORDS)
    if not len(start):
        return
    short = words.prints(SHINGLE_WORDS)
    window, item = items.seeded(short[start])
    at, text = start[window], text[window]
    reach = np.diff(items.words.first)[item] - SHINGLE_WORDS
    order = np.lexsort((at, text, item))
    at, text, item, reach = at[order], text[order], item[order], reach[order]
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (at[1:] - at[:-1] > reach[1:] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))
    first = np.maximum(at - reach, words.first[text])
    for a, b in zip(begin.tolist(), end.tolist()):
        yield int(item[a]), int(text[a]), int(first[a]), int(at[b - 1])


def _bounds(items, words, short, sums, i, first, last, high):
    """No place as long as item i that begins at first to last is more similar to it than this."""
    length = items.words.first[i + 1] - items.words.first[i]
    stop = min(last + length, high) - SHINGLE_WORDS + 1
    a, b = items.words.first[i:i + 2]
    shared = np.isin(short[first:stop], items.short[a:b - SHINGLE_WORDS + 1]) * (sums[first + 1:stop + 1] - sums[first:stop])
    shared = np.concatenate([[0], np.cumsum(shared)])
    begin = np.arange(first, last + 1)
    end = np.minimum(begin + length, high) - SHINGLE_WORDS + 1
    both = np.minimum(shared[end - first] - shared[begin - first], items.weight[i])
    return both / (items.weight[i] + sums[end] - sums[begin] - both)


def _leaks(items, texts):
    """For each text, {item id: (similarity, first word, end word)} of the best place of each item found in it."""
    words = Words(texts)
    best = [{} for _ in texts]
    tried = set()
    for width in items.index:
        start, text = words.starts(width)
        if not len(start):
            continue
        window, item, offset = items.candidates(words.prints(width)[start], width)
        for w, i, o in zip(window.tolist(), item.tolist(), offset.tolist()):
            t = text[w]
            low, high = words.first[t], words.first[t + 1]
            begin = max(int(start[w]) - o, low)
            end = min(begin + int(items.words.first[i + 1] - items.words.first[i]), high)
            if (i, begin) in tried:
                continue
            tried.add((i, begin))
            value = round(items.similarity(i, words.hash[begin:end], words.size[begin:end]), 6)
            if value >= SIMILARITY:
                place = (value, -int(begin - low), int(end - low))
                best[t][items.ids[i]] = max(best[t].get(items.ids[i], place), place)
    short, sums = words.prints(SHINGLE_WORDS), np.concatenate([[0], np.cumsum(words.weights())])
    for i, t, first, last in _seeded_runs(items, words):
        low, high = words.first[t], words.first[t + 1]
        length = int(items.words.first[i + 1] - items.words.first[i])
        bound = _bounds(items, words, short, sums, i, first, last, high)
        for at in np.argsort(-bound, kind="stable").tolist():
            begin, end = first + at, min(first + at + length, int(high))
            value, back, _ = best[t].get(items.ids[i], (SIMILARITY, -len(words.hash), 0))
            top = round(float(bound[at]), 6)
            if top < value:
                break
            if (i, begin) in tried or top == value and low - begin < back:
                continue
            tried.add((i, begin))
            value = round(items.similarity(i, words.hash[begin:end], words.size[begin:end]), 6)
            if value >= SIMILARITY:
                place = (value, -int(begin - low), int(end - low))
                best[t][items.ids[i]] = max(best[t].get(items.ids[i], place), place)
    return [[{"item_id": k, "similarity": v, "first_word": -b, "end_word": e} for k, (v, b, e) in sorted(found.items())] for found in best]


LEAKS = "array<struct<item_id:long,similarity:double,first_word:int,end_word:int>>"


def _mark(docs, items, text, name):
    from pyspark.sql import types as T
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType(kept + [T.StructField(name, T._parse_datatype_string(LEAKS))])
    inner = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, SLICE_BYTES, text):
                found = _leaks(items, batch.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(found, inner)], names=schema.names)
    return docs.mapInArrow(run, schema)


def mark(docs, benchmark, text="text", name="leaks"):
    """Add the benchmark items that each text holds: (item_id, similarity, first_word, end_word), words counted in the text.

    Items travel to the tasks in blocks of ITEM_BLOCK, one pass in the row for each block, so documents never move.
    Items without an id or a word, and texts without a word, match nothing; null text counts as empty. Equal items
    are each reported.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    # Each pass makes a column of its own; they are joined at the end.
    passes = [f"_{name}_{b}" for b in range(blocks)]
    for b, column in enumerate(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toPandas().sort_values(["item_id", "text"])
        docs = _mark(docs, Items(part.item_id.tolist(), part.text.tolist()), text, column)
    return docs.withColumn(name, F.concat(*passes)).drop(*passes)
