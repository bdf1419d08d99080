"""Byte-level BPE with a given rank table, on padded matrices of byte pieces.

Distinct pieces of a batch are bucketed by length into matrices; each round every row merges its
leftmost pair of minimum rank, found by a hashed pair lookup, and closes the gap. Rows without a
mergeable pair leave the matrix. Null text is empty and has no ids; lone input columns are kept.
"""
import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa

from textsignal.llm.common import ragged, slices

NONE = np.iinfo("int32").max
# Bytes of text handled at once in a task, and cells of one matrix.
SLICE_BYTES = 2 << 20
MATRIX_CELLS = 1 << 18


class Ranks:
    """A rank table: token bytes by id, and a hashed lookup of mergeable pairs."""

    def __init__(self, path):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        top = max(self.rank.values()) + 1
        tokens = [b""] * top
        for token, i in self.rank.items():
            tokens[i] = token
        self.data = np.frombuffer(b"".join(tokens), "uint8")
        self.size = np.array([len(t) for t in tokens], "int64")
        self.start = np.cumsum(self.size) - self.size
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], "int32")
        pairs = [(self.rank[t[:k]], self.rank[t[k:]], i) for t, i in self.rank.items()
                 for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank]
        left, right, merged = np.array(pairs, "int64").T
        # Open addressing: a slot holds a pair's key and its merged id.
        self.bits = int(np.ceil(np.log2(len(pairs) * 4)))
        self.keys = np.full(1 << self.bits, -1, "int64")
        self.values = np.full(1 << self.bits, NONE, "int32")
        key = left << 32 | right
        slot, todo, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.values[slot[placed]] = key[placed], merged[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key):
        return ((key.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype("int64")

    def pair(self, left, right):
        """Merged id of each pair, NONE where the pair is not in the table."""
        key = (left.astype("int64") << 32 | right).ravel()
        slot, out = self._slot(key), np.full(len(key), NONE, "int32")
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)

    def merge(self, ids, sizes):
        """Merge each row of a padded matrix until no pair is left; returns (ids, sizes)."""
        rows = np.arange(len(ids))
        live, size = ids.copy(), sizes.copy()
        rank = self.pair(live[:, :-1], live[:, 1:])
        rank[np.arange(rank.shape[1])[None] >= size[:, None] - 1] = NONE
        while len(rows):
            at = rank.argmin(1)
            best = rank[np.arange(len(rows)), at]
            over = best == NONE
            if over.any():
                ids[rows[over], :live.shape[1]], sizes[rows[over]] = live[over], size[over]
                keep = ~over
                rows, live, size, at, best, rank = rows[keep], live[keep], size[keep], at[keep], best[keep], rank[keep]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            live[line, at] = best
            # Close the gap behind the merged pair, in ids and in ranks.
            column = np.arange(live.shape[1] - 1)
            source = column[None] + (column[None] >= at[:, None])
            live = np.concatenate([live[:, :1], np.take_along_axis(live[:, 1:], np.minimum(source, live.shape[1] - 2), 1)], 1)
            rank = np.take_along_axis(rank, np.minimum(column[None] + (column[None] >= at[:, None]), rank.shape[1] - 1), 1)
            size -= 1
            width = max(int(size.max()), 2)
            live, rank = live[:, :width], rank[:, :width - 1]
            for side in (at - 1, at):
                ok = (side >= 0) & (side < size - 1)
                rank[line[ok], side[ok]] = self.pair(live[line[ok], side[ok]], live[line[ok], side[ok] + 1])
            rank[np.arange(rank.shape[1])[None] >= size[:, None] - 1] = NONE
        return ids, sizes

    def merge_long(self, ids):
        """One piece too long for a matrix: the same merges, on a linked list with a heap."""
        import heapq
        n = len(ids)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(self.pair(np.array(ids[:-1]), np.array(ids[1:]))) if r != NONE]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if not alive[i] or ids[i] != a or after[i] >= n or ids[after[i]] != b:
                continue
            j = after[i]
            alive[j], ids[i], after[i] = False, rank, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    r = int(self.pair(np.array([ids[k]]), np.array([ids[after[k]]]))[0])
                    if r != NONE:
                        heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
        return np.array([x for x, live in zip(ids, alive) if live], "int32")

    def encode_pieces(self, pieces):
        """Ids of many byte pieces: (flat ids, start of each piece, number of ids of each piece)."""
        size = np.array([len(p) for p in pieces], "int64")
        data = np.frombuffer(b"".join(pieces), "uint8")
        start = np.cumsum(size) - size
        count, parts, begin, used = np.zeros(len(pieces), "int64"), [], np.zeros(len(pieces), "int64"), 0
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            width = int(size[order[at]])
            if width > LONG_PIECE:
                rows = order[at:at + 1]
                done = self.merge_long(self.byte[data[start[rows[0]]:start[rows[0]] + width]])
                flat, sizes = done, np.array([len(done)])
            else:
                # A bucket: pieces of nearly one length, padded to the longest.
                wide = max(2, width + width // 4)
                stop = min(int(np.searchsorted(size[order], wide, "right")), at + max(1, MATRIX_CELLS // wide))
                rows = order[at:stop]
                wide = max(2, int(size[rows[-1]]))
                inside = np.arange(wide)[None] < size[rows][:, None]
                ids = np.zeros((len(rows), wide), "int32")
                ids[inside] = self.byte[data[ragged(start[rows], size[rows])]]
                ids, sizes = self.merge(ids, size[rows].copy())
                flat = ids[np.arange(wide)[None] < sizes[:, None]]
            count[rows], begin[rows] = sizes, used + np.cumsum(sizes) - sizes
            parts.append(flat)
            used += len(flat)
            at += len(rows)
        return (np.concatenate(parts) if parts else np.zeros(0, "int32")), begin, count

    def encode_batch(self, texts, pattern):
        """(flat ids, number of ids per text)."""
        import pandas as pd
        found = [pattern.findall(t) if t else [] for t in texts]
        each = np.array([len(f) for f in found], "int64")
        code, distinct = pd.factorize(np.array([p for f in found for p in f], dtype=object))
        del found
        flat, begin, count = self.encode_pieces([p.encode() for p in distinct])
        sizes = count[code] if len(code) else np.zeros(0, "int64")
        ids = flat[ragged(begin[code], sizes)] if len(code) else np.zeros(0, "int32")
        total = np.concatenate([[0], np.cumsum(sizes)])
        edge = np.concatenate([[0], np.cumsum(each)])
        return ids, total[edge[1:]] - total[edge[:-1]]

    def decode(self, ids):
        """Bytes of a sequence of ids."""
        return self.data[ragged(self.start[ids], self.size[ids])]


# Pieces of more bytes are merged one by one.
LONG_PIECE = 512


@lru_cache(maxsize=4)
def _tools(path, pattern):
    import regex
    return Ranks(path), regex.compile(pattern)


def encode(docs, path, pattern, text="text"):
    """Add `token_ids` array<int> to any table with a text column, null or empty text giving an empty array.

    path: a rank file that every executor can read; pattern: the regex whose matches are encoded one
    by one. The text never leaves its row, so there is no shuffle.
    """
    return _mapped(docs, path, pattern, text, lambda ids, ranks: {"token_ids": ids})


def decode(rows, path, ids="token_ids"):
    """Add `decoded` binary: the bytes of an array of ids; a null array gives empty bytes."""
    from pyspark.sql import types as T
    schema = T.StructType([f for f in rows.schema.fields if f.name != "decoded"] + [T.StructField("decoded", T.BinaryType())])

    def run(batches):
        ranks, _ = _tools(path, "")
        for batch in batches:
            column = [ranks.decode(np.array(x or [], "int64")).tobytes() for x in batch.column(ids).to_pylist()]
            batch = pa.RecordBatch.from_arrays([batch.column(f.name) if f.name != "decoded" else pa.array(column, pa.binary())
                                                for f in schema.fields], names=schema.names)
            yield batch
    return rows.mapInArrow(run, schema)


def digests(docs, path, pattern, text="text"):
    """Add n_tokens, ids_sha256 and decoded_sha256: the encoding and the round trip of each text, without shipping the ids."""
    def summary(ids, ranks):
        raw = [np.ascontiguousarray(x, "<u4").tobytes() for x in ids]
        return {"n_tokens": [len(x) for x in ids], "ids_sha256": [hashlib.sha256(x).hexdigest() for x in raw],
                "decoded_sha256": [hashlib.sha256(ranks.decode(x).tobytes()).hexdigest() for x in ids]}
    return _mapped(docs, path, pattern, text, summary)


TYPES = {"token_ids": ("array<int>", pa.list_(pa.int32())), "n_tokens": ("long", pa.int64()),
         "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}


def _mapped(docs, path, pattern, text, summary):
    """Columns of `summary` in place of the text column; other columns stay unless they bear the same names."""
    from pyspark.sql import types as T
    new = ["token_ids"] if summary([], None).keys() == {"token_ids"} else ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [f for f in docs.schema.fields if f.name not in new]
    schema = T.StructType(kept + [T.StructField(n, T._parse_datatype_string(TYPES[n][0])) for n in new])

    def run(batches):
        ranks, compiled = _tools(path, pattern)
        for whole in batches:
            for batch in slices(whole, SLICE_BYTES, text):
                flat, sizes = ranks.encode_batch(batch.column(text).to_pylist(), compiled)
                columns = summary(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else [], ranks)
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(columns[n], TYPES[n][1]) for n in new],
                                                 names=schema.names)
    return docs.mapInArrow(run, schema)
