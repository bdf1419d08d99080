"""Small helpers of the subpackage: shared scratch tables, ragged arrays, vector hashing."""
import os
import tempfile
import uuid

import numpy as np


def written(df, name):
    """Write a frame to the shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor repeats one step and not the whole plan. A folder of its
    own is made only where the session names none, as in tests on one machine.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="textsignal-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def string_buffer(column):
    """A pyarrow string or binary column as (uint8 data, int64 offsets); nulls count as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    column = column.cast(pa.large_binary())
    column = pc.fill_null(column, b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, "int64", len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, "int64")
    whole = np.frombuffer(data, "uint8") if data is not None and data.size else np.zeros(0, "uint8")
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch, limit, column="text"):
    """Parts of a record batch whose texts hold about `limit` bytes each; one long text is a part by itself."""
    import pyarrow as pa
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if batch.num_rows > begin:
        yield batch.slice(begin)


def ragged(starts, lengths):
    """Indices of the concatenation of the ranges [start, start + length)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix(h):
    """The 64-bit finaliser of splitmix, on arrays."""
    h = h.astype("uint64")
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RangeHash:
    """64-bit polynomial hashes of any byte range, from one prefix sum."""
    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self, codes):
        n = len(codes)
        up = np.full(n, self.BASE, "uint64")
        down = np.full(n + 1, self.INVERSE, "uint64")
        if n:
            up[0] = 1
        down[0] = 1
        self.back = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, "uint64")
        np.cumsum(codes * np.multiply.accumulate(up), out=self.sums[1:])

    def of(self, starts, ends):
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def byte_codes(seed):
    """A random odd 64-bit code for each byte value."""
    return np.random.default_rng(seed).integers(1, 2 ** 64 - 1, 256, dtype="uint64") | np.uint64(1)


def popcount(x):
    return np.bitwise_count(x)


def registry():
    """(queries, sql, decorator) of one module."""
    queries, sql = {}, {}

    def query(text=None):
        def register(fn):
            queries[fn.__name__] = fn
            if text:
                sql[fn.__name__] = text
            return fn
        return register
    return queries, sql, query
