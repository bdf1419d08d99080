"""Quality classifier by compression: how much better a text packs with a dictionary of good text than with one of bad text.

Two zstandard dictionaries are trained on labelled texts of either class. A text is cut into blocks of
BLOCK_BYTES, every block is packed with both, and the difference of the two sizes, as a share of their
sum, is mapped to a probability by a logistic curve fitted on labelled texts that made no dictionary.
The curve also takes how well the text packs at all: repetition packs so well that both sizes are alike.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import slices

# Bounds of the fit, documented parameters: labelled rows of each class, and the longest text among them.
FIT_ROWS = 1500
FIT_BYTES = 1 << 16
DICTIONARY_BYTES = 1 << 16
BLOCK_BYTES = 4096
LEVEL = 3


def labelled_sample(docs, labels, rows=FIT_ROWS):
    """Up to `rows` labelled texts of each class, in hash order of their ids, as a pandas frame (text, quality), and the class counts.

    Only a bounded number of ids is broadcast. Labels that are null or not 0 or 1, ids without a text, and texts over FIT_BYTES give no row.
    Of several texts with one id the smallest counts, so the sample stays bounded.
    """
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)")
    totals = {r[0]: r[1] for r in labels.groupBy("quality").count().collect()}
    picked = [labels.filter(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    texts = docs.select("doc_id", "text").filter(F.length("text") > 0).filter(F.octet_length("text") <= FIT_BYTES)
    found = texts.join(F.broadcast(picked[0].union(picked[1]).distinct()), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    return found.toPandas().sort_values(["doc_id", "quality", "text"]), totals


class Model:
    """Two dictionaries and the curve that maps packed sizes to a score."""

    def __init__(self, good=b"", bad=b"", weights=(0.0, 0.0, 0.0)):
        self.good, self.bad, self.weights = good, bad, weights
        self.packers = None

    def __getstate__(self):
        return self.__dict__ | {"packers": None}

    def sizes(self, text):
        """((bad size - good size) / (bad size + good size), log of the smaller size over the plain size), over all blocks."""
        import zstandard
        if self.packers is None:
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_dict_id=0)
            self.packers = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=params)
                            for d in (self.good, self.bad)]
        data = memoryview(text.encode())
        good, bad = (sum(len(p.compress(data[i:i + BLOCK_BYTES])) for i in range(0, len(data), BLOCK_BYTES)) for p in self.packers)
        return (bad - good) / (bad + good), float(np.log(min(good, bad) / len(data)))

    def score(self, text):
        """Probability of a good label; 0 for null or empty text."""
        if not text:
            return 0.0
        difference, ratio = self.sizes(text) if self.good else (0.0, 0.0)
        value = self.weights[0] * difference + self.weights[1] * ratio + self.weights[2]
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def _dictionary(texts):
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    import zstandard
    blocks = [b[i:i + BLOCK_BYTES] for b in (t.encode() for t in texts) for i in range(0, len(b), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(blocks)[-DICTIONARY_BYTES:]).ljust(8, b" ")


def _curve(x, y, weight):
    """Weighted logistic fit of y on the columns of x with a small penalty, by Newton steps."""
    scale = np.maximum(x.std(0), 1e-12)
    rows, w = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(len(w)), rows.T @ (weight * (y - p)) - 1e-3 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in np.append(w[:-1] / scale, w[-1]))


def fit(docs, labels, rows=FIT_ROWS):
    """A model from a bounded sample: half of it makes the dictionaries, the other half the curve.

    With fewer than two labels of a class, every text scores the share of good labels (0.5 without any).
    """
    sample, totals = labelled_sample(docs, labels, rows)
    good, bad = (sample.text[sample.quality == c].tolist() for c in (1, 0))
    if min(len(good), len(bad)) < 2:
        share = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
        return Model(weights=(0.0, 0.0, float(np.log(share / (1 - share)))))
    model = Model(_dictionary(good[::2]), _dictionary(bad[::2]))
    x = np.array([model.sizes(t) for t in good[1::2] + bad[1::2]])
    y = np.repeat([1.0, 0.0], [len(good) // 2, len(bad) // 2])
    weight = np.where(y == 1, totals[1] / (len(good) // 2), totals[0] / (len(bad) // 2))
    model.weights = _curve(x, y, weight / weight.sum() * len(x))
    return model


def score(docs, model, text="text", name="score"):
    """Add a score from 0 to 1 to each row: higher means that a good label is likelier. No shuffle; null and empty text score 0."""
    from pyspark.sql import types as T
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType(kept + [T.StructField(name, T.DoubleType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 2 << 20, text):
                scores = [model.score(t) for t in batch.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(scores, pa.float64())], names=schema.names)
    return docs.mapInArrow(run, schema)


def held_out(doc_id):
    """True for the third of the ids whose labels never serve for a fit; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
