"""Column → Column vector and score functions."""
from pyspark.sql import functions as F


def _sum(values):
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _given(value, body):
    """`body(value)` with the value evaluated once, not once per element of the lambda that uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _doubles(v):
    return v.cast("array<double>")


def dot(a, b):
    """Inner product in double precision."""
    return _sum(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def l2_norm(v):
    return F.sqrt(_sum(F.transform(_doubles(v), lambda x: x * x)))


def l2_normalize(v):
    """Unit length; a zero vector stays as it is."""
    return _given(l2_norm(v), lambda n: F.when(n > 0, F.transform(_doubles(v), lambda x: x / n)).otherwise(_doubles(v)))


def softmax(scores):
    shifted = _given(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp(x - top)))
    return _given(shifted, lambda e: _given(_sum(e), lambda total: F.transform(e, lambda x: x / total)))


def argmax(scores):
    """0-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def ranked_labels(labels, probs):
    """(label, probability rounded to 4) pairs, highest first; ties by label order."""
    pairs = F.zip_with(labels, probs, lambda l, p: F.struct((-F.round(p, 4)).alias("neg"), l.alias("label")))
    return F.transform(F.array_sort(pairs),
                       lambda s: F.struct(s["label"].alias("label"), (-s["neg"]).alias("probability")))
