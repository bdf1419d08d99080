"""Repeated passages against a search of all windows in memory."""
import hashlib
import random
import re

import pytest

from textsignal.llm import passages
from textsignal.llm import queries as Q

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, marks string, packed string"


def plain(texts, window=50):
    """(words, removed, kept) by row, from the smallest id of every window."""
    words = [(float("inf") if i is None else i, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t in texts]
    first = {}
    for i, ws in words:
        for j in range(len(ws) - window + 1):
            key = tuple(ws[j:j + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, ws in words:
        gone = [False] * len(ws)
        for j in range(len(ws) - window + 1):
            if first[tuple(ws[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        out.append((len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def found(spark, texts, window=50):
    df = spark.createDataFrame([(i, t, "k", "m", "p") for i, t in texts], SCHEMA)
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in passages.cut_passages(df, min_words=window).collect())


def same(spark, texts, window=50):
    want = sorted((str(i), *row) for (i, _), row in zip(texts, plain(texts, window)))
    assert found(spark, texts, window) == want
    return sum(row[2] for row in want)


@pytest.mark.parametrize("window", [2, 3, 7, 50, 131])
def test_spliced_texts(spark, window):
    """Texts cut and joined at random, with single words changed: every kind of partial overlap."""
    rng = random.Random(window)
    base = [[rng.choice("abcdefgh" if window < 10 else "abc") for _ in range(rng.randint(0, 4 * window))] for _ in range(25)]
    texts = []
    for i in range(80):
        words = list(rng.choice(base))
        if rng.random() < 0.5:
            words = words[rng.randint(0, len(words)):] + list(rng.choice(base))
        if words and rng.random() < 0.6:
            words[rng.randrange(len(words))] = "zz"
        texts.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    rng.shuffle(texts)
    assert same(spark, texts, window) > 0


def test_odd_rows(spark):
    words = [f"w{i}" for i in range(200)]
    long = " ".join(words)
    texts = [(None, None), (None, ""), (1, " \n\t "), (2, "word"), (3, "ab " * 30_000), (4, "ab " * 60), (4, "ab " * 60), (5, long), (5, long), (5, " ".join(words[20:120])),
             (6, " ".join(words[10:59])), (7, " ".join(words[10:60])), (None, long), (None, long), (8, "é🎉 " * 300), (9, " é🎉\x0b" * 49), (10, " é🎉\x0b" * 50), (-3, " ".join(words[150:]))]
    assert same(spark, texts) > 0
    assert found(spark, []) == []


def test_one_phrase_in_many_contexts(spark):
    """A frequent phrase with different words around it: no window repeats but where the context does."""
    rng = random.Random(5)
    phrase = [f"p{i}" for i in range(40)]
    texts = [(i, " ".join([f"x{rng.randint(0, 1)}" for _ in range(12)] + phrase + [f"y{rng.randint(0, 1)}" for _ in range(12)])) for i in range(300)]
    assert same(spark, texts) > 0


def test_repeats_are_word_positions(spark):
    words = [f"w{i}" for i in range(60)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "a b " + " ".join(words) + " c")], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.repeats] for r in passages.cut_passages(df).collect()}
    assert got == {1: [], 2: [(2, 62)]}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, gone, kept) in zip(docs, plain(docs)))
    assert sorted(map(tuple, Q.op12_passages(spark, DATA).collect())) == want
