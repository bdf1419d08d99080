"""The conversation trie against one built in memory."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textsignal.llm import prefixes
from textsignal.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string, place string, words string, block string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    source = lambda c: c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
    return {c: own.get(source(c), [])[:heads[c]] + ts[heads[c]:] for c, ts in own.items()}


def plain(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len([w for w in re.split(r"[\x20\x09-\x0D]+", node[-1][1]) if w]) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted((min(m), len(n), -1 if not n else min(members[n[:-1]]), len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def shown(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def built(spark, tmp_path, rows):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).write.parquet(path)
    return shown(Q.op11_prefixes(spark, str(tmp_path)))


@pytest.mark.parametrize("seed", range(4))
def test_random_conversations(spark, tmp_path, monkeypatch, seed):
    """Few different turns, so that conversations share prefixes of every length, end inside each other and repeat."""
    monkeypatch.setattr(prefixes, "BLOCK", [8, 3, 2, 1][seed])
    monkeypatch.setattr(prefixes, "CHUNK", [512, 2, 1, 2][seed])
    monkeypatch.setattr(prefixes, "PIECE", 3)
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 400), 150):
        many = rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 40])
        same = rng.random() < 0.3
        rows += [(c, t, rng.choice("ua") if not same else "u", "hi  there\n" * (1 if same else rng.randint(0, 1))) for t in range(many)]
    rng.shuffle(rows)
    assert built(spark, tmp_path, rows) == plain(rebuilt(rows))


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, equal turn numbers, repeated rows, a very long text, a conversation of most rows, turnless conversations."""
    rows = [(None, 1, "u", "lost"), (20, None, None, None), (20, None, "u", "b a"), (20, 1, "u", None), (20, 1, "u", None), (21, 1, "", "b  a"), (22, 5, None, ""), (23, 7, "u", "x " * 50_000)]
    rows += [(40, i, "u", f"turn {i % 7}") for i in range(5_000)] + [(41, i, "u", f"turn {i % 7}") for i in range(4_990)]
    rows += [(c, 1, "u", "only") for c in range(60, 100)] + [(c, 1, "u", "alone") for c in range(501, 520)]
    assert built(spark, tmp_path, rows) == plain(rebuilt(rows))


def test_no_rows(spark, tmp_path):
    assert built(spark, tmp_path, []) == []


def test_places_over_ranges(spark):
    """One conversation over many sorted ranges is numbered through."""
    rows = [(c, t, "u", f"{t}") for c, n in ((1, 3), (2, 3_000), (3, 2)) for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = prefixes.turns(df).join(df.select("conv_id", F.unhex(F.md5(F.concat(F.lit("1:"), "role", "text"))).alias("id"), "turn"), ["conv_id", "id"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(got) == 3005 and all(r.place == r.turn + 1 for r in got)
