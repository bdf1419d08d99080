"""The operators of the subpackage against brute force, other implementations, round trips and literal cases."""
import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from pyspark.sql import functions as F

from textsignal.llm import balltree, bpe, decontaminate, licenses, pages, pii, quality, secrets, simhash, suffixes
from textsignal.llm import queries as Q

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, fp string, score string, leaks string"
# Nulls, empty and blank texts, long texts, ties, repeated rows, and extra columns with clashing names.
ODD = [(None, None, "x", "y", "z"), (None, "", None, None, None), (1, "   \n ", "x", None, None), (2, "word", "x", None, None),
       (3, "ab " * 30_000, None, None, None), (4, "one two three four five", "p", "q", "r"), (4, "one two three four five", "p", "q", "r"),
       (5, "One two THREE four five", None, None, None), (6, "z" * 5000, None, None, None), (7, "é🎉 " * 300, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def rows(df):
    return [r.asDict() for r in df.collect()]


# 1: personal data

def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}
PII_CASES = [None, "", "a@b.c_d@e.f x@y.z.w", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.004", "é🎉 4111 1111 1111 1111, 4111-1111-1111-1112",
             "+1 (336) 555-3810 or +12 +1 5", "x" * 20_000 + "@a.b", "m@n.o " * 700, "1." * 5000, "x@" + ".a" * 9000, "4 " * 9000]


def plain_pii(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in PII.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_pii_base_spans(spark):
    df = spark.createDataFrame(list(enumerate(PII_CASES)), "doc_id long, text string")
    for r in pii.scan(df).collect():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.pii if s.kind in pii.BASE] == plain_pii(PII_CASES[r.doc_id])


def test_pii_query(spark, texts):
    for r in Q.op1_pii(spark, DATA).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain_pii(texts[r.doc_id])).encode()).hexdigest()
        assert r.n_card == sum(s.startswith("card") for s in plain_pii(texts[r.doc_id]))


def test_pii_checksums_and_context(spark):
    df = spark.createDataFrame([(1, "iban GB82 WEST 1234 5698 7654 32 or GB83 WEST 1234 5698 7654 32"), (2, "ssn 123-45-6789"), (3, "number 123-45-6789")],
                               "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start) for s in r.pii] for r in pii.scan(df).collect()}
    assert found == {1: [("iban", 5)], 2: [("ssn", 4)], 3: []}
    assert [r.text for r in pii.redact(df).orderBy("doc_id").collect()] == ["iban [IBAN] or GB83 WEST 1234 5698 7654 32", "ssn [SSN]", "number 123-45-6789"]


def test_pii_redaction_leaves_nothing(spark, odd):
    df = spark.createDataFrame(list(enumerate(PII_CASES)), "doc_id long, text string")
    clean = pii.redact(df)
    assert all(not plain_pii(r.text) for r in clean.collect() if r.doc_id != 3)
    assert Counter(map(str, pii.redact(odd).collect())) == Counter(map(str, odd.collect()))


# 2: exact top-k

def plain_top(vectors, k=5):
    good = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_topk_ties_nulls_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 8]) for i in range(300)] + [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(300, 420)]
    vectors += [(500, None), (550, [1.0, None, 0.0, 0.0]), (600, [float("nan")] * 4), (650, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    for shard, leaf, block in ((4096, 64, 512), (40, 8, 2)):
        monkeypatch.setattr(balltree, "SHARD_ROWS", shard), monkeypatch.setattr(balltree, "LEAF_ROWS", leaf), monkeypatch.setattr(balltree, "QUERY_BLOCK", block)
        points = balltree.scaled(df)
        got = sorted(tuple(r) for r in balltree.top_k(points, points.filter("vec_id % 50 = 0")).collect())
        assert got == plain_top(vectors)


@pytest.mark.parametrize("copies", [1, 6, 50])
def test_topk_repeated_rows(spark, monkeypatch, copies):
    """Rows that share the query's id hide no other row, repeated candidates count each, equal queries ask once, and two vectors of one id ask together."""
    rng = np.random.default_rng(copies)
    vectors = [(i, [float(x) for x in rng.integers(-40, 41, 4) / 8]) for i in range(1, 393)]
    vectors += [(0, [5.0, 5.0, 5.0, 5.0])] * copies + [(7, vectors[6][1])] * copies + [(50, [9.0, -9.0, 0.0, 1.0])]
    exact = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors]
    want = []
    for q in {i for i, _ in exact if i % 50 == 0}:
        asked = {tuple(v) for i, v in exact if i == q}
        best = sorted((-sum(a * b for a, b in zip(u, v)), i) for u in asked for i, v in exact if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    for shard, leaf, block, balls in ((4096, 64, 512, 256), (4096, 1024, 512, 256), (40, 8, 2, 3)):
        for name, value in (("SHARD_ROWS", shard), ("LEAF_ROWS", leaf), ("QUERY_BLOCK", block), ("BALLS", balls)):
            monkeypatch.setattr(balltree, name, value)
        points = balltree.scaled(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
        assert sorted(map(tuple, balltree.top_k(points, points.filter("vec_id % 50 = 0")).collect())) == sorted(want)


def test_topk_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    points = balltree.scaled(df)
    assert sorted(map(tuple, balltree.top_k(points, points).collect())) == [(0, 1, 50, 512 * 256), (50, 1, 0, 512 * 256)]
    assert balltree.top_k(points.limit(0), points.limit(0)).count() == 0


# 3: pages

def test_pages_query_is_the_article(spark):
    source = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}

    def article(h):
        import html
        inside = re.search(r"<article>(.*?)(</article>|$)", h, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        return "\n".join(b for b in blocks if b)
    for r in Q.op3_pages(spark, DATA).collect():
        assert r.text == article(source[r.page_id]) and r.n_chars == len(r.text)


def test_pages_noise_and_structure():
    page = """<html><body><header><h1>Site</h1></header><div id="menu"><ul><li>One<li>Two</ul></div><main><header><h2>T &amp; U</h2></header>
    <p>Hello <b>big</b>&nbsp; world<p>Second<form>no <input></form> tail</p><div class="post-comments"><p>reply</p></div><ul><li>a<li>b</ul>
    </main><script>if(a<b){"</p>"}</script><aside>s</aside></body>"""
    assert pages.extract(page) == "T & U\nHello big world\nSecond\ntail\na\nb"
    assert [pages.extract(x) for x in (None, "", "x &lt; y", "<p>a<p")] == ["", "", "x < y", "a<p"]


def test_pages_names_do_not_condemn_the_page():
    story = "<p>A long story of the day.</p><p>And its end.</p>"
    want = "A long story of the day.\nAnd its end."
    for page in ("<body class='single no-sidebar'>{}</body>", "<body class='search menu'>{}</body>", "<div class='content with-sidebar'>{}</div>",
                 "<article class='post no-comments'>{}</article>", "<article class='post comments-open'>{}</article>", "<form action='/'><div>{}</div></form>",
                 "<div id='search-result'>{}</div>", "<main class='no-header'>{}</main>", "<div class='comments'>{}<div class='comment'>Reply</div></div>",
                 "<form>{}<nav>Menu</nav><form>Ask</form></form>", "<p><svg class='i'/></p>{}", "<p><math/><object data='x' /></p>{}", "<svg><text>No</text></svg>{}"):
        for inside in (page, "<html><body>" + page + "<div class='ad'>Buy</div></body></html>"):
            assert pages.extract(inside.format(story)) == want, inside
    assert pages.extract(f"<article class='comment'><p>Reply</p></article><div>{story}</div>") == want


def test_pages_style_tree_drops_what_all_pages_share(spark):
    html = "<html><body><div class='x1'><span>Same words everywhere</span></div><div class='x2'><p>Own text {0} of the page</p></div></body></html>"
    table = [(i, "http://a.example.com/p", html.format(i)) for i in range(8)] + [(8, None, html.format(8)), (9, "http://[bad", None), (10, "http://a.example.com/q", html.format(0))]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(table, "page_id long, url string, html string")).collect()}
    assert got[3] == "Own text 3 of the page" and got[10] == "Own text 0 of the page" and got[9] == ""
    assert got[8] == "Same words everywhere\nOwn text 8 of the page"


# 4: benchmark passages

def norm(t):
    return " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "


def test_leaks_are_found_and_others_are_not(spark, texts):
    items = {r.item_id: norm(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in Q.op4_decontamination(spark, DATA).collect()}
    want = {(i, k) for i, t in texts.items() for k, v in items.items() if v in norm(t)}
    assert want <= got
    for i, k in got - want:
        shingles = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in (norm(texts[i]).split(), items[k].split())]
        assert len(shingles[0] & shingles[1]) >= 0.5 * len(shingles[1])


def test_fingerprints_within_radius_are_all_candidates():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    item = decontaminate.Items([1, 2], [" ".join(rng.choice(words, 23)) for _ in range(2)])
    prints, *_ = item.index[23]
    flipped = []
    for p in prints:
        for n in range(6):
            x = int(p)
            for b in rng.choice(64, n, replace=False):
                x ^= 1 << int(b)
            flipped.append(x)
    found = set(zip(*item.candidates(np.array(flipped, "uint64"), 23)[:2].tolist()))
    assert found == {(w, i) for w, x in enumerate(flipped) for i, p in enumerate(prints) if (x ^ int(p)).bit_count() <= decontaminate.RADIUS}


def plain_leaks(items, text):
    """For each item the best place of its length, over all places."""
    def weighted(words):
        k = max(1, min(5, len(words)))
        out = Counter()
        for j in range(len(words) - k + 1):
            out[tuple(words[j:j + k])] += sum(len(w) for w in words[j:j + k])
        return out
    words, out = norm(text).split(), {}
    for i, item in items.items():
        one, n = weighted(item.split()), len(item.split())
        for b in range(len(words)):
            two = weighted(words[b:b + n])
            both = sum((one & two).values())
            value = round(both / (sum(one.values()) + sum(two.values()) - both), 6)
            if value >= 0.8:
                out[i] = max(out.get(i, (0,)), (value, -b, min(b + n, len(words))))
    return out


def test_leaks_of_edited_passages_as_brute_force():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.choice((1, 2, 3, 5, 9))))
    found = edited = 0
    for n in (*range(1, 8), *range(15, 60)):
        item = [word() for _ in range(n)]
        items = {1: " ".join(item), 2: " ".join(word() for _ in range(n)), 3: " ".join(item[:3] * (n // 3 + 1))}
        texts = []
        for at in (0, n // 2, n - 1):
            change, insert, drop = item[:], item[:], item[:]
            change[at] = word()
            insert.insert(at, word())
            del drop[at]
            filler = lambda: [word() for _ in range(rng.choice((0, 4)))]
            texts += [" ".join(filler() + x + filler()) for x in (change, insert, drop, item[at:] + item[:at])]
        texts += [" ".join(item[:3] * 25), ""]
        got = decontaminate._leaks(decontaminate.Items(list(items), list(items.values())), texts)
        for text, leaks in zip(texts, got):
            want = plain_leaks(items, text)
            assert {x["item_id"]: (x["similarity"], -x["first_word"], x["end_word"]) for x in leaks} == want
            found += 1 in want
            edited += 1 in want and want[1][0] < 1
    assert found > 200 and edited > 150


def test_leaks_of_odd_rows(spark, odd, monkeypatch):
    bench = spark.createDataFrame([(1, "One, two three four five!"), (2, None), (None, "word"), (3, "word"), (4, ""), (5, "one two three four five")], "item_id long, text string")
    for block in (20_000, 2):
        monkeypatch.setattr(decontaminate, "ITEM_BLOCK", block)
        got = sorted((r.doc_id, sorted(x.item_id for x in r._l)) for r in decontaminate.mark(odd, bench, name="_l").collect() if r._l)
        assert got == [(2, [3]), (4, [1, 5]), (4, [1, 5]), (5, [1, 5])]


# 5: quality

def test_quality_on_held_out_labels(spark, docs):
    got = {r.doc_id: r for r in Q.op5_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(got[x.doc_id].predicted, x.quality) for x in labels if got[x.doc_id].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_quality_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = quality.score(odd, quality.fit(odd, none), name="_s").collect()
    assert len(scored) == len(ODD) and {r._s for r in scored} == {0.0, 0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(2, 8)] + [(None, 1), (5, None)], "doc_id long, quality int")
    assert all(0 <= r._s <= 1 for r in quality.score(odd, quality.fit(odd, some), name="_s").collect())


def test_quality_sample_counts_an_id_once(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a")] * 50 + [(2, "c"), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    sample, totals = quality.labelled_sample(docs, labels)
    assert sample[["doc_id", "quality", "text"]].values.tolist() == [[1, 1, "a"], [2, 0, "c"]] and totals == {0: 2, 1: 2}


# 6: repeated windows

def plain_cut(documents, window=200):
    seen = Counter(b[i:i + window] for _, b in documents for i in range(len(b) - window + 1))
    for doc_id, b in documents:
        keep = np.ones(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                keep[i:i + window] = False
        edges = int(((~keep) & np.concatenate([[True], keep[:-1]])).sum()) if len(b) else 0
        yield doc_id, len(b), int((~keep).sum()), edges, hashlib.sha256(np.frombuffer(b, "uint8")[keep].tobytes()).hexdigest()


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeats_as_brute_force(spark, docs, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    extra = [(None, None), (None, ""), (9000, "ab" * 400), (9001, "z" * 350), (9001, "z" * 350), (9002, "q" * 199), (9003, "x" * 200), (9004, "y" * 201), (9005, "é" * 100)]
    table = docs.select("doc_id", "text").limit(120).union(spark.createDataFrame(extra, "doc_id long, text string"))
    table.cache()
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = Counter(tuple(r[c] for c in columns) for r in suffixes.cut_repeats(table).collect())
    assert got == Counter(plain_cut([(r.doc_id, (r.text or "").encode()) for r in table.collect()]))


def test_repeats_of_empty_table(spark, docs):
    assert suffixes.cut_repeats(docs.limit(0)).count() == 0


# 7: licences

def test_licences():
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software. The above copyright notice and this permission "
           "notice shall be included in all\ncopies. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND.")
    names = lambda t: [x[0] for x in licenses.find(t)]
    assert licenses.find(mit)[0][:2] == ("MIT", "mit_grant+mit_notice+as_is")
    assert names("a. Licensed under CC BY-NC 4.0. b") == ["CC-BY-NC-4.0"]
    assert names("Released under the MIT License. This work is licensed under the GNU General Public License, version 3.") == ["MIT", "GPL-3.0-only"]
    assert names("# SPDX-License-Identifier: BSD-2-Clause\n\nx") == ["BSD-2-Clause"]
    assert names("We asked permission to license the public domain.") == [] == licenses.find(None) == licenses.find("")


def test_wrapped_and_commented_licences():
    as_is = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."
    for text, licence, rule in (
            ("This is free and unencumbered software released into the public domain.", "Unlicense", "unlicense"),
            ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + as_is, "ISC", "isc_grant+as_is"),
            ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software. The above copyright notice and this permission notice "
             "shall be included in all copies. " + as_is, "MIT", "mit_grant+mit_notice+as_is"),
            ("You can redistribute it and/or modify it under the terms of the GNU General Public License as published, either version 2 of the License, or (at your option) "
             "any later version. It is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.", "GPL-2.0-or-later", "gpl_may+gpl_hope"),
            ("Redistribution and use in source and binary forms, with or without modification, are permitted. Redistributions of source code must retain the above copyright "
             "notice. Redistributions in binary form must reproduce the above copyright notice. Neither the name of X nor others may be used to endorse or promote products.",
             "BSD-3-Clause", "bsd_grant+bsd_source+bsd_binary+bsd_endorse"),
            ("Released under CC BY 4.0.", "CC-BY-4.0", "cc_name"), ("Available under Creative Commons BY-SA 3.0.", "CC-BY-SA-3.0", "cc_name")):
        for gap in (" ", "  ", "\n", "\n# ", "\r\n * ", "\n// "):
            wrapped = text.replace(" ", gap)
            assert licenses.find(wrapped) == [(licence, rule, 0, len(wrapped) - 1)], (text, gap)


def test_licence_query_finds_every_line(spark, texts):
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    got = Counter((r.doc_id, r.licence) for r in Q.op7_licenses(spark, DATA).collect())
    assert got == Counter((i, v) for i, t in texts.items() for k, v in lines.items() for _ in range(t.count(k)))


# 8: secrets

SECRETS = (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
           ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24))


def plain_secrets(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(SECRETS)
             for m in re.finditer(p, text or "", re.I | re.A if name == "assign" else 0) if ok(m)]
    return ",".join(f"{name}:{s}:{e}" for s, _, name, e in sorted(found))


def test_secret_base_spans(spark, texts):
    for r in Q.op8_secrets(spark, DATA).collect():
        assert r.base_sha256 == hashlib.sha256(plain_secrets(texts[r.doc_id]).encode()).hexdigest()
    for case in ("token=token:abcdef12", "PASSWORD' : 'abc", "api_key=\"ABCdef-123\" é apikey:  x.y.z=1", "AKIA" + "A" * 15, "AKIA" * 9, "f" * 23 + " " + "f" * 24, "paſſword=abcdefgh", "", None):
        base = ",".join(f"{k}:{s}:{e}" for s, k, e in secrets.find(case) if k in secrets.BASE)
        assert base == plain_secrets(case)


def tlv(tag, content):
    size = bytes([len(content)]) if len(content) < 128 else bytes([0x82]) + len(content).to_bytes(2, "big")
    return bytes([tag]) + size + content


def test_secret_structures():
    key = tlv(0x30, tlv(2, b"\0") + tlv(2, bytes(range(1, 129))) + tlv(2, b"\1\0\1"))
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 'x'})}.c2ln"
    kinds = lambda t: {k for _, k, _ in secrets.find(t)}
    body = base64.b64encode(key).decode()
    assert "key" in kinds(f"x {body} y") and "key" in kinds(key.hex())
    assert "key" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----")
    assert kinds(f"see {token}.") == {"token"} and kinds(token.replace("eyJ", "eyK")) == set()
    ssh = b"".join(len(f).to_bytes(4, "big") + f for f in (b"ssh-ed25519", bytes(32)))
    assert "ssh" in kinds(base64.b64encode(ssh).decode())
    broken = base64.b64encode(key[:-5]).decode()
    assert kinds(f"x {broken} y") == set() == kinds("A" * 400)
    rnd = random.Random(8)
    for _ in range(5000):
        text = "".join(rnd.choice(("eyJ", "abcdefghij", "ab", ".", ".", " ", "-", "J")) for _ in range(12))
        assert list(secrets.tokens(text)) == [m.span() for m in secrets.TOKEN.finditer(text)]
    assert list(secrets.tokens("eyJ" * 500_000)) == []  # linear time


def test_secret_keys_at_any_place():
    """Keys glued to other characters or broken over lines, at every alignment; armour alone is none; spans are exact."""
    private = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(4, bytes(range(200))))
    public = tlv(0x30, tlv(0x30, tlv(6, b"\x2a\x03")) + tlv(3, bytes(range(33))))
    for key in (private, public):
        body, hexed = base64.b64encode(key).decode(), key.hex()
        lines = "\n".join(body[i:i + 64] for i in range(0, len(body), 64))
        for before in ("path/", "id-", "x_", "a", "ab", "abc", "MII", "M", "key: ", "é🎉 "):
            for written in (body, lines, lines.replace("\n", "\r\n  "), hexed.upper(), "\n".join(hexed[i:i + 60] for i in range(0, len(hexed), 60))):
                text = f"{before}{written} end"
                assert [x for x in secrets.find(text) if x[1] == "key"] == [(len(before), "key", len(before) + len(written))], (before, written)
        assert [k for _, k, _ in secrets.find("0" + hexed)] == ["hex", "key"]
    assert secrets.find("-----BEGIN PRIVATE KEY-----\nAAAA\n-----END PRIVATE KEY-----") == []
    armoured = f"-----BEGIN PRIVATE KEY-----\n{base64.encodebytes(private).decode()}-----END PRIVATE KEY-----"
    assert (0, "key", len(armoured)) in secrets.find(armoured) and len([x for x in secrets.find(armoured) if x[1] == "key"]) == 1
    twice = base64.b64encode(public).decode() + " " + base64.b64encode(private).decode()
    assert len([x for x in secrets.find(twice) if x[1] == "key"]) == 2
    assert [x for x in secrets.find("a/" + base64.b64encode(private[:-3]).decode()) if x[1] == "key"] == []
    for text in ("MII" * 70_000, "MIIC" * 50_000, "30" * 100_000, "3082" * 50_000, "MA" * 100_000):
        assert [x for x in secrets.find(text) if x[1] == "key"] == []  # linear time


def test_secrets_of_odd_rows(spark, odd):
    clashing = odd.withColumn("secrets", F.lit("mine"))
    out = secrets.scan(clashing)
    assert out.columns == clashing.columns and Counter(map(str, out.drop("secrets").collect())) == Counter(map(str, odd.collect()))
    assert all([tuple(x) for x in r.secrets] == secrets.find(r.text) for r in out.collect())
    assert secrets.scan(odd.limit(0)).count() == 0


# 9: fingerprints

def plain_print(text):
    from xxhash import xxh64_intdigest
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints):
    """Smallest id reachable over links of two bits, by id."""
    items, out = list(prints), {}
    todo = set(range(len(items)))
    while todo:
        group, edge = set(), [todo.pop()]
        while edge:
            i = edge.pop()
            group.add(i)
            near = {j for j in todo if (items[i][1] ^ items[j][1]).bit_count() <= 2}
            todo -= near
            edge += near
        ids = [items[i][0] for i in group if items[i][0] is not None]
        out.update({i: min(ids, default=None) for i in group})
    return [(items[i][0], items[i][1], out[i]) for i in range(len(items))]


def test_simhash_query(spark, texts):
    got = Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in Q.op9_simhash(spark, DATA).collect())
    assert got == Counter(plain_groups([(i, plain_print(t)) for i, t in texts.items()]))


def test_simhash_of_odd_rows(spark, odd):
    got = Counter((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in simhash.group(odd).collect())
    assert got == Counter(plain_groups([(r[0], plain_print(r[1])) for r in ODD]))
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 4").count() == 1 and kept.filter("doc_id = 1").count() == 1
    assert simhash.one_of_each(odd.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [4096, 8])
def test_links_of_planted_neighbours(spark, monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    rng = np.random.default_rng(5)
    prints = []
    for base in rng.integers(0, 2 ** 63, 40):
        x = int(base)
        for n in range(12):  # chains and stars of zero to four bits
            prints.append(x)
            y = x
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                y ^= 1 << int(b)
            x = y if n % 2 else int(base) ^ (1 << int(rng.integers(64)))
    rows_ = [(i, int(np.uint64(x).astype("int64"))) for i, x in enumerate(prints)]
    df = spark.createDataFrame(rows_, "doc_id long, fp long")
    got = Counter((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in df.join(simhash.labels(df), "fp").collect())
    assert got == Counter(plain_groups(list(enumerate(prints))))


# 10: byte-level BPE

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query(spark, texts, tokenizer):
    for r in Q.op10_bpe(spark, DATA).collect():
        ids = tokenizer.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_of_odd_rows(spark, odd, tokenizer):
    import public_tokenizers as P
    path = P.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(odd, path, P.PATTERN)
    for r in bpe.decode(coded, path).collect():
        assert list(r.token_ids) == tokenizer.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(odd.limit(0), path, P.PATTERN).count() == 0
    ranks = bpe.Ranks(path)
    cases = ["日本語🎉" * 80, "lalala" * 300, "a" * 511 + "b" * 600, " \n\n  \t x", "é" * 40]
    import regex
    flat, sizes = ranks.encode_batch(cases, regex.compile(P.PATTERN))
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [tokenizer.encode_ordinary(t) for t in cases]


# The pipeline

def test_pipeline_stages(spark, docs, texts, tokenizer):
    got = {r.doc_id: r for r in entry_points.queries()["pipeline"](spark, DATA).collect()}
    model = Q.quality_model(spark, docs, DATA)
    left = {i: t for i, t in texts.items() if model.score(t) >= 0.5}
    left = {i: left[i] for i, _, first in plain_groups([(i, plain_print(t)) for i, t in left.items()]) if i == first}
    items = decontaminate.Items(*zip(*[(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]))
    left = {i: t for (i, t), found in zip(left.items(), decontaminate._leaks(items, list(left.values()))) if not found}
    assert set(got) == set(left)
    for i, t in left.items():
        if not plain_pii(t):
            assert got[i].ids_sha256 == hashlib.sha256(np.array(tokenizer.encode_ordinary(t), "<u4").tobytes()).hexdigest()


def test_pipeline_keeps_columns_of_odd_rows(spark, odd):
    df = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, DATA)
        assert df.columns == odd.columns
        df = df.unionByName(odd)  # each stage meets the odd rows
    assert corpus_pipeline.STAGES[-1][1](spark, df, DATA).count() == df.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), DATA).count() == 0
