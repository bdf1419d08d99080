"""Licences in text: known sentences get identifiers, and ordered rules recognise sequences of them.

A sentence is normalised to lower-case words without punctuation. Each pattern below names a sentence that
licences are made of; a rule is a licence and the sentences it needs, in order, with at most MAX_GAP other
sentences between two of them. Rules are tried as listed, the longest forms first, and use up their sentences.
"""
import re

import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import slices

MAX_GAP = 2
# Normalised wording of published licences. A group gives the part of the name that varies.
SENTENCES = [(name, re.compile(pattern)) for name, pattern in (
    ("spdx", r"\bspdx-license-identifier ([a-z0-9.+-]+)"),
    ("mit_grant", r"\bpermission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit_notice", r"\bthe above copyright notice and this permission notice .*shall be included in all copies"),
    ("as_is", r"\bthe software is provided as is without warranty of any kind"),
    ("isc_grant", r"\bpermission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd_grant", r"\bredistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd_source", r"\bredistributions of source code must retain the above copyright notice"),
    ("bsd_binary", r"\bredistributions in binary form must reproduce the above copyright notice"),
    ("bsd_endorse", r"\bneither the name of .* may be used to endorse or promote products"),
    ("apache_under", r"\blicensed under the apache license version 2\.0 the license\b"),
    ("apache_may_not", r"\byou may not use this file except in compliance with the license"),
    ("gpl_may", r"\byou can redistribute it and or modify it under the terms of the gnu (lesser |affero |library )?general public license .*version ([0-9.]+) .*or at your option any later version"),
    ("gpl_hope", r"\bdistributed in the hope that it will be useful but without any warranty"),
    ("unlicense", r"\bthis is free and unencumbered software released into the public domain"),
    ("mpl_subject", r"\bthis source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2\.0"),
    ("apache_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:the )?apache (?:software )?licen[sc]e(?: version)? v?(2\.0|2)\b"),
    ("gpl_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?gnu (lesser |affero |library )?general public licen[sc]e(?: version)? v?([0-9.]+)"),
    ("mit_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?mit licen[sc]e\b"),
    ("bsd_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:new |modified |simplified )?(?:bsd ([23])-clause|([23])-clause bsd) licen[sc]e\b"),
    ("isc_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:the )?isc licen[sc]e\b"),
    ("mpl_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:the )?mozilla public licen[sc]e(?: version)? v?(2\.0)\b"),
    ("cc_name", r"\b(?:licen[sc]ed|released|distributed|available) under (?:a |an |the )?(?:cc|creative commons) (by(?:-[a-z]{2})*) ([0-9.]+)"),
    ("cc0_name", r"\b(?:licen[sc]ed|released|distributed|available|dedicated) (?:under|to) (?:the )?(?:public domain )?(?:under )?cc0\b"),
)]
RULES = (
    ("MIT", ("mit_grant", "mit_notice", "as_is")), ("MIT", ("mit_grant",)),
    ("ISC", ("isc_grant", "as_is")), ("ISC", ("isc_grant",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")), ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache_under", "apache_may_not")), ("Apache-2.0", ("apache_under",)),
    ("{gpl}-or-later", ("gpl_may", "gpl_hope")), ("{gpl}-or-later", ("gpl_may",)), ("Unlicense", ("unlicense",)), ("MPL-2.0", ("mpl_subject",)),
    ("{spdx}", ("spdx",)), ("Apache-2.0", ("apache_name",)), ("{gpl}-only", ("gpl_name",)), ("MIT", ("mit_name",)), ("BSD-{digit}-Clause", ("bsd_name",)),
    ("ISC", ("isc_name",)), ("MPL-2.0", ("mpl_name",)), ("CC-{cc}", ("cc_name",)), ("CC0-1.0", ("cc0_name",)),
)
# Every sentence pattern holds one of these, so other texts need no sentences. They are single words, since line breaks and
# comment marks may stand between two.
HINT = re.compile(r"licen[sc]e|permission|redistribut|software|endorse|creative|hope|cc0|(?<![a-z0-9])cc(?![a-z0-9])", re.I)
SENTENCE = re.compile(r"(?:[^.!?\n]|[.!?](?!\s|\Z)|\n(?!\s*\n))+")
WORD = re.compile(r"[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?")


def identifiers(text):
    """(index of the sentence, identifier, its groups as they are written, start, end) of the known sentences of a text."""
    if not text or not HINT.search(text):
        return []
    out = []
    for i, m in enumerate(SENTENCE.finditer(text)):
        if HINT.search(m[0]):
            normal = " ".join(WORD.findall(m[0].lower()))
            start = m.start() + len(m[0]) - len(m[0].lstrip())
            out += [(i, name, _written(found, m[0]), start, m.end()) for name, p in SENTENCES if (found := p.search(normal))]
    return out


def _written(found, sentence):
    """Groups of a match; the name in an identifier tag keeps its case."""
    groups = [g.strip() for g in found.groups() if g]
    if found.re.pattern.startswith(r"\bspdx"):
        groups = re.findall(re.escape(groups[0]), sentence, re.I)[:1]
    return groups


def _name(pattern, groups):
    version = groups[-1].rstrip(".") if groups else ""
    family = {"lesser": "LGPL", "library": "LGPL", "affero": "AGPL"}.get(groups[0] if groups else "", "GPL")
    return pattern.format(spdx=version, digit=version, gpl=f"{family}-{version if '.' in version else version + '.0'}",
                          cc="-".join(g.upper() for g in groups).rstrip("."))


def find(text):
    """(licence, rule, start, end) in text order, in code points. Null, empty and other texts give none."""
    left, out = identifiers(text), []
    for pattern, wanted in RULES:
        at = 0
        while at < len(left):
            chain = []
            for row in left[at:]:
                if chain and row[0] - chain[-1][0] > MAX_GAP + 1:
                    break
                if row[1] == wanted[len(chain)] and (not chain or row[0] > chain[-1][0]):
                    chain.append(row)
                    if len(chain) == len(wanted):
                        break
                elif not chain:
                    break
            if len(chain) < len(wanted):
                at += 1
                continue
            out.append((_name(pattern, chain[0][2]), "+".join(wanted), chain[0][3], chain[-1][4]))
            # The sentences of the chain, and others read from the same places, are used up.
            used = {row[0] for row in chain}
            left = [row for row in left if row[0] not in used]
    return sorted(out, key=lambda r: (r[2], r[3], r[0]))


LICENCES = "array<struct<licence:string,rule:string,start:int,end:int>>"


def scan(docs, text="text", name="licences"):
    """Add the licences of each whole text as an array. No shuffle; null text counts as empty."""
    from pyspark.sql import types as T
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType(kept + [T.StructField(name, T._parse_datatype_string(LICENCES))])
    inner = pa.list_(pa.struct([("licence", pa.string()), ("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 2 << 20, text):
                found = [[dict(zip(("licence", "rule", "start", "end"), r)) for r in find(t)] for t in batch.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(found, inner)], names=schema.names)
    return docs.mapInArrow(run, schema)


def listed(docs):
    """(doc_id, licence, rule, start, end): one row per licence found."""
    return scan(docs.select("doc_id", "text")).select("doc_id", F.explode("licences").alias("l")).select("doc_id", "l.*")
