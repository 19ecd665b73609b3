"""Licence scans by sentence rules.

A text is cut into pieces (at line ends, at ``. ! ? ;`` before a space, and where
the notices of the GNU licences have parts), each is normalised. A known licence
sentence, mapped to its identifier, covers whole pieces: pieces are taken
together, over any number of lines, until ``. ! ? ;`` ends the sentence. The sequence of identifiers in the text is
then matched against ordered licence rules: the first rule whose sequence occurs
takes its sentences, and so on until no rule fits; known sentences that no rule
takes are reported as unmatched. An SPDX line is a sentence that states its licences itself: its expression is read
(``AND``, ``OR``, ``WITH``, brackets), each licence is reported, and it counts with the category that the expression
leaves: the least restrictive of alternatives, the most restrictive of what holds together. "All rights reserved" makes
a text proprietary only where nothing grants a licence. Documents without any licence word are passed
by after one search. The work grows linearly with a text.

Defined results: null and empty texts, and texts without known sentences, have
no licences (``licenses`` empty, ``category`` none); repeated rows are scanned
each; rules are tried in their order, so ties go to the earlier; an empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import column_bytes, slices

_SENTENCE = re.compile(r"[^\n.!?;]*(?:(?:[.!?;](?![\s\"')])|(?<=\bv)\.(?= ?\d))[^\n.!?;]*)*(?:[.!?;][\"')]*|(?=\n)|$)")
#: Where parts of a notice start inside a line: "free software: you can", "Foundation, either version 3".
_PART = re.compile(r"(?<=software:)\s|(?<=,)\s(?=\s*(?:either|version)\b)", re.I)
_COMMENT = re.compile(r"^\s*(?:/\*+|\*+/?|//+|#+|--+|;+|<!--|%+|dnl\b|rem\b)\s*|\s*(?:\*/|-->)\s*$", re.I | re.M)

#: Known licence sentences after normalisation, as (identifier, pattern of the whole sentence).
SENTENCES = (
    ("spdx", r"spdx license identifier (?P<id>[a-z0-9 .+()-]+)"),
    ("apache2-grant", r"(?:this (?:work|file|software|project) is )?licensed under the apache license,? version 2(?:\.0)?(?: \(the license\))?"),
    ("apache2-short", r"(?:released|distributed|available) under the apache(?: software)? license,? (?:version )?2(?:\.0)?"),
    ("apache-comply", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at.*"),
    ("apache-asis", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis.*"),
    ("mit-short", r"(?:this (?:work|file|software|project) is )?(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit license"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("asis", r"(?:the|this) software is provided (?:by .* )?as is.*"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that.*"),
    ("bsd-source", r".*redistributions of source code must retain the above copyright notice.*"),
    ("bsd-binary", r".*redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd-endorse", r".*neither the name .* may be used to endorse or promote products.*"),
    ("bsd2-short", r"(?:released|licensed|distributed) under the (?:2-clause bsd|bsd 2-clause) license"),
    ("bsd3-short", r"(?:released|licensed|distributed) under the (?:3-clause bsd|bsd 3-clause) license"),
    ("bsd-short", r"(?:released|licensed|distributed) under the bsd license"),
    ("bsd2-title", r"bsd 2-clause (?:simplified )?license"),
    ("bsd3-title", r"bsd 3-clause (?:new or revised )?license"),
    ("mit-title", r"(?:the )?mit license(?: \(mit\))?"),
    ("apache2-title", r"apache license,? version 2(?:\.0)?(?:, january 2004)?"),
    ("isc-title", r"(?:the )?isc license(?: \(isc\))?"),
    ("isc-grant", r"permission to use, copy, modify,? and/or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("bsl1-title", r"boost software license - version 1\.0.*"),
    ("bsl1-grant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license.*"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose, including commercial applications.*"),
    ("gpl3-short", r"(?:this (?:work|file|software|project) is )?(?:released|licensed|distributed) under the gnu general public license,? (?:version|v) ?3(?:\.0)?"),
    ("gpl2-short", r"(?:this (?:work|file|software|project) is )?(?:released|licensed|distributed) under the gnu general public license,? (?:version|v) ?2(?:\.0)?"),
    ("gpl-free", r".*is free software"),
    ("gpl2-terms", r"you (?:can|may) redistribute it and/or modify it under the terms of the gnu general public license,? version 2.*"),
    ("gpl3-terms", r"you (?:can|may) redistribute it and/or modify it under the terms of the gnu general public license,? version 3.*"),
    ("gpl-terms", r"you (?:can|may) redistribute it and/or modify it under the terms of (?:version [23] of )?the gnu general public license.*"),
    ("lgpl-terms", r"you (?:can|may) redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public license.*"),
    ("agpl-terms", r"you (?:can|may) redistribute it and/or modify it under the terms of the gnu affero general public license.*"),
    ("gpl-version3", r"either version 3(?:\.0)? of the license, or.*"),
    ("gpl-version2", r"either version 2(?:\.0)? of the license, or.*"),
    ("gpl-version21", r"either version 2\.1 of the license, or.*"),
    ("gpl-only3", r"version 3(?:\.0)?(?: of the license)?"),
    ("gpl-only2", r"version 2(?:\.0)?(?: of the license)?"),
    ("lgpl-short", r"(?:released|licensed|distributed) under the gnu lesser general public license.*"),
    ("agpl-short", r"(?:this .* is )?(?:released|licensed|distributed) under the gnu affero general public license.*"),
    ("mpl2", r"this source code form is subject to the terms of the mozilla public license, v\. ?2\.0"),
    ("cc-by-nc", r"(?:this work is )?licensed under (?:a )?(?:cc by-nc|creative commons attribution-noncommercial)(?: ?4\.0)?(?: international)?(?: license)?"),
    ("cc-by-sa", r"(?:this work is )?licensed under (?:a )?(?:cc by-sa|creative commons attribution-sharealike)(?: ?4\.0)?(?: international)?(?: license)?"),
    ("cc-by", r"(?:this work is )?licensed under (?:a )?(?:cc by|creative commons attribution)(?: ?4\.0)?(?: international)?(?: license)?"),
    ("cc0", r"(?:this work is )?(?:dedicated to|released into|in) the public domain"),
    ("cc0", r".*cc0 1\.0.*"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("reserved", r"all rights reserved"),
    ("proprietary", r".*confidential and proprietary.*"),
    ("copyright", r"(?:copyright|\(c\)|©).*"),
)

#: Ordered rules (licence, category, identifiers that must follow each other, others may lie between).
RULES = (
    ("Apache-2.0", "permissive", ("apache2-grant", "apache-comply", "apache-copy", "apache-asis")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "asis")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "asis")),
    ("MIT", "permissive", ("mit-title", "mit-grant", "mit-notice", "asis")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "asis")),
    ("ISC", "permissive", ("isc-title", "isc-grant", "asis")),
    ("ISC", "permissive", ("isc-grant", "asis")),
    ("BSL-1.0", "permissive", ("bsl1-title", "bsl1-grant", "asis")),
    ("AGPL-3.0-or-later", "copyleft", ("gpl-free", "agpl-terms", "gpl-version3")),
    ("AGPL-3.0", "copyleft", ("gpl-free", "agpl-terms")),
    ("LGPL-3.0-or-later", "weak copyleft", ("gpl-free", "lgpl-terms", "gpl-version3")),
    ("LGPL-2.1-or-later", "weak copyleft", ("gpl-free", "lgpl-terms", "gpl-version21")),
    ("LGPL-2.0-or-later", "weak copyleft", ("gpl-free", "lgpl-terms", "gpl-version2")),
    ("LGPL", "weak copyleft", ("gpl-free", "lgpl-terms")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-terms", "gpl-version3")),
    ("GPL-2.0-or-later", "copyleft", ("gpl-free", "gpl-terms", "gpl-version2")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-version3")),
    ("GPL-2.0-or-later", "copyleft", ("gpl-free", "gpl-version2")),
    ("GPL-3.0-only", "copyleft", ("gpl-free", "gpl3-terms")),
    ("GPL-2.0-only", "copyleft", ("gpl-free", "gpl2-terms")),
    ("GPL-3.0-only", "copyleft", ("gpl-free", "gpl-terms", "gpl-only3")),
    ("GPL-2.0-only", "copyleft", ("gpl-free", "gpl-terms", "gpl-only2")),
    ("GPL", "copyleft", ("gpl-free", "gpl-terms")),
    ("Apache-2.0", "permissive", ("apache2-grant",)),
    ("Apache-2.0", "permissive", ("apache2-short",)),
    ("MIT", "permissive", ("mit-grant",)),
    ("MIT", "permissive", ("mit-short",)),
    ("BSD-2-Clause", "permissive", ("bsd2-short",)),
    ("BSD-3-Clause", "permissive", ("bsd3-short",)),
    ("BSD", "permissive", ("bsd-short",)),
    ("BSD-2-Clause", "permissive", ("bsd2-title",)),
    ("BSD-3-Clause", "permissive", ("bsd3-title",)),
    ("MIT", "permissive", ("mit-title",)),
    ("Apache-2.0", "permissive", ("apache2-title",)),
    ("ISC", "permissive", ("isc-title",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("BSL-1.0", "permissive", ("bsl1-title",)),
    ("BSL-1.0", "permissive", ("bsl1-grant",)),
    ("Zlib", "permissive", ("zlib-grant",)),
    ("BSD", "permissive", ("bsd-grant",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-short",)),
    ("GPL-2.0-only", "copyleft", ("gpl2-short",)),
    ("LGPL", "weak copyleft", ("lgpl-short",)),
    ("AGPL-3.0", "copyleft", ("agpl-short",)),
    ("MPL-2.0", "weak copyleft", ("mpl2",)),
    ("CC-BY-NC-4.0", "non-commercial", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa",)),
    ("CC-BY-4.0", "permissive", ("cc-by",)),
    ("Unlicense", "permissive", ("unlicense",)),
    ("CC0-1.0", "permissive", ("cc0",)),
    ("Proprietary", "proprietary", ("proprietary",)),
)
#: The rule where no other fits, and categories of SPDX identifiers by their beginnings (the first that fits).
WITHOUT_GRANT = ("Proprietary", "proprietary", "reserved")
SPDX_CATEGORIES = (
    ("CC-BY-NC", "non-commercial"), ("CC-BY-SA", "copyleft"), ("CC-BY", "permissive"), ("CC0-", "permissive"),
    ("AGPL-", "copyleft"), ("LGPL-", "weak copyleft"), ("GPL-", "copyleft"), ("MPL-", "weak copyleft"), ("EPL-", "weak copyleft"),
    ("CDDL-", "weak copyleft"), ("EUPL-", "copyleft"), ("Apache-", "permissive"), ("MIT", "permissive"), ("BSD-", "permissive"),
    ("0BSD", "permissive"), ("ISC", "permissive"), ("BSL-", "permissive"), ("Zlib", "permissive"), ("Unlicense", "permissive"),
)
#: The most restrictive category of a text's licences is its own.
CATEGORIES = ("proprietary", "non-commercial", "copyleft", "weak copyleft", "declared", "permissive")



def _over_lines(pattern: str) -> re.Pattern:
    """The pattern of a whole sentence, to be found in lines: at a line's start and end where it has no ``.*`` there."""
    first, last = pattern.startswith(".*"), pattern.endswith(".*")
    core = pattern[2 if first else 0:len(pattern) - (2 if last else 0)]
    core = re.sub(r"\[[^\]]*\]|\\.|\.\*| ", lambda m: {".*": r"[\s\S]*?", " ": r"[ \n]"}.get(m[0], m[0]), core)
    return re.compile((r"" if first else r"(?m:^)[ .!?;:,*#]*") + core + (r"" if last else r"[ .!?;:,*#]*(?m:$)"))


_KNOWN = tuple((name, _over_lines(pattern)) for name, pattern in SENTENCES)
LICENSE_SCHEMA = ("licenses array<string>, category string, sentence_ids array<string>, "
                  "spans array<struct<start:long,length:long>>, unmatched array<string>")


def normalise(piece: str) -> str:
    s = _COMMENT.sub("", piece).lower()
    s = re.sub(r"[\"'`“”‘’]|(?<=spdx)-|(?<=license)-(?=identifier)", " ", s)
    s = re.sub(r"(?<=identifier):", " ", s)
    return re.sub(r"(?<=\() | (?=\))", "", re.sub(r"\s+", " ", s)).strip()


#: A known sentence holds one of these words, however it is wrapped; texts and sentences without any need no pattern.
_HINT = re.compile(r"licen[cs]|copyright|\(c\)|©|spdx|software|permission|redistribut|domain|rights|confidential|endorse|cc0|version|gnu|"
                   r"compliance", re.I)


def _known(pieces: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Known sentences among the pieces of one sentence, the first to start before others, then in the order of ``SENTENCES``."""
    lines = "\n".join(s for _, _, s in pieces)
    if not _HINT.search(lines):
        return []
    at = list(itertools.accumulate((len(s) + 1 for _, _, s in pieces), initial=0))
    hits = sorted((bisect.bisect_right(at, m.start()) - 1, k, bisect.bisect_right(at, m.end() - 1) - 1, name)
                  for k, (name, pattern) in enumerate(_KNOWN) for m in pattern.finditer(lines))
    found, last = [], -1
    for i, _, j, name in hits:
        if i > last:
            found.append((pieces[i][0], pieces[j][1], name))
            last = j
    return found


def sentences(text: str) -> list[tuple[int, int, str]]:
    """Start, end and identifier of every known sentence, in order."""
    found, pieces = [], []
    for m in _SENTENCE.finditer(text):
        start = m.start()
        for cut in [*(c.start() for c in _PART.finditer(text, *m.span())), m.end()]:
            if s := normalise(text[start:cut]):
                pieces.append((start, cut, s))
            start = cut
        if m[0].rstrip("\"')")[-1:] in (".", "!", "?", ";"):
            found += _known(pieces)
            pieces = []
    return found + _known(pieces)


def apply_rules(ids: list[str]) -> tuple[list[tuple[str, str]], list[int]]:
    """The licences that ordered rules find in a sequence of identifiers, and the positions that they leave.

    A rule takes its first identifier's first place, then the next identifier's first place after that, and so on; then
    it is tried again on what is left. So its places only move forward, and one pass over them does.
    """
    found, places, taken = [], {}, set()
    for k, name in enumerate(ids):
        places.setdefault(name, []).append(k)
    for license_id, category, wanted in RULES:
        if any(not places.get(w) for w in wanted):
            continue
        at, used = [0] * len(wanted), []
        while True:
            last = -1
            for n, want in enumerate(wanted):
                own = places[want]
                while at[n] < len(own) and own[at[n]] <= last:
                    at[n] += 1
                if at[n] == len(own):
                    break
                last = own[at[n]]
            else:
                used.append([places[w][i] for w, i in zip(wanted, at, strict=True)])
                at = [i + 1 for i in at]
                continue
            break
        found += [(x[0], license_id, category) for x in used]
        gone = {k for x in used for k in x}
        taken |= gone
        if gone:
            for want in wanted:
                places[want] = [k for k in places[want] if k not in gone]
    left = [k for k in range(len(ids)) if k not in taken]
    return [(x, c) for _, x, c in sorted(found)], left


_SPDX = re.compile(r"spdx-license-identifier:?[ \t]*([^\n]*)", re.I)
_SPDX_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")


def spdx_category(license_id: str) -> str:
    return next((c for start, c in SPDX_CATEGORIES if license_id.lower().startswith(start.lower())), "declared")


def spdx_licenses(expression: str) -> tuple[list[str], str | None]:
    """The licences of an SPDX expression, in order, and the category that it leaves (null without a licence)."""
    tokens, names = _SPDX_TOKEN.findall(expression), []
    # Alternatives of what holds together; open brackets wait on the stack. A token like (, OR is skipped where it makes no sense.
    stack: list[list[list[str]]] = [[[]]]
    skip = False
    for token in tokens:
        word = token.upper()
        if skip:
            skip = False
        elif token == "(":
            stack.append([[]])
        elif token == ")":
            if len(stack) > 1:
                inner = _left(stack.pop())
                stack[-1][-1] += [inner] if inner else []
        elif word == "OR":
            stack[-1].append([])
        elif word == "WITH":
            skip = True  # the exception's name
        elif word != "AND":
            names.append(token)
            stack[-1][-1].append(spdx_category(token))
    while len(stack) > 1:
        inner = _left(stack.pop())
        stack[-1][-1] += [inner] if inner else []
    return names, _left(stack[0])


def _left(alternatives: list[list[str]]) -> str | None:
    """The least restrictive alternative; each is as restrictive as its most restrictive part."""
    each = [min(parts, key=CATEGORIES.index) for parts in alternatives if parts]
    return max(each, key=CATEGORIES.index, default=None)


def _scan(text: bytes) -> dict:
    t = text.decode("utf-8", "replace")
    known = sentences(t) if _HINT.search(t) else []
    ids = [name for _, _, name in known]
    found, left = apply_rules([name if name != "spdx" else "" for name in ids])
    licenses, kinds, stated = [x for x, _ in found], {c for _, c in found}, set()
    for k, (start, end, name) in enumerate(known):
        if name == "spdx" and (m := _SPDX.search(t, start, end)):
            names, category = spdx_licenses(m[1])
            if names:
                licenses += names
                kinds.add(category)
                stated.add(k)
    left = [k for k in left if k not in stated]
    if not licenses and WITHOUT_GRANT[2] in ids:
        licenses, kinds = [WITHOUT_GRANT[0]], {WITHOUT_GRANT[1]}
        left = [k for k in left if ids[k] != WITHOUT_GRANT[2]]
    return {"licenses": list(dict.fromkeys(licenses)), "category": next((c for c in CATEGORIES if c in kinds), "none"),
            "sentence_ids": ids, "spans": [{"start": a, "length": b - a} for a, b, _ in known], "unmatched": [ids[k] for k in left]}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the columns of ``LICENSE_SCHEMA`` (spans in code points)."""
    types = {"licenses": pa.list_(pa.string()), "category": pa.string(), "sentence_ids": pa.list_(pa.string()),
             "spans": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), "unmatched": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [_scan(t) for t in column_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array([x[k] for x in found], t) for k, t in types.items())], ["id", *types])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, {LICENSE_SCHEMA}").withColumnRenamed("id", id_col)
