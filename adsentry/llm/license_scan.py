"""License recognition by sentences.

A text is cut into sentences, each is normalised (A-Z lowered, everything but
letters and digits one blank) and looked up in a table of known license
sentences. The identifiers found, in their order, are then matched against
ordered rules: a rule is a run of identifiers that names a license; the first
rules are the longest, and what a rule matches is taken out before the next
one looks, so a full header is not reported again by its parts.

Two readings are matched: one where every line break ends a sentence (notices
on lines of their own) and one where it does not (headers wrapped over several
lines). Where the second holds all that the first found in one stretch, it is
matched alone: a clause wrapped over two lines then still belongs to its run.

What stands in a slot of a sentence (the owner whom a BSD clause names, the
colon of an SPDX tag) is made the same first. Only DataFrame functions are used, and every document is one
expression: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsentry.llm.common import columns_of

# Sentences of well-known license notices, as they are written.
KNOWN_SENTENCES: tuple[tuple[str, str], ...] = (
    ("apacheLicensed", "Licensed under the Apache License, Version 2.0."),
    ("apacheLicensedThe", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apacheMayNot", "you may not use this file except in compliance with the License."),
    ("apacheCopyAt", "You may obtain a copy of the License at"),
    ("apacheAsIs", "See the License for the specific language governing permissions and limitations under the License."),
    ("mitReleased", "Released under the MIT License."),
    ("mitLicensed", "Licensed under the MIT License."),
    ("mitNoticeIncluded", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl3Work", "This work is licensed under the GNU General Public License, version 3."),
    ("gplFree", "This program is free software:"),
    ("gplRedistribute3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gplCopy", "You should have received a copy of the GNU General Public License along with this program."),
    ("bsdRetain", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsdReproduce", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ccByNc4", "Licensed under CC BY-NC 4.0."),
    ("ccBy4", "Licensed under CC BY 4.0."),
    ("ccBySa4", "Licensed under CC BY-SA 4.0."),
    ("mpl2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("allRights", "All rights reserved."),
    ("mitGrant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("iscGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("iscGrant", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd0Grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("iscDisclaims", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    *(
        ("bsdNeither", f"Neither the name of {owner} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
        for owner in ("the copyright holder", "the copyright holders", "the <organization>", "the organization", "the author", "the project", "the University", "the company")
    ),
    ("zlibGrant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("boostNotice", "Distributed under the Boost Software License, Version 1.0."),
    ("boostGrant", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("unlicenseFree", "This is free and unencumbered software released into the public domain."),
    ("unlicenseAnyone", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc0Dedicated", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("cc0Waived", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."),
    ("cc0Copy", "You should have received a copy of the CC0 Public Domain Dedication along with this software."),
    ("epl2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("epl2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-v20.html"),
    ("epl1", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("lgplFree", "This library is free software;"),
)

# The GNU headers: name, identifier, versions. The terms are one sentence
# (version after a comma) or two (after a semicolon).
GNU = (
    ("GNU General Public License", "gpl", ("1", "2", "3")),
    ("GNU Library General Public License", "lgplLibrary", ("2",)),
    ("GNU Lesser General Public License", "lgpl", ("2.1", "3")),
    ("GNU Affero General Public License", "agpl", ("3",)),
)
_TERMS = "you can redistribute it and/or modify it under the terms of the "
_LATER = "either version {v} of the License, or (at your option) any later version."
_BY = " as published by the Free Software Foundation"
KNOWN_SENTENCES += tuple(
    row
    for name, ident, versions in GNU
    for row in (
        (f"{ident}Redistribute", f"{_TERMS}{name}{_BY};"),
        *((f"{ident}Later{v}", f"{_TERMS}{name}{_BY}, {_LATER.format(v=v)}") for v in versions if (ident, v) != ("gpl", "3")),
        *((f"{ident}Only{v}", f"{_TERMS}{name}{_BY}, version {v} of the License.") for v in versions),
        *((f"{ident}Only{v}", f"{_TERMS}{name}{_BY}, version {v}.") for v in versions),
        *((f"{ident}Only{v}", f"{_TERMS}{name} version {v}{_BY}.") for v in versions),
        *((f"{ident}Only{v}", f"{_TERMS}{name}, version {v},{_BY}.") for v in versions),
    )
) + tuple(
    row
    for v in ("1", "2", "2.1", "3")
    for row in ((f"eitherLater{v}", _LATER.format(v=v)), (f"versionOnly{v}", f"version {v} of the License."))
)

# "This project is licensed under the ... License." and its usual forms:
# license, class, identifier, names it goes by.
NAMED: tuple[tuple[str, str, str, tuple[str, ...]], ...] = (
    ("MIT", "permissive", "namedMit", ("the MIT License", "the MIT license (MIT)", "MIT")),
    ("ISC", "permissive", "namedIsc", ("the ISC License",)),
    ("Apache-2.0", "permissive", "namedApache2", ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache-2.0")),
    ("BSD-3-Clause", "permissive", "namedBsd3", ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License")),
    ("BSD-2-Clause", "permissive", "namedBsd2", ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License")),
    ("AGPL-3.0-only", "copyleft", "namedAgpl3", ("the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPLv3", "the AGPLv3")),
    ("LGPL-2.1-only", "copyleft", "namedLgpl21", ("the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the LGPLv2.1")),
    ("LGPL-3.0-only", "copyleft", "namedLgpl3", ("the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the LGPLv3")),
    ("GPL-2.0-only", "copyleft", "namedGpl2", ("the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GPLv2")),
    ("GPL-3.0-only", "copyleft", "namedGpl3", ("the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GPLv3")),
    ("MPL-2.0", "copyleft", "namedMpl2", ("the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0")),
    ("EPL-2.0", "copyleft", "namedEpl2", ("the Eclipse Public License 2.0", "the Eclipse Public License v2.0")),
    ("BSL-1.0", "permissive", "namedBoost", ("the Boost Software License 1.0",)),
    ("Zlib", "permissive", "namedZlib", ("the zlib License",)),
    ("Unlicense", "permissive", "namedUnlicense", ("the Unlicense",)),
    ("CC0-1.0", "permissive", "namedCc0", ("CC0 1.0", "CC0 1.0 Universal", "the CC0 1.0 Universal license")),
    ("CC-BY-NC-SA-4.0", "noncommercial", "namedCcByNcSa4", ("CC BY-NC-SA 4.0",)),
    ("CC-BY-NC-ND-4.0", "noncommercial", "namedCcByNcNd4", ("CC BY-NC-ND 4.0",)),
    ("CC-BY-NC-4.0", "noncommercial", "namedCcByNc4", ("CC BY-NC 4.0",)),
    ("CC-BY-SA-4.0", "copyleft", "namedCcBySa4", ("CC BY-SA 4.0",)),
    ("CC-BY-4.0", "permissive", "namedCcBy4", ("CC BY 4.0", "the Creative Commons Attribution 4.0 International License")),
)
_SUBJECTS = ("", "This project is ", "This file is ", "This software is ", "This work is ", "This program is ", "This library is ", "This code is ")
KNOWN_SENTENCES += tuple(
    (ident, f"{subject}{verb} under {name}.")
    for _, _, ident, names in NAMED
    for name in names
    for verb in ("licensed", "released", "distributed")
    for subject in _SUBJECTS
)

# Ordered rules: (license, class, run of sentence identifiers).
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("Apache-2.0", "permissive", ("apacheLicensedThe", "apacheMayNot", "apacheCopyAt", "apacheAsIs")),
    ("Apache-2.0", "permissive", ("apacheLicensedThe", "apacheMayNot", "apacheCopyAt")),
    ("Apache-2.0", "permissive", ("apacheLicensedThe", "apacheMayNot")),
    ("BSD-3-Clause", "permissive", ("bsdRetain", "bsdReproduce", "bsdNeither")),
    ("BSD-2-Clause", "permissive", ("bsdRetain", "bsdReproduce")),
    ("GPL-3.0-or-later", "copyleft", ("gplFree", "gplRedistribute3", "gplCopy")),
    ("GPL-3.0-or-later", "copyleft", ("gplFree", "gplRedistribute3")),
    ("Apache-2.0", "permissive", ("apacheLicensed",)),
    ("Apache-2.0", "permissive", ("apacheLicensedThe",)),
    ("MIT", "permissive", ("mitReleased",)),
    ("MIT", "permissive", ("mitLicensed",)),
    ("MIT", "permissive", ("mitNoticeIncluded",)),
    ("GPL-3.0-only", "copyleft", ("gpl3Work",)),
    ("CC-BY-NC-4.0", "noncommercial", ("ccByNc4",)),
    ("CC-BY-4.0", "permissive", ("ccBy4",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccBySa4",)),
    ("MPL-2.0", "copyleft", ("mpl2",)),
    ("0BSD", "permissive", ("bsd0Grant", "iscDisclaims")),
    ("0BSD", "permissive", ("bsd0Grant",)),
    ("ISC", "permissive", ("iscGrant", "iscDisclaims")),
    ("ISC", "permissive", ("iscGrant",)),
    ("MIT", "permissive", ("mitGrant",)),
    ("Zlib", "permissive", ("zlibGrant",)),
    ("BSL-1.0", "permissive", ("boostNotice",)),
    ("BSL-1.0", "permissive", ("boostGrant",)),
    ("Unlicense", "permissive", ("unlicenseFree",)),
    ("Unlicense", "permissive", ("unlicenseAnyone",)),
    ("CC0-1.0", "permissive", ("cc0Dedicated",)),
    ("CC0-1.0", "permissive", ("cc0Waived",)),
    ("CC0-1.0", "permissive", ("cc0Copy",)),
    ("EPL-2.0", "copyleft", ("epl2",)),
    ("EPL-1.0", "copyleft", ("epl1",)),
    ("GPL-3.0-or-later", "copyleft", ("gplRedistribute3",)),
    *(
        (f"{ident.removesuffix('Library').upper()}-{v if '.' in v else v + '.0'}-{kind}", "copyleft", run)
        for _, ident, versions in GNU
        for v in versions
        for kind, run in (
            ("or-later", (f"{ident}Redistribute", f"eitherLater{v}")),
            ("only", (f"{ident}Redistribute", f"versionOnly{v}")),
            ("only", (f"{ident}Only{v}",)),
            *((("or-later", (f"{ident}Later{v}",)),) if (ident, v) != ("gpl", "3") else ()),
        )
    ),
    *((name, kind, (ident,)) for name, kind, ident, _ in NAMED),
)

# "SPDX-License-Identifier: <license>" for every license above (one license, no expression).
_LICENSES = dict.fromkeys((name, kind) for name, kind, _ in RULES)
KNOWN_SENTENCES += tuple((f"spdx-{name}", f"SPDX-License-Identifier {name}") for name, _ in _LICENSES)
RULES += tuple((name, kind, (f"spdx-{name}",)) for name, kind in _LICENSES)

# Slots: what they look like in a lowered text, and the form in the table.
SLOTS = (
    (r"license-identifier:[ \t]+", "license-identifier "),
    (r"neither the name of [^\n]{1,200}? nor the names of its contributors",
     "neither the name of the copyright holder nor the names of its contributors"),
)

# Every known sentence holds one of these, so other texts need no cutting.
ANCHORS = (
    "licen", "copyright", "free software", "reserved", "permission", "public domain", "warranties", "anyone is free",
    "released under", "distributed under", "free software foundation",
)

SENTENCE_END = r"([.;:!?])[ \t\r]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalise(sentence: str) -> str:
    """The form a sentence is looked up by (same as ``_sentences``)."""
    lowered = sentence.translate(str.maketrans(_UPPER, _LOWER))
    return re.sub(r"[^a-z0-9]+", " ", lowered).strip(" ")


def sentence_table(known: Sequence[tuple[str, str]] = KNOWN_SENTENCES) -> dict[str, str]:
    """Normalised text -> identifier. A known sentence may itself be cut
    (``v. 2.0``): its pieces are then known by ``id/1``, ``id/2``, ..."""
    table: dict[str, str] = {}
    for ident, text in known:
        pieces = [normalise(p) for p in re.sub(SENTENCE_END, "\\1\n", text).split("\n")]
        if not any(a in text.translate(str.maketrans(_UPPER, _LOWER)) for a in ANCHORS) and ident not in ("apacheCopyAt",):
            raise ValueError(f"no anchor in {ident}")
        for n, piece in enumerate(pieces, 1):
            table.setdefault(piece, ident if len(pieces) == 1 else f"{ident}/{n}")
    return table


def rule_runs(rules=RULES, known=KNOWN_SENTENCES) -> list[tuple[str, str, str]]:
    """``(license, class, run)`` with the run as text: ``|id|id|``."""
    pieces = {i: len(re.sub(SENTENCE_END, "\\1\n", t).split("\n")) for i, t in known}
    out = []
    for name, kind, idents in rules:
        flat = [i if pieces[i] == 1 else f"{i}/{n}" for i in idents for n in range(1, pieces[i] + 1)]
        out.append((name, kind, "|" + "||".join(flat) + "|"))
    return out


def _sentences(text: Column) -> Column:
    for pattern, form in SLOTS:
        text = F.regexp_replace(text, pattern, form)
    cut = F.split(F.regexp_replace(text, SENTENCE_END, "$1\n"), "\n")
    return F.transform(cut, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: Sequence[tuple[str, str]] = KNOWN_SENTENCES,
    rules=RULES,
) -> DataFrame:
    """One row per document: ``doc_id, sentence_ids, licenses, license_class``.

    ``sentence_ids`` are the known sentences of the line-wise reading, in
    order and joined by commas; ``licenses`` the distinct licenses of the
    readings matched in the order of the rules; ``license_class`` the strictest class
    met (noncommercial, copyleft, permissive; ``unknown`` if known sentences
    matched no rule; ``none``). Null and empty texts hold nothing. Repeated
    rows are scanned each; an empty table gives none.
    """
    table = sentence_table(known)
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    text = F.translate(F.coalesce("_text", F.lit("")), _UPPER, _LOWER)
    anchored = F.lit(False)
    for a in ANCHORS:
        anchored = anchored | F.contains("_low", F.lit(a))
    empty = F.array().cast("array<string>")

    def run_of(reading: Column) -> Column:
        found = F.filter(_sentences(reading), lambda s: s.isin(*table))
        return F.when(F.col("_any"), F.transform(found, lambda s: F.element_at(lookup, s))).otherwise(empty)

    wrap = lambda ids: F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    within = F.contains(wrap(F.col("_wrapped")), wrap(F.col("_lines")))
    df = (
        columns_of(docs, _id=id_col, _text=text_col)
        .withColumn("_low", text)
        .withColumn("_any", anchored)
        .withColumn("_lines", run_of(F.col("_low")))
        .withColumn("_wrapped", run_of(F.replace(F.col("_low"), F.lit("\n"), F.lit(" "))))
        .withColumn("_seq", F.concat(F.when(within, F.lit("")).otherwise(wrap(F.col("_lines"))), F.lit("~"), wrap(F.col("_wrapped"))))
        .select("_id", "_lines", "_seq")
    )
    runs = rule_runs(rules, known)
    # Each rule looks at what the earlier ones left; a match leaves a break.
    state = F.struct(F.col("_seq").alias("left"), empty.alias("names"), empty.alias("kinds"))
    rule_list = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("k"), F.lit(r).alias("r")) for n, k, r in runs])
    hit = F.aggregate(
        rule_list,
        state,
        lambda acc, r: F.when(
            F.contains(acc["left"], r["r"]),
            F.struct(
                F.replace(acc["left"], r["r"], F.lit("~")).alias("left"),
                F.array_union(acc["names"], F.array(r["n"])).alias("names"),
                F.array_union(acc["kinds"], F.array(r["k"])).alias("kinds"),
            ),
        ).otherwise(acc),
    )
    nothing = F.struct(F.col("_seq").alias("left"), empty.alias("names"), empty.alias("kinds"))
    kinds = F.col("_hit.kinds")
    return df.withColumn("_hit", F.when(F.col("_seq") != "~", hit).otherwise(nothing)).select(
        F.col("_id").alias("doc_id"),
        F.array_join("_lines", ",").alias("sentence_ids"),
        F.array_join("_hit.names", ",").alias("licenses"),
        F.when(F.array_contains(kinds, "noncommercial"), "noncommercial")
        .when(F.array_contains(kinds, "copyleft"), "copyleft")
        .when(F.array_contains(kinds, "permissive"), "permissive")
        .when(F.col("_seq") != "~", "unknown")
        .otherwise("none")
        .alias("license_class"),
    )
