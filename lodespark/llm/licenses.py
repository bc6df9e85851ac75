"""Licences of files, in DataFrame operations only: notices by cosine, then directories.

Texts without any of the words that a notice cannot do without are set aside first; they cannot reach the
threshold. Of the others each line and paragraph is compared with templates of notices, and windows of
words with headers and texts of licences, which are wrapped and commented, each as long as the template:
by the cosine of sparse vectors, whose terms weigh their inverse document frequency over the templates.

All that is found decides: an SPDX line first, then the highest score, the longer template, the first name. A
template that is but a part of another licence's text, as the first sentence of the BSD licences, counts
only if nothing else is found. A file without a notice inherits from the licence
file in the nearest directory above.

Defined cases: a null or empty text has no notice; rows that repeat a path share the best notice among
them and come as often as they do; a null path has no directory and inherits nothing, and neither do
files outside any directory with a licence file. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import textwrap
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodespark.staging import stage

# Names and notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification,"
     " are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
     " without fee is hereby granted"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
     " software and associated documentation files"),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_BSD_END = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED"
            " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution.")
_BSD_NAMES = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse"
              " or promote products derived from this software without specific prior written permission.")
_ANY_PURPOSE = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
                " is hereby granted")
_NO_WARRANTY = (" THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
                " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.")
_COPIES = (" Everyone is permitted to copy and distribute verbatim copies of this license document, but"
           " changing it is not allowed.")


def _gnu(subject: str, name: str, version: str) -> str:
    return (f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the"
            f" GNU {name} as published by the Free Software Foundation, either version {version} of the"
            " License, or (at your option) any later version.")


# Headers of files, heads of licence files, and short licences, compared with windows of as many words.
HEADERS = (
    ("0BSD", _ANY_PURPOSE + "." + _NO_WARRANTY),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES"
     " NOT PROVIDE LEGAL SERVICES."),
    ("EPL-2.0", "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE. ANY USE,"
     " REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public"
     " License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0"),
    ("ISC", _ANY_PURPOSE + ", provided that the above copyright notice and this permission notice appear in all"
     " copies." + _NO_WARRANTY),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors"
     " be held liable for any damages arising from the use of this software. Permission is granted to anyone to use"
     " this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("AGPL-3.0", _gnu("program", "Affero General Public License", "3")),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free"
     " Software Foundation, Inc. <https://fsf.org/>" + _COPIES),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
     " except in compliance with the License. You may obtain a copy of the License at"
     " http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND"
     " CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of"
     " conditions and the following disclaimer in the documentation and/or other materials provided with"
     " the distribution." + _BSD_END),
    ("BSD-3-Clause", "the names of its contributors may be used to endorse or promote products derived from"
     " this software without specific prior written permission." + _BSD_END),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification,"
     " are permitted provided that the following conditions are met"),
    ("GPL-2.0", _gnu("program", "General Public License", "2")),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software"
     " Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA" + _COPIES),
    ("GPL-3.0", _gnu("program", "General Public License", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software"
     " Foundation, Inc. <https://fsf.org/>" + _COPIES),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
     " without fee is hereby granted, provided that the above copyright notice and this permission notice"
     " appear in all copies."),
    ("LGPL-2.1", _gnu("library", "Lesser General Public License", "2.1")),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free"
     " Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA" + _COPIES),
    ("LGPL-3.0", _gnu("library", "Lesser General Public License", "3")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software"
     " Foundation, Inc. <https://fsf.org/>" + _COPIES),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
     " software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
     " copy of the MPL was not distributed with this file, You can obtain one at"
     " http://mozilla.org/MPL/2.0/."),
)
# Words between the starts of two windows; a window is at most half of that off.
STRIDE = 4
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+(?:[ \t()]+[A-Za-z0-9.+-]+)*)"
THRESHOLD = 0.8
# Words that prose has often; shorter words than this are sought between others than letters and digits.
OFTEN = frozenset("a an and any are as at be but by for from if in is it its not of on or that the this to under which with you".split())
LONG = 4
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"
TERM = r"[a-z0-9]+"


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), 0))


def _words(notice: str) -> list[str]:
    return re.findall(TERM, notice.lower())


def _shared(licence: str, notice: str) -> bool:
    """Whether a template is part of another licence's text, which has all its terms and half as many more."""
    own = set(_words(notice))
    others = (set(_words(text)) for other, text in HEADERS if other != licence)
    return any(own < other and len(other) >= 1.5 * len(own) for other in others)


def _squares(notices: list[str]) -> tuple[dict[str, float], float]:
    """Squared weights of the terms of some templates, and of a term in none of them."""
    counted = Counter(t for notice in notices for t in set(_words(notice)))
    whole = math.log(1.0 + len(notices))
    return {t: (whole - math.log(1.0 + n) + 1) ** 2 for t, n in counted.items()}, (whole + 1) ** 2


def _needed(groups: list[list[str]], threshold: float) -> list[str]:
    """Terms of which a text has one if its cosine with any template of the groups reaches the threshold.

    What a text shares with a template, in squared weights, is at least the squared cosine times that of
    the template, so no more than the rest of it may be missing. Terms that serve most templates are
    taken first, but those that prose has often, and short ones, only where others do not do.
    """
    open_: list[tuple[dict[str, float], float]] = []
    for notices in groups:
        squares, _ = _squares(notices)
        for notice in notices:
            own = set(_words(notice))
            total = sum(squares[t] for t in own)
            open_.append(({t: squares[t] / total for t in own}, 1 - threshold**2 + 1e-9))
    needed: list[str] = []
    while open_ := [(shares, left) for shares, left in open_ if left > 0 and shares]:
        gain: Counter[str] = Counter()
        for shares, left in open_:
            for term, share in shares.items():
                gain[term] += min(share, left)
        best = max(gain, key=lambda t: (t not in OFTEN, len(t) >= LONG, t.isalpha(), gain[t], t))
        needed.append(best)
        open_ = [({t: s for t, s in shares.items() if t != best}, left - shares.get(best, 0)) for shares, left in open_]
    return needed


def hopeful(files: DataFrame, templates: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``path, text`` of the files that may hold a notice: one pass over all texts."""
    terms = _needed([templates, [notice for _, notice in HEADERS]], threshold)
    long = [t for t in terms if len(t) >= LONG] + ["spdx-license-identifier:"]
    short = [t for t in terms if len(t) < LONG]

    def possible(low: Column) -> Column:
        found = reduce(or_, (low.contains(t) for t in long))
        return found | low.rlike(rf"(?<![a-z0-9])(?:{'|'.join(short)})(?![a-z0-9])") if short else found

    # The text is put in lower case once, and then searched for each term.
    some = F.exists(F.array(F.lower("text")), possible)
    return files.where("path is not null and text is not null").where(some).select("path", "text")


def template_terms(templates: DataFrame) -> DataFrame:
    """``licence, template, term, weight, idf``: unit vectors of the templates."""
    vectors = templates.select("licence", "template", F.explode(_terms(F.col("notice"))).alias("term"))
    total = templates.count()
    # Not in the logarithm of a division, so that other engines find the same last digits.
    idf = (F.log(F.lit(1.0 + total)) - F.log(1.0 + F.count("*")) + 1).alias("idf")
    weighed = vectors.join(vectors.groupBy("term").agg(idf), "term")
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))
    return weighed.join(norms, "template").select(
        "licence", "template", "term", "idf", (F.col("idf") / F.col("norm")).alias("weight")
    )


def candidates(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``path, licence, score, template`` of lines and paragraphs that are like a template."""
    weights = stage(template_terms(templates))
    known = {r["term"]: r["idf"] for r in weights.select("term", "idf").distinct().collect()}
    if not known:
        return files.select("path", F.lit("").alias("licence"), F.lit(0.0).alias("score"), F.lit(0).alias("template")).limit(0)
    rare = math.log(1.0 + templates.count()) + 1  # weight of a term in no template
    idf = F.create_map(*(F.lit(x) for term in known.items() for x in term))
    passages = F.concat(
        F.split("text", "\n"),
        F.filter(F.split("text", r"\n[ \t\r]*\n"), lambda p: F.contains(p, F.lit("\n"))),
    )
    terms = (
        files.select("path", F.posexplode(passages).alias("place", "passage"))
        .select("path", "place", _terms(F.col("passage")).alias("terms"))
    )
    shared = terms.withColumn("shared", F.array_intersect("terms", F.lit(list(known))))
    other = F.size("terms") - F.size("shared")
    # The shared terms weigh less than a term in no template each.
    possible = F.size("shared") * (1 - threshold**2) >= threshold**2 * other
    square = F.aggregate(
        "shared", other * F.lit(rare**2), lambda sum_, t: sum_ + F.pow(F.element_at(idf, t), 2.0)
    )
    return (
        shared.where((F.size("shared") > 0) & possible)
        .select("path", "place", F.sqrt(square).alias("norm"), F.explode("shared").alias("term"))
        .join(weights, "term")
        .groupBy("path", "place", "licence", "template")
        .agg((F.sum(F.col("idf") * F.col("weight")) / F.first("norm")).alias("cosine"))
        .select("path", "licence", F.round("cosine", 9).alias("score"), "template")
        .where(F.col("score") >= threshold)
    )


def notices(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``path, licence, score``: the best template of the files (path, text) that are like one."""
    few = [r["notice"] for r in templates.select("notice").collect()]
    found = candidates(hopeful(files, few, threshold), templates, threshold)
    best = found.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("by"), "licence")).alias("best"))
    return best.select("path", "best.licence", (-F.col("best.by")).alias("score"))


def headers(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``path, licence, score, header`` of windows of files (path, text) that are like one of ``HEADERS``."""
    squares, rare = _squares([notice for _, notice in HEADERS])
    weights = F.create_map(*(F.lit(x) for known in squares.items() for x in known))
    known = []
    for number, (licence, notice) in enumerate(HEADERS):
        words = _words(notice)
        known.append(
            F.struct(
                F.lit(licence).alias("licence"),
                F.lit(number).alias("number"),
                F.lit(len(words)).alias("length"),
                F.lit(sum(squares[t] for t in set(words))).alias("square"),
                F.lit(sorted(set(words))).alias("terms"),
            )
        )

    def shared(terms: Column) -> Column:
        """Squared weight of the terms that the header has too."""
        return F.aggregate(
            F.array_intersect(terms, F.col("header.terms")),
            F.lit(0.0),
            lambda sum_, t: sum_ + F.element_at(weights, t),
        )

    def norm(terms: Column) -> Column:
        return F.sqrt(
            F.aggregate(
                terms,
                F.lit(0.0),
                lambda sum_, t: sum_ + F.coalesce(F.try_element_at(weights, t), F.lit(rare)),
            )
        )

    # Marks of comments are no terms, except for these two words.
    every = F.lit(sorted(squares))
    plain = F.regexp_replace(F.lower("text"), r"(?m)^[ \t]*(?:rem|dnl)\b", "")
    starts = F.expr(f"sequence(1, greatest(1, size(terms) - header.length + {STRIDE}), {STRIDE})")
    window = F.array_distinct(F.slice("terms", F.col("start"), F.col("header.length")))
    score = F.round(shared(F.col("window")) / norm(F.col("window")) / F.sqrt("header.square"), 9)
    return (
        files.select("path", F.regexp_extract_all(plain, F.lit(TERM), 0).alias("terms"))
        .withColumn("some", F.array_intersect("terms", every))
        .select("path", "terms", "some", F.explode(F.array(*known)).alias("header"))
        .where(shared(F.col("some")) >= threshold**2 * F.col("header.square") * (1 - 1e-9))
        .select("path", "terms", "header", F.explode(starts).alias("start"))
        .select("path", "header", window.alias("window"))
        .select("path", "header.licence", score.alias("score"), F.col("header.number").alias("header"))
        .where(F.col("score") >= threshold)
    )


def best_notices(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``path, licence, score``: what decides of all that is found in the files (path, text)."""
    few = templates.select("template", "licence", "notice").collect()
    texts = stage(hopeful(files, [r["notice"] for r in few], threshold))
    lower = F.lower("text")
    spdx = texts.where(F.contains(lower, F.lit("spdx-license-identifier:"))).select(
        "path", F.trim(F.regexp_extract("text", SPDX, 1)).alias("licence"), F.lit(1.0).alias("score"),
        F.lit(0).alias("rank"), F.lit(0).alias("length"),
    ).where("licence != ''")

    def ranked(found: DataFrame, number: str, rows: list[tuple]) -> DataFrame:
        """Rank and length of the template by its number."""
        facts = [(n, 2 if _shared(licence, notice) else 1, len(_words(notice))) for n, licence, notice in rows]
        # As many rows as there are templates.
        table = found.sparkSession.createDataFrame(facts, f"{number} int, rank int, length int")
        return found.join(F.broadcast(table), number).select("path", "licence", "score", "rank", "length")

    found = spdx.unionByName(ranked(candidates(texts, templates, threshold), "template", [tuple(r) for r in few]))
    found = found.unionByName(ranked(headers(texts, threshold), "header", [(n, *h) for n, h in enumerate(HEADERS)]))
    order = F.struct("rank", (-F.col("score")).alias("by"), (-F.col("length")).alias("short"), "licence")
    best = found.groupBy("path").agg(F.min(order).alias("best"))
    return best.select("path", "best.licence", (-F.col("best.by")).alias("score"))


def scan(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``path, notice, score, licence, inherited_from`` for every row of ``files`` (path, text).

    ``templates`` has ``licence, template, notice``, a few rows. ``licence`` is the notice's, or
    that of the licence file in the nearest directory above, which ``inherited_from`` names.
    """
    found = stage(best_notices(files, templates, threshold))
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    owners = (
        found.where(name.rlike(LICENCE_FILE))
        .withColumn("folder", folder)
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("score")).alias("by"), "licence", "path")).alias("best"))
        .select(F.col("folder").alias("above"), "best.licence", F.col("best.path").alias("owner"))
    )
    rows = files.select("path").withColumn("folder", folder)
    parts = F.split("folder", "/")
    ancestors = F.transform(
        parts, lambda _, n: F.concat_ws("/", F.slice(parts, F.lit(1), n + 1))
    )
    # Directories, not files, meet their ancestors: one row for each directory and level.
    above = (
        rows.select("folder")
        .distinct()
        .select("folder", F.posexplode(ancestors).alias("depth", "above"))
    )
    inherited = (
        above.join(owners, "above")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "licence", "owner")).alias("nearest"))
        .select("folder", "nearest.licence", "nearest.owner")
        .withColumnRenamed("licence", "inherited")
    )
    return (
        rows.join(found.withColumnRenamed("licence", "notice"), "path", "left")
        .join(inherited, "folder", "left")
        .select(
            "path",
            "notice",
            "score",
            F.coalesce("notice", "inherited").alias("licence"),
            F.when(F.col("notice").isNull(), F.col("owner")).alias("inherited_from"),
        )
    )


# Files beside those of the documents, which hold no licence texts: (path, text).
PLANTED = (
    ("planted/two/LICENSE", "Copyright (c) X\n\n" + textwrap.fill(_BSD, 70) + "\n" + textwrap.fill(_BSD_END, 70)),
    ("planted/two/code.c", "int x;"),
    ("planted/three/LICENSE", "Copyright (c) X\n\n" + textwrap.fill(_BSD + _BSD_NAMES + _BSD_END, 60)),
    ("planted/spdx.c", "// SPDX-License-Identifier: BSD-2-Clause\n// " + TEMPLATES[1][1]),
    ("planted/sentence.c", "// " + TEMPLATES[1][1]),
    ("planted/zlib.h", "/*\n * " + "\n * ".join(textwrap.wrap(dict(HEADERS)["Zlib"], 60)) + "\n */"),
    ("planted/zero.txt", textwrap.fill(dict(HEADERS)["0BSD"], 66)),
    ("planted/isc.txt", textwrap.fill(_ANY_PURPOSE + ", provided that the above copyright notice and this permission"
     " notice appear in all copies." + _NO_WARRANTY, 66)),
)

# The same in SQL over the tree that ``document_files`` makes of the documents, and those files.
SQL = r"""
WITH templates AS (
  SELECT unnest(%(licences)s) AS licence, unnest(range(%(n)d)) AS template, unnest(%(notices)s) AS notice,
    unnest(%(ranks)s) AS rank),
vectors AS (
  SELECT licence, template,
    unnest(list_distinct(regexp_extract_all(lower(notice), '[a-z0-9]+'))) AS term FROM templates),
known AS (SELECT term, ln(1.0 + %(n)d) - ln(1.0 + count(*)) + 1 AS idf FROM vectors GROUP BY term),
norms AS (
  SELECT template, sqrt(sum(idf * idf)) AS norm FROM vectors JOIN known USING (term) GROUP BY template),
weights AS (
  SELECT licence, template, term, idf, idf / norm AS weight
  FROM vectors JOIN known USING (term) JOIN norms USING (template)),
numbered AS (
  SELECT doc_id // 100 AS above, doc_id // 10 AS below, doc_id, text FROM documents),
files AS (
  SELECT text, CASE WHEN doc_id %% 100 = 0 THEN 'corpus/' || above || '/LICENSE'
    WHEN doc_id %% 10 = 0 THEN 'corpus/' || above || '/' || below || '/LICENSE'
    ELSE 'corpus/' || above || '/' || below || '/' || doc_id || '.txt' END AS path FROM numbered
  UNION ALL SELECT unnest(%(planted_texts)s), unnest(%(planted_paths)s)),
passages AS (
  SELECT path, unnest(list_concat(string_split(text, chr(10)),
    list_filter(string_split_regex(text, '\n[ \t\r]*\n'), lambda p: contains(p, chr(10))))) AS passage
  FROM files WHERE path IS NOT NULL AND text IS NOT NULL),
placed AS (SELECT path, passage, row_number() OVER () AS place FROM passages),
terms AS (
  SELECT path, place,
    unnest(list_distinct(regexp_extract_all(lower(passage), '[a-z0-9]+'))) AS term FROM placed),
lengths AS (
  SELECT place, sqrt(sum(coalesce(idf, ln(1.0 + %(n)d) + 1) ** 2)) AS norm
  FROM terms LEFT JOIN known USING (term) GROUP BY place),
scored AS (
  SELECT path, licence, template, round(sum(idf * weight) / first(norm), 9) AS score
  FROM terms JOIN weights USING (term) JOIN lengths USING (place)
  GROUP BY path, place, licence, template),
headers AS (
  SELECT unnest(%(header_licences)s) AS licence, unnest(range(%(h)d)) AS header, unnest(%(headers)s) AS notice,
    unnest(%(header_ranks)s) AS rank),
header_words AS (
  SELECT licence, header, rank, regexp_extract_all(lower(notice), '[a-z0-9]+') AS words FROM headers),
header_terms AS (SELECT header, unnest(list_distinct(words)) AS term FROM header_words),
squares AS (SELECT term, (ln(1.0 + %(h)d) - ln(1.0 + count(*)) + 1) ** 2 AS square FROM header_terms GROUP BY term),
totals AS (SELECT header, sum(square) AS total FROM header_terms JOIN squares USING (term) GROUP BY header),
tokens AS (
  SELECT row_number() OVER () AS file, path, regexp_extract_all(
    regexp_replace(lower(text), '(?m)^[ \t]*(?:rem|dnl)\b', '', 'g'), '[a-z0-9]+') AS words
  FROM files WHERE path IS NOT NULL AND text IS NOT NULL),
token_terms AS (SELECT file, unnest(list_distinct(words)) AS term FROM tokens),
pairs AS (
  SELECT file, header FROM token_terms JOIN header_terms USING (term) JOIN squares USING (term)
  JOIN totals USING (header) GROUP BY file, header, total
  HAVING sum(square) >= %(threshold)s ** 2 * total * (1 - 1e-9)),
starts AS (
  SELECT file, header, unnest(range(1, greatest(1, len(t.words) - len(w.words) + %(stride)d) + 1, %(stride)d)) AS start
  FROM pairs JOIN tokens t USING (file) JOIN header_words w USING (header)),
windows AS (
  SELECT file, header, start, unnest(list_distinct(t.words[start : start + len(w.words) - 1])) AS term
  FROM starts JOIN tokens t USING (file) JOIN header_words w USING (header)),
windows_scored AS (
  SELECT v.file, v.header, round(sum(square) FILTER (h.term IS NOT NULL)
      / sqrt(sum(coalesce(square, (ln(1.0 + %(h)d) + 1) ** 2))) / sqrt(first(total)), 9) AS score
  FROM windows v LEFT JOIN squares USING (term)
  LEFT JOIN header_terms h ON v.header = h.header AND v.term = h.term
  JOIN totals t ON v.header = t.header GROUP BY v.file, v.header, v.start),
evidence AS (
  SELECT path, trim(regexp_extract(text, '%(spdx)s', 1)) AS licence, 1.0::DOUBLE AS score, 0 AS rank, 0 AS length
  FROM files WHERE path IS NOT NULL AND contains(lower(text), 'spdx-license-identifier:')
    AND regexp_extract(text, '%(spdx)s', 1) <> ''
  UNION ALL SELECT path, t.licence, score, rank, len(regexp_extract_all(lower(notice), '[a-z0-9]+'))
  FROM scored JOIN templates t USING (template) WHERE score >= %(threshold)s
  UNION ALL SELECT path, licence, score, rank, len(w.words)
  FROM windows_scored JOIN tokens USING (file) JOIN header_words w USING (header) WHERE score >= %(threshold)s),
found AS (
  SELECT path, first(licence ORDER BY rank, score DESC, length DESC, licence) AS notice,
    first(score ORDER BY rank, score DESC, length DESC, licence) AS score
  FROM evidence GROUP BY path),
owners AS (
  SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, path, notice FROM found
  WHERE path LIKE '%%/LICENSE'),
above AS (
  SELECT f.path, first(o.notice ORDER BY length(o.folder) DESC) AS inherited,
    first(o.path ORDER BY length(o.folder) DESC) AS owner
  FROM files f JOIN owners o ON starts_with(f.path, o.folder || '/') GROUP BY f.path)
SELECT f.path, notice, score, coalesce(notice, inherited) AS licence,
  CASE WHEN notice IS NULL THEN owner END AS inherited_from
FROM files f LEFT JOIN found ON f.path = found.path LEFT JOIN above ON f.path = above.path
""" % {
    "licences": [licence for licence, _ in TEMPLATES],
    "notices": [notice for _, notice in TEMPLATES],
    "ranks": [2 if _shared(*t) else 1 for t in TEMPLATES],
    "n": len(TEMPLATES),
    "header_licences": [licence for licence, _ in HEADERS],
    "headers": [notice.replace("'", " ") for _, notice in HEADERS],
    "header_ranks": [2 if _shared(*t) else 1 for t in HEADERS],
    "h": len(HEADERS),
    "planted_paths": [path for path, _ in PLANTED],
    "planted_texts": "[" + ", ".join("'" + t.replace("'", "''") + "'" for _, t in PLANTED) + "]",
    "spdx": SPDX,
    "stride": STRIDE,
    "threshold": THRESHOLD,
}
