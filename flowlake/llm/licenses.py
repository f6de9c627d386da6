"""License scans by a positional index of rare template words.

The templates are short public notices. From the documents comes the inverse document
frequency (IDF) of every template word, counted over all of them. The index has, for each
template, the postings (template, place) of its words with the highest IDF, its *anchors*:
so many that the others together weigh less than ``share`` of the template, so no place that
reaches ``share`` misses all anchors. Words that no document has need no posting.
A file looks up the anchors among its words; each hit lays a template over the file at one
relative position. There the rest of the template is compared word by word: the share of
its IDF weight that stands in place must reach ``share``, and its mandatory phrase must
stand in that stretch. Where no such position is near, words count that stand up to
``shift`` words (a fifth of the template) before or after their place, so that inserted and
missing words do not part a notice into two halves that both fall short.

Apart from the IDF count (one row per template word leaves a task) there is no shuffle:
the index is bounded by the templates and becomes literals, and a file is scanned where it
is read, with array functions. Files without an anchor stop after the look-up.

Plain phrases (``PHRASES``) are found at all their places, beside the templates.

Defined cases: null and empty texts have no words, labels or places and score 0; words are
runs of ASCII letters and digits, lower-cased, and of all characters beyond ASCII; repeated
rows are scanned alike; columns named like the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, words of the public notice, mandatory phrase.
TEMPLATES = [
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    (
        "gpl-or-later",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
        "gnu general public license",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0",
        "apache license version 2 0",
    ),
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "permission is hereby granted free of charge",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        "for any purpose with or without fee",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "gnu lesser general public license",
    ),
    (
        "agpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
        "gnu affero general public license",
    ),
    (
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
        "endorse or promote products derived from this software",
    ),
    (
        "epl-2.0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
        "eclipse public license",
    ),
    (
        "artistic-2.0",
        "you may use modify and distribute this package under the terms of the artistic license 2 0",
        "artistic license 2 0",
    ),
    (
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license to use reproduce display distribute execute and transmit the software",
        "covered by this license",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
        "damages arising from the use of this software permission is granted to anyone to use this software for any purpose "
        "including commercial applications and to alter it and redistribute it freely",
        "redistribute it freely",
    ),
    (
        "cc0-1.0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        "waived all copyright and related or neighboring rights",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]

GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The one sign beyond ASCII whose lower-case form is an ASCII letter, and a stand-in.
KELVIN, STAND_IN = "K", "κ"


def plain(text: Column) -> Column:
    """The words of a text with one space between them."""
    lowered = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit(KELVIN), F.lit(STAND_IN)))
    return F.trim(F.regexp_replace(lowered, GAPS, " "))


def with_words(docs: DataFrame, text: str) -> DataFrame:
    rows = docs.withColumn("__plain", plain(F.col(f"`{text}`")))
    return rows.withColumn("__words", F.when(F.col("__plain") == "", F.array().cast("array<string>")).otherwise(F.split("__plain", " ")))


def frequencies(docs: DataFrame, text: str, templates: list[tuple[str, str, str]]) -> tuple[dict[str, int], int]:
    """Documents with each template word (one row per word comes back), and all documents."""
    known = sorted({w for _, notice, _ in templates for w in notice.split()})
    rows = with_words(docs.select(text), text)
    counts = rows.select(F.explode(F.array_intersect("__words", strings(known))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    return {w: found.get(w, 0) for w in known}, docs.count()


def weighed(found: dict[str, int], total: int) -> dict[str, float]:
    return {w: math.log((total + 1) / (n + 1)) + 1e-6 for w, n in found.items()}


def inverse_frequencies(docs: DataFrame, text: str, templates: list[tuple[str, str, str]]) -> dict[str, float]:
    """IDF of each template word over all documents."""
    return weighed(*frequencies(docs, text, templates))


def anchors_of(notice: list[str], found: dict[str, int], idf: dict[str, float], share: float) -> list[str]:
    """The rarest words of a notice, until the weight of the rest cannot reach ``share``."""
    need = share * sum(idf[w] for w in notice) * (1 - 1e-9)
    rest = sum(idf[w] for w in notice if found[w])
    anchors = []
    for word in sorted({w for w in notice if found[w]}, key=lambda w: (-idf[w], w)):
        if rest < need:
            break
        anchors.append(word)
        rest -= idf[word] * notice.count(word)
    return anchors


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def phrase_starts(words: Column, phrases: list[list[str]]) -> Column:
    def stands(i: Column) -> Column:
        found = F.lit(False)
        for phrase in phrases:
            here = F.lit(True)
            for step, word in enumerate(phrase):
                here = here & F.coalesce(F.get(words, i + step) == word, F.lit(False))
            found = found | here
        return found

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)


def scan(
    docs: DataFrame, text: str = "text", phrases: dict[str, str] | None = None, templates: list[tuple[str, str, str]] | None = None,
    share: float = 0.7,
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` (arrays, sorted), ``score`` and ``places``: the (label, first word, share) of each template found."""
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    found = frequencies(docs, text, templates)
    idf = weighed(*found)
    notices = [notice.split() for _, notice, _ in templates]
    weights = [[idf[w] for w in notice] for notice in notices]

    # The index: anchor word -> (template, place).
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, notice in enumerate(notices):
        rare = set(anchors_of(notice, found[0], idf, share))
        for place, word in enumerate(notice):
            if word in rare:
                postings.setdefault(word, []).append((t, place))
    posting = lambda t, place: F.struct(F.lit(t).alias("t"), F.lit(place).alias("place"))
    index = F.create_map(*[x for word, at in sorted(postings.items()) for x in (F.lit(word), F.array(*[posting(*p) for p in at]))]) if postings else None

    rows = with_words(docs, text)
    words, size = F.col("__words"), F.size("__words")
    nothing = F.array().cast("array<int>")
    padded = F.concat(F.lit(" "), F.col("__plain"), F.lit(" "))
    has = {phrase: padded.contains(f" {phrase} ") for phrase in phrases}
    some = F.lit(False)
    for one in has.values():
        some = some | one
    rows = rows.withColumns({
        "__starts": F.when(some, phrase_starts(words, [p.split() for p in phrases])).otherwise(nothing),
        "__base": F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(has[p], F.lit(label)) for p, label in phrases.items()])))) if phrases else strings([]),
    })

    laid = "array<struct<t: int, at: int>>"
    if index is None:
        rows = rows.withColumn("__laid", F.array().cast(laid))
    else:
        known = strings(sorted(postings))
        hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(known, h["w"]))
        over = lambda h: F.transform(F.element_at(index, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["place"]).alias("at")))
        rows = rows.withColumn("__laid", F.when(F.arrays_overlap(words, known), F.array_distinct(F.flatten(F.transform(hits, over)))).otherwise(F.array().cast(laid)))

    # One entry per template: label, words with weights, mandatory phrase.
    entry = lambda t: F.struct(
        F.lit(templates[t][0]).alias("label"), strings(notices[t]).alias("words"),
        F.array(*map(F.lit, weights[t])).alias("weights"), F.lit(f" {templates[t][2]} ").alias("must"), F.lit(sum(weights[t])).alias("all"),
        F.lit(max(1, len(notices[t]) // 5)).alias("shift"),
    )
    place = "array<struct<label: string, first_word: int, share: double>>"
    if templates:
        table = F.array(*[entry(t) for t in range(len(templates))])

        def weight(l: Column, stands) -> Column:
            notice = F.get(table, l["t"])
            hits = F.transform(notice["words"], lambda w, i: F.when(stands(w, l["at"] + i, notice["shift"]), F.get(notice["weights"], i)).otherwise(F.lit(0.0)))
            return F.aggregate(hits, F.lit(0.0), lambda total, w: total + w)

        def part(start: Column, end: Column) -> Column:
            first = F.greatest(start, F.lit(0))
            return F.slice(words, first + 1, F.greatest(end - first, F.lit(0)))

        def judge(l: Column, there: Column, shift: Column) -> Column:
            notice = F.get(table, l["t"])
            stretch = part(l["at"] - shift, l["at"] + F.size(notice["words"]) + shift)
            inside = F.concat(F.lit(" "), F.array_join(stretch, " "), F.lit(" "))
            return (there >= share * notice["all"]) & inside.contains(notice["must"])

        def with_weight(l: Column, there: Column) -> Column:
            return F.struct(l["t"].alias("t"), l["at"].alias("at"), there.alias("there"))

        def near(x: Column, y: Column) -> Column:
            return (x["t"] == y["t"]) & (F.abs(x["at"] - y["at"]) <= F.get(table, x["t"])["shift"])

        def ahead(x: Column, y: Column) -> Column:
            return near(x, y) & ((y["there"] > x["there"]) | (y["there"] == x["there"]) & (y["at"] < x["at"]))

        # Hits are in order and no two of a template are at one place, so those within a shift are
        # at most as many entries away.
        reach = max(max(1, len(notice) // 5) for notice in notices)
        steps = F.array(*[F.lit(d) for d in range(-reach, reach + 1) if d])

        def beside(name: str, x: Column, i: Column, holds) -> Column:
            return F.exists(steps, lambda d: F.coalesce(holds(x, F.get(name, i + d)), F.lit(False)))

        def placed(l: Column) -> Column:
            notice = F.get(table, l["t"])
            return F.struct(
                notice["label"].alias("label"), F.greatest(l["at"], F.lit(0)).alias("first_word"),
                F.least(F.lit(1.0), F.round(l["there"] / notice["all"], 9)).alias("share"),
            )

        in_place = lambda w, i, shift: F.get(words, i) == w
        around = lambda w, i, shift: F.array_contains(part(i - shift, i + shift + 1), w)
        rows = rows.withColumn("__laid", F.transform(F.array_sort("__laid"), lambda l: with_weight(l, weight(l, in_place))))
        whole = lambda l: judge(l, l["there"], F.lit(0))
        rows = rows.withColumn("__laid", F.transform("__laid", lambda l: F.struct(l["t"].alias("t"), l["at"].alias("at"), l["there"].alias("there"), whole(l).alias("alone"))))
        rows = rows.withColumn("__alone", F.transform(F.filter("__laid", lambda l: l["alone"]), lambda l: with_weight(l, l["there"])))
        rows = rows.withColumn("__joined", F.filter("__laid", lambda x, i: ~x["alone"] & ~beside("__laid", x, i, lambda x, y: y["alone"] & near(x, y))))
        rows = rows.withColumn("__joined", F.transform("__joined", lambda l: with_weight(l, weight(l, around))))
        rows = rows.withColumn("__joined", F.filter("__joined", lambda l: judge(l, l["there"], F.get(table, l["t"])["shift"])))
        joined = F.filter("__joined", lambda x, i: ~beside("__joined", x, i, ahead))
        rows = rows.withColumn("places", F.array_sort(F.array_distinct(F.transform(F.concat("__alone", joined), placed))).cast(place)).drop("__alone", "__joined")
    else:
        rows = rows.withColumn("places", F.array().cast(place))
    labels = F.array_sort(F.array_union("__base", F.transform("places", lambda p: p["label"])))
    best = F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0))
    return rows.withColumns({
        "n_words": size.cast("bigint"),
        "n_base": F.size("__starts").cast("bigint"),
        "first_word": F.array_min("__starts").cast("bigint"),
        "last_word": F.array_max("__starts").cast("bigint"),
        "base_labels": F.col("__base"),
        "labels": labels,
        "score": F.when(F.size("__base") > 0, F.lit(1.0)).otherwise(best),
    }).drop("__plain", "__words", "__starts", "__base", "__laid")
