"""License scan by a positional index of rare words, in DataFrame functions only.

Each template is a notice as it stands in files, as words. Counting over all documents gives the inverse document
frequency of the templates' words; the rarest places of each template go into the index. A text looks its
rare words up, and each hit proposes a template at a relative position; hits that agree on it are counted, and a
template that reaches its share of places at one position is reported if its mandatory phrases stand in the
text. Plain phrases give base labels beside that.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.fingerprints import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the base labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# Notices as public licences ask for them, and the phrases that must stand in the text.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ("apache license version 2 0", "in compliance with the license")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ("permission is hereby granted free of charge", "without restriction")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license", "version 2")),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("agpl-3.0", "it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify and or distribute this software",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license v 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software released into the public domain",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike 4 0",)),
    Template("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial 4 0",)),
)


@dataclass(frozen=True)
class LicenseConfig:
    """Places each template has in the index, and the share of them that must agree on a position."""

    places: int = 10
    share: float = 0.7


def words_of(text: Column) -> Column:
    """Words of a text column: runs of digits, letters and other characters beyond ASCII, A-Z lowered; empty for null."""
    spaced = F.btrim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK, " "), F.lit(" "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def document_frequency(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many documents each word of the templates stands, and the number of documents. One row per word reaches the driver."""
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    wanted = F.array(*[F.lit(w) for w in vocabulary])
    held = docs.select(F.explode_outer(F.array_append(F.array_intersect(words_of(F.col("text")), wanted), F.lit(""))).alias("word"))
    counts = {row["word"]: row["count"] for row in held.groupBy("word").count().collect()}
    return {w: counts.get(w, 0) for w in vocabulary}, counts.get("", 0)


def rare_places(frequency: dict[str, int], n_docs: int, config: LicenseConfig, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, place): the places of highest inverse document frequency of each template, the first ones in a tie."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        words = template.text.split()
        idf = [math.log((n_docs + 1) / (frequency.get(w, 0) + 1)) for w in words]
        for place in sorted(range(len(words)), key=lambda i: (-idf[i], i))[:config.places]:
            index.setdefault(words[place], []).append((number, place))
    return index


def phrase_places(words: Column, spaced: Column, phrase: str) -> Column:
    """Places of the words of a phrase standing one after another."""
    parts = phrase.split()

    def here(word: Column, i: Column) -> Column:
        match = word == parts[0]
        for j, part in enumerate(parts[1:], 1):
            match &= F.coalesce(F.get(words, i + j) == part, F.lit(False))
        return F.when(match, i)
    return F.when(F.contains(spaced, F.lit(f" {phrase} ")), F.array_compact(F.transform(words, here))).otherwise(F.array().cast("array<int>"))


OFFSET_BITS = 32


def scan(docs: DataFrame, config: LicenseConfig = LicenseConfig(), templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, base (places of all phrases), base_labels and labels (sorted arrays), score of each row of docs (doc_id, text).

    The score is the largest share of a reported template's index places that stand at one relative position, 0 without a
    template. A null text is empty.
    """
    frequency, n_docs = document_frequency(docs, templates)
    index = rare_places(frequency, n_docs, config, templates)
    rare = F.array(*[F.lit(w) for w in sorted(index)])
    postings = F.create_map(*[x for w in sorted(index) for x in (
        F.lit(w), F.array(*[F.lit((number << OFFSET_BITS) - place).cast("bigint") for number, place in index[w]]))])
    places = [min(config.places, len(t.text.split())) for t in templates]
    needed = [max(1, math.ceil(config.share * n)) for n in places]

    def looked_up(words: Column) -> Column:
        # A hit at position i of a word at place p of template t stands for t at position i - p. One number
        # holds both; half of the offsets' range keeps negative positions apart from the next template.
        def hit(word: Column, i: Column) -> Column:
            return F.when(F.array_contains(rare, word), F.transform(F.element_at(postings, word), lambda code: code + i))
        return F.sort_array(F.flatten(F.array_compact(F.transform(words, hit))))

    def agreeing(codes: Column, number: int) -> Column:
        """The most codes of a template that are equal, 0 below the number needed; a run of n is n equal sorted codes."""
        half = 1 << OFFSET_BITS - 1

        def repeated(own: Column, n: int) -> Column:
            return F.exists(F.transform(own, lambda x, i: F.coalesce(F.get(own, i + (n - 1)) == x, F.lit(False))), lambda same: same)

        def runs(own: Column) -> Column:
            best = F.lit(0)
            for n in range(needed[number], places[number] + 1):
                best = F.when(repeated(own, n), n).otherwise(best)
            return best
        own = F.filter(codes, lambda x: (x >= (number << OFFSET_BITS) - half) & (x < (number << OFFSET_BITS) + half))
        return let(own, runs)

    def of_words(words: Column) -> Column:
        return let(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), lambda spaced: let(
            F.when(F.arrays_overlap(words, rare), looked_up(words)).otherwise(F.array().cast("array<bigint>")),
            lambda codes: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.array(*[phrase_places(words, spaced, phrase) for phrase, _ in PHRASES]).alias("base"),
                F.when(F.size(codes) == 0, F.array().cast("array<double>")).otherwise(F.array(*[
                    reported(codes, spaced, number) for number in range(len(templates))])).alias("shares"))))

    def reported(codes: Column, spaced: Column, number: int) -> Column:
        verified = F.lit(True)
        for phrase in templates[number].phrases:
            verified &= F.contains(spaced, F.lit(f" {phrase} "))
        return F.when(verified, agreeing(codes, number) / places[number]).otherwise(0.0)

    found = docs.select("doc_id", let(words_of(F.col("text")), of_words).alias("found")).select("doc_id", "found.*")
    base = F.array_compact(F.array(*[F.when(F.size(F.get("base", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]))
    own = F.array_compact(F.array(*[F.when(F.coalesce(F.get("shares", F.lit(i)), F.lit(0.0)) > 0, F.lit(t.label)) for i, t in enumerate(templates)]))
    return found.select(
        "doc_id", "n_words", F.flatten("base").alias("base"), F.sort_array(F.array_distinct(base)).alias("base_labels"),
        F.sort_array(F.array_distinct(F.concat(base, own))).alias("labels"), F.coalesce(F.array_max("shares"), F.lit(0.0)).alias("score"))
