"""Licence scan with a positional rare-token index over licence templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COVERAGE = 0.75  # share of a template's words that stand at their places
ANCHORS = 2  # rarest words of a key phrase that are looked up


@dataclass(frozen=True)
class Licence:
    label: str
    text: str
    key: str  # mandatory phrase, part of the text
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def phrase(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.phrase)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.phrase)


def _whole(label: str, text: str, base: bool = False) -> Licence:
    """A short name that counts only word for word."""
    return Licence(label, text, text, base)


def _published(label: str, name: str, version: str) -> Licence:
    """The usual notice of a licence that a foundation publishes in versions; the version is part of the mandatory phrase."""
    key = f"{name} as published by the free software foundation either version {version} of the license"
    return Licence(label, f"under the terms of the {key} or at your option any later version", key)


# fixed values: published licence names, notices and sentences
GNU = "gnu general public license"
LESSER = "gnu lesser general public license"
AFFERO = "gnu affero general public license"
LICENCES = (
    _whole("mit", "under the mit license", True),
    _whole("apache-2", "apache license version 2", True),
    _whole("cc-by-nc", "cc by nc", True),
    Licence("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
            "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
            "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
            "without warranties or conditions of any kind either express or implied", "apache license version 2 0 the license"),
    Licence("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
            "redistribution and use in source and binary forms"),
    Licence("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    _whole("cc-by-sa", "cc by sa"),
    _whole("cc-by-nc-sa", "cc by nc sa"),
    _whole("cc-by-nc-nd", "cc by nc nd"),
    _whole("epl-1", "eclipse public license v 1 0"),
    _whole("epl-2", "eclipse public license v 2 0"),
    _whole("gpl-2", f"{GNU} version 2"),
    _whole("gpl-3", f"{GNU} version 3"),
    _whole("lgpl-2.1", f"{LESSER} version 2 1"),
    _whole("lgpl-3", f"{LESSER} version 3"),
    _whole("agpl-3", f"{AFFERO} version 3"),
    _published("gpl-2", GNU, "2"),
    _published("gpl-3", GNU, "3"),
    _published("lgpl-2.1", LESSER, "2 1"),
    _published("lgpl-3", LESSER, "3"),
    _published("agpl-3", AFFERO, "3"),
    Licence("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies",
            "for any purpose with or without fee is hereby granted"),
    Licence("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the rights "
            "to use copy modify merge publish distribute sublicense and or sell copies of the software",
            "permission is hereby granted free of charge"),
    _whole("mpl-1.1", "mozilla public license version 1 1"),
    _whole("mpl-2", "mozilla public license version 2 0"),
    Licence("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at", "subject to the terms of the mozilla public license v 2 0"),
    Licence("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), WORD_GAP), "")


def rarity(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents that hold each licence word, over all documents; at most one row per licence word."""
    held = docs.select(F.explode(F.array_intersect(words(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("w"))
    return {r.w: r.n for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}


def _anchors(licence: Licence, held: dict[str, int]) -> list[tuple[str, int]]:
    """The rarest distinct words of the key phrase with their places in the template."""
    first = {}
    for i, w in enumerate(licence.phrase):
        first.setdefault(w, licence.key_at + i)
    return sorted(first.items(), key=lambda x: (held.get(x[0], 0), x[1]))[:ANCHORS]


def _array(ws: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in ws) + ")"


def _starts(licence: Licence, anchors: list[tuple[str, int]]) -> str:
    """Where the template would begin in the file, for every place that fits: the anchors' postings moved to a common
    start and intersected, then the key phrase compared word by word. A template may begin before the file does."""
    moved = [f"transform(filter(hits, h -> h.w = '{w}'), h -> h.i - {at})" for w, at in anchors]
    both = moved[0] if len(moved) == 1 else f"array_intersect({moved[0]}, {moved[1]})"
    n, at = len(licence.phrase), licence.key_at
    return f"filter({both}, s -> s + {at} >= 0 and slice(words, s + {at + 1}, {n}) = {_array(licence.phrase)})"


def _coverage(licence: Licence, name: str) -> str:
    """Best share of template words at their places, over the starts found; null without a start."""
    if licence.words == licence.phrase:
        return f"if(size({name}) > 0, 1.0D, null)"
    ws = licence.words
    at = f"aggregate(sequence(0, {len(ws) - 1}), 0, (n, j) -> n + if(s + j >= 0 and s + j < n_words and get(words, int(s + j)) = {_array(ws)}[j], 1, 0))"
    return f"array_max(transform({name}, s -> cast({at} as double) / {len(ws)}))"


def scan(docs: DataFrame, licences: tuple[Licence, ...] = LICENCES) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with n_words, n_base, first_word, last_word, base_labels, labels, score.

    One pass counts in how many documents each licence word occurs; a second looks up the rarest words of each key
    phrase in the file, without any shuffle. Every place of a key phrase holds its rarest words, so none
    is missed. ``score`` is the best coverage of a licence found, else 0; a licence that is no base one counts from
    COVERAGE on. Null and empty texts have no word, no place, empty labels. Repeated rows are scanned like any others.
    Columns named like the added ones are replaced.
    """
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    held = rarity(docs, sorted({w for x in licences for w in x.words}))
    anchors = [_anchors(x, held) for x in licences]
    lookup = sorted({w for a in anchors for w, _ in a})
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    t = docs.select(*rest, words(F.col("text")).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    inside = ", ".join(f"'{w}'" for w in lookup)
    hits = f"filter(transform(words, (w, i) -> if(w in ({inside}), struct(cast(i as long) as i, w as w), null)), h -> h is not null)"
    # files without any of the rare words are done here
    t = t.withColumn("hits", F.expr(f"if(arrays_overlap(words, {_array(lookup)}), {hits}, cast(array() as array<struct<i: bigint, w: string>>))"))
    t = t.withColumns({f"s{k}": F.expr(_starts(x, a)) for k, (x, a) in enumerate(zip(licences, anchors, strict=True))})
    t = t.withColumns({f"c{k}": F.expr(_coverage(x, f"s{k}")) for k, x in enumerate(licences)})
    base = [k for k, x in enumerate(licences) if x.base]

    def joined(ks: list[int]) -> Column:
        found = [F.when(F.col(f"c{k}") >= (0.0 if licences[k].base else COVERAGE), F.lit(licences[k].label)) for k in ks]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*found)))), ",")

    places = F.concat(*[F.col(f"s{k}") for k in base])
    kept = [F.when(F.col(f"c{k}") >= (0.0 if x.base else COVERAGE), F.col(f"c{k}")).otherwise(F.lit(0.0)) for k, x in enumerate(licences)]
    return t.select(
        *rest, "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"), joined(base).alias("base_labels"),
        joined(list(range(len(licences)))).alias("labels"), F.greatest(*kept).alias("score"),
    )


def scanned(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).drop("text")


def twin() -> str:
    """The same table in SQL, by comparing every phrase at every place."""
    def at(name: str, ws: list[str]) -> str:
        return f"list_filter(range(0, n_words - {len(ws)} + 1), lambda i: words[i + 1 : i + {len(ws)}] = [{', '.join(repr(w) for w in ws)}])"

    steps, cover = [], []
    for k, x in enumerate(LICENCES):
        ready = " AND ".join(f"list_contains(words, '{w}')" for w in dict.fromkeys(x.phrase))
        steps.append(f"CASE WHEN {ready} THEN {at('words', x.phrase)} ELSE [] END AS p{k}")
        same = " + ".join(f"CASE WHEN i - {x.key_at} + {j} >= 0 AND words[i - {x.key_at} + {j} + 1] = '{w}' THEN 1 ELSE 0 END" for j, w in enumerate(x.words))
        share = f"list_max(list_transform(p{k}, lambda i: ({same})::DOUBLE / {len(x.words)}))"
        floor = 0 if x.base else COVERAGE
        cover.append(f"CASE WHEN len(p{k}) > 0 AND {share} >= {floor} THEN {share} END AS c{k}")
    base = [k for k, x in enumerate(LICENCES) if x.base]

    def labels(ks: list[int]) -> str:
        return "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(
            f"CASE WHEN c{k} IS NOT NULL THEN '{LICENCES[k].label}' END" for k in ks) + "], lambda x: x IS NOT NULL))), ',')"

    places = " || ".join(f"p{k}" for k in base)
    return f"""
    WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
    n AS (SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n_words FROM w),
    p AS (SELECT doc_id, words, n_words, {', '.join(steps)} FROM n),
    c AS (SELECT *, {', '.join(cover)} FROM p)
    SELECT doc_id, n_words, CAST(len({places}) AS BIGINT) AS n_base, CAST(list_min({places}) AS BIGINT) AS first_word,
      CAST(list_max({places}) AS BIGINT) AS last_word, {labels(base)} AS base_labels, {labels(list(range(len(LICENCES))))} AS labels,
      greatest({', '.join(f'coalesce(c{k}, 0.0)' for k in range(len(LICENCES)))})::DOUBLE AS score
    FROM c"""
