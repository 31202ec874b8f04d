"""Licence scans with a positional index of rare licence words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import WORDS_SQL, alnum_words, batched, id_and_bytes, pairs_of, read_table


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]


# Names of licences, and notices that files carry, as their publishers word them. The
# phrases must all be in a file, at their place, for the label to be given.
PHRASES = (
    Template("mit", "MIT License", ("mit license",)),
    Template("apache", "Apache License", ("apache license",)),
    Template("gpl", "General Public License", ("general public license",)),
)
NOTICES = (
    Template(
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "mit-release",
        "Released under the MIT License.",
        ("released under the mit license",),
    ),
    Template(
        "apache-2.0-notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
        ("licensed under the apache license version 2 0",),
    ),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the"
        " License, or (at your option) any later version.",
        ("under the terms of the gnu general public license",),
    ),
    Template(
        "gpl-3.0-work",
        "This work is licensed under the GNU General Public License, version 3.",
        ("licensed under the gnu general public license version 3",),
    ),
    Template(
        "lgpl",
        "GNU Lesser General Public License",
        ("gnu lesser general public license",),
    ),
    Template(
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc-notice",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
        " is hereby granted, provided that the above copyright notice and this permission notice appear in"
        " all copies.",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template(
        "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
        " MPL was not distributed with this file, You can obtain one at",
        ("subject to the terms of the mozilla public license",),
    ),
    Template(
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4 0 international license",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
        ("free and unencumbered software released into the public domain",),
    ),
)
# Share of a template's words that must stand at their relative places.
COVERAGE = 0.8
# Words by which a place may be off, as words before it were put in or left out.
DRIFT = 3
# Most bytes of templates that are read from a table and sent to every worker.
TEMPLATE_BYTES = 32 * 1024 * 1024


class TemplateIndex:
    """Where every word of the templates stands in them, and which words are rare among them.

    The words of the first key phrase stand one after the other where a match is; its start is their place less
    their place in the template. A word of the template counts if it stands within `drift` words of
    its place behind the start: postings of neighbouring offsets are chained, so a word put in
    or left out costs no more than itself. A match has `coverage` of the words and, within the drift, all other key
    phrases. A template is found through its rarest words, those of the highest inverse document
    frequency over the templates: its anchors are as many as cover one place more than a match may
    miss, so each match has one at its place.
    """

    def __init__(self, templates: tuple[Template, ...], coverage: float, drift: int = DRIFT):
        self.templates, self.drift = templates, drift
        self.words = [alnum_words(t.text.encode()) for t in templates]
        self.needed = [math.ceil(coverage * len(w)) for w in self.words]
        held = Counter(word for words in self.words for word in set(words))
        self.idf = {word: math.log(len(templates) / n) for word, n in held.items()}
        self.anchors: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, words in enumerate(self.words):
            missing_allowed = len(words) - self.needed[number]
            own: dict[bytes, list[int]] = defaultdict(list)
            for place, word in enumerate(words):
                own[word].append(place)
            covered = 0
            for word in sorted(own, key=lambda w: (-self.idf[w], w)):
                if covered > missing_allowed:
                    break
                self.anchors[word] += [(number, place) for place in own[word]]
                covered += len(own[word])
        self.rare = frozenset(self.anchors)
        # Key phrases: their words, and where they stand in the template.
        self.phrases = [
            [self._phrase(number, phrase) for phrase in t.key_phrases] for number, t in enumerate(templates)
        ]

    def _phrase(self, number: int, phrase: str) -> tuple[int, list[bytes]]:
        wanted, words = phrase.encode().split(), self.words[number]
        for start in range(len(words) - len(wanted) + 1):
            if words[start : start + len(wanted)] == wanted:
                return start, wanted
        raise ValueError(f"the template {self.templates[number].label} does not hold {phrase!r}")

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, first word, share of its words found) for every place in a text."""
        if self.rare.isdisjoint(words):
            return []
        # Offsets at which a text's rarest licence words meet a template, rarest first.
        spots: dict[bytes, list[int]] = defaultdict(list)
        for at, word in enumerate(words):
            if word in self.idf:
                spots[word].append(at)
        offsets: dict[int, set[int]] = defaultdict(set)
        for word in sorted(self.rare.intersection(spots), key=lambda w: (-self.idf[w], w)):
            for number, place in self.anchors[word]:
                offsets[number].update(at - place for at in spots[word])
        found = []
        for number in sorted(offsets):
            template = self.words[number]
            if sum(word in spots for word in template) < self.needed[number]:
                continue
            (first_at, phrase), *others = self.phrases[number]
            near = range(-self.drift, self.drift + 1)
            # Only where the key phrase begins may an offset near the postings be a start.
            begins = {at - first_at for at in spots[phrase[0]]}
            for start in sorted(begins.intersection(o + d for o in offsets[number] for d in near)):
                if not self._stands(words, start + first_at, phrase):
                    continue
                if not all(any(self._stands(words, start + at + d, other) for d in near) for at, other in others):
                    continue
                equal = sum(
                    word in words[max(0, start + place - self.drift) : max(0, start + place + self.drift + 1)]
                    for place, word in enumerate(template)
                )
                if equal >= self.needed[number]:
                    found.append((number, start, equal / len(template)))
        return found

    @staticmethod
    def _stands(words: list[bytes], at: int, phrase: list[bytes]) -> bool:
        return at >= 0 and words[at : at + len(phrase)] == phrase


class Templates:
    """Templates as they are broadcast. A worker process keeps a broadcast value for all its tasks, and with
    it the index that the first of them builds."""

    def __init__(self, templates: tuple[Template, ...], coverage: float):
        self.templates, self.coverage, self.built = templates, coverage, None

    def index(self) -> TemplateIndex:
        if self.built is None:
            self.built = TemplateIndex(self.templates, self.coverage)
        return self.built


def read_templates(table: DataFrame, most_bytes: int = TEMPLATE_BYTES) -> tuple[Template, ...]:
    """Templates of a table (label, text, key_phrases as an array of texts), in the order of label and text.

    Every worker gets all of them, so a table of more than `most_bytes` is an error. Rows with a null
    label, text or list, or without key phrases, are left out. A key phrase that its text does not hold is an
    error when the templates are used. Repeated rows count once.
    """
    rows = table.select(
        F.col("label").cast("string"), F.col("text").cast("string"), F.col("key_phrases").cast("array<string>")
    ).where("label is not null and text is not null and size(key_phrases) > 0").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"templates of {size} bytes, more than {most_bytes}")
    found = sorted((r["label"], r["text"], tuple(r["key_phrases"])) for r in rows.collect())
    return tuple(Template(*row) for row in found)


def license_scan(
    documents: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, n_words, matches, score) of every row: matches are structs of label, first word, words,
    share found and whether the label is a plain phrase; score is the largest share, 0 without match.

    Phrases must be there word by word; notices need their key phrases and `coverage` of all words
    within `DRIFT` words of their relative places, so single words may be changed, put in or left out. Whole
    texts are read. Null texts have no words; repeated rows keep a
    result each; other columns are ignored. Rows stay in their partitions; nothing is shuffled.
    """
    templates = phrases + notices
    content = documents.sparkSession.sparkContext.broadcast(Templates(templates, coverage))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()),
            (
                "matches",
                pa.list_(
                    pa.struct(
                        [
                            ("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()),
                            ("share", pa.float64()), ("phrase", pa.bool_()),
                        ]
                    )
                ),
            ),
            ("score", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = content.value.index()

        def rows():
            for doc_id, body in pairs_of(batches):
                words = alnum_words(body)
                matches = [
                    {
                        "label": index.templates[n].label, "first": max(start, 0), "words": len(index.words[n]),
                        "share": share, "phrase": n < len(phrases),
                    }
                    for n, start, share in index.matches(words)
                ]
                yield doc_id, len(words), matches, max((m["share"] for m in matches), default=0.0)

        yield from batched(rows(), schema, lambda row: 64 + 64 * len(row[2]))

    rows = id_and_bytes(documents).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(
        run,
        "doc_id long, n_words long,"
        " matches array<struct<label:string,first:long,words:long,share:double,phrase:boolean>>, score double",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    found = license_scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["phrase"])

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    starts = F.transform(base, lambda m: m["first"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"), "score",
    )


def op2_sql() -> str:
    """Every word of every text against every word of the templates, counted by template near each start."""
    index = TemplateIndex(PHRASES + NOTICES, COVERAGE)
    words, templates, phrases = [], [], []
    for number, template in enumerate(index.templates):
        own = index.words[number]
        words += [f"({number}, {place}, '{word.decode()}')" for place, word in enumerate(own)]
        is_phrase = "true" if number < len(PHRASES) else "false"
        templates.append(f"({number}, '{template.label}', {is_phrase}, {len(own)}, {index.needed[number]})")

        def stands(at: int, phrase: list[bytes]) -> str:
            listed = ", ".join(repr(p.decode()) for p in phrase)
            return f"(start + {at} >= 0 AND w[start + {at + 1} : start + {at + len(phrase)}] = [{listed}])"

        (first_at, first), *others = index.phrases[number]
        checks = [stands(first_at, first)] + [
            f"({' OR '.join(stands(at + d, phrase) for d in range(-DRIFT, DRIFT + 1))})" for at, phrase in others
        ]
        phrases.append(f"WHEN {number} THEN {' AND '.join(checks)}")
    return f"""
        WITH d AS MATERIALIZED (
            SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {WORDS_SQL.format("text")} END AS w FROM documents
        ),
        t(number, place, word) AS (VALUES {', '.join(words)}),
        l(number, label, phrase, n, needed) AS (VALUES {', '.join(templates)}),
        p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS spot FROM d),
        h AS (SELECT doc_id, number, place, spot - place AS start FROM p JOIN t USING (word)),
        c AS (
            SELECT doc_id, number, start FROM (SELECT DISTINCT doc_id, number, start FROM h) JOIN d USING (doc_id)
            WHERE CASE number {' '.join(phrases)} END
        ),
        k AS (
            SELECT c.doc_id, c.number, c.start, count(DISTINCT h.place) AS equal
            FROM c JOIN h ON h.doc_id = c.doc_id AND h.number = c.number
                AND h.start BETWEEN c.start - {DRIFT} AND c.start + {DRIFT}
            GROUP BY ALL
        ),
        m AS (
            SELECT doc_id, label, phrase, start, equal / n AS share FROM k JOIN l USING (number) WHERE equal >= needed
        ),
        g AS (
            SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word,
                max(start) FILTER (phrase) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
                string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
            FROM m GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
            CAST(coalesce(score, 0) AS DOUBLE) AS score
        FROM d LEFT JOIN g USING (doc_id)"""
