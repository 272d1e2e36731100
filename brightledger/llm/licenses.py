"""Licences that documents name or quote, found by diagonal voting.

A template is the text of a licence, or a phrase that names one. All runs of ``GRAM`` words of the documents (of all words, for templates that are shorter) are hashed, and Spark joins
the hashes to the positions in the templates that have the same hash and the same words. A document's word i that meets a template's word j votes for the diagonal
i - j: an unchanged quotation has all its votes on one diagonal, and an inserted or lost word moves the rest to a neighbouring one. Votes are summed by diagonal, diagonals at most ``SHIFT``
apart are merged to one span, and a span is verified: its share is the part of the template's words that lie in voted runs. Words were compared as text, so a share holds equal words only.

A table of 2**23 bits, of whatever size the templates are, leaves out hashes that no template has before they become rows of the join. The rest carry their words with them, so texts are
never moved and are read once. Votes are few beside the text; those of a document are bounded by its own length.

Words are runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased.

Defined cases: null text has no words; a null or repeated id is kept as it is, each row being a document of its own; an empty table gives an empty result; without
templates nothing is found; a template without words is passed over; a text of any length is read whole.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import words
from .common import settle, text_or_empty

GRAM, SHIFT = 4, 4
#: A licence text counts as quoted if this share of its words stands in the span.
LEAST = 0.6
BITS = 23

# Phrases that name a licence, and the wording of licences and of their notices.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
NAMES = (
    ("lgpl", "lesser general public license"),
    ("agpl", "affero general public license"),
    ("mpl", "mozilla public license"),
    ("bsd", "bsd license"),
    ("isc", "isc license"),
    ("cc", "creative commons attribution"),
    ("cc", "cc by"),
    ("cc", "cc0"),
    ("unlicense", "unlicense"),
)
TEXTS = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary "
        "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("cc", "This work is licensed under a Creative Commons Attribution International License."),
)

_WORD = np.ones(256, bool)
_WORD[: 0x80] = [chr(c) in string.ascii_lowercase + string.digits for c in range(0x80)]
_GRAMS = "doc_id bigint, rid bigint, n_words bigint, at bigint, gram bigint, words string"
_GRAM_TYPES = pa.schema([(c, pa.int64()) for c in ("doc_id", "rid", "n_words", "at", "gram")] + [("words", pa.string())])
_ROWS = 1 << 14


def templates(spark: SparkSession) -> DataFrame:
    """The templates of this module: label, text, least (share of the words that a span must have), base (whether it is one of the plain phrases)."""
    rows = [(a, b, 1.0, True) for a, b in PHRASES] + [(a, b, 1.0, False) for a, b in NAMES] + [(a, b, LEAST, False) for a, b in TEXTS]
    return spark.createDataFrame(rows, "label string, text string, least double, base boolean")


def _split(texts: list[bytes]) -> words.Words:
    return words.split([t.lower() for t in texts], ~_WORD)  # bytes.lower() changes A-Z only


def _grams(split: words.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of ``width`` words; hashes of different widths have nothing in common."""
    h = words.window_hashes(split.hashes(), width, seed=width)
    owner = split.owner()
    where = np.flatnonzero(owner[: len(h)] == owner[width - 1 :])
    return where, h[where].view(np.int64)


def _positions(gram: int):
    """Templates to their runs: template, n (words), width, at, gram, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                split = _split([text.encode()])
                own = _words(split)
                if width := min(gram, len(own)):
                    where, h = _grams(split, width)
                    n = len(where)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array(np.full(n, v, np.int64)) for v in (k, len(own), width)), pa.array(where), pa.array(h),
                            pa.array([b" ".join(own[i : i + width]).decode() for i in where.tolist()], pa.string()),
                        ],
                        names=["template", "n", "width", "at", "gram", "words"],
                    )

    return run


def _words(split: words.Words) -> list[bytes]:
    data = split.data.tobytes()
    return [data[a:b] for a, b in zip(split.start.tolist(), split.end.tolist(), strict=True)]


def _votes(widths: list[int], table):
    """Documents to a row each, and one for each run of words that a template may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        mask = np.uint64(8 * len(bits) - 1)
        for batch in batches:
            doc_ids, rids = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for low, high in words.chunks(texts):
                split = _split(texts[low:high])
                n_words, owner = np.diff(split.first), split.owner()
                doc, at, gram, own = [np.arange(high - low)], [np.full(high - low, -1)], [np.zeros(high - low, np.int64)], [None] * (high - low)
                data = None
                for width in widths:
                    where, h = _grams(split, width)
                    slot = h.view(np.uint64) & mask
                    hit = bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1
                    where, h = where[hit], h[hit]
                    doc.append(owner[where])
                    at.append(where - split.first[owner[where]])
                    gram.append(h)
                    if len(where):
                        data = data or split.data.tobytes()
                        begin, end = split.start.tolist(), split.end.tolist()
                        own += [b" ".join(data[begin[k] : end[k]] for k in range(i, i + width)).decode() for i in where.tolist()]
                doc, at, gram = np.concatenate(doc), np.concatenate(at), np.concatenate(gram)
                for a in range(0, len(doc), _ROWS):
                    k = doc[a : a + _ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.where(known, doc_ids, 0)[low + k].astype(np.int64), mask=~known[low + k]), pa.array(rids[low + k]),
                            pa.array(n_words[k]), pa.array(at[a : a + _ROWS]), pa.array(gram[a : a + _ROWS]), pa.array(own[a : a + _ROWS], pa.string()),
                        ],
                        schema=_GRAM_TYPES,
                    )

    return run


def _bits(grams: DataFrame) -> bytes:
    """The bits of the hashes in a table of fixed size. Spark sets them; the driver gets 2**BITS bits at most."""
    slot = F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1))
    size = 1 << 15  # bits of one bitmap of Spark
    parts = grams.groupBy(F.floor(slot / size).alias("part")).agg(F.bitmap_construct_agg(slot % size).alias("bits")).collect()
    table = bytearray((1 << BITS) // 8)
    for r in parts:
        table[r.part * size // 8 : (r.part + 1) * size // 8] = r.bits
    return bytes(table)


def scan(docs: DataFrame, templates: DataFrame, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans.

    A span has the label of its template, ``base``, the first word and the number of words from the first to the last vote, its share, and whether the share is enough. Spans are in
    order of place and label. Templates: label, text, least, base; rows that repeat count once.
    """
    spark = docs.sparkSession
    listed = templates.groupBy("label", "text").agg(F.min("least").alias("least"), F.bool_or("base").alias("base"))
    listed = settle(listed.withColumn("template", F.xxhash64("label", "text")), "templates")
    positions = settle(
        listed.select("template", text_or_empty("text")).mapInArrow(_positions(gram), "template long, n long, width long, at long, gram long, words string"), "positions"
    )
    # As many widths as ``gram`` at most.
    widths = sorted(r.width for r in positions.select("width").distinct().collect())
    table = spark.sparkContext.broadcast(_bits(positions))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    votes = read.select("doc_id", F.xxhash64("text").alias("rid"), "text").mapInArrow(_votes(widths, table), _GRAMS)
    # A document's own row has no words, meets no template and stays.
    met = positions.join(listed.drop("text"), "template").withColumnRenamed("at", "place")
    joined = votes.join(met, ["gram", "words"], "left").where("template is not null or at = -1")

    facts = ["n", "width", "label", "least", "base"]
    key = ["doc_id", "rid"]
    # Rows that repeat have the same votes, which count once.
    diagonals = joined.groupBy(*key, "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies"), F.collect_set("place").alias("places"), *(F.max(c).alias(c) for c in facts)
    )
    # Neighbouring diagonals make one span; a phrase of one run has to stand as it is.
    along = W.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("n") > F.col("width"), SHIFT).otherwise(0)
    merged = diagonals.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_part", F.sum("_new").over(along))
    spans = merged.groupBy(*key, "template", "_part").agg(
        F.max("n_words").alias("n_words"), F.max("copies").alias("copies"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("low"), F.max(F.col("diagonal") + F.array_max("places") + F.col("width")).alias("high"),
        *(F.max(c).alias(c) for c in facts),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("width") - 1)))))
    verified = spans.withColumn("share", covered / F.col("n"))
    span = F.struct(
        F.col("low").alias("start"), (F.col("high") - F.col("low")).alias("length"), "label", "base", "share", (F.col("share") >= F.col("least")).alias("enough")
    )
    found = F.col("template").isNotNull()
    own = verified.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.max(F.when(~found, F.col("copies"))).alias("copies"), F.sort_array(F.collect_list(F.when(found, span))).alias("spans")
    )
    return own.select("doc_id", "n_words", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def summary(found: DataFrame) -> DataFrame:
    """One row per document: how often and where it names a licence plainly, the labels of that and of all spans, and the best share of any template."""

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.filter("spans", lambda s: s["enough"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
