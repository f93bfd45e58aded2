"""License phrases and license sentences by diagonal voting.

Templates are short word sequences: phrases, which must stand word for word (such as names that differ in one word from another's), and
sentences of known licenses, which may be cut or changed a little. Every rolling pair of words (``GRAM``) of every text is hashed and joined with the template positions that have the same hash. A hit at
word w for template position p votes for the diagonal w - p; the positions that voted for a diagonal are kept as the bits of a long, which adds
up the same in any order. A phrase stands where all its positions vote for one diagonal. For a sentence neighbouring diagonals
(up to ``SLACK`` words apart, as inserted or missing words shift what follows) are merged, and a span is verified if the merged votes cover
``PERCENT`` of the template's words; of overlapping merged diagonals the best one is kept, among equal ones the first.

The join is one pass without a shuffle: templates are a fixed table of at most 64 positions each and are broadcast; texts of any length pass in
pieces of ``PIECE`` words. Only hits and one head row per document are written; documents are numbered in that pass, so ids may be null or
repeated. Votes are then grouped by document, template and diagonal, which spreads a document that repeats a license many times.

Null or empty texts have no words, no places and score 0. Words are told apart by 64-bit hashes of word pairs. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pairloom.llm.stages import Stage
from pairloom.llm.words import NOT_ALPHANUMERIC, blocks, grams, utf8, words
from pairloom.session import fixed_table

GRAM = 2
SLACK = 3
PERCENT = 75
PIECE = 1 << 16
_HEAD = 0x1CE5E  # a hash that stands for "a document begins"; its diagonal is the document's number of words
_NO_TEMPLATE = -1


class Template(NamedTuple):
    label: str
    text: str
    exact: bool = False
    base: bool = False


# The base phrases, and sentences of public licenses in lower case.
TEMPLATES = (
    Template("mit", "mit license", exact=True, base=True),
    Template("apache", "apache license", exact=True, base=True),
    Template("gpl", "general public license", exact=True, base=True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction",
    ),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl", "it under the terms of the gnu general public license as published by the free software foundation either version"),
    Template("lgpl", "gnu lesser general public license", exact=True),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by", "licensed under cc by 4 0", exact=True),
    Template("cc-by-sa", "licensed under cc by sa 4 0", exact=True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", exact=True),
)


def _pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word pairs of a few texts, and at which word each text begins."""
    data, offsets = utf8(texts)
    hashes, _, _, at = words(data, offsets, NOT_ALPHANUMERIC, lower=True)
    return grams(hashes, GRAM).view(np.int64), at


def _positions(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per template position, and the one that every document's head meets."""
    rows = [(_HEAD, _NO_TEMPLATE, 0)]
    for t, template in enumerate(templates):
        hashes, _ = _pairs(pa.array([template.text]))
        if not 0 < len(hashes) < 64:
            raise ValueError(f"a template has 2 to 64 words: {template.text!r}")
        rows += [(int(h), t, place) for place, h in enumerate(hashes)]
    return fixed_table(spark, rows, "gram bigint, template int, place int")


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text a head row, and the hashes of its word pairs in pieces."""
    for batch in batches:
        numbers = batch.column("row").to_numpy()
        _, offsets = utf8(batch.column("text"))
        for first, last in blocks(offsets):
            pairs, at = _pairs(batch.column("text").slice(first, last - first))
            row, begin, end = [], [], []
            for k in range(last - first):
                for b in range(int(at[k]), int(at[k + 1]) - GRAM + 1, PIECE):
                    row.append(k)
                    begin.append(b)
                    end.append(min(b + PIECE, int(at[k + 1]) - GRAM + 1))
            row, begin, end = (np.array(x, np.int64) for x in (row, begin, end))
            inside = np.ones(len(pairs), bool)  # pairs that run over the end of a text belong to no piece
            inside[at[1:-1][at[1:-1] > 0] - 1] = False
            heads = last - first
            lists = pa.ListArray.from_arrays(
                np.concatenate([np.arange(heads + 1), heads + np.cumsum(end - begin)]).astype(np.int32),
                np.concatenate([np.full(heads, _HEAD, np.int64), pairs[inside]]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([numbers[first:last], numbers[first:last][row]])),
                    pa.concat_arrays([batch.column("id").slice(first, heads), pa.nulls(len(row), batch.column("id").type)]),
                    pa.array(np.concatenate([np.diff(at), begin - at[row]])),
                    lists,
                ],
                ["row", "id", "at", "grams"],
            )


def _covered(mask: Column) -> Column:
    """Words of the template that the pairs of a mask cover."""
    return F.bit_count(mask.bitwiseOR(F.shiftleft(mask, 1)))


class Scan:
    """Heads (row, id, n_words) and verified spans (row, label, base, first, last, share) of all texts; ``drop`` removes their table."""

    def __init__(self, docs: DataFrame, id: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> None:
        spark = docs.sparkSession
        given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
        rolled = given.mapInArrow(_rolling, f"row bigint, id {given.schema['id'].dataType.simpleString()}, at bigint, grams array<bigint>")
        opened = rolled.select("row", "id", "at", F.posexplode("grams").alias("pos", "gram"))
        met = opened.join(F.broadcast(_positions(spark, templates)), "gram")
        word = F.col("at") + F.col("pos")
        self._hits = Stage(met.select("row", "id", "template", "place", word.alias("word")), "hits")
        self.heads = self._hits.df.where(F.col("template") == _NO_TEMPLATE).select("row", "id", F.col("word").alias("n_words"))
        self.spans = self._spans(spark, templates)

    def _spans(self, spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
        sizes = [(t, x.label, x.exact, x.base, len(x.text.split())) for t, x in enumerate(templates)]
        known = F.broadcast(fixed_table(spark, sizes, "template int, label string, exact boolean, base boolean, size int"))
        votes = (
            self._hits.df.where(F.col("template") != _NO_TEMPLATE)
            .groupBy("row", "template", (F.col("word") - F.col("place")).alias("diagonal"))
            .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"), F.min("word").alias("first"), F.max("word").alias("last"))
            .join(known, "template")
        )
        whole = votes.where(F.col("exact") & (F.bit_count("mask") == F.col("size") - 1)).select(
            "row", "label", "base", "first", (F.col("last") + GRAM - 1).alias("last"), F.lit(1.0).alias("share")
        )
        line = Window.partitionBy("row", "template").orderBy("diagonal")
        near, before, after = line.rangeBetween(-SLACK, SLACK), line.rangeBetween(-SLACK, -1), line.rangeBetween(1, SLACK)
        merged = votes.where(~F.col("exact")).select(
            "row", "template", "label", "base", "size", "diagonal",
            _covered(F.bit_or("mask").over(near)).alias("covered"), F.min("first").over(near).alias("first"), F.max("last").over(near).alias("last"),
        )
        sound = merged.where(F.col("covered") * 100 >= F.col("size") * PERCENT)
        best = sound.select(
            "*", F.coalesce(F.max("covered").over(before), F.lit(0)).alias("_before"), F.coalesce(F.max("covered").over(after), F.lit(0)).alias("_after")
        ).where((F.col("covered") > F.col("_before")) & (F.col("covered") >= F.col("_after")))
        return whole.union(best.select("row", "label", "base", "first", (F.col("last") + GRAM - 1).alias("last"), (F.col("covered") / F.col("size")).alias("share")))

    def drop(self) -> None:
        self._hits.drop()


def license_report(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: id, n_words, places and labels of the phrases, all labels, and the best share of a template found."""
    scan = Scan(docs, id, text, templates)
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("label", "string"), ("base", "boolean"), ("first", "bigint"), ("share", "double"))]
    heads = scan.heads.select("row", "id", "n_words", *nothing)
    found = scan.spans.select("row", F.lit(None).cast(heads.schema["id"].dataType).alias("id"), F.lit(None).cast("bigint").alias("n_words"), "label", "base", "first", "share")
    # a document's spans meet as one row for each label
    labels = heads.unionByName(found).groupBy("row", "label", "base").agg(
        F.max("id").alias("id"), F.max("n_words").alias("n_words"), F.count("base").alias("n"),
        F.min("first").alias("first"), F.max("first").alias("last"), F.max("share").alias("share"),
    )

    def named(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    base = F.col("base")
    report = labels.groupBy("row").agg(
        F.max("id").alias("id"),
        F.max("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(base, F.col("n"))), F.lit(0)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("last"))).alias("last_word"),
        named(F.when(base, F.col("label"))).alias("base_labels"),
        named(F.col("label")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    done = Stage(report.drop("row"), "licenses")
    scan.drop()
    return done.df
