"""A training corpus from raw documents: five stages, each over all that the one before kept.

Each stage takes the documents so far and the folder of the other tables, and returns a DataFrame; ``run`` writes it as a
table in the shared folder and reads it again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import bpe
from pairloom.llm.decontaminate import benchmark_hits
from pairloom.llm.minhash import near_duplicates
from pairloom.llm.stages import Stage, read
from pairloom.llm.substring import remove_repeats
from pairloom.llm.toxicity import THRESHOLD, held_out, toxicity
from pairloom.session import materialize

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score below the threshold; rows without an id are scored by their text like all others."""
    learned = read(spark, folder, "labels").where(~held_out("doc_id"))
    scored = toxicity(docs, learned, keep=[c for c in docs.columns if c != "text"]).where(F.col("score") < THRESHOLD)
    return scored.select(*[F.col(c if c == "text" else f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    dropped = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages that an earlier document has; texts that lose nothing stay as they are."""
    done = remove_repeats(docs, keep=[c for c in docs.columns if c != "text"])
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text")
    chars = F.when(changed, F.char_length("kept").cast("bigint")).otherwise(F.col("row.n_chars")).alias("n_chars")
    return done.select(*[{"text": text, "n_chars": chars}.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs, with or without an id: a row is known by the hash of its id and text."""
    row = F.xxhash64("doc_id", "text")
    found = benchmark_hits(docs.select(row.alias("row"), "text"), read(spark, folder, "benchmark"), id_column="row")
    hit = found.where("size(begins) > 0").select(F.col("id").alias("hit")).distinct()
    return docs.join(hit, row == F.col("hit"), "left_anti").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document and the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = materialize(bpe.encode(docs, path), "encoded")  # else each task would keep two Python workers, for as long as its executor lives
    coded = bpe.decode(encoded, path)
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES: list[tuple[str, Step]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_passages),
    ("benchmark", drop_contaminated),
    ("tokens", tokenize),
]

#: The first stage learns a model, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    before: Stage | None = None
    for name, step in STAGES:
        stage = Stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            before.drop()
        docs, before = stage.df, stage
    return docs
