"""Token ids as canonical length-limited Huffman codes, in independent blocks of a written table.

Texts are encoded once, into a stage of packed ids with the counts of each task beside them. Ids are counted over all documents; package merging gives the best code whose lengths are at most ``LIMIT`` bits, and the lengths
alone define the canonical code. Documents go to files in ascending order of id (a range partition of the ids, then a sort in each
range). A block holds whole documents of about ``BLOCK_IDS`` ids: their ids and lengths, the code bits, and the bit offset of
every ``STEP``-th id. Reading needs one block and the code lengths: the decoder starts at all checkpoints of a block at once and looks
each code up in a table of all ``LIMIT``-bit beginnings.

A null text is empty; every document ends with ``END``. Rows without an id come first. Rows that repeat an id follow one another, in no
defined order. An empty table makes a file without blocks. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pairloom.llm.bpe import byte_letters
from pairloom.llm.pieces import Remembering, encode_texts
from pairloom.llm.stages import Stage, partitions

LIMIT = 16
END = 2
BLOCK_IDS = 1 << 20
STEP = 512
_BLOCKS = "shard bigint, block bigint, n_ids bigint, doc_ids array<bigint>, bits binary"
_MAGIC = b"HUF1"
_HEAD = struct.Struct("<4sQQQ")  # magic, ids, documents, bits


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The best code lengths of at most ``limit`` bits, by package merging; 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids cannot have codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.float64)
    packages, leaves = np.zeros(0), []
    for _ in range(limit):
        merged = np.concatenate([weight, packages])
        order = np.argsort(merged, kind="stable")
        leaves.append(order < len(weight))
        merged = merged[order]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(used) - 2
    for leaf in reversed(leaves):
        own = int(leaf[:take].sum())
        lengths[used[:own]] += 1
        take = 2 * (take - own)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    code, before = 0, 0
    starts: dict[int, tuple[int, int]] = {}
    at = 0
    for size, many in zip(*np.unique(lengths[used], return_counts=True)):
        code <<= int(size) - before
        codes[used[at : at + many]] = np.arange(code, code + many, dtype=np.uint64)
        code, before, at = code + int(many), int(size), at + int(many)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every beginning of LIMIT bits: the id and the length of its code."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spread = 1 << (LIMIT - lengths[used])
    ids, size = np.zeros(1 << LIMIT, np.int64), np.ones(1 << LIMIT, np.int64)
    total = int(spread.sum())
    ids[:total], size[:total] = np.repeat(used, spread), np.repeat(lengths[used], spread)
    return ids, size


def pack(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    """One block: head, ids per document, checkpoints, bits."""
    size = lengths[ids]
    ends = np.cumsum(size)
    begin = ends - size
    bits = int(ends[-1]) if len(ids) else 0
    words = np.zeros((bits + 63) // 64 + 1, np.uint64)
    if len(ids):
        code, place = codes[ids], begin >> 6
        room = 64 - (begin & 63) - size  # negative: the code goes on in the next word
        over = np.maximum(-room, 0).astype(np.uint64)
        high = (code >> over) << np.maximum(room, 0).astype(np.uint64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        words[place[first]] += np.add.reduceat(high, first)
        split = np.flatnonzero(room < 0)
        words[place[split] + 1] += code[split] << (np.uint64(64) - over[split])
    body = words.astype(">u8").tobytes()
    return b"".join([_HEAD.pack(_MAGIC, len(ids), len(counts), bits), counts.astype("<i8").tobytes(), begin[::STEP].astype("<i8").tobytes(), body])


def unpack(block: bytes, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block and the number of ids of each document."""
    magic, many, documents, _ = _HEAD.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of Huffman codes")
    at = _HEAD.size
    counts = np.frombuffer(block, "<i8", documents, at)
    lanes = -(-many // STEP)
    place = np.frombuffer(block, "<i8", lanes, at + 8 * documents).copy()
    data = np.frombuffer(block, np.uint8, offset=at + 8 * (documents + lanes)).astype(np.uint32)
    windows = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    ids, size = table
    out = np.zeros((STEP, lanes), np.int32)
    full = lanes - (1 if many % STEP else 0)
    for k in range(STEP):
        if k == many % STEP and full < lanes:  # the last lane has no more ids
            place = place[:full]
        if not len(place):
            break
        peek = (windows[place >> 3] >> (np.uint32(8) - (place & 7).astype(np.uint32))) & np.uint32((1 << LIMIT) - 1)
        out[k, : len(place)] = ids[peek]
        place = place + size[peek]
    return out.T.ravel()[:many], counts


#: Letters of the Latin blocks, with one blank before them or none: one word of the published split pattern, whatever its Unicode version.
_ONE_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+")


@cache
def _encoder(path: str) -> tuple[Remembering, tuple[bytes, ...], int]:
    """The library's encoder of pieces, the special tokens, the size of the vocabulary. Pieces of one word go straight to the library's model."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    special = tuple(t.content.encode() for t in tokenizer.get_added_tokens_decoder().values())
    split = tokenizer.pre_tokenizer
    by_words = tokenizer.normalizer is None and isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
    letters = {b: c for c, b in byte_letters().items()}
    blank, model = letters[0x20], tokenizer.model
    own = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]

    def word(piece: bytes) -> bytes:
        if piece.isascii():
            text = piece.decode()
            text = blank + text[1:] if text[0] == " " else text
        else:
            text = piece.decode("latin-1").translate(letters)
        return b"".join([own[t.id] for t in model.tokenize(text)])

    def run(pieces: list[bytes]) -> list[bytes]:
        alike = [p for p in pieces if _ONE_WORD.fullmatch(p) and p not in special] if by_words else []
        known = dict(zip(alike, map(word, alike)))
        rest = [p for p in pieces if p not in known]
        coded = tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)
        known.update((p, b"".join([own[i] for i in c.ids])) for p, c in zip(rest, coded))
        return [known[p] for p in pieces]

    return Remembering(run), special, tokenizer.get_vocab_size(with_added_tokens=True)


def _packed(size: int) -> str:
    """How an id below ``size`` is kept in the stage."""
    return "<u2" if size <= 1 << 16 else "<u4"


_CODED = "id bigint, ids binary, token array<int>, n array<bigint>"


def _code(path: str):
    """id, text -> id and its packed ids, ``END`` included; the last row of a task has no ids but how often each id occurred in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, special, size = _encoder(path)
        total, kind = np.zeros(size, np.int64), _packed(size)
        width = np.dtype(kind).itemsize
        names = ["id", "ids", "token", "n"]
        for batch in batches:
            for first, last, flat, at in encode_texts(batch.column(1), encoder, special):
                with_end = np.insert(flat, at[1:], END)
                total += np.bincount(with_end, minlength=size)
                places = (at + np.arange(len(at))).astype(np.int32) * width
                ids = pa.BinaryArray.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(places), pa.py_buffer(with_end.astype(kind))])
                nothing = pa.nulls(last - first, pa.list_(pa.int32())), pa.nulls(last - first, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), ids, *nothing], names=names)
        used = np.flatnonzero(total)
        counts = pa.array([used], pa.list_(pa.int32())), pa.array([total[used]], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), *counts], names=names)

    return run


def _blocks(kind: str, lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical(lengths)
        shard, number = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        named: list[int | None] = []
        counts: list[int] = []
        held = 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    pa.array([number], pa.int64()),
                    pa.array([len(flat)], pa.int64()),
                    pa.array([named], pa.list_(pa.int64())),
                    pa.array([pack(flat, np.array(counts), lengths, codes)], pa.binary()),
                ],
                names=["shard", "block", "n_ids", "doc_ids", "bits"],
            )

        for batch in batches:
            own = batch.column(0).to_pylist()
            for row, packed in enumerate(batch.column(1)):
                coded = np.frombuffer(packed.as_buffer(), kind).astype(np.int32)
                ids.append(coded)
                counts.append(len(coded))
                named.append(own[row])
                held += len(coded)
                if held >= BLOCK_IDS:
                    yield block()
                    number, held = number + 1, 0
                    ids, named, counts = [], [], []
        if ids:
            yield block()

    return run


def _read(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, counts = unpack(batch.column(3)[row].as_py(), table)
                ends = np.cumsum(counts)
                raw = ids.astype("<u4")
                for at in range(0, len(counts), 1000):  # rows of ids leave in small batches
                    part = ends[at : at + 1000]
                    low = int(part[0] - counts[at])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], part - low]).astype(np.int32)), pa.array(raw[low : part[-1]].astype(np.int64)))
                    many = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(many, batch.column(0)[row].as_py())),
                            pa.array(np.full(many, batch.column(1)[row].as_py())),
                            batch.column(2)[row].values.slice(at, many),
                            pa.array(part - counts[at : at + 1000]),
                            lists,
                        ],
                        names=["shard", "block", "id", "offset", "ids"],
                    )

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode all texts and write the files: ``path``/codes (length of each id's code) and ``path``/blocks."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    coded = Stage(texts.mapInArrow(_code(tokenizer), _CODED), "token-ids")
    by_task = coded.df.where("token is not null").select(F.explode(F.arrays_zip("token", "n")).alias("c"))
    counted = by_task.groupBy("c.token").agg(F.sum("c.n").alias("n")).toArrow()
    token, n = counted["token"].to_numpy(), counted["n"].to_numpy()  # a row per id of the vocabulary at most
    counts = np.zeros(int(token.max(initial=END)) + 1, np.int64)
    counts[token] = n
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"token": used, "bits": lengths[used]})).coalesce(1).write.parquet(f"{path}/codes")
    ordered = coded.df.where("ids is not null").select("id", "ids").repartitionByRange(partitions(spark), "id").sortWithinPartitions("id")
    blocks = ordered.mapInArrow(_blocks(_packed(_encoder(tokenizer)[2]), lengths), _BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    coded.drop()


def _lengths(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("token bigint, bits bigint").parquet(f"{path}/codes").toArrow()
    token, bits = rows["token"].to_numpy(), rows["bits"].to_numpy()
    lengths = np.zeros(int(token.max(initial=0)) + 1, np.int64)
    lengths[token] = bits
    return lengths


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each block: a running sum over a shard's blocks, plus the shards before (one row per shard)."""
    sizes = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = shards.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("base"))
    running = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    return sizes.withColumn("running", running).join(before, "shard").select("shard", "block", (F.col("base") + F.col("running")).alias("first"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: shard, block, id, offset in the block, ids."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").select("shard", "block", "doc_ids", "bits")
    return blocks.mapInArrow(_read(_lengths(spark, path)), "shard bigint, block bigint, id bigint, offset bigint, ids array<bigint>")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(4)
        flat, at = np.asarray(lists.flatten()).astype("<u4"), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        sums = [zlib.crc32(flat[b:e].tobytes()) for b, e in zip(at[:-1], at[1:])]
        columns = [batch.column(k) for k in range(4)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())], names=["shard", "block", "id", "offset", "n_ids", "crc32"])


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), n_ids, crc32 of its ids as 32-bit integers."""
    sums = read_ids(spark, path).mapInArrow(_sums, "shard bigint, block bigint, id bigint, offset bigint, n_ids bigint, crc32 bigint")
    joined = sums.join(block_starts(spark, path), ["shard", "block"])
    return joined.select("id", (F.col("first") + F.col("offset")).alias("start"), "n_ids", "crc32")
