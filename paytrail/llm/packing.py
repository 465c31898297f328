"""Packing by concatenate and cut.

Pass one tokenizes each partition and stores ids with running totals inside the partition.
The prefix sums of the partition totals then give every document its place in one global
stream of tokens, and pass two cuts the stream into windows of fixed length. A window that
begins in one partition and ends in another is put together from boundary records.
"""

import base64
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import shipped, store

LENGTH = 2048
#: The vocabulary: byte-level BPE, its ranks for the faster of two libraries with equal ids.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The added token of the vocabulary's other file, byte_bpe_50k.json, and its id.
ADDED = {"<|endoftext|>": 50256}
#: Id that ends every document.
END = 1


@cache
def encoder(vocabulary: str = VOCABULARY):
    """The encoder of a vocabulary file, once for each Python worker."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens=ADDED if vocabulary == VOCABULARY else {},
    )


def encode(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    """Ids of a text; what looks like a special token is ordinary text."""
    return encoder(vocabulary).encode_ordinary(text)


def encode_added(text: str) -> list[int]:
    """Ids of a text as ``tokenizers`` gives them by the file as loaded: an added token is one id."""
    return encoder().encode(text, allowed_special="all")


TOKENS = "part int, before long, doc_id long, doc_tokens long, ids binary"


def tokenize(docs: DataFrame, end: int = END, added: bool = False) -> DataFrame:
    """Pass one: rows in partition order, ``before`` the partition's tokens so far."""
    ids_of = encode_added if added else encode

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            starts, counts, ids = [], [], []
            for text in batch.column("text").to_pylist():
                found = np.array([*ids_of(text or ""), end], "<u4")
                starts.append(before)
                counts.append(len(found))
                before += len(found)
                ids.append(found.astype("<u2").tobytes() if found.max() < 65536 else found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                 batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.binary())],
                ["part", "before", "doc_id", "doc_tokens", "ids"],
            )

    return shipped(docs).select("doc_id", "text").mapInArrow(run, TOKENS)


def place(tokens: DataFrame) -> DataFrame:
    """Add ``at``, the global offset, to stored rows of ``tokenize``.

    One row for each partition of pass one is ordered in a single window; that table is
    stored, so the planner broadcasts it only if its files are small.
    """
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = store(
        totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")),
        "packing-bases",
    )
    return tokens.join(bases, "part").select(
        "doc_id", "doc_tokens", "ids", (F.col("base") + F.col("before")).alias("at")
    )


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _ids(row_ids, count):
    return np.frombuffer(row_ids, "<u2" if len(row_ids) == 2 * count else "<u4").astype("<u4")


def _cut(batch, length):
    """(row, start, stop, global offset) of each piece, and the row's ids."""
    columns = (batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "ids", "at"))
    for doc_id, count, raw, at in zip(*columns, strict=True):
        ids, start = _ids(raw, count), 0
        while start < count:
            stop = min(count, start + length - (at + start) % length)
            yield doc_id, count, start, ids[start:stop], at + start
            start = stop


def pack(docs: DataFrame, length: int = LENGTH, added: bool = False) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one a piece.

    Every row of ``docs`` (doc_id, text) gives its ids and the end id; a null or empty
    text gives the end id alone, repeated rows are packed again, a null doc_id stays null,
    and an empty table gives no rows. Only the last sequence can be shorter than ``length``.
    With ``added``, the added token of the vocabulary counts as one id; else it is ordinary text.
    """
    placed = place(store(tokenize(docs, added=added), "packing-tokens"))

    def run(batches):
        for batch in batches:
            rows = [
                (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), count, at // length, at % length)
                for doc_id, count, start, ids, at in _cut(batch, length)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return placed.mapInArrow(run, PIECES)


def sequences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The training sequences themselves: (sequence_id, ids array<int>), unpadded.

    Windows complete inside a task pass straight on; only boundary records, at most two
    for each task and file split, are shuffled and joined by their offsets.
    """
    placed = place(store(tokenize(docs), "packing-tokens"))

    def run(batches):
        window, offset, ids = None, 0, []
        for batch in batches:
            done = []
            for _, _, _, piece, at in _cut(batch, length):
                if window != at // length or offset + sum(map(len, ids)) != at % length:
                    if ids:
                        done.append((window, offset, np.concatenate(ids)))
                    window, offset, ids = at // length, at % length, []
                ids.append(piece)
            if done:
                yield _records(done)
        if ids:
            yield _records([(window, offset, np.concatenate(ids))])

    def _records(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2].tolist() for d in done], pa.list_(pa.int32()))],
            ["sequence_id", "offset", "ids"],
        )

    cut = store(placed.mapInArrow(run, "sequence_id long, offset long, ids array<int>"), "packing-cut")
    whole = cut.where(F.size("ids") == length).select("sequence_id", "ids")
    boundary = cut.where(F.size("ids") < length).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("records")
    )
    return whole.unionByName(
        boundary.select("sequence_id", F.flatten(F.col("records.ids")).alias("ids"))
    )
