"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur with k edits. Cut into k + 1 pieces, at least one piece
occurs unchanged, so an Aho-Corasick automaton over all pieces finds every place worth a
look. There Myers' bit-parallel algorithm computes the edit distance. The items are taken in
blocks of bounded size, and each block against all documents.
"""

from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import running, shipped, store, unused

#: Edits allowed, in hundredths of an item's characters.
ERROR_PERCENT = 6
#: A piece has at least so many characters; short items are allowed fewer edits for it.
LEAST_PIECE = 12
#: Characters of test items that one task holds at a time.
BLOCK_CHARS = 4_000_000

Block = tuple[tuple[int, str], ...]


def normal(text: str | None) -> str:
    """Lower case, each run of white space one space."""
    return " ".join(text.lower().split()) if text else ""


def budget(length: int) -> int:
    return max(0, min(length * ERROR_PERCENT // 100, length // LEAST_PIECE - 1))


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, text) of the budget + 1 pieces, of nearly equal length."""
    k = budget(len(item))
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of ``pattern`` in ``text``, or None above ``most``."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        peq[ch] = peq.get(ch, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = ones, 0, m, None
    for at, ch in enumerate(text):
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & ones
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & ones
        mh = mh << 1 & ones
        pv = mh | ~(xv | ph) & ones
        mv = ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, at + 1)
            if not score:
                break
    return best


@lru_cache(maxsize=1)
def _automaton(items: Block):
    where: dict[str, list[tuple[int, int]]] = {}
    for n, (_, item) in enumerate(items):
        for offset, piece in pieces(item):
            where.setdefault(piece, []).append((n, offset))
    automaton = ahocorasick.Automaton()
    for piece, owners in where.items():
        automaton.add_word(piece, (len(piece), owners))
    automaton.make_automaton()
    return automaton


def search(text: str | None, items: Block) -> list[tuple[int, int, int]]:
    """(item_id, distance, end in the normal text), the best place of each item that occurs."""
    text = normal(text)
    spans: dict[int, list[list[int]]] = {}
    for end, (size, owners) in _automaton(items).iter(text):
        for n, offset in owners:
            length = len(items[n][1])
            k = budget(length)
            start = end + 1 - size - offset
            low, high = max(0, start - k), start + length + k
            known = spans.setdefault(n, [])
            # Hits come by their end, so a repeated piece may move the start back.
            while known and low <= known[-1][1]:
                before = known.pop()
                low, high = min(low, before[0]), max(high, before[1])
            known.append([low, high])
    found = []
    for n, places in spans.items():
        item_id, item = items[n]
        best = None
        for low, high in places:
            hit = myers(item, text[low:high], budget(len(item)))
            if hit and (best is None or hit[0] < best[0]):
                best = (hit[0], low + hit[1])
        if best:
            found.append((item_id, *best))
    return found


def blocks(items: DataFrame) -> Iterator[Block]:
    """The test items, one block of about BLOCK_CHARS characters after the other.

    Prefix sums of the items' lengths deal them to blocks, so neither a task nor the driver holds
    more than one block; a block exceeds the size by less than one item.
    """
    def plain(batches):
        for batch in batches:
            texts = [normal(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(texts, pa.string())], ["item_id", "text"]
            )

    named = shipped(items).where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    # Repeats go before the dealing: in two blocks an item would be found twice.
    distinct = named.mapInArrow(plain, "item_id long, text string").where("text <> ''").distinct()
    sized = distinct.select("item_id", "text", F.length("text").alias("n"))
    order = [F.col("item_id"), F.xxhash64("text")]
    before = running(sized, [], order, F.col("n").cast("long"), "before")
    dealt = store(
        before.select("item_id", "text", F.floor(F.col("before") / BLOCK_CHARS).alias("block")), "test-items"
    )
    for (number,) in dealt.select("block").distinct().orderBy("block").collect():
        rows = dealt.where(F.col("block") == number).select("item_id", "text").collect()
        yield tuple(sorted((r.item_id, r.text) for r in rows))


MATCHES = "doc_id long, item_id long, distance long, end long"


def _found(docs: DataFrame, block: Block) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
                )
                for hit in search(text, block)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "end"]
            )

    return shipped(docs).select("doc_id", "text").mapInArrow(run, MATCHES)


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, distance, end) of every test item found in a document.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not
    looked at. The best place of an item counts once for each row of ``docs``. Null and
    empty texts and items without an id match nothing; repeated items with one id and text
    count once; with several texts for an id each is searched. Each block's matches are stored
    before the next block is read.
    """
    parts = [store(_found(docs, block), "test-matches") for block in blocks(items)]
    return reduce(DataFrame.unionByName, parts, docs.sparkSession.createDataFrame([], MATCHES))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no test item occurs, with all their columns.

    Each block stores digests of the texts it is found in, and one anti-join takes their rows out. So
    null and repeated doc_ids do no harm, and equal texts go together; null texts stay.
    """
    def contaminated(block):
        def run(batches):
            for batch in batches:
                hits = [bool(search(text, block)) for text in batch.column("text").to_pylist()]
                yield batch.select(["digest"]).filter(pa.array(hits, pa.bool_()))

        texts = shipped(docs).select("text", F.sha2("text", 256).alias("digest"))
        return store(texts.mapInArrow(run, "digest string").distinct(), "test-texts")

    parts = [contaminated(block) for block in blocks(items)]
    if not parts:
        return docs
    digest = unused(docs, "_digest")
    found = reduce(DataFrame.unionByName, parts).distinct().withColumnRenamed("digest", digest)
    return docs.withColumn(digest, F.sha2("text", 256)).join(found, digest, "left_anti").drop(digest)
