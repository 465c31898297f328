"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraph blocks; each block's digest, numbered by its repeats, goes into
three cells of a small table of (count, xor of keys, xor of checks). Subtracting the sketches of
two versions leaves only what differs, and peeling cells that hold one key recovers
those digests. If peeling stops early, both sketches are made again with four times the cells.
"""

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import shipped

#: Cells of the fingerprint itself; three tables of eight.
CELLS = 24
HASHES = 3
GROWTH = 4
#: Blocks end with a line or a sentence, and after so many code points.
LONGEST = 96
_BLOCK = re.compile(r"[^\n.!?]{1,%d}[.!?]*\n?|[\n.!?]+" % LONGEST)


def blocks(text: str) -> list[str]:
    """Paragraphs, cut further at sentence ends and after LONGEST code points."""
    return _BLOCK.findall(text)


def _mix(x, salt):
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(text: str) -> np.ndarray:
    """A distinct 64-bit key for each block; the n-th repeat of a block has a key of its own."""
    seen: dict[str, int] = {}
    hashes, repeats = [], []
    for block in blocks(text):
        n = seen.get(block, 0)
        seen[block] = n + 1
        hashes.append(xxhash.xxh3_64_intdigest(block))
        repeats.append(n)
    # A set without repeats: otherwise one key could never be peeled.
    return np.unique(_mix(np.array(hashes, np.uint64) + _mix(np.array(repeats, np.uint64), 1), 2))


def _checks(key):
    return (_mix(key, 0x1234567) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _cells(key, cells):
    """The HASHES cells of each key, one in each third of the table."""
    third = cells // HASHES
    return [
        (_mix(key, 0x9E3779B9 * (i + 1)) % np.uint64(third)).astype(np.int64) + i * third
        for i in range(HASHES)
    ]


def sketch(owner, key, sign, owners, cells):
    """Tables (counts, keys, checks) of shape (owners, cells); ``sign`` adds or subtracts."""
    counts = np.zeros(owners * cells, np.int32)
    xors = np.zeros(owners * cells, np.uint64)
    checks = np.zeros(owners * cells, np.uint32)
    check = _checks(key)
    for cell in _cells(key, cells):
        at = owner * cells + cell
        np.add.at(counts, at, sign)
        np.bitwise_xor.at(xors, at, key)
        np.bitwise_xor.at(checks, at, check)
    return counts, xors, checks


def peel(tables, owners, cells):
    """Number of keys recovered for each owner (-1: not all), their owners and the keys."""
    counts, xors, checks = tables
    taken_by, taken = [], []
    while True:
        pure = np.flatnonzero((np.abs(counts) == 1) & (_checks(xors) == checks))
        if not len(pure):
            break
        # One key may be pure in several of its cells: take it once.
        owner, key = pure // cells, xors[pure]
        order = np.lexsort((key, owner))
        first = np.ones(len(order), bool)
        first[1:] = (owner[order][1:] != owner[order][:-1]) | (key[order][1:] != key[order][:-1])
        pick = order[first]
        owner, key, sign = owner[pick], key[pick], counts[pure[pick]]
        for cell in _cells(key, cells):
            at = owner * cells + cell
            np.add.at(counts, at, -sign)
            np.bitwise_xor.at(xors, at, key)
            np.bitwise_xor.at(checks, at, _checks(key))
        taken_by.append(owner)
        taken.append(key)
    left = ((counts != 0) | (xors != 0)).reshape(owners, cells).any(axis=1)
    by = np.concatenate(taken_by) if taken_by else np.empty(0, np.int64)
    found = np.bincount(by, minlength=owners)
    return np.where(left, -1, found), by, (np.concatenate(taken) if taken else np.empty(0, np.uint64))


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """How many keys differ in each pair; sketches that cannot be peeled grow and try again."""
    result = np.zeros(len(left), np.int64)
    pending = np.array([i for i in range(len(left)) if len(left[i]) or len(right[i])], np.int64)
    while len(pending):
        sizes_l, sizes_r = ([len(side[i]) for i in pending] for side in (left, right))
        owner = np.concatenate([
            np.repeat(np.arange(len(pending)), sizes_l), np.repeat(np.arange(len(pending)), sizes_r)
        ])
        key = np.concatenate([*(left[i] for i in pending), *(right[i] for i in pending)])
        sign = np.repeat([1, -1], [sum(sizes_l), sum(sizes_r)]).astype(np.int32)
        # A pair that differs by more keys in number than there are cells cannot be peeled yet.
        small = np.abs(np.subtract(sizes_l, sizes_r)) > cells
        use = ~small[owner]
        found, _, _ = peel(sketch(owner[use], key[use], sign[use], len(pending), cells), len(pending), cells)
        done = (found >= 0) & ~small
        result[pending[done]] = found[done]
        pending = pending[~done]
        cells *= GROWTH
    return result


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> list[float]:
    """Shared blocks over all blocks (Jaccard of the keys); 1 for two empty texts."""
    shared = []
    for a, b, d in zip(left, right, differences(left, right).tolist(), strict=True):
        common = (len(a) + len(b) - d) // 2
        shared.append(common / (common + d) if common + d else 1.0)
    return shared


def fingerprints(key_lists: list[np.ndarray], cells: int = CELLS) -> list[str]:
    """The sketches as text: counts (16 bits), keys and checks of all cells, in base64."""
    owner = np.repeat(np.arange(len(key_lists)), list(map(len, key_lists)))
    key = np.concatenate([np.empty(0, np.uint64), *key_lists])
    tables = sketch(owner, key, np.int32(1), len(key_lists), cells)
    counts, xors, checks = (t.reshape(len(key_lists), cells) for t in tables)
    return [
        base64.b64encode(c.astype("<u2").tobytes() + x.astype("<u8").tobytes() + k.astype("<u4").tobytes())
        .decode() for c, x, k in zip(counts, xors, checks, strict=True)
    ]


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the beginning of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


#: Ranges of documents at most; more data makes them longer, and tasks read them as streams.
RANGES = 4096
_ORDER = ("last", "at", "tie")


def _range_of(at, cuts: list[int]):
    """How many of the ascending ``cuts`` are not above ``at``, by binary search."""
    if not cuts:
        return F.lit(0)
    array = F.array(*map(F.lit, cuts))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when(
        (p + s <= len(cuts)) & (F.element_at(array, p + s) <= at), p + s
    ).otherwise(p))


def _dealt(docs: DataFrame) -> DataFrame:
    """(range, guest, doc_id, text, ...): each document and, behind it, its successor.

    Documents are dealt to ranges of the descending doc_id. Each range also gets a guest copy of
    the first document of the next range, and the last range that of the very first.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({
        "last": F.col("doc_id").isNull(), "tie": F.xxhash64("text"),
        "at": F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit((1 << 63) - 1)),
    })
    count, chars = rows.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    ranges = min(RANGES, max(1, (chars or 0) // 16_000_000, count // 20_000))
    cuts = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = sorted(set(rows.agg(F.percentile_approx("at", shares, 20 * ranges)).first()[0]))
    rows = rows.withColumn("range", _range_of(F.col("at"), cuts))
    firsts = rows.groupBy("range").agg(F.min(F.struct(*_ORDER)).alias("f")).orderBy("range").collect()
    guests = [(*row.f, firsts[i - 1].range) for i, row in enumerate(firsts)]
    schema = "last boolean, at long, tie long, host int"
    # At most RANGES rows, so they can go to every task and the texts are dealt once only.
    heads = F.broadcast(docs.sparkSession.createDataFrame(guests, schema))
    own = F.struct(F.col("range").cast("int").alias("range"), F.lit(False).alias("guest"))
    copy = F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, copy))
    return rows.join(heads, list(_ORDER), "left").withColumn("p", F.explode(places)).select(
        "p.range", "p.guest", *_ORDER, "doc_id", "text"
    )


def _compared(pairs: list[tuple]) -> pa.RecordBatch:
    """Result rows of ((doc_id, text, keys), (its successor))."""
    own = [row[2] for row, _ in pairs]
    new_texts = [edited(row[1], after[1]) for row, after in pairs]
    new = [keys(text) for text in new_texts]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[0] for row, _ in pairs], pa.int64()),
         pa.array([len(row[1]) for row, _ in pairs], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new_texts], pa.string()),
         pa.array(fingerprints(own), pa.string()), pa.array(fingerprints(new), pa.string()),
         pa.array(likeness(own, new), pa.float64()),
         pa.array(likeness(own, [after[2] for _, after in pairs]), pa.float64())],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
         "near_edited", "near_next"],
    )


def fingerprint_documents(docs: DataFrame, chunk: int = 400) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its fingerprint, and what an edit does to it.

    The edited text has its last third replaced by the beginning of the next document in
    descending doc_id (after the last comes the first; a lone document follows itself). Rows
    that repeat a doc_id are ordered by the hash of the text and follow one another; a null
    doc_id comes last, a null text counts as empty; an empty table gives no rows.
    near_edited and near_next are 1 for two empty texts and 0 if just one is empty.
    """

    def run(batches):
        held = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))
            pairs = []
            for place, guest, doc_id, text in zip(*columns, strict=True):
                row = (doc_id, text, keys(text))
                if held and held[0] == place and not held[1]:
                    pairs.append((held[2], row))
                held = (place, guest, row)
                if len(pairs) == chunk:
                    yield _compared(pairs)
                    pairs = []
            if pairs:
                yield _compared(pairs)

    dealt = _dealt(docs).repartition("range").sortWithinPartitions("range", "guest", *_ORDER)
    return shipped(dealt).select("range", "guest", "doc_id", "text").mapInArrow(run, ROWS)
