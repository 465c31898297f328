"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Documents become sets of word shingles. Equal sets form one class. Classes that can
reach the threshold are brought together by an exact filter, and inside such a group
every class searches the inverted lists of the others.

*Filter.* A pair with Jaccard ``t`` differs in at most H shingles, where H follows from
the sizes. The hash range is cut into p = H + 1 + S parts, so S + 1 parts are equal
in both sets. Parts with few shingles say little and are left out, unless a set has more
than S of them; then it uses all. Either way two linked sets share a part: nothing is lost.
A part that very many classes share is a template's and says little, too. Its classes are brought
together by their rarest shingles instead: of n shingles at most n - T differ, so the first
n - T + 1 of two linked sets, in one order of all shingles, have one in common.

*Search.* A query merges its short lists and keeps documents that occur often enough to
still reach the overlap T; those are probed in the long lists by binary search. The k-way merge
of the short lists is one stable sort (its runs are the lists), which gives what a heap gives.
"""

import math
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import components, shipped, store

#: Classes searched together in one task; a larger group becomes a grid of such blocks.
BLOCK = 512
#: Cost of one binary probe relative to one merged entry, from the DivideSkip paper.
MU = 0.0085
#: Hash buckets (a power of two) whose counts tell how rare a shingle is; one byte each in every task.
COUNTED = 1 << 22
_MASK = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15


class _Hashes(dict):
    """Word -> hash, emptied when it gets large."""

    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; fewer words than ``size`` make one."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(_hashes.__getitem__, words)), np.uint64)
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width * _ODD & _MASK, np.uint64)
    for i in range(width):
        total += hashes[i : len(words) - width + 1 + i] * np.uint64(_ODD * (2 * i + 3) & _MASK)
    return np.unique(_mix(total))


def digest(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


@cache
def _bounds(percent: int) -> list[int]:
    """Lower ends of the size classes: partners are in the same or the next class."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, (ends[-1] - 1) * 100 // percent + 1))
    return ends


@cache
def _parts(size_class: int, percent: int) -> tuple[int, int, int, int]:
    """Of a size class: parts, shingles a part needs, small parts allowed, largest partner."""
    low, most = _bounds(percent)[size_class], _bounds(percent)[size_class + 1] - 1
    differ = most * (100 - percent) // percent
    best = (differ + 1, 0, 0)
    for least in (1, 2, 3, 4):
        parts = differ + 1
        for _ in range(30):
            mean = low / parts
            share = math.exp(-mean) * sum(mean**i / math.factorial(i) for i in range(least))
            small = math.ceil(parts * share + 2 * math.sqrt(parts * share))
            parts, before = differ + 1 + small, parts
            if parts == before:
                break
        if share > 0.2 or parts > 1.35 * differ + 3:
            break
        best = (parts, least, small)
    return (*best, most * 100 // percent) if differ else (0, 0, 0, 0)


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the parts of a set, for its size class and the one below."""
    n = len(shingles)
    if not n:
        return np.empty(0, np.int64)
    own = int(np.searchsorted(_bounds(percent), n, "right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(shingles + np.uint64(_ODD)))])
    found = []
    for size_class in (own, own - 1):
        if size_class < 0:
            continue
        parts, least, small, largest = _parts(size_class, percent)
        if not parts or n > largest:
            continue
        ends = (np.arange(1, parts, dtype=np.uint64) << np.uint64(32)) // np.uint64(parts)
        cuts = np.concatenate(
            [[0], np.searchsorted(shingles, (ends + np.uint64(1)) << np.uint64(32)), [n]]
        )
        counts = np.diff(cuts)
        values = sums[cuts[1:]] - sums[cuts[:-1]]
        names = np.arange(parts, dtype=np.uint64) + np.uint64(size_class << 32)
        values = _mix(values + _mix(names + np.uint64(1)) + counts.astype(np.uint64))
        enough = counts >= least
        found.append(values[enough] if parts - enough.sum() <= small else values)
    return np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)


def fold(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each of 256 ranges of the hash; 255 stands for more as well."""
    ends = np.searchsorted(shingles, np.arange(1, 256, dtype=np.uint64) << np.uint64(56))
    return np.minimum(np.diff(ends, prepend=0, append=len(shingles)), 255).astype(np.uint8).tobytes()


def most_overlap(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlap of one folded set with others."""
    least = np.minimum(one, others).astype(np.int64)
    return np.where(least == 255, 1 << 40, least).sum(axis=1)


def describe(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, tie, n_shingles, dig, sigs, fold) of every row; dig is null for an empty set.

    tie is a hash of the text: with doc_id it tells rows apart that repeat a doc_id.
    """

    def run(batches):
        for batch in batches:
            rows = {"n_shingles": [], "dig": [], "sigs": [], "fold": []}
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, size)
                rows["n_shingles"].append(len(shingles))
                rows["dig"].append(digest(shingles) if len(shingles) else None)
                rows["sigs"].append(signatures(shingles, percent))
                rows["fold"].append(fold(shingles))
            offsets = np.cumsum([0, *map(len, rows["sigs"])])
            flat = np.concatenate([np.empty(0, np.int64), *rows["sigs"]])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("tie"),
                 pa.array(rows["n_shingles"], pa.int64()), pa.array(rows["dig"], pa.int64()),
                 lists, pa.array(rows["fold"], pa.binary())],
                ["doc_id", "tie", "n_shingles", "dig", "sigs", "fold"],
            )

    return shipped(docs).select("doc_id", "text", F.xxhash64("text").alias("tie")).mapInArrow(
        run, "doc_id long, tie long, n_shingles long, dig long, sigs array<long>, fold binary"
    )


class _Union:
    def __init__(self, labels):
        first = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]
        self.sets = len(first)

    def find(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        self.sets -= 1
        return True


def divide_skip(sets, labels, queries, percent):
    """Links that join different labels among ``sets``; positions (i, j).

    ``labels`` are known components; ``queries`` says which sets search. A link between
    sets that are already joined is not needed and its verification is left out.
    """
    union = _Union(labels)
    sizes = np.array([len(s) for s in sets])
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    postings = np.sort(ids.astype(np.int64) * len(sets) + owner)
    starts = np.searchsorted(postings, np.arange(len(words) + 1) * len(sets))
    lengths = np.diff(starts)
    by_set = np.split(ids, np.cumsum(sizes)[:-1])
    links = []
    for q in np.flatnonzero(queries):
        if union.sets == 1:
            break
        lists = by_set[q][np.argsort(lengths[by_set[q]], kind="stable")]
        overlap = max(1, -(-percent * len(lists) // 100))
        long = min(overlap - 1, int(overlap / (MU * math.log2(lengths[lists[-1]] + 1) + 1)))
        short = lists[: len(lists) - long]
        merged = np.sort(
            np.concatenate([postings[starts[i] : starts[i + 1]] for i in short]) % len(sets),
            kind="stable",
        )
        found, counts = np.unique(merged, return_counts=True)
        keep = (
            (counts >= overlap - long)
            & (100 * np.minimum(sizes[found], sizes[q]) >= percent * np.maximum(sizes[found], sizes[q]))
        )
        root = union.find(q)
        keep[keep] = [union.find(i) != root for i in found[keep]]
        found, counts = found[keep], counts[keep]
        if not len(found):
            continue
        if long:
            wanted = lists[len(lists) - long :, None] * len(sets) + found
            at = np.minimum(np.searchsorted(postings, wanted), len(postings) - 1)
            counts = counts + (postings[at] == wanted).sum(axis=0)
        linked = 100 * counts >= percent * (sizes[found] + sizes[q] - counts)
        links += [(int(i), int(q)) for i in found[linked] if union.join(int(i), int(q))]
    return links


def _searched(cells: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between the classes of each block."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, rows in block.groupby("grp", sort=True):
            known = {}
            for row in rows.sort_values("dig", kind="stable").itertuples():
                shingles = shingle_set(row.text, size)
                if len(shingles) and digest(shingles) == row.dig:
                    label, asks = known.get(row.dig, (None, None, row.label, False))[2:]
                    known[row.dig] = (row.dig, shingles, label, asks or row.asks)
            if len(known) > 1:
                digs, sets, labels, asks = zip(*known.values(), strict=True)
                found += [
                    (digs[i], digs[j]) for i, j in divide_skip(sets, labels, np.array(asks), percent)
                ]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return shipped(cells).groupBy("cell").applyInPandas(run, "a long, b long")


def shared_parts(described: DataFrame) -> DataFrame:
    """(sig, dig, low): classes that share a part with another class; low is the part's first."""
    rows = described.select(F.explode("sigs").alias("sig"), "dig")
    shared = store(
        rows.groupBy("sig").agg(F.min("dig").alias("low"), F.max("dig").alias("high"))
        .where("low <> high").select("sig", "low"), "ngram-shared",
    )
    return store(rows.join(shared, "sig").distinct(), "ngram-parts")


def rarest(docs: DataFrame, digs: DataFrame, described: DataFrame, size: int, percent: int) -> DataFrame:
    """(dig, sigs): the rarest shingles of the classes ``digs``, so many that linked classes share one.

    Shingles are ordered by the number of these classes in their bucket of hashes, to a factor of
    1.4, then by hash. Any order gives every link; this one keeps groups small. The counts
    are added up by Spark over all the classes; at most COUNTED of them come to the driver.
    """
    shift = np.uint64(64 - (COUNTED.bit_length() - 1))
    first = described.groupBy("dig").agg(F.min("doc_id").alias("doc_id"))
    texts = store(
        docs.select("doc_id", "text").join(first.join(digs, "dig"), "doc_id").select("dig", "text"),
        "ngram-templates",
    )

    def sets(batch):
        for dig, text in zip(batch.column("dig").to_pylist(), batch.column("text").to_pylist(), strict=True):
            shingles = shingle_set(text, size)
            if len(shingles) and digest(shingles) == dig:
                yield dig, shingles

    def counted(batches):
        counts = np.zeros(COUNTED, np.int64)
        for batch in batches:
            for _, shingles in sets(batch):
                np.add.at(counts, (shingles >> shift).astype(np.int64), 1)
        found = np.flatnonzero(counts > 0)
        for at in range(0, len(found), 1 << 16):
            some = found[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    rows = shipped(texts).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    known = rows.where("n > 1").select("bucket", F.floor(2 * F.log2("n")).cast("int").alias("level")).toArrow()
    levels = np.zeros(COUNTED, np.uint8)
    levels[known.column("bucket").to_numpy()] = known.column("level").to_numpy()

    def chosen(batches):
        for batch in batches:
            digs, sigs = [], []
            for dig, shingles in sets(batch):
                n = len(shingles)
                order = np.argsort(levels[(shingles >> shift).astype(np.int64)], kind="stable")
                digs.append(dig)
                sigs.append(_mix(shingles[order[: n + 1 - max(1, -(-percent * n // 100))]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digs, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))], ["dig", "sigs"]
            )

    return texts.mapInArrow(chosen, "dig long, sigs array<long>")


def _lists(parts: DataFrame) -> DataFrame:
    """(sig, dig, low, n): each set of classes that share parts once, n its classes."""
    one = F.xxhash64("dig", F.lit(7)).cast("decimal(20,0)")
    alike = parts.groupBy("sig").agg(F.sum(one).alias("all"), F.count(F.lit(1)).alias("n"))
    return store(
        parts.join(alike.groupBy("all", "n").agg(F.min("sig").alias("sig")).select("sig", "n"), "sig"),
        "ngram-lists",
    )


def possible(parts: DataFrame, docs: DataFrame, described: DataFrame, size: int, percent: int) -> DataFrame:
    """(sub, dig, low): of the classes in a part, those that may be linked with another in it.

    Parts with the same classes are looked at once. Classes of parts with more than BLOCK meet by
    their rarest shingles instead. The bound from the folded sets rules most chance meetings out
    before any text moves; what more than BLOCK classes share even so stays whole.
    """
    lists = _lists(parts)
    crowded = lists.where(F.col("n") > BLOCK).select("dig").distinct()
    finer = _lists(shared_parts(rarest(docs, crowded, described, size, percent)))
    lists = lists.where(F.col("n") <= BLOCK).unionByName(finer)
    short = lists.where(F.col("n") <= BLOCK)
    bins = max(1, -(-short.count() // (16 * BLOCK)))
    folds = described.groupBy("dig").agg(
        F.first("n_shingles").alias("size"), F.first("fold").alias("fold")
    )

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["sig", "dig"], kind="stable")
        sigs, digs, sizes = (block[c].to_numpy() for c in ("sig", "dig", "size"))
        folds = np.frombuffer(b"".join(block["fold"]), np.uint8).reshape(-1, 256)
        found = []
        for at in np.split(np.arange(len(sigs)), np.flatnonzero(np.diff(sigs)) + 1):
            union = _Union(at.tolist())
            for i in range(len(at) - 1):
                if union.sets == 1:
                    break
                rest = at[i + 1 :]
                bound = np.minimum(most_overlap(folds[at[i]], folds[rest]), np.minimum(sizes[rest], sizes[at[i]]))
                near = 100 * bound >= percent * (sizes[rest] + sizes[at[i]] - bound)
                for j in np.flatnonzero(near):
                    union.join(i, i + 1 + int(j))
            roots = [union.find(i) for i in range(len(at))]
            for i, root in enumerate(roots):
                if roots.count(root) > 1 if len(at) > 2 else union.sets == 1:
                    found.append((int(sigs[at[i]]) ^ int(digs[at[root]]), int(digs[at[i]]), int(digs[at[root]])))
        return pd.DataFrame(found, columns=["sub", "dig", "low"], dtype="int64")

    cell = F.pmod(F.xxhash64("sig"), F.lit(bins)).alias("cell")
    rows = shipped(short).join(folds, "dig").select(cell, "sig", "dig", "size", "fold")
    kept = rows.groupBy("cell").applyInPandas(run, "sub long, dig long, low long")
    whole = lists.where(F.col("n") > BLOCK).select(F.col("sig").alias("sub"), "dig", "low")
    return store(kept.unionByName(whole), "ngram-possible")


def _cells(members: DataFrame) -> DataFrame:
    """Deal (grp, dig, label, text) to blocks for the search, whatever the size of a group.

    The largest label of a group is only searched, the others search. A group within BLOCK is
    one block, and small ones share a task; of a larger one every block of classes meets
    every block of searching classes.
    """
    shares = members.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"))
    groups = store(shares.groupBy("grp").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.sum("n") - F.max("n")) / BLOCK).cast("int").alias("rounds"),
        F.sum("n").alias("n"),
    ).where("rounds > 0"), "ngram-groups")
    bins = max(1, -(-(groups.where("blocks = 1").agg(F.sum("n")).first()[0] or 0) // BLOCK))

    def dealt(n, salt):
        return F.pmod(F.xxhash64("dig", F.lit(salt)), n).cast("int")

    def every(n):
        return F.sequence(F.lit(0), n - 1)

    rows = members.join(groups, "grp").withColumn("asks", F.col("label") != F.col("main"))
    place = F.struct(F.lit(0).alias("block"), F.lit(0).alias("round"), F.col("asks").alias("asks"))
    index = F.transform(every(F.col("rounds")), lambda r: F.struct(
        dealt(F.col("blocks"), 0).alias("block"), r.alias("round"), F.lit(False).alias("asks")
    ))
    asking = F.transform(every(F.col("blocks")), lambda i: F.struct(
        i.alias("block"), dealt(F.col("rounds"), 1).alias("round"), F.lit(True).alias("asks")
    ))
    places = F.when(F.col("blocks") == 1, F.array(place)).otherwise(
        F.when(F.col("asks"), F.concat(index, asking)).otherwise(index)
    )
    cell = F.when(F.col("blocks") == 1, F.concat(F.lit("b"), F.pmod(F.xxhash64("grp"), F.lit(bins)))).otherwise(
        F.concat_ws("-", "grp", "p.block", "p.round")
    )
    return rows.withColumn("p", F.explode(places)).select(
        cell.alias("cell"), "grp", "dig", "label", F.col("p.asks").alias("asks"), "text"
    )


def links(docs: DataFrame, described: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between classes, enough to span every component of the join."""
    parts = possible(shared_parts(described), docs, described, size, percent)
    edges = parts.where("dig <> low").select(F.col("dig").alias("a"), F.col("low").alias("b"))
    grouped = components(edges, "ngram-groups").select(F.col("node").alias("dig"), F.col("root").alias("grp"))
    grouped = store(grouped, "ngram-candidates")
    sizes = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    first = described.groupBy("dig").agg(F.min("doc_id").alias("doc_id"))
    picked = first.join(grouped, "dig").join(sizes, "grp")
    texts = store(
        docs.select("doc_id", "text").join(picked, "doc_id").select(
            "dig", "grp", "text", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"),
        ), "ngram-texts",
    )
    # A small group is searched at once. In a large one every block searches itself and the
    # group's first class, which joins most of what is alike.
    small = texts.where("blocks = 1")
    spread = F.when(F.col("dig") == F.col("grp"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("dig"), F.col("blocks")).cast("int"))
    )
    many = texts.where("blocks > 1")
    blocks = many.withColumn("block", F.explode(spread)).select(
        F.xxhash64("grp", "block").alias("grp"), "dig", F.col("dig").alias("label"), "text"
    )
    small = small.select("grp", "dig", F.col("dig").alias("label"), "text")
    bins = max(1, -(-small.count() // BLOCK))
    asks = F.lit(True).alias("asks")
    near = _searched(small.select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(bins))).alias("cell"), "*", asks
    ).unionByName(blocks.select(F.concat(F.lit("l"), "grp").alias("cell"), "*", asks)), size, percent)
    near = store(near, "ngram-links")
    # What a large group still leaves open are parts whose classes are in several components.
    # Each is searched by itself; parts with the same classes once.
    known = components(near, "ngram-known").select(F.col("node").alias("dig"), F.col("root"))
    labelled = store(
        many.select("dig").distinct().join(known, "dig", "left").select(
            "dig", F.coalesce("root", "dig").alias("label")
        ), "ngram-labels",
    )
    members = store(parts.select(F.col("sub").alias("sig"), "dig").join(labelled, "dig"), "ngram-members")
    one = F.xxhash64("dig", F.lit(7)).cast("decimal(20,0)")
    unsettled = members.groupBy("sig").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sum(one).alias("all"),
        F.count(F.lit(1)).alias("n"),
    ).where("low <> high").groupBy("all", "n").agg(F.min("sig").alias("sig"))
    wanted = store(members.join(unsettled.select("sig"), "sig"), "ngram-open")
    rows = wanted.join(many.select("dig", "text"), "dig").select(F.col("sig").alias("grp"), "dig", "label", "text")
    far = store(_searched(_cells(rows), size, percent), "ngram-links")
    return near.unionByName(far)


def _rooted(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Linkable rows (doc_id, tie, n_shingles, root of the component), and the other rows."""
    described = store(describe(docs, size, percent), "ngram-sets")
    named = described.where("dig is not null and doc_id is not null")
    linked = store(
        components(links(docs, named, size, percent), "ngram-components").select(
            F.col("node").alias("dig"), "root"
        ), "ngram-classes",
    )
    rows = named.select("doc_id", "tie", "n_shingles", "dig").join(linked, "dig", "left").select(
        "doc_id", "tie", "n_shingles", F.coalesce("root", "dig").alias("root")
    )
    alone = described.where("dig is null or doc_id is null").select("doc_id", "tie", "n_shingles")
    return store(rows, "ngram-rows"), alone


def join_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text).

    Two documents are linked when the Jaccard similarity of their sets of ``size``-word
    shingles is at least ``percent`` / 100; component_id is the smallest doc_id reachable.
    Only A-Z is lower-cased, words are split at ASCII white space. A row without words,
    text or doc_id is linked with nothing and is its own component (null for a null
    doc_id). Repeated rows stay and share their component; an empty table gives no rows.
    """
    rows, alone = _rooted(docs, size, percent)
    # Stored, so that the join below deals both sides anew and a large component can be split.
    lowest = store(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ngram-lowest")
    alone = alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.join(lowest, "root").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id.

    Rows that repeat a doc_id with texts that are not linked are different documents and all
    stay. Rows equal in doc_id and text are one document; the one whose other columns
    have the smallest hash stays. Rows without a doc_id stay.
    """
    named = docs.where("doc_id is not null")
    rows, alone = _rooted(named, size, percent)
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "tie")).alias("f")).select("f.*")
    kept = store(first.unionByName(alone.select("doc_id", "tie")).distinct(), "ngram-kept").alias("k")
    other = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    tied = named.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("tie"),
        F.struct(*docs.columns).alias("row"),
    ).alias("d")
    same = (F.col("d.id") == F.col("k.doc_id")) & (F.col("d.tie") == F.col("k.tie"))
    order = F.xxhash64(*(F.col(f"row.`{name}`") for name in other))
    chosen = tied.join(kept, same, "left_semi").groupBy("id", "tie").agg(
        F.min_by("row", order).alias("row")
    )
    return chosen.select("row.*").unionByName(docs.where("doc_id is null"))
