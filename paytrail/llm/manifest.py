"""Merkle manifest of a dataset, built level by level with lag and lead windows.

Each row gives a leaf. In a source, in order of the ids, every sixteen nodes that follow one another
are a run. On each level fixed-offset lag and lead columns, masked by a node's slot and the length of
its run, are its siblings; the first node of a run hashes itself and the leads to the parent. Only
runs meet in a window, so no source is in one task. The subroots of the sources make a second
tree of the same kind. The way down joins each node with the siblings of its parent, so a proof
is at hand for every row, and a changed row is found by folding its leaf along the proof.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import store
from paytrail.llm.ordered import in_order

#: Nodes of a run.
FANOUT = 16
#: Runs in one window. Several make fewer, larger windows; masks keep them apart.
RUNS = 8
#: One row in so many, told by a hash of its id, is tampered with.
TAMPER_EVERY = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the inputs one after the other."""
    return F.sha2(F.concat(*(p.cast("binary") for p in parts)), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value: no two values run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return digest(*(framed(columns[name]) for name in FIELDS))


def source_key(source: Column) -> Column:
    """Sources in their order as text: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tampered(doc_id: Column) -> Column:
    """Whether a row is one of those tampered with; not, without an id."""
    sign = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(sign % TAMPER_EVERY == 0, F.lit(False))


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` (tree, at, size, node, ...) with left and right, the siblings before and behind each.

    ``at`` numbers the ``size`` nodes of a tree's level from 0. Texts of a run's hashes are joined.
    """
    slot = F.col("at") % fanout
    length = F.least(F.lit(fanout), F.col("size") - (F.col("at") - slot))
    window = Window.partitionBy("tree", F.floor(F.col("at") / (fanout * RUNS))).orderBy("at")
    before = [
        F.when(slot >= k, F.lag("node", k).over(window)) for k in range(fanout - 1, 0, -1)
    ]
    behind = [
        F.when(slot + k < length, F.lead("node", k).over(window)) for k in range(1, fanout)
    ]
    return nodes.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *behind)})


def parents(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level: the first node of each run hashes the run. A tree of one node stays as it is."""
    first = level.where(F.col("at") % fanout == 0)
    return first.select(
        "tree", F.floor(F.col("at") / fanout).cast("long").alias("at"),
        F.ceil(F.col("size") / fanout).cast("long").alias("size"),
        F.when(F.col("size") > 1, digest(F.col("node"), F.col("right"))).otherwise(F.col("node")).alias("node"),
    )


def climb(leaves: DataFrame, purpose: str, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels (tree, at, size, node) of each tree above ``leaves``, which are stored; the last holds the roots."""
    largest = leaves.agg(F.max("size")).first()[0] or 1
    levels = [leaves]
    while largest > 1:
        largest = -(-largest // fanout)
        levels.append(store(parents(with_siblings(levels[-1], fanout), fanout), purpose))
    return levels


def descend(levels: list[DataFrame], tops: DataFrame, purpose: str, fanout: int = FANOUT) -> DataFrame:
    """The first of ``levels`` with path: the siblings (left, right) of a node and of all above it.

    ``tops`` (tree, ...) has the path above each tree's root and columns to hand down. A level
    where a tree has one node already adds nothing to its path.
    """
    handed = [c for c in tops.columns if c not in ("tree", "path")]
    above = levels[-1].select("tree", "at").join(tops, "tree")
    for i in range(len(levels) - 2, -1, -1):
        level = with_siblings(levels[i], fanout).withColumn("up", F.floor(F.col("at") / fanout).cast("long"))
        higher = above.select("tree", F.col("at").alias("up"), F.col("path").alias("rest"), *handed)
        own = F.array(F.struct("left", "right"))
        path = F.when(F.col("size") > 1, F.concat(own, F.col("rest"))).otherwise(F.col("rest"))
        below = level.join(higher, ["tree", "up"]).withColumn("path", path)
        if i == 0:
            return below.select(*levels[0].columns, "path", *handed)
        above = store(below.select("tree", "at", "path", *handed), purpose)
    return levels[0].join(tops, "tree")


def proof(path: Column) -> Column:
    """Hash of the siblings, level by level and from left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, p: digest(p["left"], node, p["right"]))


def manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``docs``.

    Rows of a source are ordered by doc_id, null first, and rows of one doc_id by their leaf; equal
    rows are equal leaves, and all are in the tree. Null and empty values differ. Rows without a source
    are a source of their own. A lone leaf is its subroot, a lone subroot the root, and its
    proof the hash of nothing. Rows without an id are never tampered with. An empty table gives no
    rows; columns besides FIELDS are not looked at.
    """
    own = {name: F.col(name) for name in FIELDS}
    changed = own | {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    hashed = store(docs.select(
        source_key(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(own).alias("node"), F.when(tampered(F.col("doc_id")), leaf(changed)).alias("found"),
    ), "manifest-leaves")
    placed = in_order(hashed, ["tree"], ["doc_id", "node"], F.lit(1).cast("long"), "manifest-order")
    leaves = store(placed.select(
        *hashed.columns, F.col("_rank").alias("at"), F.col("_count").alias("size")
    ), "manifest-placed")
    levels = climb(leaves, "manifest-level", fanout)
    subroots = store(levels[-1].select("tree", F.col("node").alias("subroot")), "manifest-subroots")
    ranked = in_order(subroots, [], ["tree"], F.lit(1).cast("long"), "manifest-sources")
    heads = store(ranked.select(
        F.lit("").alias("tree"), F.col("_rank").alias("at"), F.col("_count").alias("size"),
        F.col("subroot").alias("node"), F.col("tree").alias("source"),
    ), "manifest-heads")
    upper = climb(heads, "manifest-top", fanout)
    roof = upper[-1].select(
        "tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("node").alias("root")
    )
    tops = store(descend(upper, roof, "manifest-top-paths", fanout).select(
        F.col("source").alias("tree"), F.col("node").alias("subroot"), "path", "root"
    ), "manifest-tops")
    proved = descend(levels, tops, "manifest-paths", fanout)
    folded = fold(F.coalesce("found", "node"), F.col("path"))
    return proved.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
