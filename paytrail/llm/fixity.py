"""Merkle fixity audit of replicated WARC records.

Every record is hashed where it lies. Records of one range of offsets give a leaf of the tree,
and the leaves of neighbouring ranges give the nodes above, up to one root for the whole archive.
Two replicas with equal roots are equal. Otherwise only children of nodes that differ are
compared, level by level, and last the records in the ranges that differ.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import numbered, store

#: Bytes of a leaf's range, children of a node, and records of a WARC file.
RANGE_BYTES = 64 * 1024
FANOUT = 32
FILE_RECORDS = 1000
#: Header lines of a record, without its own values: a fixed allowance.
HEADER_BYTES = 256

RECORD = ["warc_file", "record_offset", "record_id"]


def records(pages: DataFrame, payload: Column) -> DataFrame:
    """(record_id, url, record_length, page_digest, payload_digest): hashed where they lie.

    Length and page_digest are those of the page as written, whatever ``payload`` holds now.
    """
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.coalesce(F.octet_length("url"), F.lit(0))
    return pages.select(
        F.col("page_id").alias("record_id"), "url", (size + HEADER_BYTES).cast("long").alias("record_length"),
        F.sha2("html", 256).alias("page_digest"), F.sha2(payload, 256).alias("payload_digest"),
    )


def layout(rows: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """``rows`` with warc_file and record_offset: records written one after the other.

    Records are numbered in a stable order, so that no file grows with repeated pages.
    """
    at = numbered(rows, [], [F.col("record_id"), F.col("url"), F.col("page_digest")], "_at")
    inside = Window.partitionBy("warc_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return at.withColumn("warc_file", F.floor(F.col("_at") / file_records).cast("long")).withColumn(
        "record_offset", F.coalesce(F.sum("record_length").over(inside), F.lit(0))
    ).drop("_at")


def digests(rows: DataFrame, payload_digest: str = "payload_digest") -> DataFrame:
    """(warc_file, record_offset, record_id, digest): one hash for each record.

    The hash covers the identity, place and length of the record as well as its payload.
    """
    text = F.to_json(F.struct(
        "record_id", "record_offset", "record_length", F.col(payload_digest).alias("payload")
    ))
    return rows.select(*RECORD, F.sha2(text, 256).alias("digest"))


def _leaf(span: int, range_bytes: int) -> Column:
    return F.floor((F.col("warc_file") * span + F.col("record_offset")) / range_bytes).cast("long")


def tree(records: DataFrame, span: int, height: int, range_bytes: int, fanout: int) -> list[DataFrame]:
    """Tables (node, hash) from the leaves to the root; ``span`` bytes are kept for each file."""
    # Repeated records are counted, not collected.
    once = records.groupBy(*RECORD, "digest").agg(F.count(F.lit(1)).alias("copies"))
    part = F.struct("warc_file", "record_offset", "record_id", "digest", "copies")
    leaves = once.groupBy(_leaf(span, range_bytes).alias("node")).agg(
        F.sha2(F.to_json(F.array_sort(F.collect_list(part))), 256).alias("hash")
    )
    levels = [store(leaves, "fixity-leaves")]
    for _ in range(height):
        above = levels[-1].groupBy(F.floor(F.col("node") / fanout).cast("long").alias("node")).agg(
            F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("node", "hash")))), 256).alias("hash")
        )
        levels.append(store(above, "fixity-level"))
    return levels


def audit(
    original: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """(warc_file, record_offset, record_id, fault) of every record in which two replicas differ.

    Both sides are tables of ``digests``. fault is ``changed``, ``missing`` (not in the replica)
    or ``stray`` (only there). A record repeated unequally often is ``changed``. Two empty or
    equal replicas give no rows.
    """
    places = original.select("warc_file", "record_offset").unionByName(
        replica.select("warc_file", "record_offset")
    )
    files, offsets = places.agg(F.max("warc_file"), F.max("record_offset")).first()
    if files is None:
        return original.select(*RECORD, F.lit("changed").alias("fault")).limit(0)
    span = (offsets // range_bytes + 1) * range_bytes
    nodes, height = (files + 1) * span // range_bytes, 0
    while nodes > 1:
        nodes, height = -(-nodes // fanout), height + 1
    left, right = (tree(side, span, height, range_bytes, fanout) for side in (original, replica))
    differing = None
    for a, b in zip(reversed(left), reversed(right), strict=True):
        if differing is not None:
            parent = F.floor(F.col("node") / fanout).cast("long") == F.col("up")
            above = differing.withColumnRenamed("node", "up")
            a, b = (side.join(above, parent, "left_semi") for side in (a, b))
        both = a.join(b.withColumnRenamed("hash", "other"), "node", "full_outer")
        differing = store(both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("node"), "fixity-diff")
        if differing.isEmpty():
            break

    def suspect(side):
        counted = side.withColumn("node", _leaf(span, range_bytes)).join(differing, "node", "left_semi")
        one = counted.groupBy(*RECORD, "digest").agg(F.count(F.lit(1)).alias("n"))
        return one.groupBy(*RECORD).agg(F.array_sort(F.collect_list(F.struct("digest", "n"))).alias("seen"))

    a, b = suspect(original).alias("a"), suspect(replica).alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in RECORD]
    both = a.join(b, same, "full_outer").where(~F.col("a.seen").eqNullSafe(F.col("b.seen")))
    fault = (
        F.when(F.col("b.seen").isNull(), "missing").when(F.col("a.seen").isNull(), "stray")
        .otherwise("changed")
    )
    return both.select(*(F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in RECORD), fault.alias("fault"))


def damaged_payload() -> Column:
    """What a replica holds of a page: one in 61, by its url, has a byte more."""
    more = F.concat(F.coalesce("html", F.lit("")), F.lit("\0"))
    return F.when(_sign() % 61 == 0, more).otherwise(F.col("html"))


def damaged_copy(rows: DataFrame) -> DataFrame:
    """The records of that replica: one in 67 is lost, one in 71 is there again a byte later."""
    again = rows.where(_sign() % 71 == 2).withColumn("record_offset", F.col("record_offset") + 1)
    return rows.where(_sign() % 67 != 1).unionByName(again)


def _sign() -> Column:
    """A number from the url that any SQL engine can compute."""
    return F.conv(F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 6), 16, 10).cast("long")
