"""Balanced label propagation: documents move to their neighbours' shards under quotas.

Documents with equal text are neighbours. Every document begins in a shard given by its
doc_id. In each round a group looks where most of its members are, and its other members move
there as far as the shard's quota allows; groups that need few moves go first. Members of a
group are interchangeable, so the state is one row for each group and shard, never for each pair.
At the end shards above their quota give groups away, and unlinked documents fill the rest.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import numbered, running, store

SHARDS = 40
#: Rounds of moves after which one must bring pieces of groups together for another to follow.
ROUNDS = 12
#: Room above the quota while groups are still moving, in hundredths.
SLACK = 20
#: Bytes a row counts beside its text.
ROW_BYTES = 16
_GROUP = ["key", "text_crc32", "size"]


def _loads(cells: DataFrame, shards: int) -> list[int]:
    found = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _by_shard(values: list[int], shard):
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), shard + 1)


def _merged(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*_GROUP, "shard").agg(F.sum("n").alias("n"))


def propagate(cells: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Cells (group, shard, n) after the moves, at most at quota plus slack.

    After ``rounds`` rounds the moves go on as long as each round leaves fewer cells: a group of
    one cell is whole, and no move makes a new cell. Each move takes members to a cell as large
    or larger, so the moves end by themselves.
    """
    pieces, turn = cells.count(), 0
    while True:
        room = [
            q * (100 + SLACK) // 100 - load
            for q, load in zip(quotas, _loads(cells, len(quotas)), strict=True)
        ]
        rank = F.struct("n", -F.col("shard"))
        free = _by_shard(room, F.col("shard"))
        open_rank = F.when(free > 0, rank)
        heads = cells.groupBy(*_GROUP).agg(
            F.max(open_rank).alias("top"), F.sum("n").alias("total"),
        ).where("top is not null")
        wishes = cells.join(heads, _GROUP).withColumns({
            "to": -F.col("top.col2"), "there": F.col("top.n"),
        })
        wishes = wishes.where(
            (F.col("shard") != F.col("to")) & F.struct("n", -F.col("shard")).__lt__(F.col("top"))
        ).select(*_GROUP, "shard", "n", "to", (F.col("total") - F.col("there")).alias("missing"))
        wishes = store(wishes, "shard-wishes")
        placed = running(
            wishes, ["to"], [F.col("missing"), *map(F.col, _GROUP), F.col("shard")], F.col("n"), "before",
            rank="missing",
        )
        moved = F.greatest(
            F.lit(0), F.least(F.col("n"), _by_shard(room, F.col("to")) - F.col("before"))
        )
        moves = store(
            placed.withColumn("moved", moved).where("moved > 0").select(*_GROUP, "shard", "to", "moved"),
            "shard-moves",
        )
        if moves.isEmpty():
            break
        cells = store(_merged(
            cells.unionByName(moves.select(*_GROUP, "shard", (-F.col("moved")).alias("n")))
            .unionByName(moves.select(*_GROUP, F.col("to").alias("shard"), F.col("moved").alias("n")))
        ).where("n > 0"), "shard-cells")
        before, pieces, turn = pieces, cells.count(), turn + 1
        if turn >= rounds and pieces >= before:
            break
    return cells


def _fill(position, count, room: list[int]):
    """(shard, n) pieces of the run of ``count`` from ``position`` laid over the free places."""
    pieces, at = [], 0
    for shard, free in enumerate(room):
        if free > 0:
            low = F.greatest(position, F.lit(at))
            high = F.least(position + count, F.lit(at + free))
            pieces.append(F.struct(F.lit(shard).alias("shard"), (high - low).alias("n")))
            at += free
    pieces = pieces or [F.struct(F.lit(0).alias("shard"), F.lit(0).cast("long").alias("n"))]
    return F.filter(F.array(*pieces), lambda p: p["n"] > 0)


def settle(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """Cells with every shard at its quota at most; small cells leave first."""
    loads = _loads(cells, len(quotas))
    excess = [max(0, load - q) for q, load in zip(quotas, loads, strict=True)]
    room = [max(0, q - load) for q, load in zip(quotas, loads, strict=True)]
    if not any(excess):
        return cells
    over = _by_shard(excess, F.col("shard"))
    ranked = running(
        cells.where(over > 0), ["shard"], [F.col("n"), *map(F.col, _GROUP)], F.col("n"), "before", rank="n"
    )
    leaving = store(
        ranked.withColumn("n", F.least(F.col("n"), over - F.col("before"))).where("n > 0").drop("before"),
        "shard-leaving",
    )
    placed = running(leaving, [], [*map(F.col, _GROUP), F.col("shard")], F.col("n"), "before")
    arriving = placed.withColumn("p", F.explode(_fill(F.col("before"), F.col("n"), room))).select(
        *_GROUP, F.col("p.shard").alias("shard"), F.col("p.n").alias("n")
    )
    return store(_merged(
        cells.unionByName(leaving.withColumn("n", -F.col("n")).select(*cells.columns))
        .unionByName(arriving.select(*cells.columns))
    ).where("n > 0"), "shard-cells")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``docs``.

    The law is ``rows``: the numbers of documents in two shards differ by one at most. Rows of
    equal text, repeated rows included, stay together as far as the quotas allow; a group
    larger than a shard is spread over several. A null text counts as empty, so null and empty
    texts are one group. slot numbers the rows of a shard from 0; grown_shard is null.
    """
    text = F.coalesce("text", F.lit(""))
    rows = store(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
    ), "shard-rows")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = store(
        rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shard-groups"
    )
    linked = store(rows.join(groups.select(*_GROUP), _GROUP, "left_semi").select(*rows.columns), "shard-linked")
    start = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    cells = store(
        linked.groupBy(*_GROUP, start.alias("shard")).agg(F.count(F.lit(1)).alias("n")), "shard-cells"
    )
    cells = settle(propagate(cells, quotas, rounds), quotas)
    # Members of a group are numbered, and the cells of the group share the numbers out.
    upto = F.sum("n").over(Window.partitionBy(*_GROUP).orderBy("shard").rowsBetween(
        Window.unboundedPreceding, 0
    ))
    shares = cells.withColumn("upto", upto).groupBy(*_GROUP).agg(
        F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("shares")
    )
    members = numbered(linked, _GROUP, [F.col("doc_id")], "at")
    grouped = members.join(shares, _GROUP).withColumn(
        "shard", F.element_at(F.filter("shares", lambda s: s["upto"] > F.col("at")), 1)["shard"]
    ).select(*rows.columns, "shard")
    room = [q - load for q, load in zip(quotas, _loads(cells, shards), strict=True)]
    alone = numbered(rows.join(groups.select(*_GROUP), _GROUP, "left_anti"), [], [F.col("doc_id")], "at")
    alone = alone.withColumn(
        "shard", F.element_at(_fill(F.col("at"), F.lit(1), room), 1)["shard"]
    ).select(*rows.columns, "shard")
    placed = store(grouped.unionByName(alone), "shard-placed")
    return numbered(placed, ["shard"], [F.col("doc_id")], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
