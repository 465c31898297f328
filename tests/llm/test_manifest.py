"""The manifest and the ordered sums against plain versions."""

import hashlib
import random
import zlib

from compare import connect, differences
from pyspark.sql import functions as F

from paytrail.llm import manifest, queries
from paytrail.llm.ordered import in_order

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, node string"
LOWER = {code: code + 32 for code in range(65, 91)}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, at):
    """(left, right) of each run on the way up."""
    path = []
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        path.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        at //= 16
    return path


def plain(rows):
    """What the contract says, for rows (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, members = {}, {}
    for source in sources:
        own = [(r, leaf(r)) for r in rows if r[1] == source]
        members[source] = sorted(own, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = tree([d for _, d in members[source]])
    top = tree([trees[s][-1][0] for s in sources])
    result = []
    for place, source in enumerate(sources):
        for at, (row, own) in enumerate(members[source]):
            path = siblings(trees[source], at) + siblings(top, place)
            node = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = leaf((*row[:4], row[4].translate(LOWER) if row[4] is not None else None))
            for left, right in path:
                node = digest(left + node + right)
            root = top[-1][0]
            proof = digest("".join(a + b for a, b in path))
            result.append((row[0], own, trees[source][-1][0], root, proof, node, node == root))
    return sorted(result, key=repr)


def made(table, rows):
    docs = table([(*row, "clash", "clash") for row in rows], SCHEMA)
    return sorted(map(tuple, manifest.manifest(docs).collect()), key=repr)


def test_a_plain_version_agrees_with_one_source_of_a_third_of_all_rows(spark, table):
    rng = random.Random(5)
    names = ["web", "a", "é", "z" * 40, "", None] + [f"s{i}" for i in range(25)]
    rows = [
        (i, "web" if i % 3 == 0 else rng.choice(names), rng.choice(["en", None]), rng.choice([0, 12, None]), rng.choice(["Abc", "x", "", None, "ÄB"]))
        for i in range(1200)
    ]
    rng.shuffle(rows)
    expected = plain(rows)
    assert len({r[2] for r in expected}) == 31 and any(not r[6] for r in expected)
    assert made(table, rows) == expected


def test_trees_of_any_size(spark, table):
    rows = [(i, f"s{n}", "en", 1, "T") for n in (1, 2, 16, 17, 33, 256, 257, 273) for i in range(n)]
    assert made(table, rows) == plain(rows)
    assert made(table, rows[:1]) == plain(rows[:1])


def test_nulls_ties_repeats_and_long_texts(spark, table):
    rows = [(7, None, None, None, None)] * 20 + [(None, None, "de", 3, "Abc")] * 3 + [
        (7, None, "x", 1, "A"), (9, "", "", 0, ""), (10, "-", "-", 1, "-"), (0, "long", "en", 1, "Ab" * 2_000_000)
    ]
    result = made(table, rows)
    assert result == plain(rows)
    assert all(row[6] for row in result if row[0] is None)


def test_an_empty_table_has_an_empty_manifest(spark, table):
    assert made(table, []) == []


def test_no_two_rows_run_together():
    assert leaf((1, "a", "b", 2, "c")) != leaf((1, "ab", "", 2, "c"))


def test_a_hot_source_lies_in_many_ranges_and_sums_follow_the_order(spark, table):
    rows = table([("hot" if i % 3 else "cold", i % 500, i) for i in range(3000)], "k string, o long, w long")
    placed = in_order(rows, ["k"], ["o"], F.col("w"), "test", range_rows=100).collect()
    for key in ("hot", "cold"):
        own = sorted((r for r in placed if r.k == key), key=lambda r: r._rank)
        assert [r._rank for r in own] == list(range(len(own))) and {r._count for r in own} == {len(own)}
        assert [r.o for r in own] == sorted(r.o for r in own)
        total = 0
        for row in own:
            assert row._before == total and row._sum == sum(r.w for r in own)
            total += row.w


def test_the_query_equals_its_sql(spark, sf_dir):
    name = "op12_merkle_manifest"
    assert differences(connect(sf_dir), queries.ORACLES[name], queries.QUERIES[name](spark, sf_dir)) == []
