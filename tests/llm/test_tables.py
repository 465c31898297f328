"""Toxicity, sharding, fixity, token rollup, the pipeline and the registered queries."""

import zlib
from collections import Counter

import pytest
from compare import connect, differences

import corpus_pipeline
from paytrail.llm import common, decontaminate, fixity, ngram_join, packing, pii, queries, sharding, token_rollup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pair_of_words_decides(table):
    rows, marks = [], []
    for i in range(800):
        words = [f"w{i % 37}", f"v{i % 41}"] + ["fool"] * (i % 2) + ["group"] * (i // 2 % 2)
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 3)))
    docs = table(rows + [(900, None), (901, ""), (0, rows[0][1])], "doc_id long, text string")
    found = toxicity.classify(docs, table(marks, "doc_id long, toxic int")).collect()
    held = [r for r in found if r.held_out and r.doc_id < 800]
    assert {r.held_out for r in found} == {True, False} and all(0 <= r.score <= 1 for r in found)
    assert sum(r.predicted == (r.doc_id % 4 == 3) for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    none = toxicity.classify(docs, table([], "doc_id long, toxic int")).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    clash = docs.selectExpr("*", "1 AS _toxicity", "'x' AS score")
    kept = toxicity.keep_clean(clash, table(marks, "doc_id long, toxic int"))
    assert kept.columns == clash.columns and {(r._toxicity, r.score) for r in kept.collect()} == {(1, "x")}


@pytest.mark.parametrize("groups", [[1] * 97, [30, 5, 5, 3, 2, 2] + [1] * 40, [100], [7] * 20])
def test_shards_are_even_and_groups_stay_together(table, groups):
    rows = [(1000 * g + i, f"text {g}") for g, n in enumerate(groups) for i in range(n)]
    found = sharding.shard(table(rows + [(-1, None), (-2, "")], "doc_id long, text string"), 8, 6).collect()
    counts = Counter(r.shard for r in found)
    assert max(counts.values()) - min(counts[s] for s in range(8)) <= 1 and len(found) == len(rows) + 2
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    if groups[0] == 30:
        split = [g for g in range(1, 6) if len({r.shard for r in found if r.doc_id // 1000 == g}) > 1]
        assert len(split) <= 1
    one = next(r for r in found if r.doc_id == -1)
    assert (one.size, one.text_crc32, one.grown_shard) == (16, 0, None)


def test_shards_of_an_empty_table(table):
    assert sharding.shard(table([], "doc_id long, text string")).count() == 0


def test_sums_follow_the_rank_at_any_size(table):
    rows = [(i % 3, 1 + i % 7 * (i % 2), i) for i in range(900)]
    df = table([*rows, *rows[:9]], "k int, n long, v int")
    found = common.running(df, ["k"], [df.n, df.v], df.n, "before", bucket_rows=50, rank="n").collect()
    for k in range(3):
        own = sorted((r.before, r.n) for r in found if r.k == k)
        assert [n for _, n in own] == sorted(n for _, n in own) and own[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))


def test_small_groups_move_first_above_a_bucket(spark):
    size = 25_000
    small = ("id AS key", "0L AS text_crc32", "16L AS size")
    cells = common.store(
        spark.range(size).selectExpr(*small, "0 AS shard", "2L AS n").unionByName(
            spark.range(size, size + 8).selectExpr(*small, "0 AS shard", "900L AS n")
        ), "test-cells",
    )
    left = sharding.settle(cells, [17_200, 60_000])
    assert left.where("shard = 0").agg({"n": "sum"}).first()[0] == 17_200
    assert left.where("n >= 900 AND shard = 0").count() == 8
    # Each small group misses one member in shard 1, each large one 300; not all find room.
    halves = cells.selectExpr("key", "text_crc32", "size", "0 AS shard", "n DIV 3 + int(n = 2) AS n").unionByName(
        cells.selectExpr("key", "text_crc32", "size", "1 AS shard", "n - n DIV 3 AS n")
    )
    halves = common.store(halves, "test-cells")
    load = halves.where("shard = 1").agg({"n": "sum"}).first()[0]
    moved = sharding.propagate(halves, [0, -(-(load + size + 300) * 100 // 120)], 1)
    assert moved.where(f"key < {size} AND shard = 0").count() == 0
    assert moved.where(f"key >= {size} AND shard = 0").count() >= 6


def test_moves_go_on_while_they_bring_pieces_together(table):
    rows = [(1, 0, 16, 0, 3), (1, 0, 16, 1, 2), (2, 0, 16, 0, 3), (2, 0, 16, 2, 4)]
    cells = table(rows, "key long, text_crc32 long, size long, shard int, n long")
    # Only when group 2 has left shard 0 is there room for group 1.
    found = sharding.propagate(cells, [5, 10, 10], 1).collect()
    assert sorted((r.key, r.shard, r.n) for r in found) == [(1, 0, 5), (2, 2, 7)]


def test_audit_finds_each_fault(table):
    rows = [(f, 100 * i, f * 50 + i, f"d{f}-{i}") for f in range(4) for i in range(50)] + [(0, 0, 0, "d0-0")]
    schema = "warc_file long, record_offset long, record_id long, digest string"
    copy = [r for r in rows if r[2] != 77]
    copy[5] = (*copy[5][:3], "other")
    copy.append((3, 4950, 999, "new"))
    a, b = table(rows, schema), table(copy, schema)
    found = sorted((r.record_id, r.fault) for r in fixity.audit(a, b, 256, 4).collect())
    assert found == [(rows[5][2], "changed"), (77, "missing"), (999, "stray")]
    assert fixity.audit(a, a, 256, 4).count() == 0
    assert fixity.audit(a.limit(0), a.limit(0)).count() == 0
    assert fixity.audit(a, a.limit(0)).count() == 200


def test_rollup_counts_each_batch_once(spark, table, tmp_path):
    rows = [(i, None if i == 3 else "some words here " * i, "en" if i % 2 else None, f"s{i % 3}", 0) for i in range(60)]
    docs = table(rows, DOCS)
    rollup = token_rollup.Rollup(spark, str(tmp_path / "rollup"))
    batches = token_rollup.history(docs)
    for name, changes in batches.items():
        assert rollup.commit(name, changes) and not rollup.commit(name, changes)
    want = Counter()
    for doc_id, text, lang, source, _ in rows:
        kind = zlib.crc32(str(doc_id).encode()) % 10
        if kind == 3:
            continue
        text = text or ""
        text = text[: len(text) // 2] if kind == 5 else text
        version = token_rollup.V2 if kind == 7 else token_rollup.V1
        key = (source, lang, version)
        want[key, "docs"] += 1
        want[key, "tokens"] += len(token_rollup.encode(text, f"{version}.tiktoken"))
    got = rollup.totals().collect()
    assert {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in got} == {
        key: (want[key, "docs"], want[key, "tokens"]) for key, _ in want
    }


def test_numbers_have_no_gaps(table):
    rows = table([(i % 3, i // 2) for i in range(500)], "k int, v int")
    found = common.numbered(rows, ["k"], [rows.v], "n", bucket_rows=50).collect()
    for k in range(3):
        own = sorted(r.n for r in found if r.k == k)
        assert own == list(range(len(own)))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    labels = common.read(spark, sf_dir, "labels")
    clean = {r.doc_id for r in toxicity.classify(docs, labels).where("predicted = 0").collect()}
    components = {r.doc_id: r.component_id for r in ngram_join.join_components(docs.where(docs.doc_id.isin(*clean))).collect()}
    items = [(r.item_id, decontaminate.normal(r.text)) for r in common.read(spark, sf_dir, "benchmark").collect()]
    kept = {
        r.doc_id: r.text for r in rows
        if components.get(r.doc_id) == r.doc_id and not decontaminate.search(r.text, tuple(sorted(set(items))))
    }
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    sizes = Counter()
    for p in pieces:
        sizes[p.doc_id] += p.length
    new = {r.doc_id: r.text for r in pii.pseudonymize(docs).collect()}
    assert dict(sizes) == {i: len(packing.encode(new[i])) + 1 for i in kept}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_oracle(spark, sf_dir, name):
    assert differences(connect(sf_dir), queries.ORACLES[name], queries.QUERIES[name](spark, sf_dir)) == []
