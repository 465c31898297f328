"""The registered queries of this package and, where SQL can express them, their oracles."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.llm import (
    chat_format, common, decontaminate, fingerprints, fixity, html_text, manifest, ngram_join,
    packing, pii, sharding, spelling, token_rollup, toxicity,
)
from paytrail.session import shared_dir

QUERIES = {}
ORACLES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(common.read(spark, sf_dir, "documents"), size=3, percent=90)


ORACLES["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
n AS (
  SELECT doc_id, g, len(g) AS n FROM (SELECT doc_id, CASE
    WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
    END AS g FROM w)),
t AS (SELECT doc_id, n, unnest(g) AS g FROM n),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id
FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.n
"""


@query
def op2_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.read(spark, sf_dir, "documents"), added=True)


@query
def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return pii.pseudonymize(docs).select("doc_id", "text", "n_values")


@query
def op8_pigeonhole_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(
        common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark")
    )


@query
def op9_two_pass_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(common.read(spark, sf_dir, "pages"))


@query
def op10_invertible_bloom_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(common.read(spark, sf_dir, "documents"))


@query
def op6_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(
        common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    )


@query
def op7_balanced_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(common.read(spark, sf_dir, "documents"))


@query
def op4_merkle_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read(spark, sf_dir, "pages").select("page_id", "url", "html").withColumn(
        "copy", fixity.damaged_payload()
    )
    rows = fixity.records(pages, F.col("copy"))
    rows = common.store(fixity.layout(rows), "fixity-records")
    original = common.store(fixity.digests(rows, "page_digest"), "fixity-original")
    replica = common.store(fixity.digests(fixity.damaged_copy(rows)), "fixity-replica")
    return fixity.audit(original, replica).select(F.col("record_id").alias("page_id"), "fault")


ORACLES["op4_merkle_fixity_audit"] = """
WITH p AS (
  SELECT page_id, ('0x' || substr(md5(coalesce(url, '')), 1, 6))::BIGINT AS sign FROM pages)
SELECT page_id, 'missing' AS fault FROM p WHERE sign % 67 = 1
UNION ALL SELECT page_id, 'changed' FROM p WHERE sign % 67 <> 1 AND sign % 61 = 0
UNION ALL SELECT page_id, 'stray' FROM p WHERE sign % 71 = 2
"""


@query
def op5_delta_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = token_rollup.Rollup(spark, shared_dir(spark, "rollup"))
    batches = token_rollup.history(common.read(spark, sf_dir, "documents"))
    for name, changes in batches.items():
        rollup.commit(name, changes)
    rollup.commit("revision", batches["revision"])
    return rollup.totals()


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(common.read(spark, sf_dir, "documents"))


def _sql_crc32(code_points: str) -> str:
    """SQL for the unsigned crc32 of the UTF-8 bytes of a list of code points below U+0800.

    The table of the checksum is the list ``t``, which ``_CRC_TABLE`` makes by its rule.
    """
    utf8 = f"flatten(list_transform({code_points}, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + c // 64, 128 + c % 64] END))"
    step = "xor(a >> 8, t[1 + (xor(a, b) & 255)])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {utf8}), lambda a, b: {step}), 4294967295::BIGINT)"


_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i::BIGINT], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS t)"""

ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, w, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) AS w FROM documents) GROUP BY doc_id, w),
signed AS (
  SELECT w, times, {_sql_crc32("list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''), lambda c: unicode(c)::BIGINT)")} AS h
  FROM runs, crc),
kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, times
  FROM signed),
v AS (SELECT word, sum(times)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
parts AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n FROM parts a JOIN parts b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM parts a JOIN v b ON b.word = a.l || a.r
  UNION SELECT b.word, a.word, a.n FROM parts a JOIN v b ON b.word = a.l || a.r),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
named AS (
  SELECT v.word, v.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN best.top >= 2 * v.n THEN best.top END AS form_n,
    CASE WHEN best.top >= 2 * v.n THEN (SELECT min(x.other) FROM near x WHERE x.word = v.word AND x.n = best.top) END AS form
  FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at, form AS next FROM named
  UNION ALL SELECT w.word, w.next, f.form FROM walk w JOIN named f ON f.word = w.next WHERE w.next IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM named f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(common.read(spark, sf_dir, "documents"))


def _sql_framed(value: str) -> str:
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


def _sql_leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(map(_sql_framed, fields))})"


def _sql_levels(name: str, leaves: str) -> str:
    """All levels (tree, lv, pos, size, node) of the trees over ``leaves``, as a recursive table."""
    return f"""{name} AS (
  SELECT tree, 0 AS lv, pos, size, node FROM {leaves}
  UNION ALL SELECT tree, lv + 1, pos // 16, (max(size) + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM {name} WHERE size > 1 GROUP BY tree, lv, pos // 16)"""


def _sql_walk(name: str, leaves: str, levels: str, given: str) -> str:
    """From each leaf up to the root, with the siblings met (``proof``) and the root reached (``folded``)."""
    run = f"FROM {levels} b WHERE b.tree = w.tree AND b.lv = w.lv AND b.pos // 16 = w.pos // 16"
    return f"""{name} AS (
  SELECT tree, pos AS leaf_at, 0 AS lv, pos, size, {given} FROM {leaves}
  UNION ALL SELECT w.tree, w.leaf_at, w.lv + 1, w.pos // 16, (w.size + 15) // 16,
    w.proof || (SELECT coalesce(string_agg(b.node, '' ORDER BY b.pos), '') {run} AND b.pos <> w.pos),
    sha256((SELECT string_agg(CASE WHEN b.pos = w.pos THEN w.folded ELSE b.node END, '' ORDER BY b.pos) {run}))
  FROM {name} w WHERE w.size > 1)"""


_CRC_OF_ID = _sql_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)")
_LOWER_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_sql_leaf("text")} AS node, {_sql_leaf(_LOWER_AZ)} AS lowered,
    coalesce({_CRC_OF_ID} % 5 = 0, false) AS touched FROM documents, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS size FROM hashed),
{_sql_levels("levels", "leaves")},
subroots AS (SELECT tree AS source, node FROM levels WHERE size = 1),
heads AS (
  SELECT 0 AS tree, source, node, row_number() OVER (ORDER BY encode(source)) - 1 AS pos, count(*) OVER () AS size FROM subroots),
{_sql_levels("top", "heads")},
start AS (SELECT *, '' AS proof, CASE WHEN touched THEN lowered ELSE node END AS folded FROM leaves),
{_sql_walk("walk", "start", "levels", "proof, folded")},
met AS (SELECT w.*, h.pos AS head_at, h.node AS subroot, h.size AS heads FROM walk w JOIN heads h ON h.source = w.tree WHERE w.size = 1),
again AS (SELECT 0 AS tree, tree || ' ' || leaf_at AS pos, head_at, heads, proof, folded FROM met),
upward AS (
  SELECT pos AS leaf, 0 AS lv, head_at AS pos, heads AS size, proof, folded FROM again
  UNION ALL SELECT w.leaf, w.lv + 1, w.pos // 16, (w.size + 15) // 16,
    w.proof || (SELECT coalesce(string_agg(b.node, '' ORDER BY b.pos), '') FROM top b
      WHERE b.lv = w.lv AND b.pos // 16 = w.pos // 16 AND b.pos <> w.pos),
    sha256((SELECT string_agg(CASE WHEN b.pos = w.pos THEN w.folded ELSE b.node END, '' ORDER BY b.pos) FROM top b
      WHERE b.lv = w.lv AND b.pos // 16 = w.pos // 16))
  FROM upward w WHERE w.size > 1)
SELECT l.doc_id, l.node AS leaf, h.node AS subroot, r.node AS root, sha256(u.proof) AS proof_sha256, u.folded AS folded_root,
  u.folded = r.node AS verified
FROM leaves l JOIN heads h ON h.source = l.tree JOIN (SELECT node FROM top WHERE size = 1) r ON true
JOIN upward u ON u.leaf = l.tree || ' ' || l.pos AND u.size = 1
"""


@query
def op13_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = common.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    windows = common.store(chat_format.windows(table.unionByName(more)), "chat-windows")
    return chat_format.read_back(windows)


# Escaped texts are longer by one character for each control string; marks by role are fixed.
ORACLES["op13_budgeted_windows"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, 2 + len(regexp_extract_all(text, '\p{L}{1,5}|\p{N}{1,3}|[^\t-\r \p{L}\p{N}]')) AS cost,
    length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?SYS\]|/?INST\]|OUT\]|/?ROLE\]|TEXT\])'))
    + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 ELSE 23 + length(role) END AS chars
  FROM t),
placed AS (
  SELECT *, coalesce(sum(cost) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins,
    sum(cost) OVER (PARTITION BY conv_id) AS total, first_value(role) OVER w = 'system' AS headed,
    first_value(cost) OVER w AS head_cost, first_value(chars) OVER w AS head_chars
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
roomy AS (
  SELECT *, CASE WHEN headed AND total > 1024 THEN head_cost ELSE 0 END AS opening,
    CASE WHEN total <= 1024 THEN 1024 ELSE greatest(128, 896 - CASE WHEN headed THEN head_cost ELSE 0 END) END AS room
  FROM placed),
dealt AS (
  SELECT *, begins // room AS stretch, begins % room >= room // 2 AS behind FROM roomy),
fitted AS (
  SELECT *, max(begins + cost) OVER s - min(begins) OVER s <= room AS fits FROM dealt WINDOW s AS (PARTITION BY conv_id, stretch)),
spans AS (
  SELECT conv_id, min(begins) AS begins, sum(chars) AS chars, any_value(room) AS room, any_value(opening) AS opening,
    any_value(head_chars) AS head_chars FROM fitted GROUP BY conv_id, stretch, CASE WHEN fits THEN false ELSE behind END),
headed AS (
  SELECT s.conv_id, 3 + s.chars + CASE WHEN s.opening > 0 AND s.begins > 0 THEN s.head_chars ELSE 0 END
    + coalesce((SELECT sum(f.chars) FROM fitted f WHERE f.conv_id = s.conv_id AND f.begins < s.begins
      AND f.begins >= greatest(s.begins - least(128, s.room // 2), s.opening)), 0) AS chars FROM spans s),
written AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM headed GROUP BY conv_id),
said AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS learned FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars
FROM said JOIN written USING (conv_id)
"""
