"""The registered queries of the text operators, and their SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary_codes, ftrl, hard_negatives, host_suffixes, hyperminhash, merkle, mixing, piece_agenda, prefix_counts, quotations, suffix_tree, weak_supervision, wu_manber
from .common import crc_remainder, lower_ascii

TOKEN_LIMIT = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = binary_codes.near_vectors(spark, _table(spark, sf_dir, "embeddings"))
    return judged.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op2_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_suffixes.extract(spark, _table(spark, sf_dir, "pages"))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_order(spark, _table(spark, sf_dir, "conversations"))


def op5_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    counted = prefix_counts.prefix_token_counts(
        docs.select("doc_id", size, "text"), public_tokenizers.path("byte_bpe_50k.json"), steps=False, keep_text=False
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = ftrl.fit(spark, docs, _table(spark, sf_dir, "labels"))
    scored = ftrl.score(spark, docs.withColumn("held_out", crc_remainder(F.col("doc_id"), ftrl.FOLDS) == 0), weights)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_agenda.encode(docs, model, digests=True, keep_text=False)


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = hyperminhash.near_duplicates(spark, docs)
    return judged.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.allocate(spark, docs)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "passes")


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return weak_supervision.quality_verdicts(spark, docs, carry=["doc_id"])


def op11_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(spark, rows, F.col("id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    text = F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    proofs = merkle.manifest(spark, docs, fields=fields, by="source", order="doc_id", claims={"text": text})
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_window_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wu_manber.find_windows(spark, docs, _table(spark, sf_dir, "benchmark"), keep_text=False)
    hit = wu_manber.n_hit(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_binary_codes": op1_binary_codes,
    "op2_host_suffixes": op2_host_suffixes,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_quotation_links": op4_quotation_links,
    "op5_prefix_counts": op5_prefix_counts,
    "op6_ftrl_toxicity": op6_ftrl_toxicity,
    "op7_piece_agenda": op7_piece_agenda,
    "op8_hyperminhash": op8_hyperminhash,
    "op9_source_mix": op9_source_mix,
    "op10_weak_supervision": op10_weak_supervision,
    "op11_slot_negatives": op11_slot_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_window_hits": op13_window_hits,
}

# Levels of a tree in the SQL of the manifest: enough for 16^6 leaves of a source and as many sources.
_LEVELS = 6


def _levels_sql(name: str, tree: str) -> str:
    """The nodes of every level above ``name``0(tree, r, h, m), and the runs that they are made of."""
    parts = []
    for k in range(_LEVELS):
        parts.append(f"""
{name}{k + 1} AS (
  SELECT {tree}, r // 16 AS r, CASE WHEN m > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h,
    (m + 15) // 16 AS m, CASE WHEN m > 1 THEN list(h ORDER BY r) END AS run
  FROM {name}{k} GROUP BY {tree}, r // 16, m),""")
    return "".join(parts)


def _fold_sql(name: str, tree: str, leaves: str, keep: str) -> str:
    """Siblings so far and the folded node of ``leaves``, level by level."""
    parts, last = [], leaves
    for k in range(_LEVELS):
        parts.append(f"""
{leaves}{k + 1} AS (
  SELECT {keep}, p.r // 16 AS r, CASE WHEN run IS NULL THEN sib
      ELSE sib || array_to_string(list_filter(run, lambda x, i: i <> p.r % 16 + 1), '') END AS sib,
    CASE WHEN run IS NULL THEN node ELSE sha256(array_to_string(list_transform(run, lambda x, i:
      CASE WHEN i = p.r % 16 + 1 THEN node ELSE x END), '')) END AS node
  FROM {last} p JOIN {name}{k + 1} t ON t.{tree} IS NOT DISTINCT FROM p.{tree} AND t.r = p.r // 16),""")
        last = f"{leaves}{k + 1}"
    return "".join(parts)


def _manifest_sql() -> str:
    def leaf(text: str) -> str:
        field = lambda c: f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    steps = "[" + ", ".join(["ascii(s[i])", *["-1"] * 8]) + "]"
    crc = f"""(SELECT xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, len(s) + 1), lambda i: {steps})),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x::BIGINT) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END),
    4294967295::BIGINT) FROM (SELECT doc_id::VARCHAR AS s))"""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH c AS (SELECT *, {crc} AS crc FROM documents),
d AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN crc % 5 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS claim
  FROM c),
l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS m
  FROM d),
a0 AS (SELECT source, r, leaf AS h, m FROM l),{_levels_sql("a", "source")}
o AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS m FROM a{_LEVELS}),
b0 AS (SELECT 0 AS one, r, subroot AS h, m FROM o),{_levels_sql("b", "one")}
p AS (SELECT doc_id, source, leaf, r, '' AS sib, claim AS node FROM l),{_fold_sql("a", "source", "p", "doc_id, p.source, leaf")}
q AS (
  SELECT doc_id, leaf, subroot, 0 AS one, o.r, sib, node FROM p{_LEVELS} JOIN o ON o.source IS NOT DISTINCT FROM p{_LEVELS}.source),
{_fold_sql("b", "one", "q", "doc_id, leaf, subroot, p.one").strip()}
z AS (SELECT h AS root FROM b{_LEVELS})
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, node AS folded_root, node = root AS verified
FROM q{_LEVELS}, z
"""


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""
_LETTERS = _WORDS.replace(r"[^\x20\x09-\x0D]+", wu_manber.WORD)

SQL = {
    "op1_binary_codes": """
WITH RECURSIVE u AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
g AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM u
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(v, v) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.98),
r(node, other) AS (
  SELECT vec_id, vec_id FROM u UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT node, min(other) AS component_id FROM r GROUP BY node),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM u JOIN c ON c.node = u.vec_id LEFT JOIN k ON k.a = u.vec_id
""",
    "op4_quotation_links": r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS ls, row_number() OVER () AS id FROM conversations),
x AS (SELECT id, conv_id, turn, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM m),
p AS (SELECT *, regexp_extract(line, '^([ \t]*(?:>[ \t]*)+)', 1) AS marks FROM x),
n AS (
  SELECT id, conv_id, turn, pos, line, len(marks) - len(replace(marks, '>', '')) AS level,
    lower(regexp_replace(trim(substr(line, len(marks) + 1), chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), '[ \t\v\f\r]+', ' ', 'g')) AS content
  FROM p),
b AS (
  SELECT id, trim(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    count(*) FILTER (level > 0) AS n_quoted, max(level) AS max_level
  FROM n GROUP BY id),
o AS (SELECT conv_id, content, min(turn) AS own_turn FROM n WHERE level = 0 AND content <> '' GROUP BY ALL),
f AS (SELECT content, min(conv_id, 2) AS holders FROM o WHERE conv_id IS NOT NULL AND own_turn IS NOT NULL GROUP BY content),
q AS (
  SELECT n.conv_id, n.turn, n.level, CASE WHEN own_turn < n.turn THEN own_turn END AS inside,
    CASE WHEN own_turn IS NULL OR own_turn >= n.turn THEN list_filter(holders, lambda c: c <> n.conv_id)[1] END AS outside
  FROM n LEFT JOIN o ON o.conv_id = n.conv_id AND o.content = n.content LEFT JOIN f ON f.content = n.content
  WHERE n.level > 0 AND n.content <> ''),
k AS (
  SELECT conv_id, turn, max(inside) FILTER (level = 1) AS replied, count(coalesce(inside, outside)) AS n_linked, min(outside) AS quoted_conv
  FROM q GROUP BY ALL),
t AS (
  SELECT conv_id, turn, coalesce(replied, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn)) AS parent
  FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL) LEFT JOIN k USING (conv_id, turn)),
r AS (
  SELECT conv_id, turn, turn AS root, CAST(0 AS BIGINT) AS depth FROM t WHERE parent IS NULL
  UNION ALL SELECT t.conv_id, t.turn, r.root, r.depth + 1 FROM t JOIN r ON r.conv_id = t.conv_id AND r.turn = t.parent)
SELECT m.conv_id, m.turn, m.role, body, n_quoted, max_level, coalesce(n_linked, 0) AS n_linked, parent AS parent_turn,
  root AS root_turn, depth, row_number() OVER (PARTITION BY m.conv_id ORDER BY depth, m.turn) AS position, quoted_conv
FROM m JOIN b USING (id) JOIN t ON t.conv_id = m.conv_id AND t.turn = m.turn JOIN r ON r.conv_id = m.conv_id AND r.turn = m.turn
LEFT JOIN k ON k.conv_id = m.conv_id AND k.turn = m.turn
""",
    "op8_hyperminhash": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh
  FROM d),
n AS (SELECT doc_id, len(sh) AS n FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.other)
SELECT n.doc_id, n.n AS n_shingles, min(r.other) AS component_id, n.doc_id = min(r.other) AS kept
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
""",
    "op11_slot_negatives": """
WITH u AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM u a JOIN u b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
    "op12_merkle_manifest": _manifest_sql(),
    "op13_window_hits": f"""
WITH i AS (SELECT item_id::VARCHAR AS item, {_LETTERS} AS ws FROM benchmark),
w AS (
  SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[k:k + least(10, len(ws)) - 1], ' ') AS win
  FROM i, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) t(k) WHERE len(ws) > 0),
d AS (SELECT row_number() OVER () AS id, doc_id, {_LETTERS} AS ws FROM documents),
g AS (
  SELECT id, k, l.n, array_to_string(ws[k:k + l.n - 1], ' ') AS win
  FROM d, (SELECT DISTINCT n FROM w) l, unnest(range(1, len(ws) - l.n + 2)) t(k)),
h AS (SELECT g.id, g.k, g.n, w.item FROM g JOIN w ON w.win = g.win AND w.n = g.n),
c AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(k, k + n)) AS p FROM h) GROUP BY id),
m AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (id) LEFT JOIN m USING (id)
""",
}
