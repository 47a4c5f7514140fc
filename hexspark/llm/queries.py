"""The queries of the text operators over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexspark.llm import chat, compression, decontamination, language_model, merkle, mixing, ngram_join, quality_rules, secrets, toxicity, trie, url_filter, warc
from hexspark.llm.common import Scratch, fold, table

#: Fixed by the task: what both rows of conversation -7 say.
QUOTE = "\\### Assistant: </turn> ok"
#: Fixed by the task: host, path and verdict of the rules.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]



def _crc32(text: str) -> str:
    """SQL of the unsigned checksum of an ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))"
    codes = f"list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT))"
    return f"xor(list_reduce({codes}, lambda a, b: {bits}), 4294967295::BIGINT)"


def _said(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join([*map(_said, ('doc_id', 'source', 'lang', 'n_chars')), _said(text)])})"


SQL = {
    "op12_merkle_manifest": rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS start
  FROM documents
),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n FROM docs),
tree(grp, level, place, n, node) AS (
  SELECT grp, 0, place, n, leaf FROM leaves
  UNION ALL
  SELECT grp, level + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(node, '' ORDER BY place)) FROM tree WHERE n > 1 GROUP BY grp, level, place // 3
),
subroots AS (SELECT grp, node, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
crown(level, place, n, node) AS (
  SELECT 0, place, n, node FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(node, '' ORDER BY place)) FROM crown WHERE n > 1 GROUP BY level, place // 3
),
steps AS (
  SELECT l.rid, t.level, t.place, t.node, t.place < l.place // (3 ** t.level)::BIGINT AS before
  FROM leaves l JOIN tree t ON l.grp = t.grp AND t.place // 3 = l.place // (3 ** (t.level + 1))::BIGINT AND t.place <> l.place // (3 ** t.level)::BIGINT AND t.n > 1
  UNION ALL
  SELECT l.rid, 1000 + c.level, c.place, c.node, c.place < s.place // (3 ** c.level)::BIGINT
  FROM leaves l JOIN subroots s ON l.grp = s.grp JOIN crown c ON c.place // 3 = s.place // (3 ** (c.level + 1))::BIGINT AND c.place <> s.place // (3 ** c.level)::BIGINT AND c.n > 1
),
-- Every level is a step, also that of a node alone in its run.
sides AS (
  SELECT v.rid, row_number() OVER (PARTITION BY v.rid ORDER BY v.level) AS step,
         coalesce(string_agg(s.node, '' ORDER BY s.place) FILTER (WHERE s.before), '') AS lefts, coalesce(string_agg(s.node, '' ORDER BY s.place) FILTER (WHERE NOT s.before), '') AS rights
  FROM (SELECT l.rid, t.level FROM leaves l JOIN (SELECT DISTINCT grp, level FROM tree WHERE n > 1) t USING (grp)
        UNION ALL SELECT l.rid, 1000 + c.level FROM leaves l, (SELECT DISTINCT level FROM crown WHERE n > 1) c) v LEFT JOIN steps s ON v.rid = s.rid AND v.level = s.level
  GROUP BY v.rid, v.level
),
fold(rid, step, node) AS (
  SELECT rid, 0::BIGINT, start FROM leaves
  UNION ALL
  SELECT f.rid, s.step, sha256(s.lefts || f.node || s.rights) FROM fold f JOIN sides s ON f.rid = s.rid AND s.step = f.step + 1
),
ends AS (SELECT rid, arg_max(node, step) AS folded_root FROM fold GROUP BY rid),
proofs AS (SELECT rid, sha256(string_agg(node, '' ORDER BY level, place)) AS proof_sha256 FROM steps GROUP BY rid)
SELECT l.doc_id, l.leaf, s.node AS subroot, r.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.node AS verified
FROM leaves l JOIN subroots s ON l.grp = s.grp JOIN ends e ON l.rid = e.rid LEFT JOIN proofs p ON l.rid = p.rid, (SELECT node FROM crown WHERE n = 1) r
""",
    "op13_prefix_trie": rf"""
WITH own AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (SELECT conv_id, t, length(text) AS tok, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS pos FROM own),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
begun AS (SELECT c.conv_id, p.pos AS depth, p.t, p.tok FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos <= c.h),
moved AS (SELECT c.conv_id, c.h, count(b.depth) AS k FROM convs c LEFT JOIN begun b ON b.conv_id = c.conv_id GROUP BY c.conv_id, c.h),
turns AS (
  SELECT * FROM begun UNION ALL SELECT p.conv_id, p.pos - m.h + m.k, p.t, p.tok FROM placed p JOIN moved m ON p.conv_id = m.conv_id AND p.pos > m.h
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
),
members AS (SELECT conv_id, depth, tok, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM turns),
nodes AS (SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(tok) AS tok FROM members GROUP BY key),
kids AS (SELECT left(key, -64) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
ends AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS d FROM (SELECT conv_id, arg_max(key, depth) AS key FROM members GROUP BY conv_id) GROUP BY key),
below AS (
  SELECT m.key, sum((n.n_convs - 1) * n.tok) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth LEFT JOIN kids k ON k.key = n.key GROUP BY m.key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.d, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (key) LEFT JOIN kids k USING (key) LEFT JOIN ends e USING (key) LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, -64)
""",
    "op4_mix_sources": r"""
WITH rows AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce('=' || doc_id::VARCHAR, '') || '|' || coalesce('=' || source, '') || '|' || coalesce('=' || md5(text), '')), 1, 15))::BIGINT AS h
  FROM documents
),
per AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS most, [5, 2, 1][1 + rk % 3]::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM rows GROUP BY source)
),
-- If all sources that fill up sooner than this one are full, the others share the rest by weight.
shared AS (
  SELECT most / weight AS ratio,
         ((SELECT sum(source_size) FROM per) - coalesce((SELECT sum(o.most) FROM per o WHERE o.most / o.weight < p.most / p.weight), 0))
         / (SELECT sum(o.weight) FROM per o WHERE o.most / o.weight >= p.most / p.weight) AS factor
  FROM per p
),
targets AS (
  SELECT *, least(most, coalesce(weight * (SELECT arg_min(factor, ratio) FROM shared WHERE ratio > factor), most)) AS target FROM per
),
budgets AS (
  SELECT *, CASE WHEN target >= most THEN round(target / greatest(source_size, 1)) ELSE floor(target / greatest(source_size, 1)) END::BIGINT AS whole FROM targets
),
placed AS (
  SELECT r.*, b.source_size, b.target, b.whole, greatest(0.0, b.target - b.whole * b.source_size) AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h, r.rid ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
)
-- The row in which the budget ends is taken if that comes nearer.
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * least(3, whole + CASE WHEN upto <= rest OR (upto - size < rest AND upto - rest < rest - (upto - size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
""",
    "op5_archive_pages": """
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digested AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM rows),
marked AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS nth FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN first END AS refers_to
FROM marked
""",
    "op6_format_chats": rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '{QUOTE}' FROM range(2) AS r(t)
),
sized AS (
  -- Each escaped character takes one more; a turn adds '### ', ': ', '</turn>' and a line feed.
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\#<:]', '', 'g')) + 14 AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op7_ngram_join": r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT rid, doc_id, list_distinct(
    CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
),
shingles AS (SELECT rid, n, hash(x) AS h FROM (SELECT rid, len(s) AS n, unnest(s) AS x FROM sets)),
near AS (
  SELECT a.rid AS a, b.rid AS b
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.rid < b.rid AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
edges AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(rid, other) AS (
  SELECT rid, rid FROM sets UNION SELECT reach.rid, edges.b FROM reach JOIN edges ON reach.other = edges.a
)
SELECT any_value(d.doc_id) AS doc_id, any_value(len(d.s))::BIGINT AS n_shingles, min(o.doc_id) AS component_id,
       (SELECT count(*) FROM edges WHERE edges.a = d.rid) AS n_links
FROM reach JOIN sets d ON reach.rid = d.rid JOIN sets o ON reach.other = o.rid
GROUP BY d.rid
""",
}


def op1_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with counts and digests of the spans found in it."""
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = joined(F.filter("spans", lambda s: s["kind"] != "random"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(base, 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), of("random"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its rule statistics and the verdict."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "anomaly")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its log10 probability under the recurrent network and under add-one unigrams."""
    return language_model.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its WARC record reads."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that quotes the template, as its formatted text reads."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(QUOTE).alias("text"),
    )
    out = chat.format_branches(chat.conversation_messages(rows.unionByName(own)))
    out = out.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set of 3-word shingles, its component under similarity 0.9 and the number of documents it is linked with."""
    return ngram_join.link_components(table(spark, sf_dir, "documents"), ngram_join.Likeness(3, 90, 100)).select("doc_id", "n_shingles", "component_id", "n_links")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, by its best window."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score, learned without the held-out labels."""
    train = ~compression.held_out("doc_id")
    scored = compression.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train)
    return scored.select("doc_id", compression.held_out().alias("held_out"), "score", (F.col("score") >= compression.DECISION).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score, learned without the held-out labels."""
    train = ~toxicity.held_out("doc_id")
    scored = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its verdict: the rule's that fits best, else the model's."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    known = spark.createDataFrame(url_filter.labelled(), "url string, label int")
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules, known)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaf and proof, and the root that the proof gives for a text that lost its line feeds."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    start = F.when(even, merkle.tampered("text", F.replace("text", F.lit("\n"), F.lit("")))).otherwise(merkle.tampered("text", F.col("text")))
    found = merkle.prove(table(spark, sf_dir, "documents"), start=start).withColumn("folded_root", merkle.folded(F.col("start"), F.col("path")))
    proof = F.sha2(F.array_join(merkle.proof(F.col("path")), ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, which begin with turns of the conversation a hundred begins with."""
    conv = F.col("conv")
    kept, runs = trie.numbered(table(spark, sf_dir, "conversations"), Scratch(spark))
    turns, convs = trie.with_shared_starts(kept, runs, (F.crc32(conv.cast("string")) % 6).cast("int"), conv - conv % 100, 5)
    return trie.build(turns, convs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_find_secrets, op2_quality_rules, op3_language_model, op4_mix_sources, op5_archive_pages, op6_format_chats, op7_ngram_join, op8_decontaminate,
        op9_quality_classifier, op10_toxicity, op11_filter_urls, op12_merkle_manifest, op13_prefix_trie,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
