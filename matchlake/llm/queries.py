"""Catalogue queries of the operators: ``opN_<name>`` applies operator N with
production parameters to its whole table; the DuckDB SQL stands beside it
where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import conversation_repair as talk, merkle, quality_gam
from matchlake.llm.decontaminate import contaminated
from matchlake.llm.exact_dedup import exact_dedup
from matchlake.llm.jaccard_join import jaccard_classes
from matchlake.llm.line_dedup import line_dedup
from matchlake.llm.mixing import mix_sources
from matchlake.llm.pii import digest, find_pii
from matchlake.llm.store import documents
from matchlake.llm.substring_dedup import substring_dedup
from matchlake.llm.suffix_dedup import suffix_dedup
from matchlake.llm.token_output import write_tokens
from matchlake.llm.toxicity import fit, fold, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return add


@_query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM n WINDOW same AS (PARTITION BY norm)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


@_query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), digest=True)


@_query("op3_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos, len(words) AS n FROM d),
s AS (SELECT doc_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos
             ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win FROM w),
later AS (SELECT doc_id, pos FROM s WHERE pos + 20 <= n
          QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later),
kept AS (SELECT w.doc_id, w.pos, w.word, gone.pos IS NOT NULL AS cut FROM w LEFT JOIN gone USING (doc_id, pos))
SELECT doc_id, count(pos) AS n_words, count(*) FILTER (cut) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT cut), '')) AS kept_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN kept USING (doc_id) GROUP BY doc_id
""")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), digest=True)


@_query("op4_line_dedup", r"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM l),
s AS (SELECT doc_id, pos, lines[pos] AS line, lines[pos:pos + 2] AS w, pos + 2 <= len(lines) AS whole FROM p),
later AS (SELECT doc_id, pos FROM s WHERE whole
          QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 3)) AS pos FROM later),
kept AS (SELECT s.doc_id, s.pos, s.line, gone.pos IS NOT NULL AS cut FROM s LEFT JOIN gone USING (doc_id, pos))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (cut) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT cut), '')) AS kept_sha256
FROM kept GROUP BY doc_id
""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir))


@_query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_pii(documents(spark, sf_dir)))


@_query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return toxicity(docs, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


@_query("op8_mix_sources", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [1.0::DOUBLE, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM d GROUP BY source),
lev AS (SELECT *, 3.0::DOUBLE * source_size / w AS level FROM s),
f AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size) OVER (
          ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 3)::DOUBLE
        / sum(w) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM lev),
g AS (SELECT *, (SELECT struct_pack(level := level, share := share) FROM f x WHERE x.share <= x.level
                 ORDER BY level, share LIMIT 1) AS b FROM f),
t AS (SELECT source, source_size, CASE WHEN b IS NULL OR level < b.level THEN 3.0::DOUBLE * source_size
        ELSE least(w * b.share, 3.0::DOUBLE * source_size) END AS target FROM g),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM t),
k AS (SELECT *, floor(ratio)::BIGINT AS whole, ratio - floor(ratio)::BIGINT AS p,
             target - floor(ratio)::BIGINT * source_size AS rest FROM r),
u AS (SELECT d.doc_id, d.size, k.*,
             (('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5)
             / 281474976710656.0::DOUBLE AS u
      FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source),
q AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM u),
c AS (SELECT *, CASE WHEN q IS NOT NULL THEN sum(size) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id, size
             ROWS UNBOUNDED PRECEDING) END AS upto FROM q)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN upto <= rest
          OR upto - rest < rest - (upto - size) THEN 1 ELSE 0 END END * size)::BIGINT AS taken
FROM c
""")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@_query("op9_token_output")
def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_tokens(documents(spark, sf_dir))


@_query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


@_query("op11_quality")
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_gam.fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return quality_gam.quality(docs, model).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


#: crc32 of a string of ASCII characters, by its table of 256 remainders made here.
CRC32_SQL = r"""list_reduce([4294967295::BIGINT] || list_transform(string_split({s}, ''), lambda c: ascii(c)::BIGINT), lambda crc, b:
    xor(crc >> 8, list_reduce([xor(crc & 255, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""


def crc32_sql(s: str) -> str:
    return f"xor({CRC32_SQL.format(s=s)}, 4294967295::BIGINT)"


@_query("op12_conversation_repair", rf"""
WITH RECURSIVE
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
hit AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
               CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM raw WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                  count(*) OVER (PARTITION BY conv_id) AS n FROM hit),
marked AS (SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS c,
                  NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut FROM placed),
faults AS (SELECT *, NOT blank AND again AS dup, NOT blank AND NOT again AND cut AS trunc,
                  lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM marked),
moves(q, letter, c, add, q2) AS (VALUES (0, 'D', '', 3, 0), (1, 'D', '', 3, 1), (2, 'D', '', 3, 2), (3, 'D', '', 3, 3),
    (0, 'K', 's', 0, 1), (0, 'K', 'u', 0, 2), (1, 'K', 'u', 0, 2), (3, 'K', 'u', 0, 2), (2, 'K', 'a', 0, 3),
    (0, 'R', '', 2, 2), (1, 'R', '', 2, 2), (3, 'R', '', 2, 2), (2, 'R', '', 2, 3)),
gaps(q, letters, add, q2) AS (VALUES (0, '', 0, 0), (1, '', 0, 1), (2, '', 0, 2), (3, '', 0, 3), (0, 'I', 2, 2), (1, 'I', 2, 2),
    (2, 'I', 2, 3), (3, 'I', 2, 2), (0, 'II', 4, 3), (1, 'II', 4, 3)),
paths AS (SELECT DISTINCT conv_id, n, 0::BIGINT AS i, 0 AS q, '00000000' AS best FROM placed
          UNION ALL
          SELECT p.conv_id, p.n, p.i + 1, m.q2,
                 min(lpad((left(p.best, 8)::INT + g.add + m.add + CASE WHEN f.trunc AND letter <> 'D' THEN 1 ELSE 0 END)::VARCHAR, 8, '0')
                     || substr(p.best, 9) || g.letters || m.letter)
          FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
          JOIN gaps g ON g.q = p.q JOIN moves m ON m.q = g.q2 AND (m.c = '' OR m.c = f.c) AND (m.letter = 'D' OR NOT (f.blank OR f.dup))
          GROUP BY p.conv_id, p.n, p.i, m.q2),
ended AS (SELECT conv_id, min(lpad((left(best, 8)::INT + g.add)::VARCHAR, 8, '0') || substr(best, 9) || g.letters) AS best
          FROM paths p JOIN gaps g ON g.q = p.q AND g.q2 IN (0, 3) WHERE i = n GROUP BY conv_id),
audits AS (SELECT conv_id, left(best, 8)::BIGINT AS cost, substr(best, 9) AS audit FROM ended),
letters AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS j, unnest(string_split(audit, '')) AS letter FROM audits WHERE audit <> ''),
edits AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS p,
                 sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS m FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
lines AS (SELECT e.conv_id, j, CASE letter WHEN 'K' THEN f.role ELSE CASE WHEN (p - m % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END END
                 || ':' || CASE letter WHEN 'I' THEN '' ELSE f.text END AS line
          FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE letter <> 'D'),
sums AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY j)) AS sha FROM lines GROUP BY conv_id),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
""")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    r = talk.repair(talk.damaged(given))
    every = given.select("conv_id").distinct().withColumn("conv", talk.conversation_key("conv_id"))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(r.conversations, "conv", "left").join(talk.digests(talk.repaired(r)), "conv", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _coded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


@_query("op13_merkle_manifest", f"""
WITH RECURSIVE
docs AS (SELECT *, {" || ".join(_coded(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head FROM documents),
leaves AS (SELECT doc_id, source, sha256(head || {_coded("text")}) AS leaf,
                  CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS said, head FROM docs),
placed AS (SELECT doc_id, source, leaf, sha256(head || {_coded("said")}) AS claim,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                  count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (SELECT source, 0 AS lvl, idx, leaf AS h, n FROM placed
          UNION ALL
          SELECT source, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1
          GROUP BY source, lvl, idx // 3, n),
tops AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source IS NOT NULL, source) - 1 AS idx, count(*) OVER () AS n
         FROM nodes WHERE n = 1),
upper AS (SELECT 0 AS lvl, idx, subroot AS h, n FROM tops
          UNION ALL
          SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM upper WHERE n > 1
          GROUP BY lvl, idx // 3, n),
heights AS (SELECT source, max(lvl) AS height FROM nodes GROUP BY source),
steps AS (SELECT p.doc_id, p.idx AS place, p.source, x.lvl AS step,
                 coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx < p.idx // 3 ** x.lvl), '') AS before,
                 coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx > p.idx // 3 ** x.lvl), '') AS after
          FROM placed p JOIN nodes x ON x.source IS NOT DISTINCT FROM p.source AND x.n > 1 AND x.idx // 3 = p.idx // 3 ** (x.lvl + 1)
          GROUP BY p.doc_id, p.idx, p.source, x.lvl
          UNION ALL
          SELECT p.doc_id, p.idx, p.source, x.lvl + heights.height,
                 coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx < t.idx // 3 ** x.lvl), ''),
                 coalesce(string_agg(x.h, '' ORDER BY x.idx) FILTER (x.idx > t.idx // 3 ** x.lvl), '')
          FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source
               JOIN heights ON heights.source IS NOT DISTINCT FROM p.source
               JOIN upper x ON x.n > 1 AND x.idx // 3 = t.idx // 3 ** (x.lvl + 1)
          GROUP BY p.doc_id, p.idx, p.source, x.lvl, heights.height, t.idx),
fold AS (SELECT source, idx AS place, 0 AS step, claim AS h FROM placed
         UNION ALL
         SELECT f.source, f.place, f.step + 1, sha256(s.before || f.h || s.after) FROM fold f
         JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.place = f.place AND s.step = f.step),
ends AS (SELECT source, place, max_by(h, step) AS folded_root FROM fold GROUP BY source, place),
proofs AS (SELECT source, place, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY source, place)
SELECT p.doc_id, p.leaf, t.subroot, r.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.h AS verified
FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source JOIN (SELECT h FROM upper WHERE n = 1) r ON true
JOIN ends e ON e.source IS NOT DISTINCT FROM p.source AND e.place = p.idx
LEFT JOIN proofs q ON q.source IS NOT DISTINCT FROM p.source AND q.place = p.idx
""".replace("3 ** x.lvl", "(3 ** x.lvl)::BIGINT").replace("3 ** (x.lvl + 1)", "(3 ** (x.lvl + 1))::BIGINT"))
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    manifest = merkle.build(docs, F.col("source"), F.col("doc_id"), merkle.leaf_of(*values), merkle.tampered_leaf())
    return merkle.prove(manifest).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
