"""Registered queries of the pipeline operations, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (
    bpe, chat, embedding_dedup, filter_audit, licenses, merkle, minhash_dedup, mix, piece_bpe, quality, token_counts, topk, url_filter,
)
from lectern.llm.runtime import stored

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

PIECES = public_tokenizers.path("piece_bpe_32k.model")

RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]

#: Documents from this score up have predicted quality 1.
KEEP_SCORE = 0.7

#: The conversation that holds control strings of other templates.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(spark: SparkSession, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, path, pattern)


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    return chat.read_back(chat.format_chat(rows.unionByName(probe)))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix.positions(mix.plan_mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "position")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer(spark))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("text")
    # The sums read the histogram more than once; the documents are to be encoded once.
    return token_counts.suffix_sums(stored(token_counts.length_histogram(docs, tokenizer(spark)), "lengths"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = quality.score(docs, model).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a repository with directories for each 1000 and 100 ids; each tenth document is a licence file."""
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100), name)
    files = _table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    found = licenses.scan_licences(files)
    return found.select(F.col("row.doc_id").alias("doc_id"), "path", "own", "similarity", "licence", "declared_in")


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = piece_bpe.round_trip(docs, piece_bpe.PieceTokenizer(spark, PIECES))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return filter_audit.audit(filter_audit.count_masks(docs, labels))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents").select(*merkle.COLUMNS))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_top_k": exact_top_k,
        "op2_embedding_near_dedup": embedding_near_dedup,
        "op3_chat_format": chat_format,
        "op4_minhash_near_dedup": minhash_near_dedup,
        "op5_source_mix": source_mix,
        "op6_url_filter": url_verdicts,
        "op7_bpe_round_trip": bpe_round_trip,
        "op8_token_counts": token_histogram,
        "op9_quality": quality_scores,
        "op10_licence_scan": licence_scan,
        "op11_piece_round_trip": piece_round_trip,
        "op12_filter_audit": filter_interactions,
        "op13_merkle_manifest": merkle_manifest,
    }


_TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id != q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""

_NEAR = """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id != b.vec_id
   AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM vectors UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), parts AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degree AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT p.vec_id, coalesce(n_links, 0) AS n_links, component_id, p.vec_id = component_id AS kept
FROM parts p LEFT JOIN degree d ON p.vec_id = d.vec_id
"""

_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT *, role = 'assistant' AS learned,
         length(regexp_replace(text, '([<\[])(\\*)(\|start\|>|\|end\|>|\|image\|>|\|audio\|>|\|document\|>|s>|/s>|INST\]|/INST\])',
                               '\1\2\\\3', 'g')) AS escaped
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN learned THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN learned THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(9 + length(role) + 1 + escaped + 7 + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_MIX = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))) AS key
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM docs GROUP BY source
), weighed AS (
  SELECT *, CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM per
), ranked AS (
  SELECT *, CAST(source_size * 3 AS DOUBLE) / weight AS ratio,
         CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER before, 0) AS DOUBLE)
           / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW before AS (ORDER BY CAST(source_size * 3 AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (SELECT level FROM ranked WHERE level <= ratio ORDER BY ratio LIMIT 1) AS reached FROM ranked
), targets AS (
  SELECT source, turn, source_size, least(CAST(source_size * 3 AS DOUBLE), reached * weight) AS target FROM levels
), placed AS (
  SELECT d.doc_id, d.size, t.turn, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS need,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size, d.doc_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0
                 ELSE (need // source_size) * size
                      + least(greatest(need % source_size - start, 0), size) END AS taken,
         CASE turn WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1::DOUBLE ELSE 0.5::DOUBLE END AS f0,
         CASE turn WHEN 0 THEN -1::DOUBLE WHEN 1 THEN 0::DOUBLE ELSE 1::DOUBLE END AS slope,
         start / target AS share
  FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN round(least(greatest(2 * share / (f0 + sqrt(greatest(f0 * f0 + 2 * slope * share, 0))), 0), 1), 9)
       END AS position
FROM taken
"""

_URLS = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


_AUDIT = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), measured AS (
  SELECT doc_id, part, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n,
         len(list_distinct(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS d,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS caps, min(doc_id) OVER (PARTITION BY text) AS first_id
  FROM docs
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN n < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * d < 80 * n THEN 2 ELSE 0 END
         + CASE WHEN 100 * caps > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM measured m LEFT JOIN marks USING (doc_id)
), counted AS (
  SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, b)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a JOIN letters b ON b.l != a.l JOIN letters c ON c.l NOT IN (a.l, b.l) JOIN letters d ON d.l NOT IN (a.l, b.l, c.l)
  JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
  FROM orders, range(1, 6) AS r(step)
), found AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit != 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit != 0 AND mask & earlier != 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit != 0 AND mask & earlier = 0 AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit != 0 AND mask & earlier = 0 AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM found
"""


#: Levels that the SQL of the manifest goes through; more than enough for eight million rows a group.
_LEVELS = 8


def _merkle_sql() -> str:
    """Nodes by level, each level a table of its own; then the siblings and the folded digests, level by level."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')"
                 for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, start: str) -> list[str]:
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(_LEVELS):
            out.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT grp, CASE WHEN size > 1 THEN pos // 8 ELSE pos END AS pos,
         CASE WHEN size > 1 THEN sha256(string_agg(h, '' ORDER BY {name}{k}.pos)) ELSE any_value(h) END AS h, (size + 7) // 8 AS size
  FROM {name}{k} GROUP BY grp, size, CASE WHEN size > 1 THEN pos // 8 ELSE pos END)""")
        return out

    def climb(name: str, nodes: str, start: str) -> list[str]:
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(_LEVELS):
            out.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT c.id, c.grp, c.pos // 8 AS pos, c.proof || coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos != c.pos), '') AS proof,
         CASE WHEN any_value(s.size) > 1
              THEN sha256(string_agg(CASE WHEN s.pos = c.pos THEN c.folded ELSE s.h END, '' ORDER BY s.pos)) ELSE c.folded END AS folded
  FROM {name}{k} c JOIN {nodes}{k} s ON s.grp = c.grp AND s.pos // 8 = c.pos // 8
  GROUP BY c.id, c.grp, c.pos, c.proof, c.folded)""")
        return out

    bits = ("list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), "
            "lambda i: [ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])))")
    crc = (f"xor(list_reduce({bits}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)")
    lower = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    parts = [f"""leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, coalesce('v' || lang, '') AS grp, {leaf('text')} AS h, {leaf(lower)} AS low,
         coalesce({crc} % 3 = 0, false) AS changed
  FROM documents)""", """placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS size
  FROM leaves)"""]
    parts += tree("node", "SELECT grp, pos, h, size FROM placed")
    parts += tree("top", f"SELECT 'all' AS grp, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos, h, count(*) OVER () AS size FROM node{_LEVELS}")
    parts += climb("inner", "node", "SELECT id, grp, pos, '' AS proof, CASE WHEN changed THEN low ELSE h END AS folded FROM placed")
    parts += climb("outer", "top", f"""SELECT i.id, 'all' AS grp, g.pos, i.proof, i.folded
  FROM inner{_LEVELS} i JOIN (SELECT grp, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos FROM node{_LEVELS}) g ON g.grp = i.grp""")
    return f"""WITH {', '.join(parts)}
SELECT p.doc_id, p.h AS leaf, n.h AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root, o.folded = t.h AS verified
FROM placed p JOIN outer{_LEVELS} o ON o.id = p.id JOIN node{_LEVELS} n ON n.grp = p.grp JOIN top{_LEVELS} t ON true
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": _TOP_K, "op2_embedding_near_dedup": _NEAR, "op3_chat_format": _CHAT, "op5_source_mix": _MIX,
        "op6_url_filter": _URLS, "op12_filter_audit": _AUDIT, "op13_merkle_manifest": _merkle_sql(),
    }
