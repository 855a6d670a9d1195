"""Registered queries of the corpus operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .align import align_tokens, load_byte_level, score_links, vocabulary_size
from .bpe import encode, load_ranks
from .chat import examples, read_back
from .common import SPACE, table
from .exact import exact_dedup, text_sha256
from .lines import line_dedup, passage_dedup
from .graph import nearest
from .mixing import mix
from .periodic import periodic_runs
from .pq import near_embeddings
from .quality import fit_quality, score_quality, training_rows
from .simhash import simhash_dedup
from .toxicity import fit_toxicity, score_toxicity
from .wordpiece import pieces_of, token_counts

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op9_exact_dedup", """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS s FROM documents),
         g AS (SELECT s, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY s)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM d JOIN g USING (s)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text_sha256", text_sha256())
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op10_line_dedup", r"""
    WITH d AS (SELECT doc_id, text, md5(text) AS th, string_split(text, chr(10)) AS ls FROM documents),
         l AS (SELECT doc_id, th, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM d),
         h AS (SELECT *, CAST('0x' || substr(md5(x), 1, 15) AS BIGINT) % 2147483647 AS h, strlen(x) >= 200 AS lg FROM l),
         r AS (SELECT *, (h + coalesce(lag(h) OVER w, 0) * 1000003) % 2147483647 AS r FROM h
               WINDOW w AS (PARTITION BY doc_id, th ORDER BY i)),
         b AS (SELECT *, CASE WHEN i = 1 OR lg OR lag(lg) OVER w OR lag(r) OVER w % 3 = 0 THEN 1 ELSE 0 END AS b FROM r
               WINDOW w AS (PARTITION BY doc_id, th ORDER BY i)),
         k AS (SELECT *, sum(b) OVER (PARTITION BY doc_id, th ORDER BY i) AS k FROM b),
         c AS (SELECT doc_id, th, k, string_agg(x, chr(10) ORDER BY i) AS c, count(*) AS n FROM k GROUP BY ALL),
         e AS (SELECT *, strlen(c) >= 40 AND (n > 1 OR strlen(c) >= 200) AS e FROM c),
         f AS (SELECT *, e AND row_number() OVER (PARTITION BY e, c ORDER BY doc_id, k) > 1 AS gone FROM e),
         o AS (SELECT doc_id, th, coalesce(string_agg(c, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept_text,
                      count(*) AS n, count(*) FILTER (gone) AS n_removed FROM f GROUP BY ALL)
    SELECT d.doc_id, sha256(kept_text) AS text_sha256, CAST(strlen(kept_text) AS BIGINT) AS text_bytes,
           CASE WHEN text = '' THEN 0 ELSE n END AS n_chunks, n_removed
    FROM d LEFT JOIN o ON d.doc_id = o.doc_id AND d.th = o.th""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.sha2("text", 256).alias("text_sha256"),
                      F.octet_length("text").cast("bigint").alias("text_bytes"), "n_chunks", "n_removed")


@query("op10_passage_dedup")
def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.sha2("text", 256).alias("text_sha256"),
                      F.octet_length("text").cast("bigint").alias("text_bytes"), "n_lines", "n_removed")


_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


@query("op4_mix_sources", rf"""
    WITH RECURSIVE d AS (SELECT doc_id, source, {_SIZE} AS size,
                  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS u FROM documents),
         s AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS i FROM d GROUP BY source),
         w AS (SELECT source, n, 3 * n AS cap, [5.0, 2.0, 1.0][1 + i % 3]::DOUBLE AS w FROM s),
         t AS (SELECT 0 AS round, source, n, cap, w, false AS stuck FROM w
               UNION ALL
               SELECT round + 1, source, n, cap, w, stuck OR (left_over * w / rest > cap) FROM (
                   SELECT *, CAST(sum(n) OVER () - coalesce(sum(cap) FILTER (stuck) OVER (), 0) AS DOUBLE) AS left_over,
                          sum(w) FILTER (NOT stuck) OVER () AS rest FROM t) WHERE round < 30),
         f AS (SELECT source, n, CASE WHEN stuck THEN CAST(cap AS DOUBLE) ELSE
                      CAST(sum(n) OVER () - coalesce(sum(cap) FILTER (stuck) OVER (), 0) AS DOUBLE) * w / sum(w) FILTER (NOT stuck) OVER () END AS target
               FROM t WHERE round = 30),
         p AS (SELECT *, CASE WHEN n > 0 THEN least(floor(target / n), 3) ELSE 0 END AS base FROM f),
         r AS (SELECT d.*, n, target, base, target - base * n AS budget, sum(size) OVER (PARTITION BY d.source ORDER BY u) AS upto,
                      sum(size) OVER (PARTITION BY d.source, u) AS tied FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, target,
           CAST(size * (base + CASE WHEN budget > 0 AND upto - tied < budget AND (upto < budget OR upto - budget <= budget - (upto - tied))
                               THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM r""")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")) \
        .select("doc_id", "size", "source_size", "target", "taken")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "fingerprint", "component_id")


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep=["doc_id"],
                  outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    first, inner = pieces_of(load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    return token_counts(table(spark, sf_dir, "documents"), first, inner, keep=["doc_id"])


#: A conversation whose texts look like the template's marks.
MARKED = r"\### Assistant: </turn> ok"


@query("op6_chat_prefixes", rf"""
    WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '{MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{MARKED}'),
         l AS (SELECT *, 14 + length(role) + length(regexp_replace(role, '[^\\#:]', '', 'g'))
                         + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS n FROM c),
         p AS (SELECT *, sum(n) OVER w AS upto, lead(turn) OVER w IS NULL AND role <> 'assistant' AS rest FROM l
               WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR rest) AS BIGINT) AS formatted_chars,
           count(*) FILTER (role = 'assistant') AS n_examples
    FROM p GROUP BY conv_id""")
def op6_chat_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], turns.schema)
    return read_back(examples(turns.union(marked)))


#: A document counts as good from this score on.
QUALITY_THRESHOLD = 0.3


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", (~training_rows("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), where=training_rows("doc_id"))
    scored = score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (~training_rows("doc_id")).alias("held_out"), "severity", "p_toxic",
                         (F.col("p_toxic") >= model["decision"]).cast("int").alias("toxic"))


@query("op5_embedding_pq", """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
         l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
               WHERE list_dot_product(a.e, b.e) >= 0.9 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
         r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
    SELECT a AS vec_id, (SELECT count(*) FROM l WHERE l.a = r.a) AS n_links, min(b) AS component_id, a = min(b) AS kept FROM r GROUP BY a""")
def op5_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = f.read()
    aligned = align_tokens(table(spark, sf_dir, "documents"), load_byte_level(public_tokenizers.path("byte_bpe_50k.json")),
                           public_tokenizers.PATTERN, pieces, keep=["doc_id"])
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return score_links(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"), vocabulary_size(pieces))


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """One document in ten (by its id's CRC-32) with its words from some place on repeated in turn."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        turned = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), turned), " ")).otherwise("")
    # transform over an array of one holds the words, so the pattern runs once
    words = F.array(F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), F.lit(0)))
    return docs.select("doc_id", F.when(h % 10 == 0, F.get(F.transform(words, tail), F.lit(0))).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeated_tail(table(spark, sf_dir, "documents")), keep=["doc_id"])
    # runs come by start, then period, so only a greater exponent replaces one
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.reduce("runs", none, lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return told.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


#: Nearest neighbours asked for, and the share of rows that ask (one in ...).
NEIGHBOURS, ASKED = 10, 100


@query("op11_graph_ann", """
    WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
         d AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
               WHERE q.vec_id % 100 = 0),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS n FROM d)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""")
def op11_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % ASKED == 0), NEIGHBOURS)
