"""The operators on the test tables with production parameters, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import (ann, bpe, chat, clustering, hard_negatives, html_text, jaccard_join, mixing, quality,
                          sentencepiece_bpe, sharding, suffix_dedup, token_counts)
from millrace.llm.common import table


def tokenizer(name: str) -> str:
    """A vocabulary file, in a folder that every machine has; see its README for the formats."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


SHARDS = [f"shard-{i:02d}" for i in range(64)]
SLOTS = 6421

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn
    return register


_STOP = ", ".join(f"'{s}'" for w in quality.STOP_WORDS for s in (w, w.capitalize()))


@query(f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
twice AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (
  SELECT doc_id, sum(least(5, i - before)) AS n_repeat_words
  FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -5) AS before FROM twice)
  GROUP BY doc_id),
counts AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         length(regexp_replace(body, '[^!]+', '', 'g')) AS n_shouts,
         len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop
  FROM t LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 2 * word_chars < 3 * n_words OR word_chars > 25 * n_words
            OR 10 * n_symbols > n_words OR 2 * n_shouts > n_words
            OR (n_words >= 100 AND 100 * n_stop < n_words)
            OR 2 * n_dup_lines > n_lines) AS kept
FROM judged""")
def op1_quality_rules(spark, folder):
    report = quality.with_quality(table(spark, folder, "documents").select("doc_id", "text"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return report.select("doc_id", *[F.col(f"quality_report.{f}").alias(f) for f in fields])


@query("""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS total,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source),
-- with the k sources that are full first taken out, the others share rest / weights; the right k gives the most
levels AS (
  SELECT (sum(total) OVER () - coalesce(sum(3 * total) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM s WINDOW before AS (ORDER BY total / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, total, 3 * total < weight * level AS full_,
         CASE WHEN 3 * total < weight * level THEN 3 * total ELSE weight * level END AS target,
         ('0x' || substr(md5(concat_ws(':', '20', source)), 1, 3))::INT / 4096.0::DOUBLE AS start
  FROM s, (SELECT max(level) AS level FROM levels)),
r AS (
  SELECT d.*, t.total, t.target, t.start,
         CASE WHEN t.total = 0 THEN 0 WHEN full_ THEN 3 ELSE t.target / t.total END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, total::BIGINT AS source_size, round(target, 6) AS target,
       (size * (floor(rate * k + start) - floor(rate * (k - 1) + start)))::BIGINT AS taken
FROM r""")
def op3_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mix = lambda name: F.col(f"mix.{name}")
    return mixing.with_copies(docs).select(
        "doc_id", mix("size").alias("size"), mix("source_size").alias("source_size"),
        F.round(mix("target"), 6).alias("target"), (mix("size") * mix("copies")).alias("taken"))


def conversation_log(conversations: DataFrame) -> DataFrame:
    """Each row opens a message and streams its text; rows of one turn are messages of their own.

    The text comes in three pieces. Behind the first a wrong one is streamed, and an edit puts
    it right. An answer is begun with other words and regenerated.
    """
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", "turn", "role", "text", nth.alias("nth"))
    text, third = F.col("text"), F.floor(F.length("text") / 3).cast("int")
    first, second, rest = F.substring(text, F.lit(1), third), F.substring(text, third + 1, third), F.substring(
        text, third * 2 + 1, F.length(text))
    answers = F.col("role") == "assistant"
    steps = [("start", None), ("delta", F.when(answers, F.lit("Well, [INST] "))), ("regenerate", None), ("delta", first),
             ("delta", F.lit(" no, </s>")), ("edit", first), ("delta", second), ("delta", rest)]
    events = F.array(*[F.struct(
        F.when(answers if kind == "regenerate" else F.lit(True), F.lit(kind)).alias("kind"), F.lit(j).alias("step"),
        (F.col("role") if kind == "start" else F.lit(None)).cast("string").alias("role"),
        (F.lit(None) if piece is None else piece).cast("string").alias("text")) for j, (kind, piece) in enumerate(steps)])
    return rows.withColumn("event", F.explode(events)).filter("event.kind IS NOT NULL").select(
        "conv_id", F.struct("turn", "nth", F.col("event.step").alias("step")).alias("seq"), "event.kind",
        F.struct("turn", "nth").alias("message"), "event.role", "event.text")


@query("""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(8 + length(role) + length(text)
           + length(regexp_replace(role || text, '[^<\\[\\\\\\n]', '', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id""")
def op10_chat_formatting(spark, folder):
    fixed = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  role.alias("role"), F.lit(fixed).alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.render(chat.replay(conversation_log(rows)))
    loss = F.array_join("loss", "")
    return chat.read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars")


@query()
def op4_token_counts(spark, folder):
    """The file is a BPE model; its pieces and scores are read as a unigram vocabulary."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_token_count(docs, tokenizer("piece_bpe_32k.model")).select("doc_id", "n_tokens")


@query(f"""
WITH RECURSIVE shards AS (
  SELECT i, printf('shard-%02d', i) AS name FROM range({len(SHARDS)}) t(i)),
preference AS (
  SELECT list(('0x' || substr(md5(name || '#offset'), 1, 13))::BIGINT % {SLOTS} ORDER BY i) AS start,
         list(('0x' || substr(md5(name || '#skip'), 1, 13))::BIGINT % {SLOTS - 1} + 1 ORDER BY i) AS step
  FROM shards),
-- one row per claim: the slots taken so far, and how far each shard is in its preferences
claims AS (
  SELECT 0 AS n, -1::BIGINT AS slot, list_transform(range({SLOTS}), lambda x: false) AS taken,
         list_transform(range({len(SHARDS)}), lambda x: 0::BIGINT) AS tried
  UNION ALL
  SELECT n + 1, found, taken[:found] || [true] || taken[found + 2:],
         tried[:n % {len(SHARDS)}] || [nth + 1] || tried[n % {len(SHARDS)} + 2:]
  FROM (
    SELECT *, (start[n % {len(SHARDS)} + 1] + nth * step[n % {len(SHARDS)} + 1]) % {SLOTS} AS found
    FROM (
      SELECT claims.*, start, step,
             list_filter(range(tried[n % {len(SHARDS)} + 1], {SLOTS}), lambda j: NOT taken[
               (start[n % {len(SHARDS)} + 1] + j * step[n % {len(SHARDS)} + 1]) % {SLOTS} + 1])[1] AS nth
      FROM claims, preference WHERE n < {SLOTS}))),
lookup AS (SELECT slot, printf('shard-%02d', (n - 1) % {len(SHARDS)}) AS shard FROM claims WHERE n > 0)
SELECT doc_id, shard FROM documents
JOIN lookup ON slot = ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT % {SLOTS}""")
def op8_sharding(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return sharding.with_shard(docs, "doc_id", SHARDS, SLOTS)


def bpe_digests(docs: DataFrame, between=lambda ids: ids) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    return bpe.decode(between(bpe.encode(docs, path).drop("text")), path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op5_bpe(spark, folder):
    return bpe_digests(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op9_jaccard_join(spark, folder):
    return jaccard_join.with_components(table(spark, folder, "documents"))


@query()
def op2_suffix_array_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.without_repeats(docs).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.coalesce(F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]), F.lit(0)).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_nearest_neighbours(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.neighbours(vectors, vectors.filter("vec_id % 20 = 0"))


@query()
def op6_html_extraction(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op11_sentencepiece(spark, folder):
    """``as_library`` says whether the sentencepiece library gave the same ids."""
    path = tokenizer("piece_bpe_32k.model")
    encoded = sentencepiece_bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), path, check="as_library")
    return sentencepiece_bpe.decode(encoded.drop("text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "as_library")


def _clusters_sql(k: int, rounds: int) -> str:
    """One assignment and one move of the centroids as steps for each round."""
    steps = [f"""
kept AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS m FROM kept
  QUALIFY c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT kept.*, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, c{n})
  GROUP BY rid)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
  SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY j) AS m
  FROM (SELECT c, j, sum(x)::BIGINT AS total, count(*) AS n
        FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range(64)) AS j FROM a{n}) GROUP BY c, j)
  GROUP BY c),
c{n + 1} AS (SELECT c{n}.c, coalesce(m{n}.m, c{n}.m) AS m FROM c{n} LEFT JOIN m{n} USING (c))""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
       sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.c = c{rounds}.c"""


@query(_clusters_sql(16, 3))
def op12_centroid_clustering(spark, folder):
    return clustering.clusters(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5""")
def op13_hard_negatives(spark, folder):
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", turned.alias("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
