"""Queries of the document operators over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import (
    decontamination, divergence, exact_dedup, fill_middle, language, language_model, neighbour_forest, ngram_join, packing, secrets, sharding,
    suffix_dedup, toxicity,
)
from hourloom.llm.common import id_remainder, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


@_query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed")
    return rows.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@_query()
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"), n=4, percent=85)
    return rows.select("doc_id", "n_shingles", "component_id", "n_links")


@_query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


@_query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    learned = labels.where(id_remainder(F.col("doc_id"), 5) != 0)
    model = toxicity.fit_toxicity(*toxicity.training_sample(docs, learned))
    rows = toxicity.score_toxicity(docs, model)
    held_out = (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return rows.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query()
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 10) == 0
    model = language_model.train(docs.where(~held_out))
    rows = language_model.score(docs, model)
    return rows.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


@_query(f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


@_query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    learned = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = language.fit_language(*language.training_sample(learned))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@_query()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffle_into_shards(read_table(spark, sf_dir, "documents"), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@_query(f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
found AS (SELECT p.doc_id, p.s, p.n, windows.item_id
          FROM (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
                FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)) p
          JOIN windows ON windows.n = p.n AND windows.k = p.k),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query()
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) AS long)").alias(f"n_{kind}")
    return rows.withColumn("every", F.concat("base", "linked")).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.span_text("base"), 256).alias("base_sha256"), secrets.span_text("every").alias("spans"),
    )

@_query(f"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS c, count(DISTINCT i) AS n FROM (SELECT lang, source, i, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(c) AS c FROM counts GROUP BY ALL HAVING sum(n) >= 10),
languages AS (SELECT lang, count(*) AS v, sum(c) AS total FROM kept GROUP BY lang),
cells AS (SELECT g.lang, g.source, k.term, CAST(coalesce(counts.c, 0) AS HUGEINT) AS c, k.c AS lang_c, v, l.total AS lang_total
          FROM groups g JOIN kept k ON k.lang = g.lang JOIN languages l ON l.lang = g.lang
          LEFT JOIN counts ON counts.lang = g.lang AND counts.source = g.source AND counts.term = k.term),
shares AS (SELECT lang, source, term, c, 1 + 1000000000 * (c + 2) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS p,
                  1 + 1000000000 * (lang_c + 2) // (lang_total + 2 * v) AS q FROM cells),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
          UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"))


@_query()
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_forest.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@_query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90
                  THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
parts AS (SELECT *, substr(t, 1, least(x, y)) AS p, substr(t, least(x, y) + 1, abs(x - y)) AS m, substr(t, greatest(x, y) + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(x, y) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(x - y) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
         AS output_sha256, sha256(t) AS restored_sha256 FROM parts""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, restored = fill_middle.restore(fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )
