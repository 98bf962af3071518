"""The operators as queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joinwright.sources import new_folder

from . import chat, middle, toxicity, urls
from .bpe import token_counts
from .centroids import cluster_vectors
from .common import importable
from .covertree import near_vectors
from .idfiles import crc32, read_ids, write_ids
from .language import identify, learn
from .mixing import mix, oracle
from .packing import pack
from .simhash import hex_fingerprints, near_duplicates
from .topk import top_k
from .toxicity import severity
from .urls import Rule, judge, with_rules


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 best of all rows for every row whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity of every document, learned from the labelled ones."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return severity(docs, toxicity.learn(docs, labels))


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.98 or more."""
    return near_vectors(table(spark, folder, "embeddings"), threshold=0.98)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by byte-pair merging."""
    docs = table(spark, folder, "documents")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, written as Huffman-coded blocks and read back."""
    out = new_folder(spark)
    file = public_tokenizers.path("word_bpe_49k.json")
    write_ids(table(spark, folder, "documents"), out, file, words=True, end_id=2)
    return crc32(read_ids(spark, out))


def held_out() -> Column:
    """True for a quarter of the documents, which no language is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    model = learn(docs.filter(~held_out()))
    found = identify(docs, model).withColumn("held_out", held_out())
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the copies that its cell is to have, and how often it is drawn."""
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "tokens",
        F.round(F.col("copies") * 1e6).cast("long").alias("copies_ppm"),
        "times",
    )


#: Rules by host and path; the longest that fits stands.
RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL, by the rules or by trees learned from what they decide."""
    ruled = with_rules(table(spark, folder, "pages"), RULES)
    return judge(ruled, urls.learn(ruled)).select("page_id", "host", "path", "rule", "verdict")


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents by fingerprints of 3-word shingles."""
    return hex_fingerprints(near_duplicates(table(spark, folder, "documents"), size=3))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    docs = table(spark, folder, "documents")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


#: Fixed value: the contract's conversation whose texts are the template's own marks.
MARKS_AS_TEXT = (-7, "</s>[INST] ok [/INST]")


def op11_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, rebuilt from its event log, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = MARKS_AS_TEXT
    added = [(conv_id, n, role, text) for n, role in enumerate(("user", "assistant"))]
    turns = rows.union(spark.createDataFrame(added, rows.schema))
    return chat.read_back(chat.render(chat.fold(chat.log_of(turns))))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its middle moved, and the text that is restored from that."""
    moved = middle.fill_in_middle(table(spark, folder, "documents"))
    moved = moved.withColumn("output_sha256", F.sha2(F.col("output").cast("binary"), 256))
    return middle.restored(moved).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
        F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"),
    )


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters."""
    return cluster_vectors(table(spark, folder, "embeddings"), k=40, rounds=5, width=64, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_top_k, op2_toxicity, op3_embedding_near_dedup, op4_token_counts, op5_token_files,
        op6_language_id, op7_mixing, op8_url_filter, op9_simhash_near_dedup, op10_best_fit_packing,
        op11_chat_formatting, op12_fill_in_middle, op13_centroid_clustering,
    )
}

FINITE = (
    "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
)


def clusters_sql(k: int, rounds: int) -> str:
    """Assignment and floor of the mean, written out round by round."""
    parts = [
        f"""
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND {FINITE}
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS cluster, x
  FROM v QUALIFY cluster < {k}
)"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS (
  SELECT place, min(distance) AS distance, arg_min(cluster, ROW(distance, cluster)) AS cluster FROM (
    SELECT v.place, c.cluster,
      CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM v CROSS JOIN c{n} c
  ) GROUP BY place
)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY i) AS x FROM (
      SELECT cluster, i, sum(v.x[i]) AS s, count(*) AS k
      FROM a{n} JOIN v USING (place) CROSS JOIN (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i
    ) GROUP BY cluster
  ) m USING (cluster)
)""")
    return (
        ",\n".join(parts)
        + f"""
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (place) JOIN c{rounds} c ON c.cluster = a.cluster"""
    )


SQL: dict[str, str] = {
    "op1_exact_top_k": f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS place,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS weights
  FROM embeddings WHERE {FINITE}
), scored AS (
  SELECT q.vec_id AS query_id, q.place, c.vec_id,
         CAST(list_inner_product(q.weights, c.weights) AS BIGINT) AS score
  FROM v q JOIN v c ON q.place <> c.place AND q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_mixing": oracle(),
    "op11_chat_formatting": rf"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT {MARKS_AS_TEXT[0]}, turn, role, '{MARKS_AS_TEXT[1]}'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), formatted AS (
  SELECT *,
    CASE role WHEN 'system' THEN '[SYS] ' WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN '<s> '
      ELSE '[ROLE] ' || coalesce(role, '') || ' [/ROLE] ' END
    || regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|END\])', '\1\2\\\3', 'g')
    || CASE role WHEN 'system' THEN ' [/SYS]' || chr(10) WHEN 'user' THEN ' [/INST]'
      WHEN 'assistant' THEN ' </s>' || chr(10) ELSE ' [END]' || chr(10) END AS formatted
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id""",
    "op12_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), formed AS (
  SELECT *, least(a, b) AS low, greatest(a, b) AS high,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT *, substring(text, 1, low) AS p, substring(text, low + 1, high - low) AS m, substring(text, high + 1) AS s
  FROM formed
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut""",
    "op13_centroid_clustering": clusters_sql(k=40, rounds=5),
}
