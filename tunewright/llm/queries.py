"""Queries of the operators over their whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from pyspark.sql import functions as F

from tunewright.llm import (
    bpe_count, centroids, chat_events, embed_dedup, html_text, jaccard, language, mixing, neighbours, packing, quality, spelling, word_table,
)
from tunewright.llm.common import prepare, table

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: What both turns of conversation -1 say.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_quality(spark, folder):
    """Score of every document, learnt from labels that are not held out."""
    prepare(spark)
    documents = table(spark, folder, "documents")
    return quality.classify(documents, quality.train(documents, table(spark, folder, "labels")))


@query
def op9_language(spark, folder):
    """Language of every document, learnt from texts that are not held out."""
    prepare(spark)
    documents = table(spark, folder, "documents")
    return language.identify(documents, language.train(documents))


@query
def op6_jaccard(spark, folder):
    """Class of every document by links of 3-word sets with a Jaccard similarity of 0.9 or more."""
    prepare(spark)
    return jaccard.jaccard_classes(table(spark, folder, "documents"))


@query
def op8_mixing(spark, folder):
    """Size, target of the source and words taken of every document."""
    prepare(spark)
    return mixing.mixed_sizes(table(spark, folder, "documents"))


@query
def op10_packing(spark, folder):
    """Pieces of every document in packed windows."""
    prepare(spark)
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_chat(spark, folder):
    """Digests, read back from the formatted text, of every conversation and of one with control strings."""
    prepare(spark)
    control = spark.sql(
        f"SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{CONTROL}' AS text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    events = rows.select(
        F.col("conv_id").alias("conv"), F.monotonically_increasing_id().alias("msg"), F.col("turn").cast("long").alias("seq"),
        F.lit(chat_events.MESSAGE).alias("kind"), "role", "text",
    )
    return chat_events.digests(chat_events.read_back(chat_events.format_chats(events))).withColumnRenamed("conv", "conv_id")


SQL["op7_chat"] = f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               replace(replace(coalesce(text, ''), '\\', '\\\\'), '<|', '<\\|') AS body
        FROM (SELECT conv_id, turn, role, text FROM conversations
              UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}') t)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length('<|im_start|>') + length(role) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id"""


@query
def op5_tokens(spark, folder):
    """Bytes and tokens of every document."""
    prepare(spark)
    return bpe_count.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_vectors(spark, folder):
    """Links, class and survivor of every vector."""
    prepare(spark)
    return embed_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op4_neighbours(spark, folder):
    """The ten nearest vectors found of every hundredth one."""
    prepare(spark)
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op1_pages(spark, folder):
    """Main text of every page."""
    prepare(spark)
    return html_text.extract(table(spark, folder, "pages"))


@query
def op11_spelling(spark, folder):
    """Form and root of every word of all documents."""
    prepare(spark)
    return spelling.variants(table(spark, folder, "documents"))


SQL["op11_spelling"] = f"""
    WITH crc AS (
        SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                    ORDER BY i) AS tab
        FROM range(256) r(i)),
    runs AS (
        SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
        FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents) d
        GROUP BY ALL),
    spelt AS (SELECT run, n, hex(doc || ':' || run) AS x FROM runs),
    hashed AS (
        SELECT run, n, xor(list_reduce(
            [4294967295] || list_transform(range(0, length(x) // 2), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::BIGINT),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
        FROM spelt, crc),
    w AS MATERIALIZED (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
            FROM hashed) t
        WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cut AS MATERIALIZED (SELECT word, n, left(word, i::INT) AS a, substr(word, i::INT + 2) AS b
                         FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w) u),
    near AS (
        SELECT x.word, x.n, y.word AS other, y.n AS m FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT x.word, x.n, w.word, w.n FROM cut x JOIN w ON x.a || x.b = w.word
        UNION SELECT w.word, w.n, x.word, x.n FROM cut x JOIN w ON x.a || x.b = w.word),
    best AS (
        SELECT word, any_value(n) AS n, count(*) AS n_near, max(m) AS m, min(other) FILTER (WHERE m = top) AS other
        FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) t GROUP BY word),
    form AS MATERIALIZED (SELECT word, other AS form, m AS form_n FROM best WHERE m >= 10 * n),
    chain AS (
        WITH RECURSIVE c(word, root, steps) AS (
            SELECT word, form, 1 FROM form UNION ALL SELECT c.word, f.form, steps + 1 FROM c JOIN form f ON c.root = f.word)
        SELECT word, arg_max(root, steps) AS root FROM c GROUP BY word)
    SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0) AS n_near, form_n
    FROM w LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN chain USING (word)"""


@query
def op12_encoding(spark, folder):
    """Digests of every document's token ids and of the text that they decode to."""
    prepare(spark)
    return word_table.digests(word_table.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


@query
def op13_clusters(spark, folder):
    """Cluster, distance and centroid of every vector."""
    prepare(spark)
    return centroids.cluster(table(spark, folder, "embeddings"))


def _assign_sql(turn: int) -> str:
    """Assignment to the centroids of a turn, and the centroids of the next one."""
    return f"""
    a{turn} AS MATERIALIZED (
        SELECT vec_id, row, v, arg_min(num, (away, num)) AS cluster, min(away) AS away
        FROM (SELECT vec_id, row, v, num, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS away FROM kept, c{turn}) d
        GROUP BY vec_id, row, v),
    c{turn + 1} AS MATERIALIZED (
        SELECT c.num, coalesce(m.c, c.c) AS c FROM c{turn} c LEFT JOIN (
            SELECT cluster, list(x ORDER BY i) AS c FROM (
                SELECT cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS x
                FROM a{turn}, range(1, 65) r(i) GROUP BY cluster, i) t GROUP BY cluster) m ON m.cluster = c.num)"""


SQL["op13_clusters"] = f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (
        SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS num, v AS c
        FROM (SELECT sha256('2:' || vec_id::VARCHAR) AS h, v FROM kept ORDER BY h, v LIMIT 40) t),
    {','.join(_assign_sql(t) for t in range(6))},
    told AS (SELECT num, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM c5)
    SELECT vec_id, cluster, away AS distance, (sum(away) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
           (sum(away) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM a5 JOIN told ON cluster = num"""


def queries() -> dict:
    return {**QUERIES, "pipeline": corpus_pipeline.run}
