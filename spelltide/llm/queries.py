"""One query per operator over its whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spelltide.llm import covertree, decontam, fm, sampling, secrets, urls
from spelltide.llm.interleave import stratified_shards
from spelltide.llm.katz import katz_scores
from spelltide.llm.ngram_join import link_documents
from spelltide.llm.packing import pack
from spelltide.llm.scratch import stored
from spelltide.llm.trie import trie, turn_keys
from spelltide.llm.pivots import near_duplicates
from spelltide.llm.warc import roundtrip
from spelltide.session import ship_package


#: Rows that Spark hands to Python at once. Texts can be very long, and a batch must fit in a task several times.
BATCH_ROWS = 1_000


#: Least score of an accepted document.
QUALITY = 0.7


def prepared(spark: SparkSession) -> None:
    """What the operators need of a session: this package on the executors, and bounded batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a WARC archive: what the archive says of it."""
    records = roundtrip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and the component of documents that it is linked with."""
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def held_out(modulus: int):
    """Whether crc32 of the id as text leaves 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == 2, F.lit(False))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: fixed patterns and random strings."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(documents, secrets.fit(documents))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op4_pivot_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's number of near duplicates and the component that it belongs to."""
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability under a bigram model of those that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(7).alias("held"))
    return katz_scores(documents, "doc_id", "text", "held")


def op6_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learnt from labels that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fm.fit(documents, table(spark, sf_dir, "labels").where(~held_out(4)), "doc_id", "quality")
    scored = fm.score(documents, model)
    return scored.select("doc_id", held_out(4).alias("held_out"), "score", (F.col("score") >= QUALITY).cast("int").alias("predicted"))


def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document, and whether they decode to its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.encode(text, "UTF-8"), 256).alias("text_hash"))
    decoded = sampling.decode(sampling.encode(documents, "doc_id", columns=["doc_id", "text_hash"]))
    return decoded.select(
        "doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion",
        (F.sha2(F.encode("decoded", "UTF-8"), 256) == F.col("text_hash")).alias("round_trip"),
    )


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items: one row per document and item."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.with_leaks(documents, table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.score", "leak.question_overlap", "leak.answer_overlap")


def op9_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards that match the mixture of sources; their row counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    carry = {"size": F.octet_length(text).cast("long") + 8, "text_crc32": F.crc32(F.encode(text, "UTF-8"))}
    shards = stratified_shards(table(spark, sf_dir, "documents"), "source", "doc_id", 24, carry=carry)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


RULES = [
    urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/"),
]


def op10_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, or by models of the urls that rules allow and block."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = urls.fit(urls.rule_labels(pages, RULES), "url", "accepted")
    return urls.judge(pages, model, RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def rebuilt(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations where conversation c starts with the first crc32(c) % 9 turns of c - c % 5.

    Its own turns follow after as many of them; the largest number of turns taken over is 8, so heads are small.
    """
    counts = keys.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.withColumns({"h": F.crc32(F.col("conv").cast("string")) % 9, "base": F.col("conv") - F.col("conv") % 5}), "rebuilt-counts")
    sizes = counts.select(F.col("conv").alias("base"), F.col("n").alias("of_base"))
    plan = counts.join(sizes.hint("merge"), "base", "left").withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0).cast("long"))))
    plan = stored(plan.select("conv", "base", "h", "taken"), "rebuilt-plan")
    first = keys.where("conv % 5 = 0 and pos <= 8").withColumnRenamed("conv", "base")
    heads = plan.where("taken > 0").join(first.hint("merge"), "base").where("pos <= taken").select("conv", *keys.columns[1:])
    own = keys.join(plan.hint("merge"), "conv").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    return stored(heads.unionAll(own.select(*keys.columns)), "rebuilt-turns"), plan.select("conv")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt with the start of another: one row per node."""
    keys = stored(turn_keys(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"), "rebuilt-keys")
    return trie(*rebuilt(keys)).drop("n_ends")


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every anchor and each of its positives, the best rows of other labels in a window below the positive."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # Null where a component is null, not finite or too large for the operator.
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * 256) < covertree.LARGEST - 1, F.lit(False)))
    vector = F.when(finite, F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)))
    rows = rows.select("vec_id", label.alias("label"), vector.alias("vector"))
    return covertree.hard_negatives(rows, "vec_id", "vector", "label", F.col("vec_id") % 100 == 0)


#: Name of the packed sequences' tokenizer, and the id that ends a document.
PACKING, END = "word_bpe_49k.json", 1


def op13_concat_cut(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's tokens in sequences of 2 048: one row per piece."""
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer or public_tokenizers.path(PACKING), end=END)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")


QUERIES = {
    "op1_warc_zstd": op1_warc_zstd,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_secret_scan": op3_secret_scan,
    "op4_pivot_vectors": op4_pivot_vectors,
    "op5_katz_scores": op5_katz_scores,
    "op6_quality_fm": op6_quality_fm,
    "op7_sampled_pieces": op7_sampled_pieces,
    "op8_benchmark_leaks": op8_benchmark_leaks,
    "op9_stratified_shards": op9_stratified_shards,
    "op10_url_ratio": op10_url_ratio,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_cover_tree": op12_cover_tree,
    "op13_concat_cut": op13_concat_cut,
}

SQL = {
    "op1_warc_zstd": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages
        ), f AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
        SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op2_ngram_jaccard": """
        WITH RECURSIVE w AS (
            SELECT DISTINCT doc_id, text, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
            FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
        ), reach AS (
            SELECT doc_id AS node, doc_id AS other FROM documents
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
        )
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
        JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id
    """,
    "op4_pivot_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ), reach AS (
            SELECT vec_id AS node, vec_id AS other FROM embeddings
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
        )
        SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, r.component_id, e.vec_id = r.component_id AS kept
        FROM embeddings e
        JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = e.vec_id
        LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
    """,
    "op9_stratified_shards": """
        WITH crc AS MATERIALIZED (
            SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
                lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS step
        ), b AS MATERIALIZED (
            SELECT doc_id, coalesce('s' || source, 'null') AS s, md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h,
                list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
            FROM documents
        ), d AS MATERIALIZED (
            SELECT doc_id, s, h, len(bytes) + 8 AS size,
                xor(list_reduce(bytes, lambda a, x: xor(a >> 8, step[1 + (xor(a, x) & 255)]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
            FROM b, crc
        ), r AS (
            SELECT *, (2 * row_number() OVER (PARTITION BY s ORDER BY h, doc_id, size, text_crc32) - 1)::DOUBLE
                / (2 * count(*) OVER (PARTITION BY s))::DOUBLE AS part
            FROM d
        ), g AS (
            SELECT *, row_number() OVER (ORDER BY part, s, h, doc_id, size, text_crc32) - 1 AS place, count(*) OVER () AS n FROM r
        )
        SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * 24 // n)::INT AS shard,
            place - ((place * 24 // n) * n + 23) // 24 AS slot, NULL::INT AS grown_shard
        FROM g
    """,
    "op11_prefix_trie": """
        WITH crc AS MATERIALIZED (
            SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
                lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS step
        ), t AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), h AS (
            SELECT conv_id, turns, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT),
                lambda a, x: xor(a >> 8, step[1 + (xor(a, x) & 255)]), 4294967295::BIGINT), 4294967295)::BIGINT % 9 AS h
            FROM t, crc
        ), c AS MATERIALIZED (
            SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
            FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 5
        ), p AS MATERIALIZED (
            SELECT conv_id, d AS depth, turns[1:d] AS way, len(turns) = d AS last, octet_length(encode(coalesce(turns[d].text, ''))) AS size
            FROM c, unnest(range(0, len(turns) + 1)) AS r(d)
        ), n AS MATERIALIZED (
            SELECT depth, way, min(conv_id) AS rep, count(*) AS n_convs, max(size) AS size,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
            FROM p GROUP BY depth, way
        ), q AS MATERIALIZED (SELECT p.conv_id, n.* FROM p JOIN n USING (depth, way)),
        k AS (
            SELECT up.rep, up.depth, count(*) AS n_children
            FROM n JOIN q up ON up.conv_id = n.rep AND up.depth = n.depth - 1 GROUP BY ALL
        ), s AS (
            SELECT up.rep, up.depth, sum((k.n_children IS NULL)::INT)::BIGINT AS n_leaves, sum((n.n_convs - 1) * n.size)::BIGINT AS saved_tokens
            FROM n LEFT JOIN k ON k.rep = n.rep AND k.depth = n.depth JOIN q up ON up.conv_id = n.rep AND up.depth <= n.depth GROUP BY ALL
        )
        SELECT n.rep AS conv_id, n.depth, q.rep AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM n LEFT JOIN k ON k.rep = n.rep AND k.depth = n.depth
        JOIN s ON s.rep = n.rep AND s.depth = n.depth
        LEFT JOIN q ON q.conv_id = n.rep AND q.depth = n.depth - 1
    """,
    "op12_cover_tree": """
        WITH v AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, list_inner_product(a.e, b.e)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
        QUALIFY row_number() OVER best <= 5
    """,
}
