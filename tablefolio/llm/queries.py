"""The registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio.llm import (balltree, best_position, bpe, decontam, line_dedup, minhash, preference, quality, resample, secret_scan,
                            simhash, tokenfile, warc)
from tablefolio.llm.common import fresh_folder
from tablefolio.plans.catalogue import Catalogue, table

QUERIES = Catalogue()
WORD_BPE = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


@QUERIES.add()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents to compressed files and back."""
    folder = fresh_folder(spark, "token-files")
    tokenfile.write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_path(), END_ID)
    return tokenfile.read_ids(spark, folder)


@QUERIES.add()
def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the texts decoded from them."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


@QUERIES.add()
def op2_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of known form and strings of high entropy in all documents."""
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@QUERIES.add()
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@QUERIES.add(decontam.LEAKS_SQL)
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@QUERIES.add()
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines they share with earlier ones."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.when(F.col("deleted_lines").isNull(), 0).otherwise(F.size("deleted_lines")).alias("n_deleted"),
                      F.coalesce("shared_with", F.array().cast("array<long>")).alias("shared_with"), "text")


@QUERIES.add()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under a model of trusted text, and which of them are kept."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("h")


@QUERIES.add("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
""")
def op8_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return balltree.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@QUERIES.add(preference.PAIRS_SQL)
def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations that have a neighbour; spans as text."""
    pairs = preference.preference_pairs(*preference.swapped_endings(table(spark, sf_dir, "conversations")))

    def listed(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")

    return pairs.withColumns({f"{side}_trained": listed(f"{side}_trained") for side in preference.SIDES})


@QUERIES.add("""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) END AS latest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to FROM l
""")
def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to WARC files and back."""
    folder = fresh_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@QUERIES.add()
def op13_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups of those within two bits."""
    return simhash.near_fingerprints(table(spark, sf_dir, "documents"))


@QUERIES.add("""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
size AS (SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d WHERE len(words) > 0),
tf AS (SELECT doc_id, length, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS length, unnest(words) AS term FROM d)
       GROUP BY doc_id, length, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, size GROUP BY term, n),
q AS (SELECT item_id, term, count(*) AS times FROM (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * length * n) // l)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), size GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM r WHERE k <= 10
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@QUERIES.add("""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark WHERE text IS NOT NULL),
df AS (SELECT doc_id, feature, count(*) AS n FROM (
         SELECT doc_id, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM d)
       GROUP BY doc_id, feature),
bf AS (SELECT feature, count(*) AS n FROM (
         SELECT unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM b)
       GROUP BY feature),
steps AS (SELECT feature, list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(0, strlen(feature)),
            lambda i: [CAST(('0x' || substr(hex(encode(feature)), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS x
          FROM (SELECT feature FROM df UNION SELECT feature FROM bf)),
h AS (SELECT feature, xor(list_reduce(x, lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) ELSE xor(c >> 1, 3988292384 * (c & 1)) END),
                          4294967295) % 10000 AS bucket FROM steps),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM df JOIN h USING (feature) GROUP BY bucket),
t AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS t FROM bf JOIN h USING (feature) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) + 10000 AS s, (SELECT coalesce(sum(t), 0) FROM t) + 10000 AS t),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * total.s::DOUBLE / ((s.s + 1)::DOUBLE * total.t::DOUBLE))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket), total),
w AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain)::DOUBLE / sum(n)) AS BIGINT) AS weight
      FROM df JOIN h USING (feature) JOIN g USING (bucket) GROUP BY doc_id),
a AS (SELECT d.doc_id, len(words) >= 20 AS long, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                                / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM a WHERE long)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 25 * n // 100 THEN k END AS rank FROM a LEFT JOIN r USING (doc_id)
""")
def op12_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weights towards the benchmark's distribution, and the drawn quarter ranked."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
