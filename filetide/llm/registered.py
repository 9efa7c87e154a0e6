"""One query for each operator of this folder, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    """Where the installed package has the tokenizer; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.packing import pack_documents

    return pack_documents(documents(spark, sf_dir), tokenizer_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.private import FORMATS, pseudonymise

    done = pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), "a key that stays with its owner")
    of_kind = lambda kind: F.size(F.filter("private", lambda x: x == kind)).cast("bigint").alias(f"n_{kind}")
    return done.select("doc_id", "text", *[of_kind(kind) for kind in FORMATS])


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.near import near_duplicates

    return near_duplicates(documents(spark, sf_dir), size=2)


def op4_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.repeats import remove_repeats

    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.secret_scan import KINDS, scan, written

    found = scan(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "secrets")
    of_kind = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == KINDS.index(kind))).cast("bigint")
    return found.select(
        "doc_id", of_kind("assign").alias("n_assign"), of_kind("access").alias("n_access"), of_kind("hex").alias("n_hex"),
        F.sha2(written(F.filter("secrets", lambda x: x["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"))


LANGUAGE_WEIGHTS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def mixing_levels() -> dict:
    """Four domains, by a hash of the source, then language, then source."""
    return {"domain": F.concat(F.lit("domain"), F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 4),
            "lang": F.col("lang"), "source": F.col("source")}


def mixing_weight(path: tuple) -> float:
    """Equal domains, stated languages (others as the least of them), equal sources."""
    return LANGUAGE_WEIGHTS.get(path[1], 0.2) if len(path) == 2 else 1.0


def op6_hierarchical_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.mixing import mix

    mixed = mix(documents(spark, sf_dir), mixing_levels(), mixing_weight, share=0.7, epochs=2)
    return mixed.select("doc_id", F.col("__epoch").alias("epoch"), F.col("__tokens").alias("tokens"),
                        F.col("__leaf").alias("leaf"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.fingerprint import with_successor

    return with_successor(documents(spark, sf_dir))


def op8_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.neighbours import nearest

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id"), F.col("embedding").alias("vector"))
    return nearest(vectors.filter(F.col("vec_id") % 20 == 0), vectors, 20)


def op9_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.language import held_out, learn, predict

    docs = documents(spark, sf_dir)
    model = learn(docs.filter(~held_out("doc_id")))
    return predict(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op10_line_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.lines import without_repeats

    return without_repeats(documents(spark, sf_dir).select("doc_id", "text"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.divergence import divergence

    return divergence(documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.spelling import variants

    return variants(documents(spark, sf_dir))


def op13_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from filetide.llm.archives import read_archives, write_archives

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archives(write_archives(pages)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+')"


TERMS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         "'[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")


def oracle_sql() -> dict[str, str]:
    """For what SQL can say: exact links by a join on shingles, exact neighbours by all products, exact
    shares of words, and the records that a page should give."""
    return {
        "op11_source_divergence": f"""WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
              coalesce(source, '') AS source FROM documents
          ), each AS (SELECT r, lang, source, unnest({TERMS}) AS term FROM d
          ), kept AS (SELECT lang, term FROM each GROUP BY ALL HAVING count(DISTINCT r) >= 10
          ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM each JOIN kept USING (lang, term) GROUP BY ALL
          ), groups AS (SELECT DISTINCT lang, source FROM d
          ), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1
          ), of_group AS (
            SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total, v
            FROM groups JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)
          ), shared AS (
            SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS HUGEINT) AS p
            FROM of_group
          ), of_lang AS (SELECT lang, term, sum(n) AS n FROM of_group GROUP BY ALL
          ), lang_total AS (SELECT lang, sum(n) AS total FROM of_lang GROUP BY 1
          ), whole AS (
            SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS HUGEINT) AS q
            FROM of_lang JOIN lang_total USING (lang) JOIN sizes USING (lang)
          ), rows AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(
              ((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS BIGINT) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN shared x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN shared y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL
            UNION ALL
            SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)
            FROM shared JOIN whole USING (lang, term) WHERE n > 0 AND p > q
          ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM rows)
          SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
        "op13_zip_archives": """WITH p AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
              sha1(coalesce(html, '')) AS payload_digest FROM pages
          ), last AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS l FROM p)
          SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND l <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND l <> page_id THEN l END AS refers_to FROM last""",
        "op3_hyperminhash": f"""WITH RECURSIVE worded AS (
            SELECT doc_id, {WORDS} AS w FROM documents
          ), shingled AS (
            SELECT doc_id, CASE WHEN len(w) = 1 THEN [w[1]] WHEN len(w) > 1 THEN list_distinct(list_transform(
              generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) ELSE [] END AS s FROM worded
          ), sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM shingled
          ), each AS (SELECT doc_id, unnest(s) AS shingle FROM shingled
          ), both_in AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM each a JOIN each b USING (shingle)
            WHERE a.doc_id <> b.doc_id GROUP BY ALL
          ), links AS (
            SELECT a, b FROM both_in JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
            WHERE 100 * c >= 80 * (x.n + y.n - c)
          ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
          ), heads AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1)
          SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN heads USING (doc_id)""",
        "op8_one_bit_neighbours": """WITH v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
          ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
          ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
              vec_id, score FROM scored)
          SELECT * FROM ranked WHERE rank <= 20""",
    }
