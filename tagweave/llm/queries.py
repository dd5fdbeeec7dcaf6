"""The corpus operators over their whole tables, and the same as SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tagweave.llm import codes, exact, fingerprint, html_text, lexical, mixing, neardup, packing, repeats, simhash, toxicity, urls, warc
from tagweave.llm.common import table
from tagweave.storage import scratch_path


def op1_mixing(spark, sf_dir):
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_exact_dedup(spark, sf_dir):
    return exact.duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.held_out(F.col("doc_id"))
    weights = toxicity.learn(docs.filter(~held_out), labels)
    scored = toxicity.score(docs, weights).withColumnRenamed("id", "doc_id")
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted, "offending")


def op4_suffix_dedup(spark, sf_dir):
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    spans = F.size("spans").cast("long").alias("n_spans")
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


def op5_fingerprint(spark, sf_dir):
    return fingerprint.fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op7_minhash(spark, sf_dir):
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, threshold=80)
    kept = (F.col("id") == F.col("component_id")).alias("kept")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept)


def op8_html_text(spark, sf_dir):
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    columns = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    record = F.sha2("record", 256).alias("record_sha256")
    return warc.read_archive(spark, path).select(F.col("id").alias("page_id"), *columns, record)


def op10_url_filters(spark, sf_dir):
    rules = urls.rule_table(spark, urls.RULES)
    return urls.judge(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op11_vector_codes(spark, sf_dir):
    return codes.coded(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_lexical_search(spark, sf_dir):
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


ALL = (
    op1_mixing, op2_exact_dedup, op3_toxicity, op4_suffix_dedup, op5_fingerprint, op6_packing, op7_minhash, op8_html_text, op9_warc, op10_url_filters,
    op11_vector_codes, op12_lexical_search, op13_simhash,
)
QUERIES = {f.__name__: f for f in ALL}

ORACLES = {
    "op1_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS dealt
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
        w AS (SELECT *, no % 3 + 1 AS weight, sum(source_size) OVER () AS total FROM s),
        c AS (
            SELECT *, coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS full_before,
                   (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS weights_left
            FROM w WINDOW before AS (ORDER BY source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        u AS (SELECT max((total - full_before)::DOUBLE / weights_left) AS unit FROM c),
        t AS (
            SELECT source, no, source_size, total,
                   CASE WHEN 3 * source_size < unit * weight THEN (3 * source_size)::DOUBLE ELSE unit * weight END AS target
            FROM w, u),
        bw AS (SELECT greatest(1, least(64, floor(min(target) / 8)))::BIGINT AS block FROM t WHERE target > 0),
        q AS (
            SELECT no, target / (2 * k + 1) AS quotient, total, block,
                   row_number() OVER (ORDER BY target / (2 * k + 1) DESC, no, k) AS place
            FROM (t CROSS JOIN bw) AS tb, LATERAL (SELECT unnest(range(0, round(tb.total / tb.block)::BIGINT + 1)) AS k) WHERE target > 0),
        seats AS (SELECT no, count(*) AS seats FROM q WHERE place <= round(total / block) GROUP BY no),
        n AS (
            SELECT d.*, t.no, t.source_size, t.target, coalesce(seats, 0) AS seats,
                   ('0x' || substr(dealt, 1, 8))::BIGINT % greatest(1, ceil(t.source_size / 1048576))::BIGINT AS shard
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN seats USING (no)),
        units AS (
            SELECT no, shard, any_value(seats) AS seats, sum(size)::BIGINT AS words FROM n WHERE size > 0 GROUP BY no, shard),
        uq AS (
            SELECT no, shard, seats, row_number() OVER (PARTITION BY no ORDER BY words / (2 * k + 1) DESC, shard, k) AS place
            FROM units, LATERAL (SELECT unnest(range(0, seats)) AS k)),
        quotas AS (SELECT no, shard, count(*) AS quota FROM uq WHERE place <= seats GROUP BY no, shard),
        b AS (
            SELECT no, shard, words, least(coalesce(quota, 0) * block, 3 * words) AS given
            FROM units LEFT JOIN quotas USING (no, shard) CROSS JOIN bw),
        streamed AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY no, shard ORDER BY dealt, doc_id, size
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM n)
        SELECT doc_id, size, source_size, target,
               CASE WHEN size = 0 THEN 0
                    ELSE given // words * size + greatest(0, least(size, given % words - start)) END::BIGINT AS taken
        FROM streamed LEFT JOIN b USING (no, shard)
    """,
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT doc_id, unnest(CASE WHEN len(words) < 2 THEN words
                ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END) AS shingle
            FROM w),
        n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * shared >= 80 * (x.n_shingles + y.n_shingles - shared)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS node, doc_id AS root FROM w
            UNION SELECT edges.b, reach.root FROM reach JOIN edges ON reach.node = edges.a)
        SELECT w.doc_id, coalesce(n_shingles, 0) AS n_shingles, min(root) AS component_id, w.doc_id = min(root) AS kept
        FROM w LEFT JOIN n USING (doc_id) JOIN reach ON node = w.doc_id GROUP BY w.doc_id, n_shingles
    """,
    "op9_warc": """
        WITH p AS (
            SELECT page_id, url, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages),
        r AS (SELECT *, payload_bytes >= 1000 AND page_id <> last AS again, sha1(body) AS payload_digest, chr(13) || chr(10) AS nl FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to,
               sha256('WARC/1.1' || nl || 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END || nl
                      || 'WARC-Record-ID: <urn:page:' || page_id || '>' || nl || 'WARC-Date: 1970-01-01T00:00:00Z' || nl
                      || 'WARC-Target-URI: ' || replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') || nl
                      || 'WARC-Payload-Digest: sha1:' || payload_digest || nl
                      || CASE WHEN again THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl
                              || 'WARC-Refers-To: <urn:page:' || last || '>' || nl ELSE '' END
                      || 'Content-Length: ' || payload_bytes || nl || nl
                      || CASE WHEN again THEN '' ELSE body END || nl || nl) AS record_sha256
        FROM r
    """,
    "op10_url_filters": r"""
        WITH rules(h, p, verdict) AS (VALUES
            ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        u AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        fit AS (
            SELECT u.*, h || p AS rule, verdict,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS n
            FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE n = 1
    """,
    "op11_vector_codes": """
        WITH k AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT vec_id, pos, v[pos * 4 + 1] AS x0, v[pos * 4 + 2] AS x1, v[pos * 4 + 3] AS x2, v[pos * 4 + 4] AS x3
            FROM k, (SELECT unnest(range(0, 16)) AS pos)),
        f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k),
        b0 AS (SELECT pos, entry, x0 AS c0, x1 AS c1, x2 AS c2, x3 AS c3 FROM p JOIN f USING (vec_id) WHERE entry < 64),
        a0 AS (
            SELECT vec_id, pos, x0, x1, x2, x3, min(((x0-c0)*(x0-c0) + (x1-c1)*(x1-c1) + (x2-c2)*(x2-c2) + (x3-c3)*(x3-c3)) * 64 + entry) % 64 AS entry
            FROM p JOIN b0 USING (pos) GROUP BY ALL),
        m1 AS (
            SELECT pos, entry, floor(sum(x0) / count(*))::BIGINT AS n0, floor(sum(x1) / count(*))::BIGINT AS n1,
                   floor(sum(x2) / count(*))::BIGINT AS n2, floor(sum(x3) / count(*))::BIGINT AS n3 FROM a0 GROUP BY pos, entry),
        b1 AS (
            SELECT pos, entry, coalesce(n0, c0) AS c0, coalesce(n1, c1) AS c1, coalesce(n2, c2) AS c2, coalesce(n3, c3) AS c3
            FROM b0 LEFT JOIN m1 USING (pos, entry)),
        a1 AS (
            SELECT vec_id, pos, x0, x1, x2, x3, min(((x0-c0)*(x0-c0) + (x1-c1)*(x1-c1) + (x2-c2)*(x2-c2) + (x3-c3)*(x3-c3)) * 64 + entry) % 64 AS entry
            FROM p JOIN b1 USING (pos) GROUP BY ALL),
        m2 AS (
            SELECT pos, entry, floor(sum(x0) / count(*))::BIGINT AS n0, floor(sum(x1) / count(*))::BIGINT AS n1,
                   floor(sum(x2) / count(*))::BIGINT AS n2, floor(sum(x3) / count(*))::BIGINT AS n3 FROM a1 GROUP BY pos, entry),
        b2 AS (
            SELECT pos, entry, coalesce(n0, c0) AS c0, coalesce(n1, c1) AS c1, coalesce(n2, c2) AS c2, coalesce(n3, c3) AS c3
            FROM b1 LEFT JOIN m2 USING (pos, entry)),
        a2 AS (
            SELECT vec_id, pos, min(((x0-c0)*(x0-c0) + (x1-c1)*(x1-c1) + (x2-c2)*(x2-c2) + (x3-c3)*(x3-c3)) * 64 + entry) AS least
            FROM p JOIN b2 USING (pos) GROUP BY ALL),
        r AS (
            SELECT vec_id, string_agg(printf('%02x', least % 64), '' ORDER BY pos) AS code, sum(least // 64)::BIGINT AS error
            FROM a2 GROUP BY vec_id),
        h AS (SELECT sha256(string_agg(concat_ws(',', c0, c1, c2, c3), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b2)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM r JOIN k USING (vec_id), h
    """,
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        n AS (SELECT doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
        c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tf, c GROUP BY term, docs),
        q AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL),
        s AS (
            SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (doc_id), c GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10
    """,
}
