"""Registered queries of this package: thin digests of the operators' outputs
over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import (audit, chat, decontam, exact, hardneg, html, langid, lines, maxscore, minhash, mixing, pii,
                            warc)
from basketlens.llm.common import read


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_components(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"), pii.train())
    base = F.filter("spans", lambda s: s["base"])

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):  # one parameter: a second would be the element's index
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("row.doc_id", *[count(k) for k in pii.KINDS], F.sha2(told(base), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("copies")


def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                   read(spark, sf_dir, "benchmark"))
    items = F.array_sort("items")
    return found.select("row.doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                        decontam.is_contaminated().alias("contaminated"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    # every record is of a declared layout: one that is not read as such is no empty conversation
    formatted = F.when(F.col("layout").isNotNull(), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("record without a layout: conv_id "), F.coalesce(F.col("row.conv_id").cast("string"), F.lit("null")))).cast("string"))
    done = chat.format_records(chat.as_records(turns), "record").select("row.conv_id", formatted.alias("formatted"), "loss")
    back = done.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("formatted"), F.col("loss")).alias("own"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("own").cast("long").alias("loss_chars"), F.sha2("own", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.fit(pages)).select("row.page_id", "row.url", "text",
                                                       F.length("text").cast("long").alias("n_chars"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "row.doc_id", langid.held_out("row.doc_id").alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part, order and step: documents ``kept`` after the step, ``removed``
    by it, ``redundant`` (failing its filter, removed earlier),
    ``unique_fails`` (failing its filter only), good and toxic ones among the
    removed, and what its filter removes over all orders (``shapley``)."""
    return audit.audit(*audit.mask_cells(read(spark, sf_dir, "documents").select("doc_id", "text", "source"),
                                         read(spark, sf_dir, "labels")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_topk_search": op4_topk_search,
    "op5_mixing": op5_mixing,
    "op6_arc_to_warc": op6_arc_to_warc,
    "op7_decontamination": op7_decontamination,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_html_extraction": op9_html_extraction,
    "op10_language_id": op10_language_id,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL of the queries that SQL can express at the size of the SQL check
ORACLE_SQL: dict[str, str] = {
    # shingle sets, pairs by shared shingles, and what is reachable over the links
    "op1_minhash_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        e AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b
              ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT a, b FROM e JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b
              WHERE 100 * common >= 75 * (x.n + y.n - common)),
        m AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT DISTINCT a AS doc_id, a AS seen FROM m UNION SELECT r.doc_id, m.b FROM r JOIN m ON m.a = r.seen),
        c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
               coalesce(component_id, doc_id) = doc_id AS kept
        FROM d LEFT JOIN z USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op4_topk_search": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    # base 32 by looking five bits at a time up in a list of cells of six characters
    "op6_arc_to_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS payload_bytes,
                          sha1(coalesce(html, '')) AS h FROM pages),
        c AS (SELECT string_agg(b, '' ORDER BY b) AS cells FROM (
                  SELECT CAST(CAST(CAST(i AS UTINYINT) AS BIT) AS VARCHAR)[-5:] || '|' AS b FROM range(32) r(i))),
        d AS (SELECT page_id, payload_bytes, h, CAST(CAST(unhex(h) AS BIT) AS VARCHAR) AS bits FROM p),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
        SELECT page_id, payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST((instr(cells, substr(bits, CAST(5 * i + 1 AS INT), 5) || '|') - 1) // 6 + 1 AS INT), 1)
                   FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
        FROM w, c""",
    # windows as texts, for documents of each length that an item's windows have
    "op7_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
        k AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
              FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
                    FROM b WHERE len(w) > 0)),
        x AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
              FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k))),
        h AS (SELECT DISTINCT doc_id, i, n, item FROM x JOIN k USING (n, win)),
        p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h)
              GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)""",
    # the template adds 12 characters and the role, a line break and 11 characters a turn, and a backslash
    # for each "<|" and each "<", backslashes, "|"
    "op8_chat_formatting": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
               CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT)
                   AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    # per part and set of failed filters the counts, per order and step the bits of the filters before
    "op12_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
        l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
              FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        m AS (SELECT w.doc_id, part,
                     CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
                     + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INT)
                     + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
                     + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS mask FROM w),
        c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
              FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
        f AS (SELECT substr('ABCDE', i + 1, 1) AS letter, CAST(1 << i AS INT) AS bit FROM range(5) r(i)),
        o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
              FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        s AS (SELECT filter_order, CAST(i AS INT) AS step, f.bit,
                     (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(filter_order, g.letter) < i) AS applied
              FROM o, range(1, 6) r(i), f WHERE f.letter = substr(filter_order, CAST(i AS INT), 1)),
        r AS (SELECT part, filter_order, step, bit,
                     sum(n) FILTER (mask & CAST(applied AS INT) = 0 AND mask & bit = 0) AS kept,
                     sum(n) FILTER (mask & CAST(applied AS INT) = 0 AND mask & bit != 0) AS removed,
                     sum(n) FILTER (mask & CAST(applied AS INT) != 0 AND mask & bit != 0) AS redundant,
                     sum(n) FILTER (mask = bit) AS unique_fails,
                     sum(good) FILTER (mask & CAST(applied AS INT) = 0 AND mask & bit != 0) AS good_lost,
                     sum(toxic) FILTER (mask & CAST(applied AS INT) = 0 AND mask & bit != 0) AS toxic_lost
              FROM c, s GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
        FROM r""",
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
               score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 10""",
}
