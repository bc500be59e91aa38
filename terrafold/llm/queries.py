"""The registered queries of these operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, cross_parse, cuckoo, decontaminate, html_template, mixing, novelty, piece_agenda, prefix_tree, run_index, run_links, toxicity, warc_zip

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_site_templates(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    return html_template.main_text(table(spark, sf, "pages"))


def op2_zip_archives(spark: SparkSession, sf: str) -> DataFrame:
    """All pages as records of ZIP-packaged archives, read back."""
    return warc_zip.archived_pages(table(spark, sf, "pages"))


def op3_run_index_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    found = run_index.without_repeats(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_prefix_tree_join(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return prefix_tree.jaccard_components(table(spark, sf, "documents"))


def op5_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """All documents mixed to the weights of their sources, better labelled ones first."""
    quality = table(spark, sf, "labels").select("doc_id", "quality")
    plan = mixing.mix(table(spark, sf, "documents"), quality)
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken")


def op6_cuckoo_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Exact duplicates among all documents."""
    return cuckoo.exact_groups(table(spark, sf, "documents"))


def op7_novelty_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every document."""
    return novelty.find_secrets(table(spark, sf, "documents"))


def op8_kernel_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    return toxicity.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_cross_parse_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document."""
    return cross_parse.identify(table(spark, sf, "documents"))


def op10_prefix_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document under windows of benchmark items."""
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("items", "text_key")


def op11_link_cut_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words in every document, some of which a faulty source repeats."""
    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return run_links.runs_of_words(table(spark, sf, "documents"), key).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_multikey_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The leading collocations of every language of the documents."""
    return collocations.collocations(table(spark, sf, "documents"))


def op13_piece_agenda(spark: SparkSession, sf: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    """Every document in pieces of a public vocabulary, and back."""
    import public_tokenizers

    found = piece_agenda.tokenize(table(spark, sf, "documents"), public_tokenizers.path(model))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_site_templates": op1_site_templates,
    "op2_zip_archives": op2_zip_archives,
    "op3_run_index_repeats": op3_run_index_repeats,
    "op4_prefix_tree_join": op4_prefix_tree_join,
    "op5_source_mix": op5_source_mix,
    "op6_cuckoo_dedup": op6_cuckoo_dedup,
    "op7_novelty_secrets": op7_novelty_secrets,
    "op8_kernel_toxicity": op8_kernel_toxicity,
    "op9_cross_parse_language": op9_cross_parse_language,
    "op10_prefix_decontamination": op10_prefix_decontamination,
    "op11_link_cut_runs": op11_link_cut_runs,
    "op12_multikey_collocations": op12_multikey_collocations,
    "op13_piece_agenda": op13_piece_agenda,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_zip_archives": """
        WITH records AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
        ),
        tops AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM records)
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (((('0x' || substr(h, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1) FOR i IN range(32)], '')
                   AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM tops""",
    "op5_source_mix": r"""
        WITH best AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
        rows AS (
            SELECT d.doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   -ln((('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12))::BIGINT + 0.5e0) / 281474976710656e0)
                     / CASE WHEN quality >= 1 THEN 2e0 WHEN quality < 1 THEN 0.5e0 ELSE 1e0 END AS draw
            FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
        ),
        sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
        ranked AS (
            SELECT *, [5e0, 2e0, 1e0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM sizes
        ),
        filled AS (SELECT *, source_size * 2e0 / w AS fill FROM ranked),
        levels AS (
            SELECT *, (1.5e0 * sum(source_size) OVER ()
                       - coalesce(sum(source_size) OVER (ORDER BY fill, source NULLS LAST
                                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2e0)
                      / sum(w) OVER (ORDER BY fill, source NULLS LAST
                                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM filled
        ),
        targets AS (
            SELECT source, source_size,
                   least(source_size * 2e0, w * (SELECT arg_min(level, fill) FROM levels WHERE level <= fill)) AS target
            FROM levels
        ),
        placed AS (
            SELECT r.doc_id, r.source, size, source_size, target,
                   coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY draw, r.doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
            FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, source, size, source_size, target,
               (epochs * size + least(size, greatest(0, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
        FROM placed""",
    "op6_cuckoo_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(lowered) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS lowered FROM documents)
        WINDOW same AS (PARTITION BY lowered)""",
    # Every period at which some 8 words come again, tried over its whole document.
    "op11_link_cut_runs": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS digits,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        keys AS (
            SELECT id, doc_id, words, len(words)::BIGINT AS n,
                   xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT FOR c IN string_split(digits, '') IF c <> '']), lambda h, c:
                       list_reduce(list_concat([xor(h, c)], [0::BIGINT FOR i IN range(8)]),
                                   lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) AS h
            FROM texts
        ),
        begun AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM keys),
        made AS (
            SELECT id, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                THEN [words[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1)::BIGINT] FOR i IN range(n)]
                ELSE words END AS words
            FROM begun
        ),
        placed AS (SELECT id, n, unnest(range(n)) AS i, unnest(words) AS w FROM made),
        grams AS (
            SELECT id, n, i, array_to_string(array_agg(w) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), ' ') AS g
            FROM placed
        ),
        periods AS (
            SELECT DISTINCT x.id, y.i - x.i AS q
            FROM (SELECT * FROM grams WHERE i + 8 <= n) x JOIN grams y ON x.id = y.id AND x.g = y.g AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
            WHERE y.i + 8 <= y.n
        ),
        alike AS (
            SELECT p.id, q, y.i, y.i - row_number() OVER (PARTITION BY p.id, q ORDER BY y.i) AS island
            FROM periods p JOIN placed x ON x.id = p.id JOIN placed y ON y.id = p.id AND y.i = x.i + q AND y.w = x.w
        ),
        repeated AS (SELECT id, q, min(i) - q AS s, count(*) + q AS m FROM alike GROUP BY id, q, island),
        runs AS (SELECT id, s, m, min(q) AS q FROM repeated WHERE m >= greatest(24, 3 * q) GROUP BY id, s, m),
        gone AS (SELECT DISTINCT id, unnest(range(s + q, s + m)) AS i FROM runs),
        kept AS (
            SELECT p.id, string_agg(w, ' ' ORDER BY p.i) AS collapsed
            FROM placed p LEFT JOIN gone g ON p.id = g.id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.id
        ),
        best AS (
            SELECT * FROM runs
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY m // q DESC, (m % q)::DOUBLE / q DESC, s, q) = 1
        ),
        listed AS (SELECT id, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY id)
        SELECT m.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.m::BIGINT AS length, b.q::BIGINT AS period,
               (1000 * b.m // b.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
               sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM made m LEFT JOIN listed USING (id) LEFT JOIN best b USING (id) LEFT JOIN kept USING (id)""",
    "op12_multikey_collocations": rf"""
        WITH texts AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, {_LOWER} AS text FROM documents),
        pieces AS (SELECT id, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) sizes(k))
        ),
        counts AS MATERIALIZED (
            SELECT lang, phrase, lang || chr(10) || phrase AS key, any_value(k) AS k, count(*)::HUGEINT AS n FROM grams GROUP BY lang, phrase
        ),
        totals AS (SELECT lang, sum(n)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
        cuts AS (
            SELECT lang, phrase, n AS a, cut, string_split(phrase, ' ') AS w
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM counts WHERE k > 1 AND n >= 10)
        ),
        scored AS (
            SELECT c.lang, c.phrase, a, cut, f.n AS l, r.n AS r, 1000000::HUGEINT * a * a // (f.n * r.n) AS score
            FROM cuts c JOIN counts f ON f.key = c.lang || chr(10) || array_to_string(w[1:cut], ' ')
                        JOIN counts r ON r.key = c.lang || chr(10) || array_to_string(w[cut + 1:], ' ')
        ),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inner_parts AS (
            SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, n
            FROM counts WHERE k = 3 AND n >= 10
        ),
        longest AS (SELECT lang, phrase, max(n) AS n FROM inner_parts GROUP BY lang, phrase),
        free AS (
            SELECT s.* FROM lowest s LEFT JOIN longest x ON x.lang = s.lang AND x.phrase = s.phrase
            WHERE x.n IS NULL OR 100 * x.n < 50 * s.a
        )
        SELECT f.lang, row_number() OVER (PARTITION BY f.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
               a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n, score::BIGINT AS score
        FROM free f JOIN totals t ON t.lang = f.lang
        QUALIFY rank <= 2000""",
}
