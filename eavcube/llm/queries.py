"""The queries of the operators over the driver tables, each next to the SQL that checks it where SQL can."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavcube.llm import collocations, decontaminate, divergence, jaccard, licenses, lines, maxscore, mixing, pii, quality, suffixes, templates, warc
from eavcube.llm.common import table
from eavcube.session import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# Parts of the checking SQL.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _shingles(k: int) -> str:
    """SQL for the list of distinct k-word shingles over a column `w` of words."""
    return (f"CASE WHEN len(w) >= {k} THEN list_distinct(list_transform(range(1, len(w) - {k - 2}), "
            f"lambda i: array_to_string(w[i:i + {k - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] "
            "ELSE CAST([] AS VARCHAR[]) END")


def query(oracle: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if oracle is not None:
            ORACLES[build.__name__] = oracle
        return build

    return register


@query(r"""
WITH rows_ AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('mix:' || CAST(doc_id AS VARCHAR)) AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM rows_ GROUP BY source),
weighed AS (
    SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
           ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight FROM src),
ranked AS (
    SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, source ASC NULLS LAST) AS k FROM weighed),
levels AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)) /
        (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM ranked WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT ratio AS final_ratio, level AS final_level FROM levels WHERE level <= ratio ORDER BY k LIMIT 1),
targets AS (
    SELECT source, source_size, CASE WHEN ratio < final_ratio THEN cap ELSE least(cap, weight * final_level) END AS target
    FROM ranked, final),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
cum AS (
    SELECT r.doc_id, r.source, r.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
        coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM rows_ r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
    CAST(size * (whole + CASE WHEN rest > 0 AND before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM cum""")
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to weights 3, 1, 2 in turn at 150 % of their words and two epochs at most."""
    mixed = mixing.mix_sources(table(spark, folder, "documents"), share=1.5, max_epochs=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(f"""
WITH docs AS (SELECT doc_id, {_WORDS.format(_FOLDED)} AS w FROM documents),
items AS (SELECT item_id, least(len(w), 5) AS k, {_shingles(5)} AS s FROM (SELECT item_id, {_WORDS.format(_FOLDED)} AS w FROM benchmark)),
flat AS (SELECT item_id, k, len(s) AS n_shingles, unnest(s) AS g FROM items),
runs AS (SELECT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM items WHERE k > 0))),
doc_flat AS (SELECT DISTINCT doc_id, k, g FROM runs WHERE g IN (SELECT g FROM flat)),
hits AS (SELECT item_id, doc_id, n_shingles, count(*) AS n_found FROM flat JOIN doc_flat USING (k, g) GROUP BY ALL)
SELECT item_id, doc_id, n_shingles, n_found, n_found / n_shingles AS containment FROM hits
WHERE 100 * n_found >= 80 * n_shingles""")
def op2_find_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items of which a document holds 80 % of the five-word shingles or more; shorter items as one shingle."""
    return decontaminate.find_contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(r"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, name AS license FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
JOIN (VALUES ('MIT', 'Released under the MIT License.'), ('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
    ('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
    ('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.')) AS t(name, notice) ON contains(line, notice)""")
def op3_scan_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Confirmed license notices of all documents, each license once for a line."""
    found = licenses.scan_licenses(table(spark, folder, "documents"))
    return found.where("confirmed and nth = 0").select("doc_id", "line", "license")


@query("""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op5_top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five best partners of every vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    return maxscore.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256.0)


@query("""
WITH d AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
first AS (SELECT hex, min(page_id) AS original FROM d GROUP BY hex)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, 1 + 5 * i, 5) AS INTEGER) >> s) & 31) AS INTEGER), 1)), '')), '')
        AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM d JOIN first USING (hex)""")
def op6_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as deduplicated archives, then read back."""
    pages = table(spark, folder, "pages")
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(pages, path, min_bytes=0)
    read = warc.read_archives(spark, path)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(r"""
WITH l AS (
    SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
common AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT l.*, c.key IS NOT NULL AS gone FROM l LEFT JOIN common c ON l.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op10_drop_shared_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that ten documents or more share."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = lines.apply_bitmaps(docs, lines.shared_line_bitmaps(docs, min_docs=10, min_chars=1), text="kept")
    return kept.select("doc_id", F.size(lines.split_lines(F.col("text"))).cast("long").alias("n_lines"), "n_dropped",
                       F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query()
def op8_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score, learned from labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
                         quality.quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query()
def op9_find_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data and revealing terms of every document as spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = pii.find_spans(docs).select("doc_id", "spans")
    counts = [pii.span_count(F.col("spans"), name).alias(f"n_{name}") for name in pii.KINDS[:4]]
    return spans.select("doc_id", *counts,
                        F.sha2(pii.span_list(F.col("spans"), base_only=True).cast("binary"), 256).alias("base_sha256"),
                        pii.span_list(F.col("spans")).alias("spans"))


@query()
def op7_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the 50-byte strings that start in a document with a smaller id."""
    found = suffixes.remove_repeats(table(spark, folder, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query(f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_shingles(4)} AS s FROM (SELECT doc_id, {_WORDS.format(_FOLDED)} AS w FROM documents)),
flat AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM d),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
    FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM pairs WHERE 100 * c >= 85 * (n + m - c)),
both_ AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM both_ UNION SELECT r.x, b.y FROM reach r JOIN both_ b ON r.y = b.x)
SELECT d.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(min(reach.y), d.doc_id)) AS component_id
FROM d LEFT JOIN reach ON d.doc_id = reach.x GROUP BY d.doc_id, len(s)""")
def op4_similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 85 % of their four-word shingles."""
    return jaccard.similar_documents(table(spark, folder, "documents"), words=4, percent=85).drop("row")


@query(r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') AS t
    FROM documents),
flat AS (SELECT r, lang, source, unnest(t) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS c FROM flat GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS c FROM flat SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS MATERIALIZED (
    SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(c), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang) LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
        CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS HUGEINT) AS p
    FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
    FROM shares JOIN (
        SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (kept.c + 1)) // (langs.n + langs.v) AS q FROM kept JOIN langs USING (lang))
        USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 200""")
def op11_audit_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set each source apart."""
    return divergence.source_divergence(table(spark, folder, "documents"), min_docs=3, k=200)


@query(r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) AS t(n))),
f AS MATERIALIZED (SELECT lang, n, g, count(*) AS a, string_split(g, ' ') AS w FROM grams GROUP BY lang, n, g HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE n = 1 GROUP BY lang),
cuts AS (
    SELECT lang, n, g, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
    FROM (SELECT *, unnest(range(1, n)) AS k FROM f WHERE n > 1)),
scored AS (
    SELECT c.lang, c.g, c.a, k, l.a AS l, r.a AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.a + r.a) AS BIGINT) AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = c.x JOIN f r ON r.lang = c.lang AND r.g = c.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
    SELECT lang, g, max(a) AS longer FROM (
        SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
            SELECT lang, a, w, m, unnest(range(1, n - m + 2)) AS i FROM f JOIN (VALUES (2), (3)) AS t(m) ON m < n))
    GROUP BY lang, g),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR 100 * longer < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, g AS phrase, a, l, r, totals.n, score FROM ranked JOIN totals USING (lang)
WHERE rank <= 2000""")
def op12_mine_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return collocations.mine_collocations(table(spark, folder, "documents"), min_count=30, first=2000)


@query()
def op13_extract_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return templates.extract_main_text(table(spark, folder, "pages"))
