"""The registered queries of the operators, and their DuckDB counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.centroids import cluster_vectors, inertias
from parcelmart.llm.common import table
from parcelmart.llm.decontaminate import find_leaks
from parcelmart.llm.filter_audit import audit_documents
from parcelmart.llm.hnsw import nearest_neighbours
from parcelmart.llm.langid import identify_language
from parcelmart.llm.licence_texts import MORE_NOTICES, NOTICES, SPELLINGS, published_texts
from parcelmart.llm.license_scan import COPYRIGHT_LINE, NO_WORD, RESERVED_LINE, known_texts, scan_licences
from parcelmart.llm.line_dedup import COPY, repeated_lines, with_copies, worded_lines
from parcelmart.llm.ngram_join import near_duplicates
from parcelmart.llm.pieces import encode_texts
from parcelmart.llm.pii import all_spans, find_spans
from parcelmart.llm.quality import remainder, score_quality
from parcelmart.llm.sharding import assign_shards
from parcelmart.llm.warc import read_records, write_archives
from parcelmart.session import scratch_path


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    """The canonical form of the licence scan in DuckDB's terms, whose expressions have no look-ahead: a line
    that names a holder is split behind the word, and its rest is held against the words of the law."""
    head = "^[^\\p{L}\\p{N}(]*Copyright[ \\t:,]+(?:(?i:by|the)[ \\t]+)?"
    rest = f"regexp_extract(x, '{head}([^ \\t:,].*)$', 1)"
    law = "^(?i:act|disclaimer|holder|infring|interest|law|licen|notice|office|owner|permission|protect|right|statement|treat)"
    holder = f"regexp_matches({rest}, '^(?:\\p{{Lu}}|contributors\\b|authors\\b)') AND NOT regexp_matches({rest}, '{law}')"
    unnamed = f"list_transform(string_split({text}, chr(10)), lambda x: CASE WHEN contains(x, 'Copyright') AND {holder} THEN '' ELSE x END)"
    whole = f"lower(array_to_string({unnamed}, chr(10)))"
    for pattern, replacement in ((COPYRIGHT_LINE, ""), (RESERVED_LINE, ""), (NO_WORD, " ")):
        whole = f"regexp_replace({whole}, {_sql_text(pattern)}, '{replacement}', 'g')"
    return whole


def _sql_whole(lines: str) -> str:
    return _sql_spelled(f"trim(regexp_replace({lines}, '[ \n]+', ' ', 'g'))")


def _sql_spelled(whole: str) -> str:
    for pattern, replacement in SPELLINGS.items():
        whole = f"regexp_replace({whole}, {_sql_text(pattern)}, {_sql_text(replacement)}, 'g')"
    return whole


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+')"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query(
    f"""
    WITH item AS (
        SELECT item_id, least(len(w), 5) AS width,
               list_distinct([array_to_string(w[i:i + least(len(w), 5) - 1], ' ')
                              for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS grams
        FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    gram AS (SELECT DISTINCT item_id, width, len(grams) AS n_shingles, unnest(grams) AS gram FROM item),
    doc AS (
        SELECT DISTINCT doc_id, width, unnest([array_to_string(w[i:i + width - 1], ' ')
                                               for i in range(1, len(w) - width + 2)]) AS gram
        FROM (SELECT doc_id, {WORDS} AS w FROM documents), (SELECT DISTINCT width FROM item)
        WHERE len(w) >= width)
    SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(count(*) AS BIGINT) AS n_shared,
           CAST(count(*) AS DOUBLE) / n_shingles AS containment
    FROM doc JOIN gram USING (width, gram)
    GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
    """
)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: five-word shingles, containment of 0.8 or more."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of personal data, and the terms that reveal them."""
    return find_spans(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2("base", 256).alias("base_sha256"),
        all_spans().alias("spans"),
    )


@query()
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of quality label 1, learned from the ids whose remainder is not 1."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    scored = score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(F.col("key"), 3) != 1, ["doc_id"]
    )
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the ids whose remainder is not 0."""
    learn = remainder(F.col("doc_id"), 5) != 0
    found = identify_language(table(spark, sf_dir, "documents"), learn, ["doc_id"])
    return found.select(
        "doc_id",
        F.coalesce(~learn, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


@query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding gives it back."""
    encoded = encode_texts(table(spark, sf_dir, "documents"), ["doc_id"])
    return encoded.select("doc_id", F.size("ids").alias("n_ids"), "ids", "round_trip")


@query(
    """
    SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
           CASE WHEN strlen(h) >= 1000 AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN strlen(h) >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
    FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
    """
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back from byte ranges."""
    archives = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_records(archives, payloads=False).select(
        F.regexp_extract("record_id", "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.regexp_extract("refers_to", "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long").alias("refers_to"),
    )


@query(
    f"""
    WITH RECURSIVE doc AS (
        SELECT doc_id, CASE WHEN len(w) > 0 THEN
                   list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, greatest(len(w) - 2, 1) + 1)]))
               ELSE [] END AS grams
        FROM (SELECT doc_id, {WORDS} AS w FROM documents)),
    kind AS (SELECT grams, min(doc_id) AS root, len(grams) AS n FROM doc WHERE len(grams) > 0 GROUP BY grams),
    gram AS (SELECT root, n, unnest(grams) AS gram FROM kind),
    often AS (SELECT gram, count(*) AS often FROM gram GROUP BY 1),
    prefix AS (
        SELECT root, n, gram FROM (
            SELECT root, n, gram, row_number() OVER (PARTITION BY root ORDER BY often, gram) AS pos FROM gram JOIN often USING (gram))
        WHERE pos <= n - (90 * n + 99) // 100 + 1),
    met AS (
        SELECT DISTINCT a.root AS a, b.root AS b FROM prefix a JOIN prefix b USING (gram)
        WHERE a.root < b.root AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
    link AS (
        SELECT a, b FROM met JOIN kind x ON x.root = a JOIN kind y ON y.root = b
        WHERE 190 * len(list_intersect(x.grams, y.grams)) >= 90 * (x.n + y.n)),
    edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT root AS node, root AS reached FROM kind UNION SELECT node, b FROM reach JOIN edge ON a = reached),
    component AS (SELECT node, min(reached) AS component_id FROM reach GROUP BY node)
    SELECT d.doc_id, CAST(len(d.grams) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
    FROM doc d LEFT JOIN kind k ON k.grams = d.grams LEFT JOIN component c ON c.node = k.root
    """
)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingle sets have a Jaccard similarity of 0.9 or more."""
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", F.col("n_ngrams").alias("n_shingles"), "component_id")


@query()
def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query(
    """
    WITH line AS (
        SELECT doc_id, line, list_sort(list_distinct([array_to_string(w[i:i + 4], ' ')
                                                      for i in range(1, greatest(len(w) - 4, 1) + 1)])) AS words FROM (
            SELECT doc_id, k - 1 AS line, regexp_extract_all(lower(parts[k]), '[^\\x20\\x09-\\x0D]+') AS w
            FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS k
                  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)))
        WHERE len(w) > 0),
    kind AS (SELECT row_number() OVER () AS kind, * FROM (
        SELECT words, len(words) AS n, min(doc_id * 1000000 + line) AS first FROM line GROUP BY words)),
    word AS (SELECT kind, n, first, unnest(words) AS word FROM kind),
    often AS (SELECT word, count(*) AS often FROM word GROUP BY 1),
    prefix AS (
        SELECT kind, n, first, word FROM (
            SELECT kind, n, first, word, row_number() OVER (PARTITION BY kind ORDER BY often, word) AS pos FROM word JOIN often USING (word))
        WHERE pos <= n - (80 * n + 99) // 100 + 1),
    met AS (
        SELECT DISTINCT a.kind AS a, b.kind AS b FROM prefix a JOIN prefix b USING (word)
        WHERE b.first < a.first AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
    later AS (
        SELECT DISTINCT a FROM met JOIN kind x ON x.kind = a JOIN kind y ON y.kind = b
        WHERE 180 * len(list_intersect(x.words, y.words)) >= 80 * (x.n + y.n)),
    gone AS (
        SELECT doc_id, line FROM line JOIN kind USING (words)
        WHERE doc_id * 1000000 + line <> first OR kind IN (SELECT a FROM later))
    SELECT d.doc_id, CAST(coalesce(g.n_removed, 0) AS BIGINT) AS n_removed, coalesce(g.removed, '') AS removed
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n_removed, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed FROM gone GROUP BY doc_id) g
    USING (doc_id)
    """
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the lines of each document that repeat an earlier line."""
    docs = table(spark, sf_dir, "documents")
    gone = (
        repeated_lines(docs)
        .groupBy("doc_id", "version")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    every = with_copies(docs).select("doc_id", F.xxhash64("text").alias("version"), F.when(F.col(COPY), worded_lines(F.col("text"))).alias("all_lines"))
    met = every["doc_id"].eqNullSafe(gone["doc_id"]) & (every["version"] == gone["version"])
    removed = F.coalesce("all_lines", "lines", F.array().cast("array<int>"))
    return every.join(gone, met, "left").select(
        every["doc_id"], F.size(removed).cast("long").alias("n_removed"), F.array_join(removed, ",").alias("removed")
    )


_KNOWN = ", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, text in published_texts())
_NOTICES = ", ".join(f"({_sql_text(line)}, {_sql_text(name)})" for line, name in (NOTICES | MORE_NOTICES).items())


@query(
    f"""
    WITH known AS (
        SELECT sha256(whole) AS digest, min(name) AS licence
        FROM (SELECT name, {_sql_whole(_sql_canonical("text"))} AS whole FROM (VALUES {_KNOWN}) t(name, text)) GROUP BY 1),
    notice AS (SELECT DISTINCT {_sql_spelled(f'trim({_sql_canonical("line")})')} AS line, name FROM (VALUES {_NOTICES}) t(line, name)),
    doc AS (SELECT row_number() OVER () AS row, doc_id, {_sql_canonical("text")} AS lines FROM documents),
    found AS (
        SELECT row, string_agg(name, ',' ORDER BY name) AS notices
        FROM (SELECT DISTINCT row, name FROM (SELECT row, unnest(string_split(lines, chr(10))) AS line FROM doc) d
              JOIN notice ON {_sql_spelled("trim(d.line)")} = notice.line)
        GROUP BY row)
    SELECT doc_id, CASE WHEN whole <> '' THEN sha256(whole) END AS digest, licence, coalesce(notices, '') AS notices
    FROM (SELECT *, {_sql_whole("lines")} AS whole FROM doc) d
    LEFT JOIN known ON known.digest = sha256(d.whole) AND whole <> '' LEFT JOIN found USING (row)
    """
)
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digests of entire texts, the known licence each is, and the notices in it."""
    return scan_licences(table(spark, sf_dir, "documents"), known_texts(spark))


#: CRC-32 in SQL: its table by the shifts of each byte, then a fold over the bytes of the text.
_CRC = """
    crc_table AS (SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b)))"""
_CRC_OF = """xor(list_reduce([4294967295] || [CAST('0x' || substr(hex(encode(text)), 2 * i + 1, 2) AS BIGINT) for i in range(CAST(strlen(text) AS BIGINT))],
                           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"""


@query(
    f"""
    WITH RECURSIVE {_CRC},
    doc AS (SELECT doc_id, strlen(text) + 1 AS size, sha256(text) AS key, {_CRC_OF} AS crc
            FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents), crc_table),
    kind AS (SELECT row_number() OVER (ORDER BY bytes DESC, key) AS k, key, CAST(bytes AS BIGINT) AS bytes
             FROM (SELECT key, sum(size) AS bytes FROM doc GROUP BY 1)),
    deal AS (
        SELECT CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS shard, [CAST(0 AS BIGINT) for i in range(8)] AS loads
        UNION ALL
        SELECT d.k + 1, list_position(loads, list_min(loads)) - 1,
               [loads[i] + CASE WHEN i = list_position(loads, list_min(loads)) THEN bytes ELSE 0 END for i in range(1, 9)]
        FROM deal d JOIN kind ON kind.k = d.k + 1)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
           CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM doc JOIN kind USING (key) JOIN deal USING (k)
    """
)
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes, equal texts together."""
    assigned = assign_shards(table(spark, sf_dir, "documents"), 8)
    none = F.lit(None).cast("int").alias("grown_shard")
    return assigned.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


@query(
    """
    WITH text AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    doc AS (
        SELECT part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
               + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) AS INT) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
               + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS fails,
               coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
               coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
        FROM text),
    cell AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM doc GROUP BY 1, 2),
    f AS (SELECT chr(65 + k) AS name, 1 << k AS bit FROM (SELECT CAST(unnest(range(5)) AS INT) AS k)),
    ord AS (SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits, a.name || b.name || c.name || d.name || e.name AS filter_order
            FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.name, b.name, c.name, d.name, e.name])) = 5),
    step AS (SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0) AS before FROM ord, (SELECT unnest(range(1, 6)) AS k)),
    counted AS (
        SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0) AS kept,
               coalesce(sum(n) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS removed,
               coalesce(sum(n) FILTER (fails & before <> 0 AND fails & bit <> 0), 0) AS redundant,
               coalesce(sum(n) FILTER (fails = bit), 0) AS unique_fails,
               coalesce(sum(n_good) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS good_lost,
               coalesce(sum(n_toxic) FILTER (fails & before = 0 AND fails & bit <> 0), 0) AS toxic_lost
        FROM step, cell GROUP BY part, filter_order, step, bit)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted
    """
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in every order, by language."""
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _sql_clustering() -> str:
    """Three rounds and the last assignment of op13 in DuckDB's terms."""
    near = """list_sum([(vector[i] - centroid[i]) * (vector[i] - centroid[i]) for i in range(1, 65)])"""
    parts = [
        """kept AS MATERIALIZED (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS vector FROM embeddings
        WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vector) - 1 AS cluster, vector AS centroid
        FROM (SELECT *, sha256('1:' || vec_id) AS h FROM kept ORDER BY h, vector LIMIT 16))""",
    ]
    for k in range(4):
        parts.append(
            f"""a{k} AS MATERIALIZED (SELECT vec_id, vector, near[2] AS cluster, near[1] AS distance FROM (
        SELECT vec_id, vector, min([{near}, cluster]) AS near FROM (SELECT row_number() OVER () AS r, * FROM kept), c{k} GROUP BY r, vec_id, vector))"""
        )
        if k < 3:
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(moved, centroid) AS centroid FROM c{k} LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM (
            SELECT cluster, i, CAST(sum(vector[i]) AS BIGINT) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i)
        GROUP BY cluster) USING (cluster))"""
            )
    return "WITH " + ",\n    ".join(parts)


@query(
    f"""
    {_sql_clustering()}
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
           CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(centroid, ',')) AS centroid_sha256
    FROM a3 JOIN c3 USING (cluster)
    """
)
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings around sixteen integer centroids, after three rounds."""
    clusters = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join("centroid", ","), 256)
    each = inertias(clusters).select("cluster", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))
    joined = clusters.rows.join(F.broadcast(each), "cluster")  # a row per centroid
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
