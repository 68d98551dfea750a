"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import (
    ann,
    chat,
    decontam,
    jaccard_join,
    languages,
    mixing,
    mixing_sql,
    phrases,
    quality,
    recompress,
    sharding,
    token_blocks,
    warc,
    whitening,
)
from starfold.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op2_jaccard_join": """
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
          FROM documents),
        starts AS (
          SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM words),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM starts),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
          FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
          SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 100 * k >= 75 * (p.n + q.n - k)),
        reach AS (
          SELECT doc_id, doc_id AS c FROM documents
          UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id)
        SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.c) AS component_id
        FROM documents d JOIN reach r USING (doc_id) LEFT JOIN sizes s USING (doc_id) GROUP BY d.doc_id
    """,
    "op3_chat": """
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
        sizes AS (
          SELECT *, length(text) + length(regexp_replace(text, '[^\\\\<#]', '', 'g')) AS inner_chars,
                 length(role) + length(regexp_replace(role, '[^\\\\<#:]', '', 'g')) AS role_chars
          FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                 AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
                 AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                                 ORDER BY turn, role, text)) AS loss_sha256,
               CAST(sum(4 + role_chars + 2 + inner_chars + 8) AS BIGINT) AS formatted_chars,
               CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
        FROM sizes GROUP BY conv_id
    """,
    "op8_recompress": """
        WITH words AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
          FROM documents),
        places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words),
        windows AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS x FROM places),
        firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY x) AS least FROM windows),
        gone AS (
          SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM firsts WHERE doc_id > least),
        per_doc AS (SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id),
        kept AS (
          SELECT doc_id, len(w) AS n_words, w,
                 list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)) AS k
          FROM words LEFT JOIN per_doc USING (doc_id))
        SELECT doc_id, n_words, n_words - len(k) AS n_removed,
               sha256(array_to_string(list_transform(k, lambda i: w[i]), ' ')) AS kept_sha256
        FROM kept
    """,
    "op9_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                 sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f
    """,
    "op4_decontam": """
        WITH texts AS (
          SELECT 'd' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
          UNION ALL SELECT 'i', item_id, text FROM benchmark WHERE item_id IS NOT NULL),
        words AS (
          SELECT kind, id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w
          FROM texts),
        lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE kind = 'i' AND len(w) > 0),
        starts AS (
          SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, lengths
          WHERE len(w) >= k AND (kind = 'd' OR k = least(len(w), 5))),
        shingles AS (
          SELECT DISTINCT kind, id, array_to_string(w[i:i + k - 1], ' ') AS shingle FROM starts),
        items AS (SELECT *, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'i')
        SELECT d.id AS doc_id, i.id AS item_id, i.n_item, count(*) AS n_shared
        FROM shingles d JOIN items i USING (shingle) WHERE d.kind = 'd'
        GROUP BY d.id, i.id, i.n_item HAVING count(*) >= 0.75 * i.n_item
    """,
    "op6_mixing": mixing_sql.TAKEN,
    "op11_phrases": """
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        lengths AS (SELECT unnest([1, 2, 3, 4]) AS k),
        places AS (
          SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, lengths WHERE len(w) >= k),
        counts AS (
          SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
          FROM places GROUP BY ALL HAVING count(*) >= 30),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
        spans AS (
          SELECT lang, phrase, k, w, f, unnest(range(1, k)) AS m FROM candidates),
        cuts AS (
          SELECT s.lang, s.phrase, s.f AS a, x.f AS l, y.f AS r, m AS k,
                 CAST((2000000::HUGEINT * s.f) // (x.f + y.f) AS BIGINT) AS score
          FROM spans s
          JOIN counts x ON x.lang = s.lang AND x.phrase = array_to_string(s.w[1:m], ' ')
          JOIN counts y ON y.lang = s.lang AND y.phrase = array_to_string(s.w[m + 1:], ' ')),
        inner_runs AS (
          SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM spans WHERE m > 1),
        longer AS (
          SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f FROM inner_runs GROUP BY ALL),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
          SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
          FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
          WHERE g.f IS NULL OR 100::HUGEINT * g.f < 80::HUGEINT * b.a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest rows of every twentieth vector, among all vectors."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose shingle sets are similar enough."""
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"))


#: Texts that look like the template's own marks.
TRAP = r"\### Assistant: </turn> ok"


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of template marks, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame(
        [(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], turns.schema
    )
    return chat.read_back(chat.format_conversations(turns.union(trap)))


@query
def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item of which a document holds three quarters of the shingles."""
    return decontam.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as packed blocks and read back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_blocks.token_ids(table(spark, sf_dir, "documents"), path)


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the slots of the schedule take of all documents, to the targets of their sources."""
    mixed = mixing.taken_words(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the weakly trained classifier on all documents."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of earlier ones."""
    kept = recompress.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records with a merged index, read back through it."""
    index, folder = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_archives(index, folder)


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in 40 shards of equal row counts."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language, of all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    documents = table(spark, sf_dir, "documents")
    return languages.identify(documents, languages.learn(documents))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every embedding."""
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # Beyond 64 bits there is no long for it.
    return whitened.withColumn("deviation", F.expr("try_cast(deviation as long)"))
