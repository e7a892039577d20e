"""One query for each operator of this package, over the whole test tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.audit import damaged, repair
from tripmill.llm.centroids import cluster_vectors
from tripmill.llm.chat import format_records, read_formatted, rows_to_records
from tripmill.llm.common import read_table
from tripmill.llm.decontamination import find_contamination
from tripmill.llm.exact_dedup import find_copies
from tripmill.llm.html_text import extract_text
from tripmill.llm.near_dedup import find_near_copies
from tripmill.llm.repeats import find_repeats
from tripmill.llm.sentencepieces import digests, encode_and_decode
from tripmill.llm.sharding import balance_by_bytes
from tripmill.llm.sql import AUDIT_SQL, WARC_SQL, clusters_sql
from tripmill.llm.token_counts import count_tokens
from tripmill.llm.toxicity import held_out, score, train
from tripmill.llm.warc import archive_pages

SHARDS = 24
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
CLUSTERS = {"k": 8, "dims": 64, "scale": 1024, "rounds": 10, "seed": 3}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# A conversation that says what the template says.
_CONTROL_TEXT = "\\### Assistant: </turn> ok"
_CONTROL_ROWS = [(-7, 0, "user", _CONTROL_TEXT), (-7, 1, "assistant", _CONTROL_TEXT)]


def op1_chat_format(spark: SparkSession, tables: str) -> DataFrame:
    """Every conversation as one formatted string, read back from it."""
    rows = read_table(spark, tables, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(_CONTROL_ROWS, "conv_id long, turn long, role string, text string"))
    records = rows_to_records(rows, "conv_id", "turn", "role", "text")
    return read_formatted(format_records(records, "conv_id"), "conv_id")


def op2_repeats(spark: SparkSession, tables: str) -> DataFrame:
    """Every document without the strings of 400 bytes that also start elsewhere."""
    return find_repeats(read_table(spark, tables, "documents")).drop("spans")


def op3_decontamination(spark: SparkSession, tables: str) -> DataFrame:
    """Words of every document that lie in a window of 10 words of a benchmark item."""
    found = find_contamination(read_table(spark, tables, "documents"), read_table(spark, tables, "benchmark"))
    return found.drop("spans")


def op4_exact_dedup(spark: SparkSession, tables: str) -> DataFrame:
    """Every document with the one of its equals that stays: the one with the largest id."""
    return find_copies(read_table(spark, tables, "documents"), keep="largest")


def op5_toxicity(spark: SparkSession, tables: str) -> DataFrame:
    """Every document's toxicity, learned from the labels that are not held out."""
    docs = read_table(spark, tables, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, tables, "labels"))
    scored = score(docs.withColumn("held_out", held_out("doc_id")), model)
    return scored.select("doc_id", "held_out", F.col("score"), "predicted")


def op6_token_counts(spark: SparkSession, tables: str) -> DataFrame:
    """Tokens of every document, and whether they are more than a context holds."""
    return count_tokens(read_table(spark, tables, "documents"), tokenizer_file(PIECES), TOKEN_LIMIT)


def op7_sentencepieces(spark: SparkSession, tables: str) -> DataFrame:
    """Every document encoded to ids and decoded again, as digests."""
    return digests(encode_and_decode(read_table(spark, tables, "documents"), tokenizer_file(PIECES)))


def op8_near_dedup(spark: SparkSession, tables: str) -> DataFrame:
    """Every document with its class of near-duplicates."""
    return find_near_copies(read_table(spark, tables, "documents"))


def op9_html_text(spark: SparkSession, tables: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(read_table(spark, tables, "pages"))


def op10_sharding(spark: SparkSession, tables: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, equal texts together."""
    return balance_by_bytes(read_table(spark, tables, "documents"), SHARDS)


def op11_conversation_repair(spark: SparkSession, tables: str) -> DataFrame:
    """Every conversation, damaged, with the cheapest edits that repair its roles."""
    return repair(damaged(read_table(spark, tables, "conversations")))


def op12_centroid_clusters(spark: SparkSession, tables: str) -> DataFrame:
    """Every whole vector with the nearest of 8 centroids after 10 rounds, in integers."""
    return cluster_vectors(read_table(spark, tables, "embeddings"), **CLUSTERS)


def op13_warc_index(spark: SparkSession, tables: str) -> DataFrame:
    """Every page written to a WARC archive and read back by its URL through the capture index."""
    return archive_pages(spark, read_table(spark, tables, "pages")).drop("url", "payload")


_OP1_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *, regexp_replace(regexp_replace(text, '(\\*)(###|</turn>)', '\1\1\\\2', 'g'), '(\\+)\z', '\1\1') AS body,
        CASE WHEN role IN ('user', 'assistant', 'system', 'tool') THEN length(role)
            ELSE 1 + length(replace(replace(role, '\', '\\'), ':', '\:')) END AS label
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text))
        AS loss_sha256,
    CAST(sum(4 + label + 2 + length(body) + 8) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_OP3_SQL = r"""
WITH cut AS (
    SELECT doc_id, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS parts
    FROM documents
), doc AS (
    SELECT doc_id, list_filter(parts, lambda x: x <> '') AS w FROM cut
), item_cut AS (
    SELECT CAST(item_id AS VARCHAR) AS item, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS parts
    FROM benchmark
), item_words AS (
    SELECT item, list_filter(parts, lambda x: x <> '') AS w FROM item_cut
), item AS (
    SELECT item, w, least(len(w), 10) AS n FROM item_words WHERE len(w) > 0
), item_start AS (
    SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM item
), item_window AS (
    SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS words FROM item_start
), lengths AS (
    SELECT DISTINCT n FROM item_window
), doc_start AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, lengths WHERE len(w) >= n
), hit AS (
    SELECT doc_id, s, d.n, item
    FROM doc_start d JOIN item_window i ON d.n = i.n AND array_to_string(w[s:s + d.n - 1], ' ') = words
), hit_word AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id
), hit_item AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_word USING (doc_id) LEFT JOIN hit_item USING (doc_id)
"""

_OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_chat_format,
        op2_repeats,
        op3_decontamination,
        op4_exact_dedup,
        op5_toxicity,
        op6_token_counts,
        op7_sentencepieces,
        op8_near_dedup,
        op9_html_text,
        op10_sharding,
        op11_conversation_repair,
        op12_centroid_clusters,
        op13_warc_index,
    )
}

ORACLES: dict[str, str] = {
    "op1_chat_format": _OP1_SQL,
    "op3_decontamination": _OP3_SQL,
    "op4_exact_dedup": _OP4_SQL,
    "op11_conversation_repair": AUDIT_SQL,
    "op12_centroid_clusters": clusters_sql(**CLUSTERS),
    "op13_warc_index": WARC_SQL,
}
