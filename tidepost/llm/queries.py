"""The registered queries of the operators and, where SQL can state them, their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepost.functions.binding import bind
from tidepost.llm import alignment, chat, contamination, graph_search, languages, lines, ngram_join, packing, periodic, personal, sentences, sharding, substrings
from tidepost.llm.common import table, text_of

#: Bytes of text per shard in the query; the operator's own default is 64 MiB.
SHARD_BYTES = 1 << 20


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES)


OP1_SQL = f"""
WITH h AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
                  translate(substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, 8),
                            '0123456789abcdef', 'ghijklmnopqrstuv') AS x FROM documents),
b AS (SELECT doc_id, n_bytes, {"".join("replace(" for _ in range(16))}x{"".join(f", '{c}', '{i:04b}')" for i, c in enumerate("ghijklmnopqrstuv"))} AS bits FROM h),
l AS (SELECT doc_id, bits, n_bytes, level, substr(bits, 1, level) AS shard FROM b, range(0, 33) AS r(level)),
s AS (SELECT level, shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY ALL),
f AS (SELECT l.*, shard_bytes, shard_docs FROM l JOIN s USING (level, shard)
      WHERE shard_bytes <= {SHARD_BYTES} OR shard_docs = 1)
SELECT doc_id, n_bytes, shard, shard_bytes, shard_docs FROM f
QUALIFY row_number() OVER (PARTITION BY doc_id, bits ORDER BY level) = 1
"""


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.cut_documents(table(spark, sf_dir, "documents")).drop("kept")


def op3_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), word_tokenizer())


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return contamination.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "score")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return languages.identify(docs).select("doc_id", "held_out", "lang_pred", "score", F.to_json("lang_shares").alias("shares"))


def op9_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentences.dedup_sentences(docs).select("doc_id", "n_sentences", "n_removed", "text")


#: A conversation whose texts hold the template's own control strings.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    tricky = spark.range(2).select(F.lit(TRICKY_ID).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(TRICKY_TEXT).alias("text"))
    turns = turns.unionByName(tricky)
    read = chat.read_back(chat.format_conversations(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("text").cast("bigint").alias("formatted_chars"),
    )


def _escaped_sql(column: str, escapes: tuple[tuple[str, str], ...]) -> str:
    for plain, mark in escapes:
        column = f"replace({column}, '{plain}', '{mark}')"
    return column


OP11_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT {TRICKY_ID}, k, r, '{TRICKY_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(k, r)),
o AS (SELECT *, row_number() OVER w AS rn, lag(role) OVER w AS before FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{chat.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(length({_escaped_sql("text", chat.ESCAPES)}) + CASE WHEN before IS NOT DISTINCT FROM role THEN {len(chat.NEXT)}
                ELSE {len(chat.OPEN + chat.AFTER_ROLE + chat.END) + 1} + length({_escaped_sql("role", chat.ROLE_ESCAPES)}) END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        byte_level = file.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        pieces = file.read()
    return alignment.align(table(spark, sf_dir, "documents"), byte_level, pieces)


def planted_text() -> Column:
    """The text, in one of ten documents with its words from some place on repeated periodically."""
    held = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(held / 10).cast("bigint")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a, parts = g % F.greatest(n, F.lit(1)), g % 8 + 3
        period = 1 + ((n - a - (n - a) % parts) / parts).cast("bigint")

        def word(old: Column, i: Column) -> Column:
            return F.when(i < a, old).otherwise(F.get(words, (a + (i - a) % period).cast("int")))

        return F.array_join(F.transform(words, word), " ")

    words = F.filter(F.split(text_of(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(held % 10 == 0, bind(words, planted)).otherwise(F.col("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_text().alias("text"))
    found = periodic.periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    start, length, period = -F.col("longest.start"), F.col("longest.length"), -F.col("longest.period")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_suffix_array": op2_suffix_array,
    "op3_personal": op3_personal,
    "op4_ngram_join": op4_ngram_join,
    "op5_packing": op5_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_language": op8_language,
    "op9_graph_search": op9_graph_search,
    "op10_sentence_spans": op10_sentence_spans,
    "op11_chat": op11_chat,
    "op12_alignment": op12_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op1_sharding": OP1_SQL,
    "op6_line_dedup": lines.SQL,
    "op10_sentence_spans": sentences.SQL,
    "op11_chat": OP11_SQL,
}
