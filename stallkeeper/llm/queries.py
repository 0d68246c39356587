"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stallkeeper.llm.bpe import bpe_decode, bpe_encode
from stallkeeper.llm.common import bounded_sample, remainder, table
from stallkeeper.llm.conversation_repair import repair
from stallkeeper.llm.decontaminate import find_contamination
from stallkeeper.llm.exact_topk import top_k
from stallkeeper.llm.hash_search import nearest
from stallkeeper.llm.language import fit_language, predict_language
from stallkeeper.llm.main_text import extract_main_text
from stallkeeper.llm.near_duplicates import near_duplicates
from stallkeeper.llm.prefix_trie import numbered, prefix_trie, turn_ids
from stallkeeper.llm.quality import fit_quality, score_quality
from stallkeeper.llm.token_count import count_tokens
from stallkeeper.llm.toxicity import MAX_LABELLED, fit_toxicity, score_toxicity
from stallkeeper.llm.url_model import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL filter.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
# Folds by the crc32 of the id: labels of fold 0 are held out, languages of fold 2.
FOLDS = 5
LANGUAGE_FOLDS = 4
# How conversations borrow their openings before the trie is built.
OPENING_GROUP = 5
OPENING_TURNS = 9
# Fixed value: how many cases the damage of conversations has, four of them with a fault.
DAMAGE_CASES = 20
QUALITY_LEAST = 0.3
TOXICITY_LEAST = 0.5


def tokenizer_spec(name: str = TOKENIZER) -> str:
    """The content of a public tokenizer file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, keys=("page_id", "url"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``id, text, label`` of the documents whose labels may be learnt.

    The labels are a sample of at most about ``MAX_LABELLED`` rows of two numbers, so they are
    broadcast and the texts stay where they are.
    """
    rows = labels.where(F.col(label).isNotNull() & (remainder("doc_id", FOLDS) != 0))
    rows = bounded_sample(rows.select("doc_id", label), "doc_id", MAX_LABELLED)
    rows = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    return rows.select(F.col("doc_id").alias("id"), "text", F.col(label).alias("label"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(labelled(docs, labels, "quality"))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(labelled(docs, labels, "toxic"), docs)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= TOXICITY_LEAST).cast("int").alias("predicted"),
        "evidence",
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = remainder("doc_id", LANGUAGE_FOLDS)
    network = fit_language(docs.where(fold != 2).withColumnRenamed("doc_id", "id"))
    predicted = predict_language(docs.select("doc_id", "text"), network)
    return predicted.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.where(F.col("vec_id") % 100 == 0)
    return top_k(asked, vectors, "vec_id", "embedding", k=10)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), tokenizer_spec())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = tokenizer_spec()
    encoded = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), spec), spec)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_hash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.where(F.col("vec_id") % 100 == 0)
    return nearest(asked, vectors, "vec_id", "embedding", k=10)


def borrowed_openings(turns: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of the first one of their five.

    Of ``turns`` (``conv, place, id, size``); the number of turns is the hash of the id modulo nine.
    """
    first = F.col("conv") - F.col("conv") % OPENING_GROUP
    turns = turns.withColumn("h", F.crc32(F.col("conv").cast("string")) % OPENING_TURNS)
    keys = turns.select("conv", "h").distinct().withColumn("first", first)
    openings = turns.where((F.col("conv") == first) & (F.col("place") < OPENING_TURNS))
    openings = openings.select(F.col("conv").alias("first"), "place", "id", "size")
    taken = keys.join(openings, "first").where("place <= h")
    kept = turns.where("place > h").withColumn("part", F.lit(1))
    rows = taken.withColumn("part", F.lit(0)).select("conv", "part", "place", "id", "size")
    rows = rows.unionAll(kept.select(*rows.columns))
    return numbered(rows, F.col("part"), F.col("place"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    turns = turn_ids(rows, "conv_id", "turn", "role", "text")
    return prefix_trie(borrowed_openings(turns), rows.select("conv_id"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fault in one of four rows, by the hash of id and turn; nulls are one space."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    case = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % DAMAGE_CASES
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(case == 4, F.lit("user")).otherwise(told[2]).alias("role"),
        F.when(case == 1, F.lit(""))
        .when(case == 2, F.regexp_replace(told[3], "[.!?]", ""))
        .otherwise(told[3])
        .alias("text"),
        F.when(case == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("times"),
        case.alias("case"),
    ).where("case <> 0")
    return rows.select("conv_id", "turn", "role", "text", F.explode("times").alias("time"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = repair(damaged(rows), rows.select("conv_id"))
    return repaired.withColumnRenamed("conv", "conv_id")


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_quality": op3_quality,
    "op4_url_filter": op4_url_filter,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_language": op7_language,
    "op8_exact_topk": op8_exact_topk,
    "op9_token_counts": op9_token_counts,
    "op10_bpe": op10_bpe,
    "op11_hash_search": op11_hash_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_conversation_repair": op13_conversation_repair,
}
