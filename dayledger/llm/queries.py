"""The registered queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import decontaminate, jaccard, language, ngram_lm, packing, periodic, radix_dedup, simhash, topk, toxicity, turn_trie, url_filter, warc
from dayledger.llm.common import remainder, scratch, stored, table

Query = Callable[[SparkSession, str], DataFrame]

RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public tokenizer lies on each machine; nothing of it is kept here."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = ngram_lm.score(docs, remainder(F.col("doc_id"), 5) != 1)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    said = language.predict(docs, language.train(docs.filter(~held_out)), ["doc_id"])
    return said.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path(), END_ID)


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch(spark, "warc")
    files = warc.write(table(spark, folder, "pages"), archives)
    return warc.read(files, archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return radix_dedup.remove_repeats(table(spark, folder, "documents"))


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    said = toxicity.score(docs, toxicity.train(docs, labels.filter(~held_out)))
    return said.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"))


def rewritten(doc_id: Column, text: Column) -> Column:
    """The text; for a tenth of the ids with a repetition of some of its words up to its end."""
    draw = F.crc32(doc_id.cast("string"))
    rest = F.floor(draw / 10)

    def again(words: Column) -> Column:
        n = F.size(words)
        at = rest % n
        period = 1 + F.floor((n - at) / (3 + rest % 8))
        places = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < at, i).otherwise(at + (i - at) % period).cast("int")))
        return F.when(n > 0, F.array_join(places, " ")).otherwise("")

    # An array of one, so that the words are found once and not for each place.
    return F.when(draw % 10 == 0, F.get(F.transform(F.array(periodic.words(text)), again), F.lit(0))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = periodic.find_runs(docs.select("doc_id", rewritten(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda run: F.concat(run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","), run["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which every conversation begins with turns of the one whose id ends in 00."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    convs = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), head.alias("head"))
    convs = convs.join(own.select(F.col("conv_id").alias("base"), "n"), "base", "left")
    convs = convs.select("conv_id", "base", "head", F.least("head", F.coalesce("n", F.lit(0))).alias("taken"))
    first = turns.filter((F.col("place") < 5) & (F.col("conv_id") % 100 == 0)).withColumnRenamed("conv_id", "base")
    first = first.join(convs, "base").filter(F.col("place") < F.col("taken")).select("conv_id", "place", "turn_id", "chars")
    rest = turns.join(convs, "conv_id").filter(F.col("place") >= F.col("head"))
    rest = rest.select("conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "turn_id", "chars")
    return first.unionByName(rest), convs.select("conv_id")


def op13_turn_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = stored(turn_trie.encoded(table(spark, folder, "conversations")), "encoded")
    return turn_trie.nodes(*rebuilt(turns))


REGISTRY: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_url_filter,
        op2_lm_scoring,
        op3_language_id,
        op4_benchmark_decontamination,
        op5_packing,
        op6_exact_top_k,
        op7_warc,
        op8_suffix_dedup,
        op9_simhash_dedup,
        op10_toxicity,
        op11_ngram_jaccard,
        op12_periodic_runs,
        op13_turn_trie,
    )
}
