"""The operators bound to the given tables: query name -> function, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import (chat, decontaminate, exact, langid, licenses, lines, merkle, mixing, oracle, periodic, pii, quality, simhash,
                        urls)
from tiffin.llm.common import SPACE_WORD, table, text_or_empty

#: Of the query only; users bring their own.
PII_KEY = "op2"

MIX_WEIGHTS, MIX_SHARE, MIX_CAP = [5, 2, 1], 1.5, 2.0

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.replace_entities(table(spark, sf_dir, "documents"), PII_KEY)
    return found.select("doc_id", "text", "n_entities", F.array_join("kinds", ",").alias("kinds"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "license",
                        F.array_join("line_licenses", ",").alias("line_licenses"), "n_notice_lines")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


#: A conversation about the template itself.
OWN_CONVERSATION = (-7, ["user", "assistant"], "\\### Assistant: </turn> ok")


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id, roles, text = OWN_CONVERSATION
    own = spark.range(len(roles)).select(F.lit(conv_id).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                         F.get(F.array(*map(F.lit, roles)), F.col("id").cast("int")).alias("role"),
                                         F.lit(text).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    found = chat.format_conversations(turns)
    learned = chat.learned_text(F.col("formatted"), F.col("spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (found.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                         learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.length("learned").cast("long").alias("loss_chars"),
                    F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars"))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by crc32 of its id, words from one on repeat in a period of the contract."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("g").isNotNull(), F.regexp_extract_all(
        text_or_empty("text"), F.lit(f"({SPACE_WORD})"), F.lit(1))))
    n, g = F.size("w"), F.col("g")
    rows = rows.withColumn("a", F.when(n > 0, g % n).cast("int"))
    rows = rows.withColumn("p", F.floor((n - F.col("a")) / (3 + g % 8)).cast("int") + 1)
    a, p = F.col("a"), F.col("p")
    period = F.slice("w", a + 1, p)
    tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
    words = F.concat(F.slice("w", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return rows.select("doc_id", F.when(a.isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = merkle.leaves(table(spark, sf_dir, "documents"), MANIFEST_FIELDS, "lang", "doc_id", {"n_chars": tampered})
    found = merkle.manifest(rows)
    folded = merkle.fold(F.coalesce("claim", "node"), F.col("place"), F.col("n"), F.col("tree"), F.col("proof"))
    found = found.select("doc_id", merkle.hex_of(F.col("node")).alias("leaf"), merkle.hex_of(F.col("subroot")).alias("subroot"),
                         merkle.hex_of(F.col("root")).alias("root"), F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                         folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_licenses": op3_licenses,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_langid": op7_langid,
    "op8_linededup": op8_linededup,
    "op9_urls": op9_urls,
    "op10_exact": op10_exact,
    "op11_chat": op11_chat,
    "op12_periodic": op12_periodic,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op3_licenses": oracle.op3(),
    "op4_mixing": oracle.op4(MIX_WEIGHTS, MIX_SHARE, MIX_CAP),
    "op6_decontaminate": oracle.op6(decontaminate.WINDOW),
    "op8_linededup": oracle.OP8,
    "op9_urls": oracle.op9(URL_RULES),
    "op10_exact": oracle.OP10,
    "op11_chat": oracle.op11(*OWN_CONVERSATION),
    "op13_merkle": oracle.OP13,
}
