"""The corpus pipeline: stages over documents, each one an operator of hourlens.llm.

    quality rules -> n-gram Jaccard join -> decontamination -> mixing -> token ids

Every stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before it wrote, and all but the
last return the columns of ``documents``.  ``run`` applies them in turn, writing each stage's rows
under the shared folder.

Copies: of the documents one component of the Jaccard join holds, the one with the smallest doc_id stays;
documents without an id are compared, too, and of rows that repeat a doc_id and its text one stays.
Mixing emits a document once per copy it draws, so a doc_id may come twice after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.llm import decontaminate, mixing, ngram_join, quality_rules, token_store
from hourlens.llm.common import Stages, hash_pair
from hourlens.llm.queries import table, tokenizer_json
from hourlens.llm.registry import query
from hourlens.session import tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NGRAM, RATIO = 5, (80, 100)          # word shingles of the near-duplicate stage


def _on(id_column: str, hash_column: str):
    return F.col("doc_id").eqNullSafe(F.col(id_column)) & (F.xxhash64("text") == F.col(hash_column))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what fails the base rule or is depleted; boilerplate lines leave the rest."""
    verdict, lines = quality_rules.judge(docs.withColumn("host", F.col("source")))
    kept = verdict.where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "host").distinct()
    bad = lines.select(F.col("host").alias("_host"), F.col("text_hash").alias("_text"), "boilerplate")
    kept = kept.join(bad, F.col("host").eqNullSafe(F.col("_host")) & (F.col("_hash") == F.col("_text")),
                     "left").select("_id", "_hash", "host", "boilerplate")
    rows = docs.select(*COLUMNS).join(
        kept.hint("shuffle_hash"), _on("_id", "_hash") & F.col("source").eqNullSafe(F.col("host")))
    clean = quality_rules.without_lines(rows, ["doc_id", "lang", "source", "n_chars"])
    # a text that lost no line keeps its count as it was
    return clean.select("doc_id", "text", "lang", "source", F.when(
        F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")).alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays; documents without words all stay.

    A document is a doc_id and a text: the smallest id leads, then the smallest text hash, documents without
    an id come last.  Of rows that repeat a doc_id (or none) and a text with words the smallest stays."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                   *[h.alias(f"h{k}") for k, h in enumerate(hash_pair(F.col("text")))])
    linked = ngram_join.link_components(docs.select(key.alias("doc_id"), "text"), NGRAM, RATIO)
    lead = Stages(spark, "copies").write(linked.where("doc_id = component_id").groupBy(
        F.col("doc_id").alias("_key")).agg(
        ((F.max("n_shingles") > 0) & (F.count("*") > 1)).alias("_alike")))
    rows = docs.select(*COLUMNS)
    alone = rows.join(lead.where("not _alike").hint("shuffle_hash"), key == F.col("_key")).select(*COLUMNS)
    repeated = lead.where("_alike")
    if repeated.isEmpty():
        return alone
    alike = rows.join(repeated.hint("shuffle_hash"), key == F.col("_key")).groupBy("_key").agg(
        F.min(F.struct(*COLUMNS)).alias("row"))
    return alone.unionByName(alike.select("row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    hits = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"))
    clean = hits.where("size(spans) > 0").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.select(*COLUMNS).join(clean.hint("shuffle_hash"), _on("_id", "_hash"), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix draws it."""
    drawn = mixing.draw(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"),
                                    mixing.word_count(F.col("text")).alias("size")),
                        ["doc_id", "text_hash", "source"])
    drawn = Stages(spark, "mixed").write(
        drawn.groupBy("doc_id", "text_hash", "source").agg(
            F.sum("copies").alias("copies"), F.count("*").alias("alike")).where("copies > 0").select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
            F.col("source").alias("_source"), "copies", "alike"))
    same = _on("_id", "_hash") & F.col("source").eqNullSafe(F.col("_source"))
    own = docs.select(*COLUMNS)
    rows = own.join(drawn.where("alike = 1").hint("shuffle_hash"), same)
    repeated = drawn.where("alike > 1")
    if not repeated.isEmpty():          # rows of one document and text share the copies they drew
        rows = rows.unionByName(own.join(repeated.hint("shuffle_hash"), same)
                                .dropDuplicates(["_id", "_hash", "_source"]))
    return rows.select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
                       .alias("_copy")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token store; returns doc_id, start, n_tokens and ids_crc32 from its files."""
    return token_store.token_report(docs.select("doc_id", "text"), tokenizer_json())


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminated), ("mixing", mixed), ("token ids", tokens)]
ORACLE_SQL = None       # token ids are beyond SQL; tests/llm compares with a brute-force run


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    tune(spark)
    docs, stages = table(spark, sf_dir, "documents"), Stages(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
