"""Corpus pipeline over the ``documents`` table: quality rules, line dedup,
near-duplicate documents, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept,
written as Parquet in the shared folder and read again.  All but the last
return the columns of ``documents``; texts and n_chars follow the stages'
decisions:

* quality_rules: rejected documents go;
* line_dedup: texts lose the lines that stand elsewhere already; a document
  of which no line is left goes, one without any line stays;
* near_dedup: one document of each group stays (five-word shingles, similarity
  at least 0.8; 8 trees lose 0.0003 of the pairs at 0.8);
* decontamination: the words of benchmark passages are cut from documents that
  the contamination rule (hit words at least 5 % of all) names; others stay as
  they are;
* byte_bpe: token ids of every document, with digests of ids and decoded bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from salesmart.llm.queries import pre_token_pattern, table, tokenizer
from salesmart.llm.tables import bound_batches, free_name
from salesmart.session import materialize

#: SQL cannot express the hashed, fitted and fuzzy stages.
ORACLE_SQL = None


def _kept(df: DataFrame, keep: Column, columns: list[Column]) -> DataFrame:
    """Rows with ``keep``.  The rows pass an outer explode, so that the
    condition is not pushed below the plan that computes it and done twice."""
    held = df.select(F.explode_outer(F.when(keep, F.array(F.struct(*columns)))).alias("kept_row"))
    return held.where("kept_row is not null").select("kept_row.*")


def _columns(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of ``docs``, with another text and its length if given."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")} if text is not None else {}
    return [new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    return _kept(judged, F.col(f"`{free_name(docs, 'rules')}`.kept"), _columns(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    done = line_dedup.dedup_lines(docs)
    lines = f"`{free_name(docs, 'lines')}`"
    empty = (F.col(f"{lines}.n_lines") > 0) & (F.col(f"{lines}.n_removed") == F.col(f"{lines}.n_lines"))
    return _kept(done, ~empty, _columns(docs, F.col("text")))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    verdicts = near_dedup.near_duplicates(docs, percent=80, trees=8)
    gone = verdicts.where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    others = [c for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "doc_id", "text")
    found = decontaminate.find_contamination(whole, table(spark, sf_dir, "benchmark"), keep=("row", "text"))
    left = F.expr("""
        cast(aggregate(byte_spans, named_struct('at', 0L, 'kept', cast('' as binary)),
          (acc, s) -> named_struct('at', s.last, 'kept', concat(acc.kept,
             substring(cast(text as binary), cast(acc.at + 1 as int), cast(s.first - acc.at as int)))),
          acc -> concat(acc.kept, substring(cast(text as binary), cast(acc.at + 1 as int)))) as string)""")
    judged = found.select("row", F.when(F.expr("n_hit > 0 and 20 * n_hit >= n_words"), left).otherwise(
        F.col("text")).alias("new_text"))
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("bigint")}
    return judged.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    ranks, pattern = tokenizer("byte_bpe_50k.tiktoken"), pre_token_pattern()
    # Stored between the two, so that a task runs one Python worker, not two.
    encoded = materialize(bpe.encode(docs, ranks, pattern), "encoded")
    decoded = bpe.decode(encoded, ranks, pattern)
    return decoded.select(
        "doc_id", "n_tokens", "ids",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("byte_bpe", encode_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
