"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept. All but the last return the columns that they were given, whatever these are
besides doc_id and text; an empty table gives an empty one. ``run`` chains them,
writing each stage's rows as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwash.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from starwash.llm.common import save, table
from starwash.llm.queries import tokenizer_file

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    """id and text, and all other columns in a struct that no operator looks into."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("row"))


def _back(rows: DataFrame, columns: list[str], **changed) -> DataFrame:
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **changed}
    return rows.select(*[own[c] if c in own else F.col("row").getField(c).alias(c) for c in columns])


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; null and empty texts have the score of the bias alone."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.training_rows())
    return _back(toxicity.score(_rows(docs), model).filter("predicted = 0"), docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of words that stand earlier, ``n_chars`` counted anew where a text has changed;
    documents of which nothing is left go, null and empty texts stay as they are."""
    changed = F.col("n_removed") > 0
    kept = line_dedup.dedup_lines(_rows(docs)).filter(~changed | (F.trim("text") != ""))
    n_chars = None
    if "n_chars" in docs.columns:
        n_chars = F.when(changed, F.length("text")).otherwise(F.col("row").getField("n_chars")).cast("long")
    return _back(kept, docs.columns, **({"n_chars": n_chars.alias("n_chars")} if n_chars is not None else {}))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id. Texts without words, and rows
    without an id, are in no group and stay."""
    dropped = near_dedup.near_duplicates(docs.select("doc_id", "text")).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; texts without words stay."""
    return _back(decontaminate.decontaminate(_rows(docs), table(spark, sf_dir, "benchmark")), docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences; a null or empty text is its end token alone."""
    return packing.pack_documents(docs, tokenizer_file(), tokenizer_file("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("packing", pack_tokens),
]

#: no SQL for a trained classifier, sketches or a tokenizer: the stages are tested one by one, the chain has no brute-force test
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, name)
    return docs
