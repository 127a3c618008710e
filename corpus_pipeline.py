"""From raw documents to packed token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor
kept, and its result is written as Parquet before the next one reads it. All
but the last return the columns of ``documents``.

Defined results: rows with a null or letterless text go in the first stage, but
where no row is labelled nothing is learned and every row stays; rows that share
an id are one document to the second stage, which keeps or drops them together
and makes one row of those that repeat a text; rows with a null id are kept apart
(they link with nothing); a document that the mix gives twice is two rows of
the last stage; an empty table passes through as an empty one. Columns that have
a name an operator uses come through as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, entries, language_id, mixing, ngram_join, token_output
from tessera.llm.common import materialise, read, ship
from tessera.session import quote_ident, scratch_path

#: The language model and the mixture have no SQL form; tests/llm has brute-force versions of the stages.
ORACLE_SQL = None


def _apart(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list]:
    """``docs`` with its own columns of these names, or of names that need quotes, renamed; and the columns that give ``docs`` back."""
    aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in names or not c.isidentifier()}
    back = [F.col(quote_ident(aside.get(c, c))).alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(aside), back


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones; the undetermined go."""
    ship(spark)
    model = language_id.fit(docs.where(~entries.held_out()))
    if not model.languages:
        return docs
    rows, back = _apart(docs, ("lang_pred", "score", "_known", "_best"))
    return language_id.predict(rows, model).where("lang_pred <> 'und'").select(back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of n-gram sets linked at 0.75 or more."""
    ship(spark)
    first = (ngram_join.link_sets(docs, label="pipeline-ngrams").where("doc_id = component_id")
             .select("doc_id").distinct())
    rest = F.struct(*[F.col(quote_ident(c)) for c in docs.columns if c != "doc_id"])
    kept = (docs.join(materialise(first, "pipeline-first"), "doc_id", "left_semi")
            .groupBy("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("__hash"))
            # as text, since a map has no order
            .agg(F.min_by(rest, F.to_json(F.struct(*[F.col(quote_ident(c)) for c in docs.columns if c != "text"]))).alias("__row"))
            .select("doc_id", "__row.*"))
    return kept.select(*map(quote_ident, docs.columns)).union(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    ship(spark)
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as before, the sources as even as at most two repeats of any allow."""
    ship(spark)
    rows, back = _apart(docs, ("block", "block_order", "copies", "cut", "_block", "_hash", "_s", "_b", "_order", "_copies", "_copy"))
    return mixing.mixed(rows, budget_ratio=1.0, max_repeats=2.0, label="pipeline-mix").select(back)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed ids of what is left, read back from their files."""
    ship(spark)
    path = scratch_path(spark, "pipeline-ids")
    token_output.write_ids(docs, path, entries.tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return token_output.read_documents(spark, path)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
