"""A corpus from documents in five stages, each an operator of chronopix.llm, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.llm import decontaminate, langid, mixing, simhash, toxicity
from chronopix.llm.common import forget, fresh, scope, written


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


#: A document whose best language is no nearer than this is in none that was learned. Texts of the languages learned that have
#: OWN n-grams score 0.7 and more, of unrelated ones 0.4 and less; those of few n-grams say too little to reject them.
LEAST_SCORE, LEAST_LETTERS = 0.45, 60


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language that could be learned. Profiles are learned as for op10, from the rows with a lang.

    Null, empty and letterless texts go, and texts of LEAST_LETTERS letters or more whose nearest profile scores under LEAST_SCORE: other
    languages, other scripts, noise. Shorter ones stay. A profile of fewer than OWN n-grams judges nothing: documents that are declared to be in its language
    stay, as do all with letters where no language has a longer one. Columns of any name are left alone.
    """
    known = langid.profiles(docs.where(~langid.held_out()).select("text", "lang"))
    thin = [n for n, p in known.items() if len(p) < langid.OWN]
    pred, score = fresh(docs, "lang_pred", "lang_score")
    found = langid.identify(docs, known, unlearned="any", names=(pred, score))
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    foreign = F.lit(len(thin) < len(known)) & ~F.coalesce(F.col("lang").isin(thin), F.lit(False)) & (F.col(score) < LEAST_SCORE) & (letters >= LEAST_LETTERS)
    return _columns(found.where((F.col(pred) != "und") & ~foreign), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity reaches the threshold of op9, learned from the labelled ones among docs.

    Null, empty and wordless texts stay, as do all where no toxic one is labelled. Columns of any name are left alone.
    """
    (name,) = fresh(docs, "toxicity")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.held_out)
    return _columns(toxicity.score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD), docs)


#: Words of a shingle, and the similarity from which on two texts are near copies.
SHINGLE, SIMILAR = 5, 0.8


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, five-word shingles at a similarity of 0.8 as wide fingerprints tell it, the document of the smallest id stays; of rows that share it, the one of least hash.

    Exact copies always go, null, empty and blank texts being copies of each other. Columns of any name are left alone.
    """
    return _columns(simhash.keep_one(docs, SHINGLE, SIMILAR), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that op8 calls contaminated go; others, null and empty texts among them, stay as they are, columns of any name included."""
    return _columns(decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training plan of op4 over what is left: words taken and the position in every pass of every document, repeated rows and ids each; null and empty texts with 0 words."""
    return mixing.curriculum(docs)


STAGES = [("language", language), ("toxicity", toxic), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixture", mixture)]

#: Learned stages and graph components are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's tables go when its result is written, and that when the next one's is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scope() as keep:
            new = keep(written(stage(spark, docs, sf_dir), f"stage-{name}"))
        forget(docs)
        docs = new
    return docs
