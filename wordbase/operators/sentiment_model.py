"""A model of the sentiment of words, learnt from words that have a label: logistic regression over hashed character n-grams.

Features, fitting and scoring are Spark's own and run without Python workers. A fitted model is a ``PipelineModel``: it can be saved and
loaded, and ``sentiment.score_sentiment`` takes it as a scorer.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordbase.runtime import stored

POSITIVE, NEGATIVE = "positive", "negative"
SHORTEST, LONGEST = 1, 4
FEATURES = 1 << 14
PENALTY = 0.01
ROUNDS = 50


def character_grams(word: Column) -> Column:
    """The distinct n-grams of a word with a mark at either end, as an array."""
    marked = F.concat(F.lit("^"), word, F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1)))
        return F.transform(starts, lambda at: F.substring(marked, at, F.lit(n)))

    return F.array_distinct(F.concat(*(of_length(n) for n in range(SHORTEST, LONGEST + 1))))


def _with_grams(words: DataFrame) -> DataFrame:
    return words.withColumn("grams", character_grams(F.coalesce("word", F.lit(""))))


def fit(labelled: DataFrame, features: int = FEATURES, penalty: float = PENALTY, rounds: int = ROUNDS) -> PipelineModel:
    """A model of ``word, label`` and, if there is one, ``weight``; rows with other labels than positive and negative teach nothing.

    What a word teaches is a sparse row of its n-grams, so a round costs the letters of the words, spread over all tasks; the driver holds ``features`` numbers.
    The result depends on the rows alone, up to the order in which sums are added.
    """
    rows = labelled.where(F.col("label").isin(POSITIVE, NEGATIVE) & F.col("word").isNotNull())
    weight = F.col("weight").cast("double") if "weight" in labelled.columns else F.lit(1.0)
    rows = stored(rows.select("word", (F.col("label") == POSITIVE).cast("double").alias("is_positive"), weight.alias("weight")), "labelled")
    if rows.isEmpty():
        raise ValueError("no word has a label to learn from")
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=features, binary=True)
    regression = LogisticRegression(labelCol="is_positive", weightCol="weight", regParam=penalty, maxIter=rounds, standardization=False)
    return Pipeline(stages=[hashing, regression]).fit(_with_grams(rows))


def predicted(words: DataFrame, model: PipelineModel) -> DataFrame:
    """``words`` with ``label`` and ``score``, the probability of that label; half and half is positive."""
    positive = F.get(vector_to_array("probability"), F.lit(1))
    made = model.transform(_with_grams(words)).withColumn("positive", positive)
    label = F.when(F.col("positive") >= 0.5, POSITIVE).otherwise(NEGATIVE)
    return made.select(*words.columns, label.alias("label"), F.greatest("positive", 1 - F.col("positive")).alias("score"))


def report(labelled: DataFrame, model: PipelineModel) -> DataFrame:
    """One row about words with a known label, which the model should not have seen: how many, how many it has right, and how many the more frequent label has."""
    known = labelled.where(F.col("label").isin(POSITIVE, NEGATIVE)).select("word", F.col("label").alias("known"))
    return predicted(known, model).agg(
        F.count("*").alias("words"),
        F.count_if(F.col("label") == F.col("known")).alias("right"),
        F.greatest(F.count_if(F.col("known") == POSITIVE), F.count_if(F.col("known") == NEGATIVE)).alias("most_frequent"),
    )
