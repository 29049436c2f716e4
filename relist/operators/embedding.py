"""Text → vector: the hook in front of the vector search.

An encoder is any Spark ML transformer from a text column to a vector column.
The default needs no model and no training: words are cut at everything that
is no letter or digit and lower-cased, counted in hashed buckets (murmur3)
and scaled to length 1.  A learnt encoder, or one that calls a model in
batches, is passed in its place; the search takes the vectors as they come."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vector_search import match_to_corpus

WORDS = r"[\p{L}\p{N}]+"
BUCKETS = 256
_IN, _OUT = "_text", "_vector"


def hashed_words(buckets: int = BUCKETS, pattern: str = WORDS) -> PipelineModel:
    """Words → hashed counts → unit length; no stage has anything to fit."""
    return PipelineModel(stages=[
        RegexTokenizer(inputCol=_IN, outputCol="_words", pattern=pattern, gaps=False, toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=buckets),
        Normalizer(inputCol="_counts", outputCol=_OUT, p=2.0)])


def embed(df: DataFrame, text: str, out: str = "vec", encoder: Transformer | None = None) -> DataFrame:
    """``df`` with the vector of ``text`` as an array of doubles; a null text
    is encoded as an empty one (a zero vector here)."""
    model = encoder if encoder is not None else hashed_words()
    coded = model.transform(df.withColumn(_IN, F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return coded.select(*[F.col(f"`{c}`") for c in df.columns if c != out], vector_to_array(_OUT).alias(out))


def match_texts(queries: DataFrame, corpus: DataFrame, qid: str, qtext: str, cid: str, ctext: str, k: int = 3,
                encoder: Transformer | None = None, **layout) -> DataFrame:
    """The k closest corpus texts of every query text: (qid, rank, cid, score)."""
    asked = embed(queries.select(qid, qtext), qtext, "_qvec", encoder)
    known = embed(corpus.select(cid, ctext), ctext, "_cvec", encoder)
    return match_to_corpus(asked, known, k, qid, "_qvec", cid, "_cvec", **layout)
