"""Property tests: rule classifiers and bands vs a plain Python statement."""

import random
import re

from pyspark.sql import functions as F

from relist.functions import classify as C


def _py_classify(text, rules, default):
    for i, (label, pat) in enumerate(rules, start=1):
        if text is not None and re.search(pat, text):
            return i, label
    return len(rules) + 1, default


def test_category_and_condition_vs_python(spark):
    rnd = random.Random(13)
    words = ["robe", "jean", "lot de 3", "bébé", "basket", "veste", "pull", "sac", "pyjama", "sport", "top",
             "très bon état", "bon état", "neuf avec étiquette", "usé", "tache", "léger", "x2", "12 mois",
             "nouveau-né", "sous-vêtement", "rien", "é", " ", "ROBE", "Très Bon État"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 5))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(C.category(F.col("t")).alias("c"), C.condition(F.col("t"), F.lit("")).alias("k"),
                    C.never_worn(F.col("t"), F.lit(None)).alias("n"), C.is_bulk(F.col("t")).alias("b")).collect()
    for t, r in zip(texts, got):
        low = (t or "").lower()
        assert (r.c.ord, r.c.label) == _py_classify(low, C.CATEGORY_RULES, C.CATEGORY_DEFAULT), t
        assert (r.k.ord, r.k.label) == _py_classify(low + " ", C.CONDITION_RULES, C.CONDITION_DEFAULT), t
        assert r.n == bool(re.search(C.NEVER_WORN_PATTERN, low + " ")), t
        assert r.b == bool(re.search(C.BULK_PATTERN, low)), t


def test_bands_vs_python(spark):
    rnd = random.Random(17)
    values = [None] + [round(rnd.uniform(-5, 600), 2) for _ in range(300)] + [0.0, 5.0, 10.0, 30.0, 499.99, 500.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(C.bucketize(F.col("v"), C.PRICE_BANDS).alias("p"),
                    C.bucketize(F.col("v"), C.AGE_BANDS, inclusive=True).alias("a")).collect()

    def band(v, bounds, inclusive):
        for i, (b, label) in enumerate(bounds, start=1):
            if b is not None and v is not None and (v <= b if inclusive else v < b):
                return i, label
        return next((i, label) for i, (b, label) in enumerate(bounds, start=1) if b is None)
    for v, r in zip(values, got):
        assert (r.p.ord, r.p.label) == band(v, C.PRICE_BANDS, False), v
        assert (r.a.ord, r.a.label) == band(v, C.AGE_BANDS, True), v
