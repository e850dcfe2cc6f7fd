"""Confidence of recognised text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# The lowest mean confidence of each grade.
GOOD, FAIR = 80.0, 60.0
WORD_LEVEL, COLUMNS = 5, 12


def tsv_words(df: DataFrame, tsv: str = "tsv") -> DataFrame:
    """The words of a tab-separated recognition table in column `tsv`: one row for each counted word, with conf and text.

    The first line is a header; short rows and rows whose level or confidence
    is no number are left out, as are containers, negative confidences and blanks.
    """
    rows = F.slice(t.lines(tsv), 2, F.greatest(F.size(t.lines(tsv)) - 1, F.lit(0)))
    cut = df.withColumn("_row", F.explode(F.transform(rows, lambda r: F.split(r, "\t", -1)))).where(F.size("_row") >= COLUMNS)
    out = cut.withColumns({"level": F.get("_row", F.lit(0)).try_cast("int"), "conf": F.get("_row", F.lit(10)).try_cast("double"), "word": F.get("_row", F.lit(11))}).drop("_row")
    return out.where(counted(F.col("level"), F.col("conf"), F.col("word")))


def counted(level: Column, conf: Column, word: Column) -> Column:
    return (level == WORD_LEVEL) & (conf >= 0) & (t.strip(word) != "")


def quality(words: Column, conf: Column) -> Column:
    """Grade from the number of words and the unrounded mean confidence."""
    return F.when(words == 0, "empty").when(conf >= GOOD, "good").when(conf >= FAIR, "fair").otherwise("review")


#: Confidences of at most this many places are added up exactly, so a mean on the edge of a rounding does not depend on the order of the rows.
EXACT = "decimal(18,9)"


def page_confidence(words: DataFrame, keys: list[str]) -> DataFrame:
    """Word rows (level, conf, word) to one row for each key: word_count, mean_conf (1 place) and quality_flag."""
    use = counted(F.col("level"), F.col("conf"), F.col("word"))
    conf = F.when(use, F.col("conf"))
    exact = conf.try_cast(EXACT)
    sums = F.count_if(use).alias("word_count"), F.sum(exact).alias("_sum"), F.count_if(use & ~F.coalesce(exact.cast("double") == conf, F.lit(False))).alias("_odd"), F.coalesce(F.avg(conf), F.lit(0.0)).alias("_avg")
    out = words.groupBy(*keys).agg(*sums).withColumn("_mean", F.when((F.col("word_count") > 0) & (F.col("_odd") == 0), F.col("_sum") / F.col("word_count")))
    mean_conf = F.coalesce(F.round("_mean", 1).cast("double"), F.round("_avg", 1)).alias("mean_conf")
    return out.select(*keys, "word_count", mean_conf, quality(F.col("word_count"), F.coalesce(F.col("_mean").cast("double"), F.col("_avg"))).alias("quality_flag"))
