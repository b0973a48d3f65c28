"""How far two labellings of the same encounters agree, and what identifies a patient."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantry.functions import scalars as S
from vantry.operators.ranges import overlap_join


def best_pairs(gain: list[list[float]]) -> float:
    """Largest sum of entries of which no two share a row or a column, by shortest augmenting paths over row and column prices."""
    if len(gain) > len(gain[0]):
        gain = [list(column) for column in zip(*gain, strict=True)]
    rows, columns = len(gain), len(gain[0])
    row_price, price, owner = [0.0] * rows, [0.0] * columns, [-1] * columns
    for new in range(rows):
        slack, via, done = [float("inf")] * columns, [-1] * columns, [False] * columns
        row, last = new, -1
        while row >= 0:
            for c in range(columns):
                left = -gain[row][c] - row_price[row] - price[c]
                if not done[c] and left < slack[c]:
                    slack[c], via[c] = left, last
            last = min((c for c in range(columns) if not done[c]), key=slack.__getitem__)
            step = slack[last]
            row_price[new] += step
            for c in range(columns):
                if done[c]:
                    price[c] -= step
                    row_price[owner[c]] += step
                else:
                    slack[c] -= step
            done[last] = True
            row = owner[last]
        while last >= 0:
            before = via[last]
            owner[last] = owner[before] if before >= 0 else new
            last = before
    return sum(gain[r][c] for c, r in enumerate(owner) if r >= 0)


def _shared(refs: pd.Series, hyps: pd.Series, seconds: pd.Series) -> pd.Series:
    """Seconds that the best pairing of each row's speakers shares; pairs that never meet share none."""
    out = []
    for ref, hyp, held in zip(refs, hyps, seconds, strict=True):
        row, column = ({name: k for k, name in enumerate(sorted(set(names)))} for names in (ref, hyp))
        gain = [[0.0] * len(column) for _ in row]
        for r, h, s in zip(ref, hyp, held, strict=True):
            gain[row[r]][column[h]] += float(s)
        out.append(best_pairs(gain))
    return pd.Series(out, dtype="float64")


def der(turns: DataFrame, gold: DataFrame) -> DataFrame:
    """case_id, total_s, miss_s, false_alarm_s, confusion_s, der of turns (case_id, start_s, end_s, speaker) against the gold ones.

    Time is cut at every boundary of a case; in each piece the speakers of both sides count once. Speakers are paired one to one so that most
    seconds agree. A case without gold speech has a null rate; empty turns and those with a null in any column do not count.
    """
    both = gold.withColumn("side", F.lit("ref")).unionByName(turns.withColumn("side", F.lit("hyp")))
    both = both.select("case_id", "side", "speaker", F.col("start_s").cast("double").alias("s"), F.col("end_s").cast("double").alias("e")).dropna().where("e > s")
    # speakers on at a moment are those that began before it and have not ended: counts of open turns, carried from piece to piece
    marks = both.select("case_id", "side", "speaker", F.explode(F.array(F.struct(F.col("s").alias("at"), F.lit(1).alias("d")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("d")))).alias("m"))
    steps = marks.groupBy("case_id", "side", "speaker", F.col("m.at").alias("at")).agg(F.sum("m.d").alias("d"))
    own = Window.partitionBy("case_id", "side", "speaker").orderBy("at")
    runs = steps.withColumn("open", F.sum("d").over(own)).withColumn("until", F.lead("at").over(own)).where("open > 0")
    # two runs of one speaker that touch are one span each: they never overlap
    edge = F.struct("side", F.lit(1).alias("d"), F.col("at").alias("t")), F.struct("side", F.lit(-1).alias("d"), F.col("until").alias("t"))
    line = runs.select("case_id", F.explode(F.array(*edge)).alias("x")).groupBy("case_id", F.col("x.t").alias("t"))
    of = lambda side: F.sum(F.when(F.col("x.side") == side, F.col("x.d")).otherwise(0)).alias(side)
    in_time = Window.partitionBy("case_id").orderBy("t")
    pieces = line.agg(of("ref"), of("hyp")).select("case_id", F.sum("ref").over(in_time).alias("ref"), F.sum("hyp").over(in_time).alias("hyp"), (F.lead("t").over(in_time) - F.col("t")).alias("w"))
    sums = pieces.groupBy("case_id").agg(
        F.sum(F.col("ref") * F.col("w")).alias("total_s"),
        F.sum(F.greatest(F.col("ref") - F.col("hyp"), F.lit(0)) * F.col("w")).alias("miss_s"),
        F.sum(F.greatest(F.col("hyp") - F.col("ref"), F.lit(0)) * F.col("w")).alias("false_alarm_s"),
        F.sum(F.least("ref", "hyp") * F.col("w")).alias("shared_s"),
    )
    side = lambda name, s, e: runs.where(F.col("side") == name).select("case_id", F.col("speaker").alias(name), F.col("at").alias(s), F.col("until").alias(e))
    met = overlap_join(side("ref", "start_s", "end_s"), side("hyp", "r_start", "r_end"), ["case_id"], 60.0)
    seconds = met.groupBy("case_id", "ref", "hyp").agg(F.sum(F.least("end_s", "r_end") - F.greatest("start_s", "r_start")).alias("seconds"))
    # a case has a pair or so for each of its speakers, so many cases go to Python together
    pairs = seconds.groupBy("case_id").agg(F.collect_list(F.struct(F.col("ref").cast("string").alias("ref"), F.col("hyp").cast("string").alias("hyp"), "seconds")).alias("p"))
    same = pairs.select("case_id", F.pandas_udf(_shared, "double")("p.ref", "p.hyp", "p.seconds").alias("same"))
    out = sums.join(same, "case_id", "left").withColumn("confusion_s", F.col("shared_s") - F.coalesce("same", F.lit(0.0)))
    rate = F.try_divide(F.col("miss_s") + F.col("false_alarm_s") + F.col("confusion_s"), F.col("total_s")).alias("der")
    return out.select("case_id", "total_s", "miss_s", "false_alarm_s", "confusion_s", rate)


def annotator_agreement(texts: DataFrame) -> DataFrame:
    """case_id, first, second, wer: error rates between every two annotators of a case (case_id, annotator, text), the first by name as reference.

    A few people annotate a case, so its pairs are few. Null texts and annotators have no pairs."""
    one = texts.dropna(subset=["case_id", "annotator", "text"])
    left = one.select("case_id", F.col("annotator").alias("first"), F.col("text").alias("a"))
    right = one.select("case_id", F.col("annotator").alias("second"), F.col("text").alias("b"))
    both = left.join(right, "case_id").where("first < second")
    return both.select("case_id", "first", "second", S.word_error_rate(S.normalized_text(F.col("a")), S.normalized_text(F.col("b"))).alias("wer"))


def bare(word: Column) -> Column:
    """A word without letter case and the punctuation around it."""
    return F.lower(F.regexp_replace(word, r"^\p{P}+|\p{P}+$", ""))


def phi_tagged(words: DataFrame, names: DataFrame) -> DataFrame:
    """words (case_id, word, ...) with tags for what identifies: the case's own names (case_id, name of one word, tag), dates, numbers of six digits or more.

    The name decides before the patterns; of several tags of a name the least. Null words stay null."""
    known = names.select("case_id", bare(F.col("name")).alias("_bare"), "tag").where("_bare <> ''").groupBy("case_id", "_bare").agg(F.min("tag").alias("_tag"))
    found = words.withColumn("_bare", bare(F.col("word"))).join(known, ["case_id", "_bare"], "left")
    pattern = F.when(F.col("_bare").rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}$"), "[DOB]").when(F.col("_bare").rlike(r"^[0-9]{6,}$"), "[ID]")
    return found.withColumn("word", F.coalesce("_tag", pattern, "word")).select(*words.columns)


#: Chances that a Poisson number of mean 1 is at most 0, 1, 2, ...
POISSON = (0.367879441171, 0.735758882343, 0.919698602929, 0.981011843124, 0.996340153173, 0.999405815182, 0.999916758850)


def error_confidence(items: DataFrame, group: str, key: str, errors: str, size: str, draws: int = 100, level: float = 0.95) -> DataFrame:
    """group, rate, low, high: errors over size of each group, with the bounds of a bootstrap over items.

    Each item counts a Poisson number of times in a draw, taken from a hash of its key and the draw, so runs repeat and no group is gathered.
    """
    drawn = items.select(group, key, errors, size).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    chance = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(":"), F.col("draw").cast("string"))), 1, 8), 16, 10).cast("double") / 2.0**32
    weight = sum((F.when(chance > p, 1).otherwise(0) for p in POISSON[1:]), F.when(chance > POISSON[0], 1).otherwise(0))
    sums = drawn.withColumn("w", weight).groupBy(group, "draw").agg(F.sum(F.col(errors) * F.col("w")).alias("e"), F.sum(F.col(size) * F.col("w")).alias("n"))
    rates = sums.select(group, F.try_divide("e", "n").alias("r"))
    tail = (1 - level) / 2
    bounds = rates.groupBy(group).agg(F.percentile("r", F.lit(tail)).alias("low"), F.percentile("r", F.lit(1 - tail)).alias("high"))
    return items.groupBy(group).agg(F.try_divide(F.sum(errors), F.sum(size)).alias("rate")).join(bounds, group)
