"""Segmentation metrics and losses as aggregates. Only K x K counts, or sums, are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterweave.model import IGNORE, N_CLASSES
from rasterweave.operators.stats import weight_map


def of_size(values: Column, k: int) -> Column:
    """The first k values of an array, null where it has fewer."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get(values, i))


def softmax(logits: Column) -> Column:
    """A null logit leaves all of them unknown."""
    top = F.array_max(logits)
    raised = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def argmax_class(scores: Column) -> Column:
    """Of equals, the least id; 0 where no score is known."""
    return F.when(scores.isNotNull(), F.coalesce(F.array_position(scores, F.array_max(scores)) - 1, F.lit(0))).cast("int")


def one_hot(target: Column, k: int = N_CLASSES) -> Column:
    """Targets beyond the last class count as the last."""
    t = F.least(F.greatest(target, F.lit(0)), F.lit(k - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == t, 1).otherwise(0))


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """pred, target, n; ignored targets are left out."""
    return pairs.where(F.col("target") != IGNORE).groupBy("pred", "target").agg(F.count("*").alias("n"))


def iou(confusion: DataFrame, k: int = N_CLASSES) -> DataFrame:
    """class_id, inter, union_, iou (null without pixels) and miou, the mean over classes that have some, 0 if none has."""
    hit = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    sums = confusion.agg(*[F.struct(hit((F.col("pred") == i) & (F.col("target") == i)).alias("inter"), hit(F.col("pred") == i).alias("p"), hit(F.col("target") == i).alias("t")).alias(f"c{i}") for i in range(k)])
    rows = sums.select(F.posexplode(F.array(*[F.col(f"c{i}") for i in range(k)])).alias("class_id", "s"))
    inter, union = F.coalesce("s.inter", F.lit(0)), F.coalesce(F.col("s.p") + F.col("s.t") - F.col("s.inter"), F.lit(0))
    rows = rows.select("class_id", inter.alias("inter"), union.alias("union_")).withColumn("iou", F.when(F.col("union_") > 0, F.col("inter") / F.col("union_")))
    return rows.withColumn("miou", F.coalesce(F.avg("iou").over(Window.partitionBy()), F.lit(0.0)))


def focal_terms(scores: DataFrame, weights: dict[int, float], gamma: float = 2.0, k: int = N_CLASSES) -> DataFrame:
    """scores (logits, target) with the focal term of each pixel: (1 - exp(-ce))^gamma * ce of the weighted cross entropy; 0 where the target is ignored, null where one of k logits is not there."""
    logits = of_size(F.col("logits"), k)
    top = F.array_max(logits)
    lse = top + F.log(F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - top)))
    ce = weight_map(weights)[F.col("target")] * (lse - F.get(logits, F.col("target")))
    with_ce = scores.withColumn("ce", F.when(F.col("target") != IGNORE, ce))
    return with_ce.withColumn("focal", F.when(F.col("target") == IGNORE, 0.0).otherwise(F.pow(1 - F.exp(-F.col("ce")), gamma) * F.col("ce")))


def focal_loss(scores: DataFrame, weights: dict[int, float], gamma: float = 2.0) -> DataFrame:
    return focal_terms(scores, weights, gamma).agg(F.avg("focal").alias("focal"))


def dice_loss(scores: DataFrame, image: str = "tile_id", k: int = N_CLASSES, smooth: float = 1e-6) -> DataFrame:
    """1 - (2 * overlap + smooth) / (total + smooth) per image and class, mean over classes from 1; an ignored target counts as the last class. A pixel that lacks logits adds to no sum of probabilities."""
    probs = scores.withColumn("p", softmax(of_size(F.col("logits"), k))).withColumn("t", F.least("target", F.lit(k - 1)))
    sums = []
    for i in range(1, k):
        hot = (F.col("t") == i).cast("double")
        sums += [F.sum(F.col("p")[i] * hot).alias(f"o{i}"), (F.sum(F.col("p")[i]) + F.sum(hot)).alias(f"s{i}")]
    dice = [1 - (2 * F.col(f"o{i}") + smooth) / (F.col(f"s{i}") + smooth) for i in range(1, k)]
    per_image = probs.groupBy(image).agg(*sums).select((sum(dice[1:], dice[0]) / (k - 1)).alias("d"))
    return per_image.agg(F.avg("d").alias("dice"))


def combined_loss(scores: DataFrame, weights: dict[int, float], focal_part: float = 0.5, dice_part: float = 0.5) -> DataFrame:
    both = focal_loss(scores, weights).crossJoin(dice_loss(scores))
    return both.withColumn("loss", focal_part * F.col("focal") + dice_part * F.col("dice"))


def epoch_metrics(batches: DataFrame) -> DataFrame:
    return batches.groupBy("run_id", "phase", "epoch").agg(F.avg("loss").alias("loss"))


def best_epoch(epochs: DataFrame) -> DataFrame:
    """run_id, best_epoch (the first of the largest val_miou), best, epochs."""
    return epochs.groupBy("run_id").agg(F.max_by("epoch", F.struct("val_miou", -F.col("epoch"))).alias("best_epoch"), F.max("val_miou").alias("best"), F.count("*").alias("epochs"))


def class_means(pixels: DataFrame, bands: int, weight: str = "n") -> dict[int, list[float]]:
    """The weighted mean of each band per class of labelled pixels (bands, target, weight): the least model that can be fitted in one pass. A row per class."""
    value = lambda i: F.get("bands", F.lit(i))
    mean = lambda i: F.sum(value(i) * F.col(weight)) / F.sum(F.when(value(i).isNotNull(), F.col(weight)))
    rows = pixels.where(F.col("target") != IGNORE).groupBy("target").agg(F.array(*[mean(i) for i in range(bands)]).alias("means"))
    return {r.target: list(r.means) for r in rows.collect()}


def nearest_mean(bands: Column, means: dict[int, list[float]]) -> Column:
    """The class whose mean is nearest, of equals the least; null without any."""
    if not means:
        return F.lit(None).cast("int")
    far = lambda m: sum(((bands[i] - x) * (bands[i] - x) for i, x in enumerate(m)), F.lit(0.0))
    return F.array_min(F.array(*[F.struct(far(m).alias("far"), F.lit(c).alias("class_id")) for c, m in sorted(means.items())]))["class_id"]
