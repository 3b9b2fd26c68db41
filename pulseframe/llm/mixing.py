"""Soft-membership mixing: document rates whose expected domain token totals match target weights.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.session import scratch_path

# Domains of a labelled document, in the order they are tried; the last one is the rest. Each but the
# last is one question, with a classifier of its own, so a document that is both toxic and poor is toxic.
DOMAINS = ("toxic", "poor", "good")
# Wanted part of all expected tokens of each domain.
TARGET = {"toxic": 0.0, "poor": 0.1, "good": 0.9}
# About so many labelled rows at most fit the classifier, chosen by a hash of the id.
LABELLED = 20_000
# A feature counts if it is in so many labelled rows, and is so many times as frequent in one domain
# as in the others, by so many standard deviations; of those the strongest are used.
LEAST_ROWS, LEAST_LIFT, LEAST_DEVIATION, FEATURES = 5, 6.0, 5.0, 20_000
# Posteriors are taken to three decimals, so documents fall into a bounded number of cells.
DIGITS = 3
# Weight of the rates' change from 1 beside the domains' totals: a document that is certainly of an
# unwanted domain keeps this rate. The fit ends at a gradient of this part of each domain's words.
RIDGE, TOLERANCE = 1e-3, 1e-5
# Lengths of a step that are tried at once, each half of the one before.
TRIED = 4


def domain_of(quality: Column, toxic: Column) -> Column:
    """Index into DOMAINS; null where a label that decides is missing."""
    return F.when(toxic == 1, 0).when(toxic.isNull(), None).when(quality == 0, 1).when(quality == 1, 2)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def with_features(docs: DataFrame, text: str) -> DataFrame:
    """``_n``, the number of words, and ``_features``: the different words and the shape of a text.

    Shapes (shares of other characters, capitals and different words, word length, number of words)
    are features like words, by steps; their names have a space, which no word has.
    """
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = F.filter(F.split(F.lower(plain), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def features(words: Column, different: Column) -> Column:
        size = F.greatest(F.length(plain), F.lit(1))
        capitals = F.length(plain) - F.length(F.translate(plain, UPPER, ""))
        letters, n = F.length(F.array_join(words, "")), F.greatest(F.size(words), F.lit(1))
        shapes = {
            "other": F.floor(20 * (1 - letters / size)),
            "capitals": F.floor(20 * capitals / size),
            "different": F.floor(20 * F.size(different) / n),
            "length": F.floor(2 * letters / n),
            "words": F.floor(F.log2(F.size(words) + 1)),
        }
        named = F.array(*[F.concat(F.lit(f"{k} "), v.cast("string")) for k, v in shapes.items()])
        return F.struct(F.size(words).cast("long").alias("n"), F.concat(different, named).alias("features"))

    # Arrays of one element and their lambdas make Spark split a text once, whatever is taken from it.
    different = F.transform(F.array(words), lambda w: F.struct(w.alias("w"), F.array_distinct(w).alias("d")))
    found = F.transform(different, lambda x: features(x["w"], x["d"]))
    docs = docs.withColumn("_found", F.explode(found))
    return docs.withColumns({"_n": F.col("_found.n"), "_features": F.col("_found.features")}).drop("_found")


# Yes or no to each question of a labelled document; null where the label is missing.
QUESTIONS = {"toxic": "cast(toxic as int)", "poor": "1 - cast(quality as int)"}


def answers(labels: DataFrame, doc_id: str) -> DataFrame:
    """(_id, _toxic, _poor) of every labelled document; of labels that contradict each other yes counts."""
    each = labels.select(F.col(f"`{doc_id}`").alias("_id"), *[F.expr(v).alias(f"_{q}") for q, v in QUESTIONS.items()])
    return each.filter("_id is not null").groupBy("_id").agg(*[F.max(f"_{q}").alias(f"_{q}") for q in QUESTIONS])


def fit_classifier(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, most: int = LABELLED):
    """Naive Bayes over significant features, for each question: (feature, w: by question), and log odds without any.

    A feature that is there adds its log odds ratio; the log odds without any hold what it means that
    none is. A feature speaks on the questions only for which it is significant.

    ``labels`` has the id, ``quality`` and ``toxic`` (0 or 1). Rows without a text are left out, and a
    row without a label says nothing on its question; repeated labels count once. Without any
    label the answer is no.
    """
    spark = docs.sparkSession
    names = list(QUESTIONS)
    known = answers(labels, doc_id)
    n = known.count()
    part = 1.0 if n <= most else most / n
    known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * part))
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")).filter("_text is not null")
    # At most about LABELLED small rows.
    rows = rows.join(F.broadcast(known), "_id")
    path = scratch_path(spark, "labelled")
    found = with_features(rows, "_text").select(*[f"_{q}" for q in names], F.explode("_features").alias("feature"))
    of = [F.count_if(F.col(f"_{q}") == v).alias(f"{q}{v}") for q in names for v in (0, 1)]
    found.groupBy("feature").agg(*of).write.parquet(path)
    counts = spark.read.parquet(path)
    sizes = rows.agg(*of).first().asDict()
    weights, without, off = {}, {}, {}
    for q in names:
        size = [sizes[f"{q}{v}"] for v in (0, 1)]
        every = max(sum(size), 1)
        have = [F.col(f"{q}{v}") for v in (0, 1)]
        both = have[0] + have[1]
        there = [(have[v] + 0.5) / (size[v] + 1) for v in (0, 1)]
        significant = []
        for v in (0, 1):
            usual = both * (size[v] / every)
            more = (have[v] - usual) / F.sqrt(usual * (1 - size[v] / every) + 0.25)
            significant.append(F.when(there[v] >= LEAST_LIFT * there[1 - v], more).otherwise(0.0))
        off[q] = F.when(both >= LEAST_ROWS, F.greatest(*significant)).otherwise(0.0)
        speaks = off[q] >= LEAST_DEVIATION
        ratio = F.log(there[1] / (1 - there[1])) - F.log(there[0] / (1 - there[0]))
        weights[q] = F.when(speaks, ratio).otherwise(0.0)
        without[q] = F.when(speaks, F.log(1 - there[1]) - F.log(1 - there[0])).otherwise(0.0).alias(f"m_{q}")
    strong = counts.withColumn("off", F.greatest(*off.values())).filter(F.col("off") >= LEAST_DEVIATION)
    strong = strong.orderBy(F.desc("off"), "feature").limit(FEATURES)
    strong = strong.select("feature", F.array(*weights.values()).alias("w"), *without.values())
    path = scratch_path(spark, "classifier")
    strong.write.parquet(path)
    model = spark.read.schema(strong.schema).parquet(path)
    none = model.agg(*[F.coalesce(F.sum(f"m_{q}"), F.lit(0.0)) for q in names]).first()
    prior = [
        float(np.log((sizes[f"{q}1"] + 1e-9) / (sizes[f"{q}0"] + (1e-9 if sizes[f"{q}1"] else 1.0))) + m)
        for q, m in zip(names, none, strict=True)
    ]
    return model.select("feature", "w"), prior


def memberships(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, row: str) -> DataFrame:
    """(row, _n, _p) for each row of ``docs``: words, and posteriors by domain, rounded.

    A domain's posterior is the probability that its question is the first one with the answer yes. A
    document that is labelled itself has the answer of its label, all others that of the classifier.
    """
    model, prior = fit_classifier(docs, labels, text, doc_id)
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in ((row, "row"), (doc_id, "_id"), (text, "_text"))])
    each = with_features(rows, "_text").select("row", "_id", "_n", F.explode("_features").alias("feature"))
    # FEATURES rows at most.
    each = each.join(F.broadcast(model), "feature", "left")
    odds = [F.coalesce(F.sum(F.col("w")[i]), F.lit(0.0)) + v for i, v in enumerate(prior)]
    judged = [(1 / (1 + F.exp(-x))).alias(f"_judged_{q}") for q, x in zip(QUESTIONS, odds, strict=True)]
    scored = each.groupBy("row", "_id").agg(F.max("_n").alias("_n"), *judged)
    scored = scored.join(answers(labels, doc_id), "_id", "left")
    parts, rest = [], F.lit(1.0)
    for q in QUESTIONS:
        yes = F.coalesce(F.col(f"_{q}").cast("double"), F.col(f"_judged_{q}"))
        parts.append(rest * yes)
        rest = rest * (1 - yes)
    return scored.select("row", "_n", F.array(*[F.round(x, DIGITS) for x in (*parts, rest)]).alias("_p"))


def fit_rates(members: DataFrame, target: Mapping[str, float] = TARGET, whole: bool = False) -> DataFrame:
    """(_p, rate): the nonnegative rate of each cell of posteriors whose domain totals match ``target``.

    Least squares by projected gradient. What is minimised: the squared differences between sum(rate *
    words * posterior) and each domain's part of all words, each over the larger of the part
    wanted and the part there is, plus RIDGE times the squared change of the rates from 1, by words. A
    small domain thus counts like a large one, and there is one solution.

    The gradient by a cell's rate is its posteriors times one number for each domain, so the sum of all
    steps is one number for each domain too, ``price``, and a rate is 1 + posteriors . price, projected to
    0 or more. A round is one pass over the cells: it tries several lengths of the step along the
    gradient, which is scaled for each domain by its squares over the cells above 0, and adds up for
    each what it leaves and the next gradient. Nothing is written and no cell leaves the tasks. The
    best length is taken; where none is better, shorter ones are tried. It ends when no domain's gradient
    is above TOLERANCE of its part, or no step makes a difference any more; there is no limit on
    rounds. With ``whole`` the wanted total grows until no wanted domain has to shrink. Without any
    words all rates stay 1.
    """
    spark = members.sparkSession
    path = scratch_path(spark, "rates")
    members.groupBy("_p").agg(F.sum("_n").cast("double").alias("n")).write.parquet(path)
    # Kept, as every round reads them; a part that is lost is read again from the table.
    cells = spark.read.parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fitted(cells, target, whole)
    finally:
        cells.unpersist()


def _fitted(cells: DataFrame, target: Mapping[str, float], whole: bool) -> DataFrame:
    k = len(DOMAINS)
    p = [F.col("_p")[i] for i in range(k)]

    def rate(price) -> Column:
        raised = F.lit(1.0)
        for c, v in zip(p, price, strict=True):
            raised = raised + c * float(v)
        return F.greatest(F.lit(0.0), raised)

    *share, total = cells.agg(*[F.sum(F.col("n") * c) for c in p], F.sum("n")).first()
    if not total:
        return cells.select("_p", F.lit(1.0).alias("rate"))
    share = np.array(share) / total
    wanted = np.array([target.get(d, 0.0) for d in DOMAINS])
    if whole:
        wanted *= max([1.0, *(share[wanted > 0] / wanted[wanted > 0])])
    part = np.maximum(wanted, share)
    part[part == 0] = 1.0

    def passed(prices) -> list[tuple]:
        """For each price: what is minimised, its gradient, and the squares by which a step is scaled."""
        sums = []
        for price in prices:
            there = F.when(rate(price) > 0, F.col("n")).otherwise(0.0)
            sums += [F.sum(F.col("n") * rate(price) * rate(price))]
            sums += [F.sum(F.col("n") * rate(price) * c) for c in p] + [F.sum(there * c * c) for c in p]
        found = np.array(cells.agg(*sums).first()).reshape(len(prices), 2 * k + 1) / total
        out = []
        for price, (square, *rest) in zip(prices, found, strict=True):
            value = square / 2 - wanted @ price + RIDGE / 2 * (part * price) @ price
            out.append((value, np.array(rest[:k]) - wanted + RIDGE * part * price, np.array(rest[k:]) + RIDGE * part))
        return out

    price = np.zeros(k)
    ((value, slope, scale),) = passed([price])
    longest = 2.0
    while (np.abs(slope) > TOLERANCE * part).any():
        prices = [price - longest / 2**i * slope / scale for i in range(TRIED)]
        best = min(zip(passed(prices), prices, strict=True), key=lambda x: x[0][0])
        if best[0][0] < value:
            (value, slope, scale), price = best
            longest = 2.0
        elif longest * np.abs(slope / scale).max() < 1e-12 * (1 + np.abs(price).max()):
            break
        else:
            longest /= 2**TRIED
    return cells.select("_p", rate(price).alias("rate"))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    target: Mapping[str, float] = TARGET,
    whole: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, posteriors ``p_<domain>`` and ``rate``.

    ``rate`` is how often a document should be drawn. Null and empty texts have no words, and the
    rate of their posteriors. Repeated rows are rated one by one. Without any words all rates are
    1. Columns of ``docs`` named like the new ones are replaced. The rows are written once with a
    number each, by which their rates find them. A text's features are added up in the
    task that reads it, so one row per text is moved.
    """
    spark = docs.sparkSession
    new = ("n_words", "rate", "__row", *[f"p_{d}" for d in DOMAINS])
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    names = docs.columns
    path = scratch_path(spark, "numbered")
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    docs = spark.read.parquet(path)
    path = scratch_path(spark, "memberships")
    memberships(docs, labels, text, doc_id, "__row").write.parquet(path)
    members = spark.read.parquet(path)
    # As many rows as there are posteriors of three decimals: half a million for three domains.
    rates = F.broadcast(fit_rates(members, target, whole))
    shares = {f"p_{d}": F.col("_p")[i] for i, d in enumerate(DOMAINS)}
    rated = members.join(rates, "_p").select(
        F.col("row").alias("__row"), F.col("_n").alias("n_words"), *[v.alias(c) for c, v in shares.items()], "rate"
    )
    found = docs.join(rated, "__row")
    return found.select(*[F.col(f"`{c}`") for c in names], "n_words", *shares, "rate")
