"""Mix sources by temperature: weights are token shares to a power, realised as block permutations.

The exponent lies between 1 (the shares as they are) and 0 (all sources
alike). It is bisected to the largest one whose weights reach a target
entropy, and raised again where a source would be repeated more often than
allowed. Each source then gets its part of the token budget: whole epochs,
and of one more epoch the first blocks of a permutation, the last of them cut
after the document that the budget still holds.

Nothing here depends on the number of sources: the sums that bisection needs
are aggregates over the table of sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.tables import unused, written

BLOCK_DOCS = 8_192
#: Steps that one aggregate decides, and how many aggregates are made.
STEPS, ROUNDS = 6, 5


def word_count(text: str = "text") -> Column:
    """Words of a text; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


class Sums:
    """Entropy and repetition at any exponent, from aggregates over the table of sources."""

    def __init__(self, sources: DataFrame):
        self.shares = sources.where("tokens > 0").select("share")
        row = self.shares.agg(F.count("*"), F.min("share"), F.max("share")).first()
        self.n, self.least, self.most = row[0], row[1], row[2]

    def at(self, powers: list[float]) -> list[tuple[float, float]]:
        """Sum of weights before norming, and entropy, at each exponent."""
        parts = []
        for i, power in enumerate(powers):
            weight = F.pow("share", F.lit(power))
            parts += [F.sum(weight).alias(f"z{i}"), F.sum(weight * F.log("share") * power).alias(f"h{i}")]
        row = self.shares.agg(*parts).first()
        return [(row[f"z{i}"], math.log(row[f"z{i}"]) - row[f"h{i}"] / row[f"z{i}"]) for i in range(len(powers))]


def bisect(good, evaluate, low: float = 0.0, high: float = 1.0) -> float:
    """The largest exponent at which ``good`` holds; it holds below it and nowhere above.

    One call of ``evaluate`` serves several steps: it gets all the exponents
    that these steps may come to.
    """
    for _ in range(ROUNDS):
        parts = 1 << STEPS
        points = [low + (high - low) * i / parts for i in range(parts + 1)]
        values = evaluate(points)
        if good(points[-1], values[-1]):
            return points[-1]
        lo, hi = 0, parts
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if good(points[mid], values[mid]) else (lo, mid)
        low, high = points[lo], points[hi]
    return low


def exponent(
    sums: Sums, budget_share: float | None, target_entropy: float | None, most_repeats: float | None
) -> float:
    """The exponent that meets the targets.

    ``target_entropy`` is a fraction of the greatest entropy, that of equal
    weights. ``most_repeats`` wins over it. Without an entropy target the
    limit of repetition alone decides; without either the shares stay.
    ``budget_share`` is the budget over all tokens; None stands for the least
    budget that uses every source once.
    """
    if not sums.n or (target_entropy is None and most_repeats is None):
        return 1.0
    power = 0.0
    if target_entropy is not None:
        power = bisect(lambda _, v: v[1] >= target_entropy * math.log(sums.n) - 1e-12, sums.at)
    if most_repeats is not None:

        def repeats(p: float, value: tuple[float, float]) -> float:
            if budget_share is None:
                return (sums.least / sums.most) ** (p - 1)
            return budget_share * sums.least ** (p - 1) / value[0]

        # Repetition falls as the exponent rises: look for the last one that still has too much.
        (at_power,) = sums.at([power])
        if repeats(power, at_power) > most_repeats:
            power = bisect(lambda p, v: repeats(p, v) > most_repeats, sums.at, power, 1.0)
            power = min(1.0, power + 2.0 ** -(STEPS * ROUNDS))
    return power


def source_weights(
    tokens: DataFrame,
    budget: int | None,
    target_entropy: float | None,
    most_repeats: float | None,
) -> DataFrame:
    """``source, tokens, share, weight, budget, epochs, rest`` of each source.

    ``tokens`` has a row per source with its tokens. ``epochs`` whole passes
    and ``rest`` tokens of another make up the budget of a source.
    """
    total = tokens.agg(F.sum("tokens")).first()[0] or 0
    shares = written(tokens.withColumn("share", F.col("tokens") / F.lit(max(total, 1))))
    sums = Sums(shares)
    share = None if budget is None or not total else budget / total
    power = exponent(sums, share, target_entropy, most_repeats)
    ((z, _),) = sums.at([power]) if sums.n else ((1.0, 0.0),)
    if budget is None:
        # The largest source, which has the least repeats, is used once exactly.
        budget = math.ceil(total * z * (sums.most or 1.0) ** (1 - power)) if sums.n else 0
    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(power)) / z).otherwise(0.0)
    part = F.round(weight * budget).cast("long")
    whole = F.when(F.col("tokens") > 0, F.floor(part / F.col("tokens"))).otherwise(0).cast("long")
    return (
        shares.withColumn("weight", weight)
        .withColumn("budget", part)
        .withColumn("epochs", whole)
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    )


def mix(
    docs: DataFrame,
    budget: int | str | None = "all",
    target_entropy: float | None = None,
    most_repeats: float | None = 2.0,
    seed: int = 7,
    source_col: str = "source",
    id_col: str = "doc_id",
    tokens: Column | None = None,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, each as often as its source's weight asks for, with their place in the mix.

    ``budget`` is a number of tokens, "all" for as many as the texts have, or
    None for the least at which no source is cut, so that every text stays.
    Added columns: ``mix_epoch`` (0 for the first use of a text), ``mix_block``
    (block of the permutation), ``mix_tokens``, and ``mix_place``, from 0 to 1:
    in its order sources alternate by their weights. Columns of ``docs`` keep
    their names; where they have one of these, the added column gets a leading
    underscore more. A null source is a source of its own; sources without any
    token have no weight, and their rows are left out, except where no source
    is cut. Equal rows are used alike.
    """
    count = word_count(text_col) if tokens is None else tokens
    names = docs.columns
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.xxhash64(text_col).cast("string")))
    base = docs.select(
        F.struct(*[F.col(c) for c in names]).alias("_row"),
        F.col(source_col).cast("string").alias("_source"),
        count.cast("long").alias("_tokens"),
        F.xxhash64(key, F.lit(seed)).alias("_key"),
    )
    narrow = docs.select(
        F.col(source_col).cast("string").alias("_source"),
        count.cast("long").alias("_tokens"),
        F.xxhash64(key, F.lit(seed)).alias("_key"),
    )
    blocks = max(1, -(-docs.count() // BLOCK_DOCS))
    block = F.pmod("_key", F.lit(blocks)).cast("int")
    sized = written(
        narrow.groupBy(F.col("_source"), block.alias("_block")).agg(F.sum("_tokens").alias("_sum"))
    )
    totals = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("tokens"))
    total = None if budget is None else budget
    if budget == "all":
        total = sized.agg(F.sum("_sum")).first()[0] or 0
    weights = source_weights(totals, total, target_entropy, most_repeats)
    if budget is None:
        # Rounding must not cut a source that is to be used once.
        weights = weights.withColumn("rest", F.when(F.col("epochs") < 1, 0).otherwise(F.col("rest")))
        weights = weights.withColumn("epochs", F.greatest("epochs", F.lit(1)))
        weights = weights.withColumn("budget", F.greatest("budget", "tokens"))

    # Every epoch has its own order of blocks; ``_before`` counts the tokens of the blocks before.
    turns = sized.join(weights, F.col("_source").eqNullSafe(F.col("source")))
    turns = turns.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("epochs").cast("int"))))
    order = Window.partitionBy("_source", "_epoch").orderBy(
        F.xxhash64("_block", "_epoch", F.lit(seed)), "_block"
    )
    turns = turns.withColumn(
        "_before", F.coalesce(F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    last = F.col("_epoch") == F.col("epochs")
    turns = turns.where(~last | (F.col("_before") < F.col("rest")))
    turns = turns.select(
        F.col("_source").alias("_turn_source"),
        F.col("_block").alias("_turn_block"),
        "_epoch",
        "_before",
        F.col("tokens").alias("_source_tokens"),
        F.col("budget").alias("_budget"),
        F.col("_sum").alias("_block_tokens"),
        F.when(last & (F.col("_before") + F.col("_sum") > F.col("rest")), F.col("rest") - F.col("_before")).alias("_room"),
    )
    turns = written(turns)

    def used(part: DataFrame) -> DataFrame:
        rows = base.withColumn("_block", block)
        on = F.col("_source").eqNullSafe(F.col("_turn_source")) & (F.col("_block") == F.col("_turn_block"))
        return rows.join(part, on)

    full = used(turns.where(F.col("_room").isNull()))
    within = Window.partitionBy("_source", "_block", "_epoch").orderBy(F.xxhash64("_key", "_epoch"), "_key", "_tokens")
    cut = used(turns.where(F.col("_room").isNotNull()))
    cut = cut.withColumn("_sum", F.sum("_tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    cut = cut.where(F.col("_sum") <= F.col("_room")).drop("_sum")
    jitter = F.pmod(F.xxhash64("_key", "_epoch", F.lit("place")), F.lit(1 << 20)) / float(1 << 20)
    part = F.coalesce("_room", "_block_tokens") * jitter
    place = (F.col("_epoch") * F.col("_source_tokens") + F.col("_before") + part) / F.greatest(
        F.col("_budget"), F.lit(1)
    )
    return full.unionByName(cut).select(
        *[F.col("_row")[c].alias(c) for c in names],
        F.col("_epoch").alias(unused("mix_epoch", docs)),
        F.col("_block").alias(unused("mix_block", docs)),
        F.col("_tokens").alias(unused("mix_tokens", docs)),
        F.least(place, F.lit(1.0)).alias(unused("mix_place", docs)),
    )
