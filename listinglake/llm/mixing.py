"""Mixing sources to target weights: iterative proportional fitting, calibrated sampling.

Documents fall into cells of (source, language, topic), and the cells' tokens are raked
until the shares of every source, language and topic meet their targets. The weight of a
cell over its tokens, scaled to a token budget, is the chance of each of its documents to be
kept; chances above 1 are cut to 1 and the rest scaled up in turn until the budget is met.

Targets: a given table (dimension, value, share), or by default each value's own token
share to the power ``SMOOTHING``, which lifts rare values and holds back hot ones. Topics
come from ordered rules over the text (``TOPIC_RULES``).

Raking goes on until no share is further than ``TOLERANCE`` from its target, however many
rounds that takes. Targets can contradict each other, as when a source of one language has
another share than the language it fills: then the largest deviation stops shrinking, raking
ends there, and the targets that are not met are reported (:func:`unmet`, and a warning). A
target for a value without tokens cannot be met either; the others of its dimension are scaled
to sum to 1 and it is reported as well. A value without a target keeps no weight.

Everything is a DataFrame expression. A text becomes one narrow row; all later work is on the
cells, which pre-aggregation makes few. The weight of a cell is its tokens times one factor per
dimension, so a raking step writes nothing but the new factors of one dimension: a group-by with
map-side sums over the cells and the factors of the other two. Factors are joined by broadcast
while a dimension has at most ``FEW_VALUES`` values and else with hot values salted, so a
language that every cell has puts no task above the others.
:func:`sampled` reads the texts a second time, for their topic, when it picks rows.

Null source, language or text reads as "unknown" or an empty text. Empty texts count 0
tokens and are kept with the chance of their cell, which is 0 where no text of the cell has
tokens. Null ids take the draw of an empty id. Repeated rows
share one draw. Ties do not arise: a document is kept when its draw is below its chance.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table
from listinglake.operators.skew import hot_keys, lookup_join, spread_join
from listinglake.session import store

logger = logging.getLogger(__name__)

DIMENSIONS = ("source", "lang", "topic")
#: Largest distance of a raked share from its target.
TOLERANCE = 1e-10
#: Rounds in a row that bring the distance down by less than ``GAIN`` end the raking.
STALLED, GAIN = 6, 1e-3
#: After so many rounds, rates between these two are slow; above them targets contradict.
WATCHED, SLOW = 8, (0.5, 0.98)
#: Values of a dimension whose factors are broadcast, under 64 MiB.
FEW_VALUES = 200_000
SMOOTHING = 0.7
#: Share of all tokens to keep.
BUDGET = 0.5
#: Relative distance from the budget at which cutting ends.
BUDGET_TOLERANCE = 1e-12
#: First match decides; the last is for all other texts.
TOPIC_RULES = (
    ("legal", r"[Ll]icen[cs]e|[Rr]ights reserved|[Cc]opyright"),
    ("tabular", r" \| "),
    ("contact", r"[0-9A-Za-z]@[0-9A-Za-z]"),
    ("numeric", r"[0-9]{3}"),
)
WORD = r"[^ \t-\r]+"
OTHER_TOPIC = "prose"
#: The draw is this many bits of the md5 of the id.
DRAW_DIGITS = 13


def topic(text: Column) -> Column:
    name, pattern = TOPIC_RULES[0]
    found = F.when(text.rlike(pattern), name)
    for name, pattern in TOPIC_RULES[1:]:
        found = found.when(text.rlike(pattern), name)
    return found.otherwise(OTHER_TOPIC)


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) fixed by the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**DRAW_DIGITS)


def described(documents: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, tokens): tokens are runs without white space."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id",
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("lang", F.lit("unknown")).alias("lang"),
        topic(text).alias("topic"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("tokens"),
    )


def targets_of(cells: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(dimension, value, share): smoothed token shares, each dimension summing to 1."""
    each = cells.select(
        F.explode(
            F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in DIMENSIONS])
        ).alias("at"),
        "tokens",
    )
    raised = (
        each.groupBy("at.dimension", "at.value")
        .agg(F.sum("tokens").alias("tokens"))
        .where("tokens > 0")
        .withColumn("raised", F.pow(F.col("tokens").cast("double"), F.lit(smoothing)))
    )
    whole = raised.groupBy("dimension").agg(F.sum("raised").alias("whole"))
    return raised.join(whole, "dimension").select(
        "dimension", "value", (F.col("raised") / F.col("whole")).alias("share")
    )


def reachable(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """(dimension, value, wanted, share): ``wanted`` as given, ``share`` as raked to.

    ``share`` is 0 for values without tokens, and sums to 1 over the others of a dimension.
    """
    each = cells.select(
        F.explode(
            F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in DIMENSIONS])
        ).alias("at"),
        "tokens",
    )
    there = each.where("tokens > 0").select("at.*").distinct().withColumn("there", F.lit(True))
    given = targets.groupBy("dimension", "value").agg(F.sum("share").alias("wanted"))
    marked = given.join(there, ["dimension", "value"], "left")
    whole = marked.where("there").groupBy("dimension").agg(F.sum("wanted").alias("whole"))
    share = F.when(F.col("there") & (F.col("whole") > 0), F.col("wanted") / F.col("whole")).otherwise(0.0)
    return marked.join(whole, "dimension", "left").select("dimension", "value", "wanted", share.alias("share"))


def shares_of(fitted: DataFrame) -> DataFrame:
    """(dimension, value, reached): the share of each value by its cells' weights."""
    each = [
        fitted.groupBy(F.col(name).alias("value"))
        .agg(F.sum("weight").alias("reached"))
        .select(F.lit(name).alias("dimension"), "value", "reached")
        for name in DIMENSIONS
    ]
    return each[0].union(each[1]).union(each[2])


def unmet(fitted: DataFrame, goal: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(dimension, value, wanted, reached) of the targets that raking did not meet."""
    met = goal.join(shares_of(fitted), ["dimension", "value"], "left")
    return met.select("dimension", "value", "wanted", F.coalesce("reached", F.lit(0.0)).alias("reached")).where(
        F.abs(F.col("wanted") - F.col("reached")) > tolerance
    )


class _Factors:
    """One stored table per dimension: (value, share, factor, distance)."""

    def __init__(self, cells: DataFrame, goal: DataFrame) -> None:
        self.cells = cells
        self.tables, self.hot = {}, {}
        sizes = {row[0]: row[1] for row in goal.groupBy("dimension").count().collect()}
        for name in DIMENSIONS:
            mine = goal.where(F.col("dimension") == name)
            start = mine.select(
                F.col("value").alias(name), "share", F.lit(1.0).alias("factor"), F.lit(0.0).alias("distance")
            )
            self.tables[name] = store(start, "factors")
            few = sizes.get(name, 0) <= FEW_VALUES
            self.hot[name] = None if few else (hot_keys(cells, [name]),)

    def _joined(self, frame: DataFrame, name: str) -> DataFrame:
        """``frame`` with ``weight`` times the factor; cells of values without a target go."""
        table = self.tables[name].select(name, "factor")
        if self.hot[name] is None:
            met = frame.join(F.broadcast(table), name)
        else:
            others = [d for d in DIMENSIONS if d != name]
            met = spread_join(frame, table, [name], "inner", self.hot[name][0], others)
        return met.withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")

    def weighed(self, names: tuple[str, ...]) -> DataFrame:
        frame = self.cells.withColumn("weight", F.col("tokens").cast("double"))
        for name in names:
            frame = self._joined(frame, name)
        return frame

    def _fit(self, name: str, power: float) -> None:
        """The factors that meet the targets of ``name`` under the others' factors.

        A ``power`` above 1 takes the step further than that. ``distance`` is how far the share
        was away before. Each step is stored: plans that held several would grow with them.
        """
        others = tuple(d for d in DIMENSIONS if d != name)
        have = self.weighed(others).groupBy(name).agg(F.sum("weight").alias("have"))
        if self.hot[name] is None:
            have = F.broadcast(have)
        step = F.col("share") / F.col("have")
        if power != 1.0:
            step = F.when(step > 0, F.col("factor") * F.pow(step / F.col("factor"), F.lit(power))).otherwise(0.0)
        met = self.tables[name].join(have, name, "left").select(
            name,
            "share",
            F.when(F.col("have") > 0, step).otherwise(0.0).alias("factor"),
            F.abs(F.coalesce("have", F.lit(0.0)) * F.col("factor") - F.col("share")).alias("distance"),
        )
        self.tables[name] = store(met, "factors")

    def round(self, power: float = 1.0) -> float:
        """Fit one dimension after the other; gives the largest distance met on the way."""
        for name in DIMENSIONS:
            self._fit(name, power)
        each = [table.select("distance") for table in self.tables.values()]
        return each[0].union(each[1]).union(each[2]).agg(F.max("distance")).first()[0] or 0.0


def rake(cells: DataFrame, goal: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, lang, topic, tokens, weight) for a :func:`reachable` goal: weights sum to 1.

    A round fits one dimension after the other. It is the last when no share was further from
    its target than ``tolerance`` when its turn came. If ``WATCHED`` rounds show that the distance
    shrinks slowly, the steps are taken further by what suits that rate; the limit is the same.
    """
    factors = _Factors(cells, goal)
    distances: list[float] = []
    best, stalled, power = float("inf"), 0, 1.0
    while best > tolerance and stalled < STALLED:
        distances.append(factors.round(power))
        stalled = 0 if distances[-1] < (1 - GAIN) * best else stalled + 1
        best = min(best, distances[-1])
        if len(distances) == WATCHED:
            rate = (distances[-1] / distances[-4]) ** (1 / 3) if distances[-4] else 0.0
            power = 2 / (1 + math.sqrt(1 - rate)) if SLOW[0] < rate < SLOW[1] else 1.0
    weighed = factors.weighed(DIMENSIONS).select(*DIMENSIONS, "weight")
    rest = cells.join(weighed, list(DIMENSIONS), "left")
    return store(rest.withColumn("weight", F.coalesce("weight", F.lit(0.0))), "cells")


def chances(fitted: DataFrame, budget: float = BUDGET) -> DataFrame:
    """(source, lang, topic, weight, chance): expected tokens add up to the budget.

    ``rate`` is kept tokens per token before scaling. Each turn scales all rates below 1
    to what the cut ones leave of the budget, until they fill it or none is left below 1.
    """
    now = fitted.withColumn(
        "rate",
        F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0),
    )
    while True:
        total = now.agg(
            F.sum("tokens").alias("all"),
            F.sum(F.when(F.col("rate") >= 1.0, F.col("tokens"))).alias("cut"),
            F.sum(F.when(F.col("rate") < 1.0, F.col("rate") * F.col("tokens"))).alias("free"),
        ).first()
        left = budget * (total["all"] or 0) - (total["cut"] or 0)
        scale = max(left / total["free"], 0.0) if total["free"] else 1.0
        if abs(scale - 1.0) <= BUDGET_TOLERANCE:
            break
        rate = F.when(F.col("rate") >= 1.0, 1.0).otherwise(F.col("rate") * F.lit(scale))
        now = store(now.withColumn("rate", rate), "rates")
    return now.select(*DIMENSIONS, "weight", F.least("rate", F.lit(1.0)).alias("chance"))


def calibrated(documents: DataFrame, targets: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The described documents, the chance of each cell and the unmet targets, all stored."""
    narrow = store(described(documents), "described")
    cells = store(narrow.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    goal = store(reachable(cells, targets_of(cells) if targets is None else targets), "targets")
    fitted = rake(cells, goal)
    missed = store(unmet(fitted, goal), "unmet")
    worst = missed.agg(F.count(F.lit(1)), F.max(F.abs(F.col("wanted") - F.col("reached")))).first()
    if worst[0]:
        logger.warning("%d targets cannot be met, by up to %.3g", worst[0], worst[1])
    return narrow, store(chances(fitted), "chances"), missed


def mix(documents: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, weight, chance, kept) of every row.

    ``weight`` is the raked token share of the row's cell.
    """
    narrow, chance, _ = calibrated(documents, targets)
    return lookup_join(narrow, chance, list(DIMENSIONS), "left").select(
        "doc_id",
        *DIMENSIONS,
        "tokens",
        "weight",
        "chance",
        (draw(F.col("doc_id")) < F.col("chance")).alias("kept"),
    )


def sampled(documents: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The kept rows of ``documents`` with their ``topic``, ``chance`` and ``weight``."""
    _, chance, _ = calibrated(documents, targets)
    keys = [f"_{name}" for name in DIMENSIONS]
    chance = chance.toDF(*keys, "_weight", "_chance")
    # The row travels as one column, so no name of it can clash.
    keyed = documents.select(
        F.struct("*").alias("row"),
        F.coalesce("source", F.lit("unknown")).alias("_source"),
        F.coalesce("lang", F.lit("unknown")).alias("_lang"),
        topic(F.coalesce("text", F.lit(""))).alias("_topic"),
    )
    own = [name for name in documents.columns if name not in ("topic", "chance", "weight")]
    return (
        lookup_join(keyed, chance, keys, "inner")
        .where(draw(F.col("row.doc_id")) < F.col("_chance"))
        .select(
            *(F.col(f"row.`{name}`") for name in own),
            F.col("_topic").alias("topic"),
            F.col("_chance").alias("chance"),
            F.col("_weight").alias("weight"),
        )
    )


def _raked_sql(fit: str) -> str:
    """``fit`` after one round, and how far each cell's shares were away in it."""
    for name in DIMENSIONS:
        fit = f"""(select turn, source, lang, topic, tokens,
                weight * case when have > 0 then share / have else 0 end as weight,
                greatest(away, abs(have - share)) as away
            from (select turn, source, lang, topic, tokens, weight, away,
                    sum(weight) over (partition by {name}) as have from {fit})
            join to_{name} using ({name}))"""
    return fit


def _sql() -> str:
    """The same steps as DuckDB SQL; the loops are recursive tables with the same ends."""
    rules = " ".join(
        f"when regexp_matches(text, '{pattern}') then '{name}'" for name, pattern in TOPIC_RULES
    )
    parts = [
        f"""narrow as (select doc_id, source, lang, case {rules} else '{OTHER_TOPIC}' end as topic,
            cast(len(regexp_extract_all(text, '{WORD}')) as bigint) as tokens
            from (select doc_id, coalesce(source, 'unknown') as source,
                  coalesce(lang, 'unknown') as lang, coalesce(text, '') as text
                  from documents))""",
        """cells as materialized (select source, lang, topic,
            cast(sum(tokens) as bigint) as tokens from narrow group by all)""",
        *(
            f"""to_{name} as materialized (select {name}, raised / sum(raised) over () as share
                from (select {name}, pow(cast(sum(tokens) as double), {SMOOTHING}) as raised
                      from cells group by 1 having sum(tokens) > 0))"""
            for name in DIMENSIONS
        ),
        f"""fit as (
            select 0 as turn, source, lang, topic, tokens, cast(tokens as double) as weight,
                1.0::double as distance from cells
            union all
            select turn + 1, source, lang, topic, tokens, weight, max(away) over ()
            from {_raked_sql(f"(select *, 0.0::double as away from fit where distance > {TOLERANCE})")})""",
        """fitted as materialized (
            select source, lang, topic, cells.tokens, coalesce(weight, 0) as weight
            from cells left join (from fit where turn = (select max(turn) from fit))
            using (source, lang, topic))""",
        f"""cutting as (
            select 0 as turn, source, lang, topic, tokens, weight,
                case when tokens > 0 then weight / tokens else 0 end as rate, 2.0::double as scale
            from fitted
            union all
            select turn + 1, source, lang, topic, tokens, weight,
                case when rate >= 1 then 1.0 else rate * scale end, scale
            from (select *, case when free > 0
                    then greatest(({BUDGET} * everything - cut) / free, 0) else 1 end as scale
                  from (select turn, source, lang, topic, tokens, weight, rate,
                          sum(tokens) over () as everything,
                          coalesce(sum(case when rate >= 1 then tokens end) over (), 0) as cut,
                          coalesce(sum(case when rate < 1 then rate * tokens end) over (), 0) as free
                        from cutting))
            where abs(scale - 1) > {BUDGET_TOLERANCE})""",
        """rates as materialized (
            select source, lang, topic, weight, rate from cutting
            where turn = (select max(turn) from cutting))""",
    ]
    draw_sql = (
        f"cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, {DRAW_DIGITS})"
        f" as bigint)::double / {16**DRAW_DIGITS}::double"
    )
    return f"""with recursive {", ".join(parts)}
        select doc_id, source, lang, topic, narrow.tokens, round(weight, 9) as weight,
            round(least(rate, 1.0::double), 9) as chance, {draw_sql} < least(rate, 1.0) as kept
        from narrow join rates using (source, lang, topic)"""


@query("op1_mixing", _sql())
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.withColumns({"weight": F.round("weight", 9), "chance": F.round("chance", 9)})
