"""Mixing documents to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The tokens of the cells are raked: their weights are
scaled to the target shares of the sources, then of the languages, then of the topics, round after round, until the
table has all three margins. A document is then kept with a probability in proportion to weight over tokens of its cell,
so the expected tokens of the sample have the target shares. Probabilities stop at 1: the cells that
reach it are found exactly, and the others share what is left of the budget.

Where many cells reach 1, that alone leaves the sample off the targets. ``sample_to_targets`` (the stage of the pipeline) rakes within the
bounds: the scale of each source, language and topic is such that its cells, none above what it has, come to its target. If the
margins cannot be met so, the budget is lowered in steps until they are. ``mixed`` without ``within`` is what the SQL of the query says.

Only DataFrame functions are used. Documents are counted by cell with partial sums; all further work is on the table of cells, and
the way back is a join with that small written table, which the planner broadcasts if its size on disk permits.

Defined results: null source, language or topic is the group ``(none)``; null and empty texts have no tokens, and
cells without tokens have weight and probability 0; the draw depends on id and text only, so equal rows share it;
a budget of all tokens or more keeps every document that has some; an empty table gives no row; input columns are
carried in a struct, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editsieve.llm.common import settle

MARGINS = ("source", "lang", "topic")
# Targets: token shares to this power, put to sum 1. 1 keeps the mix as it is, 0 makes all equal.
FLATTEN = {"source": 0.5, "lang": 0.7, "topic": 0.5}
ROUNDS = 8
# Expected share of all tokens in the sample.
BUDGET = 0.7
# Raking within bounds: how far a share may be from its target, relative to it; the step down of the budget if that is not reached.
TOLERANCE, STEP, LOWERINGS, PASSES = 0.01, 0.95, 60, 20
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"


def token_count(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.size(words).cast("long")


def form_topic(text: Column, tokens: Column) -> Column:
    """A stand-in for a topic where the table has none: the form of the whole text."""
    body = F.coalesce(text, F.lit(""))
    symbols = F.length(body) - F.length(F.translate(body, SYMBOLS, ""))
    digits = F.length(body) - F.length(F.translate(body, DIGITS, ""))
    return (
        F.when(symbols * 50 > F.length(body), "markup").when(digits * 50 > F.length(body), "figures")
        .when(tokens < 150, "brief").when(tokens < 600, "article").otherwise("long form")
    )


def draw(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on id and text."""
    seed = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(seed, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, target): shares to aim at, from the tokens themselves."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("t"))
    total = sums.agg(F.sum("t")).first()[0]
    return sums.select(margin, (F.col("t") / F.lit(total or 1.0)).alias(f"target_{margin}"))


def rake(cells: DataFrame, goals: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Weights of the cells (…, tokens) with the margins of ``goals``, last margin exact."""
    table = cells
    for margin, goal in goals.items():
        table = table.join(goal, margin)
    table = settle(table.withColumn("w", F.col("tokens").cast("double")), "raked")
    for _ in range(rounds):
        for margin in goals:
            share = F.col(f"target_{margin}") / F.sum("w").over(Window.partitionBy(margin))
            table = table.withColumn("w", F.col("w") * share)
        table = settle(table, "raked")
    return table


def calibrate(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Adds ``weight`` (target over actual share) and ``probability`` of the documents of each cell."""
    total = raked.agg(F.sum("tokens")).first()[0] or 1
    share = F.col("tokens") / F.lit(float(total))
    rated = raked.withColumn("share", share).withColumn("weight", F.col("w") / F.col("share"))
    # Cells by falling weight. If those before this one are kept whole, the scale for the rest is what
    # is left of the budget over the weight that is left. The first scale that needs no more than 1 is the one.
    line = Window.orderBy(F.desc("weight"), *MARGINS)  # one row per cell
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing)
    left = F.lit(budget) - F.coalesce(F.sum("share").over(before), F.lit(0.0))
    scaled = settle(rated.withColumn("scale", left / F.sum("w").over(after)).withColumn("at", F.row_number().over(line)), "scaled")
    fits = scaled.where(F.col("scale") * F.col("weight") <= 1.0)
    found = fits.agg(F.min_by("scale", "at")).first()[0]
    probability = F.least(F.lit(1.0), F.lit(found) * F.col("weight")) if found is not None else F.lit(1.0)
    return scaled.withColumn("probability", probability).select(*MARGINS, "weight", "probability")


def given(cells: DataFrame, margin: str, shares: dict[str, float]) -> DataFrame:
    """(margin, target) from explicit shares, put to sum 1 over the groups that are there; groups not named get nothing."""
    spark = cells.sparkSession
    named = spark.createDataFrame([(k, float(v)) for k, v in shares.items() if v > 0], f"{margin} string, t double")
    here = named.join(cells.select(margin).distinct(), margin, "left_semi")
    total = here.agg(F.sum("t")).first()[0]
    return here.select(margin, (F.col("t") / F.lit(total or 1.0)).alias(f"target_{margin}"))


def _met(table: DataFrame, margin: str, budget: float) -> DataFrame:
    """Scales ``v`` in each group of ``margin`` such that the sum of least(share, v) is its part of the budget."""
    full = F.col("v") / F.col("share")
    line = Window.partitionBy(margin).orderBy(F.desc("full"), *MARGINS)
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing)
    left = F.lit(budget) * F.col(f"target_{margin}") - F.coalesce(F.sum("share").over(before), F.lit(0.0))
    scaled = table.withColumn("full", full).withColumn("at", F.row_number().over(line)).withColumn("scale", left / F.sum("v").over(after))
    fits = F.when(F.col("scale") * F.col("full") <= 1.0, F.struct("at", "scale"))
    group = Window.partitionBy(margin)
    # Without room for the target, all cells of the group are taken whole.
    factor = F.coalesce(F.min(fits).over(group)["scale"], F.lit(1.0) / F.min("full").over(group))
    return scaled.withColumn("v", F.col("v") * factor).drop("full", "at", "scale")


def _miss(table: DataFrame, taken: Column, budget: float) -> float:
    """Largest difference of a group from its part of the budget, relative to it."""
    parts = [
        table.groupBy(m).agg(F.abs(F.sum(taken) / (F.lit(budget) * F.first(f"target_{m}")) - 1).alias("miss")).agg(F.max("miss").alias("miss"))
        for m in MARGINS
    ]
    return parts[0].union(parts[1]).union(parts[2]).agg(F.max("miss")).first()[0] or 0.0


def calibrate_within(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """As ``calibrate``, but the expected tokens of the sample have the margins, at the budget or what is possible below it."""
    total = raked.agg(F.sum("tokens")).first()[0] or 1
    table = settle(raked.withColumn("share", F.col("tokens") / F.lit(float(total))).withColumn("v", F.col("w")), "bounded")
    rooms = [table.groupBy(m).agg((F.sum("share") / F.first(f"target_{m}")).alias("room")).agg(F.min("room")).first()[0] for m in MARGINS]
    room = min((r for r in rooms if r is not None), default=budget)
    # Margins that contradict each other are not met by any budget: then no more is asked than raking without bounds gives.
    budget, allowed = min(budget, room), max(TOLERANCE, 1.1 * _miss(table, F.col("w"), 1.0))
    taken = F.least("share", "v")
    best, chosen = float("inf"), table
    for _ in range(LOWERINGS):
        last = float("inf")
        for _ in range(PASSES):
            for margin in MARGINS * 2:
                table = _met(table, margin, budget)
            table = settle(table, "bounded")
            miss = _miss(table, taken, budget)
            if miss <= allowed or miss > 0.8 * last:
                break
            last = miss
        # A smaller sample has to be clearly nearer to the targets; if no budget meets them, the nearest one is taken.
        if miss <= allowed or miss < 0.8 * best:
            best, chosen = miss, table
        if miss <= allowed:
            break
        budget *= STEP
    return chosen.select(*MARGINS, (F.col("w") / F.col("share")).alias("weight"), (taken / F.col("share")).alias("probability"))


def mixed(
    docs: DataFrame, budget: float = BUDGET, flatten: dict[str, float] | None = None, rounds: int = ROUNDS,
    within: bool = False, shares: dict[str, dict[str, float]] | None = None,
) -> DataFrame:
    """(row, source, lang, topic, n_tokens, weight, probability, selected) for every document; ``row`` holds its columns.

    ``shares`` are explicit targets of the groups of a margin; the others follow from ``flatten``. ``within`` rakes within the bounds.
    A column ``topic`` of the input is used; without one, the form of the text stands in.
    """
    power = FLATTEN if flatten is None else flatten
    n = token_count(docs["text"])
    topic = docs["topic"] if "topic" in docs.columns else form_topic(docs["text"], n)
    group = {"source": docs["source"], "lang": docs["lang"], "topic": topic}
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        *(F.coalesce(c.cast("string"), F.lit("(none)")).alias(k) for k, c in group.items()),
        n.alias("n_tokens"), draw(docs["doc_id"], docs["text"]).alias("u"),
    )
    counted = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    cells = settle(counted, "cells")
    goals = {m: given(cells, m, shares[m]) if m in (shares or {}) else targets(cells, m, power[m]) for m in MARGINS}
    raked = rake(cells, goals, rounds)
    rated = settle((calibrate_within if within else calibrate)(raked, budget), "calibrated")
    joined = rows.join(rated, list(MARGINS), "left")
    weight, p = F.coalesce("weight", F.lit(0.0)), F.coalesce("probability", F.lit(0.0))
    return joined.select(
        "row", *MARGINS, "n_tokens", weight.alias("weight"), p.alias("probability"), (F.col("u") < p).alias("selected")
    )


def mixture_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The decision on every document."""
    return mixed(docs).select(
        "row.doc_id", *MARGINS, "n_tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "selected"
    )


def sample_mixture(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The documents that the draw keeps, with the columns of the input."""
    return mixed(docs, budget).where("selected").select("row.*")


def sample_to_targets(docs: DataFrame, budget: float = BUDGET, shares: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The documents of a sample that has the target shares, with the columns of the input."""
    return mixed(docs, budget, within=True, shares=shares).where("selected").select("row.*")


def _rounds_sql() -> str:
    """The rounds of ``rake`` as a chain of tables."""
    chain, last = [], "r0"
    for i in range(ROUNDS):
        for margin in MARGINS:
            name = f"r{i}_{margin}"
            chain.append(
                f"{name} AS MATERIALIZED (SELECT * REPLACE (w * target_{margin} / sum(w) OVER (PARTITION BY {margin}) AS w) FROM {last})"
            )
            last = name
    chain.append(f"raked AS (SELECT * FROM {last})")
    return ",\n".join(chain)


def oracle() -> str:
    goals = ",\n".join(
        f"g_{m} AS (SELECT {m}, pow(CAST(sum(tokens) AS DOUBLE), {FLATTEN[m]}) / sum(pow(CAST(sum(tokens) AS DOUBLE), {FLATTEN[m]})) OVER () "
        f"AS target_{m} FROM cells GROUP BY {m})"
        for m in MARGINS
    )
    return f"""
WITH counted AS (
  SELECT doc_id, coalesce(text, '') AS body, source, lang,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
docs AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, n_tokens,
         CASE WHEN (length(body) - length(translate(body, '{SYMBOLS}', ''))) * 50 > length(body) THEN 'markup'
              WHEN (length(body) - length(translate(body, '{DIGITS}', ''))) * 50 > length(body) THEN 'figures'
              WHEN n_tokens < 150 THEN 'brief' WHEN n_tokens < 600 THEN 'article' ELSE 'long form' END AS topic,
         CAST(('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', body)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM counted),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0),
{goals},
r0 AS MATERIALIZED (
  SELECT source, lang, topic, tokens, target_source, target_lang, target_topic, CAST(tokens AS DOUBLE) AS w
  FROM cells JOIN g_source USING (source) JOIN g_lang USING (lang) JOIN g_topic USING (topic)),
{_rounds_sql()},
rated AS (SELECT *, tokens / CAST(sum(tokens) OVER () AS DOUBLE) AS share, w / (tokens / CAST(sum(tokens) OVER () AS DOUBLE)) AS weight FROM raked),
scaled AS MATERIALIZED (
  SELECT *, row_number() OVER line AS pos,
         ({BUDGET} - coalesce(sum(share) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
           / sum(w) OVER (line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale
  FROM rated WINDOW line AS (ORDER BY weight DESC, source, lang, topic)),
found AS (SELECT arg_min(scale, pos) AS s FROM scaled WHERE scale * weight <= 1.0),
rates AS (SELECT source, lang, topic, weight, coalesce(least(1.0, s * weight), 1.0) AS probability FROM scaled, found)
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(coalesce(weight, 0.0), 6) AS weight,
       round(coalesce(probability, 0.0), 6) AS probability, u < coalesce(probability, 0.0) AS selected
FROM docs d LEFT JOIN rates r ON d.source = r.source AND d.lang = r.lang AND d.topic = r.topic
"""
