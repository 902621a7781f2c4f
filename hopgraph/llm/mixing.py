"""Operator 2: mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  The cells' token totals
are raked until their sums meet the target share of every source, every
language and every topic; the raked weight of a cell over its tokens gives the
probability with which its documents are sampled.

Targets are shares by value.  A dimension without given targets takes the
tempered natural shares (tokens to the power ``temper``, normalised); values
that given targets leave out share the rest by their tokens.  Probabilities
are clipped at 1, so a cell that is scarcer than its target is kept whole; with
``fill`` the other cells are raked again to the budget that is left.
Sampling hashes the document id, so a rerun or a retried task draws alike.

Cases: NULL source, language or topic is a value of its own; a text without
words has no tokens and is sampled with the plain budget share; repeated ids
are drawn together; an empty table gives an empty result; the input row is
carried as a struct, so other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table, words_of, written

DIMS = ("source", "lang", "topic")
ROUNDS = 8          # raking rounds over the three marginals
TEMPER = 0.7        # default targets: natural shares to this power
BUDGET = 0.6        # tokens to sample, as a share of all
SEED = "mix-1"


def topic_of(text: Column) -> Column:
    """A coarse topic from the text's form (no topic column is given)."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(t.contains(" | "), "table").when(t.contains("License"), "legal")
            .when(t.rlike(r"[#*$%&]{3}"), "symbols").when(F.length(t) < 500, "note")
            .when(F.length(t) < 5000, "article").otherwise("book"))


def _value(c: str) -> Column:
    """A dimension's value as text, with NULL apart from every string."""
    return F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(c).cast("string")))


def marginal_targets(cells: DataFrame, dim: str, given: dict | None, temper: float) -> DataFrame:
    """(``dim``, ``target``): shares that add up to 1."""
    natural = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
    if given is None:
        natural = natural.withColumn("t", F.pow("t", F.lit(temper)))
        whole = natural.agg(F.sum("t").alias("s")).scalar()
        return natural.select(dim, (F.col("t") / whole).alias("target"))
    spark = cells.sparkSession
    named = spark.createDataFrame(
        [("-" if k is None else f"={k}", float(v)) for k, v in given.items()], f"{dim} string, share double")
    both = natural.join(named, dim, "left")
    rest = F.lit(max(0.0, 1 - sum(given.values())))
    left = both.where("share IS NULL").agg(F.sum("t").alias("s")).scalar()
    raw = both.withColumn("raw", F.coalesce("share", rest * F.col("t") / left, F.lit(0.0)))
    whole = raw.agg(F.sum("raw").alias("s")).scalar()
    return raw.select(dim, (F.col("raw") / whole).alias("target"))


def rake(cells: DataFrame, targets: dict | None = None, rounds: int = ROUNDS,
         temper: float = TEMPER) -> DataFrame:
    """Cells (``DIMS``, ``tokens``) with ``weight``: shares raked to every marginal.

    One step is a partial aggregate over a marginal and a join back to the
    cells.  Every step is written to the shared folder, so all steps run the
    same small plan.  Nothing is gathered: sources may be as many as hosts.
    """
    targets = targets or {}
    whole = cells.agg(F.sum("tokens").cast("double").alias("s")).scalar()
    df = cells.where("tokens > 0").withColumn("weight", F.col("tokens") / whole)
    for d in DIMS:
        goal = marginal_targets(cells, d, targets.get(d), temper)
        df = df.join(goal.withColumnRenamed("target", f"{d}_target"), d)
    df = written(df, "mix-round")
    for _ in range(rounds):
        for d in DIMS:
            sums = df.groupBy(d).agg(F.sum("weight").alias("s"))
            df = written(df.join(sums, d).withColumn("weight", F.col("weight") * F.col(f"{d}_target") / F.col("s"))
                         .drop("s"), "mix-round")
    return df.drop(*[f"{d}_target" for d in DIMS])


def filled(raked: DataFrame, goals: dict[str, DataFrame], whole: float, budget: float, rounds: int = ROUNDS,
           most: int = 40) -> DataFrame:
    """Raked cells with ``take``: tokens to draw, at most all of a cell, to the budget and the marginals.

    Full cells stay at their tokens; the others are raked to what the
    marginals leave, ``rounds`` times, and then scaled to what the budget
    leaves until no further cell is full.  A marginal whose cells are all full
    cannot be reached; the budget then goes to the others.
    """
    full = F.col("take") >= F.col("tokens") * (1 - 1e-12)
    at = F.sum(F.when(full, F.col("take")).otherwise(0.0)).alias("fixed")
    free = F.sum(F.when(full, 0.0).otherwise(F.col("take"))).alias("free")

    def step(df: DataFrame, ratio: Column) -> Column:
        return F.when(full, F.col("take")).otherwise(F.least(F.col("tokens").cast("double"), F.col("take") * ratio))

    goal = min(1.0, float(budget)) * whole
    df = raked.withColumn("take", F.least(F.col("tokens").cast("double"), F.col("weight") * goal))
    for d in DIMS:
        df = df.join(goals[d].withColumnRenamed("target", f"{d}_target"), d)
    df = written(df, "mix-fill")
    for _ in range(rounds):
        for d in DIMS:
            left = F.greatest(F.col(f"{d}_target") * goal - F.col("fixed"), F.lit(1e-9) * goal)
            df = written(df.join(df.groupBy(d).agg(at, free), d).withColumn("take", step(df, left / F.col("free")))
                         .drop("fixed", "free"), "mix-fill")
    for _ in range(most):
        sums = df.agg(at, free).first()                       # one row
        if not sums["free"] or abs(sums["fixed"] + sums["free"] - goal) <= 1e-9 * goal:
            break
        ratio = max(goal - sums["fixed"], 1e-9 * goal) / sums["free"]
        df = written(df.withColumn("take", step(df, F.lit(ratio))), "mix-fill")
    return df.drop(*[f"{d}_target" for d in DIMS])


def mix(docs: DataFrame, targets: dict | None = None, budget: float = BUDGET, rounds: int = ROUNDS,
        temper: float = TEMPER, seed: str = SEED, topic: Column | None = None, fill: bool = False) -> DataFrame:
    """``_row`` (the input row), ``topic``, ``tokens``, ``prob`` and ``sampled`` for every document.

    With ``fill`` the budget that full cells cannot take goes to the others.

    ``docs`` needs doc_id, text, source and lang.  The text is read twice (for
    the token totals, then for the draw) and never shuffled: only cell totals
    are, and the table of cell probabilities is joined by its measured size.
    """
    df = docs.select(F.struct("*").alias("_row"), (topic_of(F.col("text")) if topic is None else topic).alias("topic"))
    keyed = df.select("_row", "topic", F.col("_row.source").alias("source"), F.col("_row.lang").alias("lang"))
    keyed = keyed.select("_row", F.col("topic").alias("topic_name"), *[_value(c).alias(c) for c in DIMS],
                         F.size(words_of(F.col("_row.text"))).cast("long").alias("tokens"))
    cells = written(keyed.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    whole = cells.agg(F.sum("tokens").cast("double").alias("s")).scalar()
    raked = rake(cells, targets, rounds, temper)
    p = F.least(F.lit(1.0), F.lit(float(budget)) * whole * F.col("weight") / F.col("tokens"))
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] if fill else None
    if total:
        goals = {d: marginal_targets(cells, d, (targets or {}).get(d), temper) for d in DIMS}
        raked = filled(raked, goals, total, budget, rounds)
        p = F.least(F.lit(1.0), F.col("take") / F.col("tokens"))
    odds = written(raked.select(*DIMS, p.alias("p")), "mix-odds")
    draw = F.conv(F.substring(F.md5(F.concat(
        F.lit(seed + ":"), F.coalesce(F.col("_row.doc_id").cast("string"), F.lit("null"))).cast("binary")),
        1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    prob = F.when(F.col("tokens") > 0, F.coalesce("p", F.lit(1.0))).otherwise(F.lit(float(budget)))
    return (keyed.join(odds, list(DIMS), "left").withColumn("prob", prob)
            .select("_row", F.col("topic_name").alias("topic"), "tokens", "prob",
                    (draw < F.col("prob")).alias("sampled")))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents, with the columns of ``docs``."""
    return mix(docs, **options).where("sampled").select("_row.*")


def op2_mixing(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mix(docs).select("_row.doc_id", "_row.source", "_row.lang", "topic", "tokens",
                            F.round("prob", 6).alias("prob"), "sampled")


def _sql() -> str:
    ctes, last = [], "c0"
    for r in range(ROUNDS):
        for d in DIMS:
            name = f"r{r}_{d}"
            ctes.append(f"{name} AS (SELECT c.* REPLACE (weight * target / sum(weight) OVER (PARTITION BY c.{d})"
                        f" AS weight) FROM {last} c JOIN goal_{d} g ON c.{d} IS NOT DISTINCT FROM g.{d})")
            last = name
    goals = ",\n".join(
        f"goal_{d} AS (SELECT {d}, pow(sum(tokens)::DOUBLE, {TEMPER}) / sum(pow(sum(tokens)::DOUBLE, {TEMPER})) "
        f"OVER () AS target FROM cells GROUP BY {d})" for d in DIMS)
    return rf"""
WITH d AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), 'License') THEN 'legal'
         WHEN regexp_matches(coalesce(text, ''), '[#*$%&]{{3}}') THEN 'symbols'
         WHEN length(coalesce(text, '')) < 500 THEN 'note' WHEN length(coalesce(text, '')) < 5000 THEN 'article'
         ELSE 'book' END AS topic FROM documents),
cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
{goals},
c0 AS (SELECT *, tokens / (SELECT sum(tokens)::DOUBLE FROM cells) AS weight FROM cells WHERE tokens > 0),
{(',' + chr(10)).join(ctes)},
odds AS (SELECT source, lang, topic,
  least(1.0, {BUDGET} * (SELECT sum(tokens)::DOUBLE FROM cells) * weight / tokens) AS p FROM {last}),
o AS (
  SELECT d.*, CASE WHEN tokens > 0 THEN coalesce(p, 1.0) ELSE {BUDGET} END AS pr,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0 AS u
  FROM d LEFT JOIN odds ON d.source IS NOT DISTINCT FROM odds.source AND d.lang IS NOT DISTINCT FROM odds.lang
    AND d.topic = odds.topic)
SELECT doc_id, source, lang, topic, tokens, round(pr, 6) AS prob, u < pr AS sampled FROM o
"""


SQL = _sql()
