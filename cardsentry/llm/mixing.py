"""Mixing documents to target weights.

Tokens are counted per cell (source, language, topic). Iterative proportional fitting rakes a weight per cell: in turn,
the weighted tokens of every source, language and topic are brought to their target shares. Documents are then drawn by
probabilities in proportion to the weight of their cell, at most 1, whose factor is calibrated so that the expected tokens
are the budget. All work after the counting is on cells.
"""

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import frozen, uniform_of

MARGINS = {"source": 0.5, "lang": 0.7, "topic": 0.7}  # target shares: shares of tokens to this power, brought to sum 1
ROUNDS = 12  # of raking before the margins are looked at, and again until they are reached
CALIBRATIONS = 12
MOST_ROUNDS = 480  # then the weights are taken as they are, with a warning of the error left
RESTED = 1e-10  # largest change of a cell in a round, as a share of all tokens, once raking has come to rest
TOLERANCE = 1e-6  # largest error of a margin value, relative to its target
KEPT_TOKENS = 0.5
SEED = 17
NONE = "(none)"

# topic by the form of the text: the first rule that holds; the counts are those of ``measured``
TOPICS = [
    ("table", "n_bars * 20 > n"),
    ("shouting", "n_upper * 2 > n"),
    ("notes", "n_lines * 60 > n"),
    ("long read", "n > 4000"),
]


def measured(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, lang, topic, tokens): the row itself and what is counted of it; null names are a value of
    their own. Tokens are words between spaces and line ends. The topic is the form of the text, from counts of
    characters."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    without = lambda pattern: n - F.length(F.regexp_replace(text, pattern, ""))
    spread = F.regexp_replace(text, "[^ \\n]+", "x")
    counted = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in ("source", "lang")),
        n.alias("n"),
        F.length(F.regexp_replace(spread, "[ \\n]", "")).cast("long").alias("tokens"),
        without("[|]").alias("n_bars"),
        without("[A-Z]").alias("n_upper"),
        (without("\\n") + 1).alias("n_lines"),
    )
    topic = reduce(lambda rest, rule: F.when(F.expr(rule[1]), F.lit(rule[0])).otherwise(rest), TOPICS[::-1], F.lit("prose"))
    return counted.select("row", "doc_id", "source", "lang", topic.alias("topic"), "tokens")


def raked(cells: DataFrame, margins: dict[str, float] = MARGINS, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margin columns, tokens) with a weight such that weight x tokens has the target shares of all tokens.
    Every step is one window over the cells of a margin value; the plan is cut off by a stored table every few rounds. The
    rounds go on until every margin is within ``TOLERANCE``. Where the weights come to rest before, or ``MOST_ROUNDS`` have
    not been enough, targets contradict each other: the weights are returned as they are, and a warning gives the error
    left."""
    at = cells.withColumn("weight", F.lit(1.0))
    for column, power in margins.items():
        sums = cells.groupBy(column).agg(F.sum("tokens").alias("t"))
        raised = frozen(sums.withColumn("share", F.pow(F.col("t").cast("double"), F.lit(power))))
        whole = raised.agg(F.sum("share").alias("shares"), F.sum("t").alias("tokens")).first()
        scale = F.lit(float(whole["tokens"] or 0) / (whole["shares"] or 1.0))
        at = at.join(raised.select(column, (F.col("share") * scale).alias(f"to_{column}")), column)
    done = 0
    while True:
        for k in range(rounds):
            if k == rounds - 1:
                at = at.withColumn("rested", F.col("weight"))
            for column in margins:
                now = F.sum(F.col("weight") * F.col("tokens")).over(Window.partitionBy(column))
                at = at.withColumn("weight", F.col("weight") * (F.col(f"to_{column}") / now))
            if k % 4 == 3 or k == rounds - 1:
                at = frozen(at)
        done += rounds
        left = margin_error(at, margins)
        if left <= TOLERANCE:
            break
        moved = at.agg(F.max(F.abs(F.col("weight") - F.col("rested")) * F.col("tokens")) / F.sum("tokens")).first()[0]
        if moved is not None and moved < RESTED:
            warnings.warn(f"no weights reach all margins; the largest error is {left:.3g}", stacklevel=2)
            break
        if done >= MOST_ROUNDS:  # cells between which weights go on shifting for ever: what is reached is returned
            warnings.warn(f"margins are off by {left:.3g} after {done} rounds", stacklevel=2)
            break
        at = at.drop("rested")
    return at.select(*cells.columns, "weight")


def margin_error(at: DataFrame, margins: dict[str, float]) -> float:
    """The largest error of a margin value, relative to its target."""
    worst = 0.0
    for column in margins:
        sums = at.groupBy(column).agg(F.sum(F.col("weight") * F.col("tokens")).alias("now"), F.first(f"to_{column}").alias("to"))
        worst = max(worst, sums.agg(F.max(F.abs(F.col("now") / F.col("to") - 1))).first()[0] or 0.0)
    return worst


def calibrated(cells: DataFrame, kept: float) -> DataFrame:
    """``cells`` with the probability min(1, factor x weight) at which the expected tokens are ``kept`` of all.

    The factor is found by giving cells that would pass 1 exactly 1 and sharing out the rest; the set of such cells only
    grows, and the rounds end when it doesn't."""
    full = F.lit(False)
    total = F.sum("tokens").alias("all")
    factor = 0.0
    n_full = -1
    while True:
        row = cells.agg(
            total,
            F.sum(F.when(full, F.col("tokens"))).alias("capped"),
            F.sum(F.when(~full, F.col("weight") * F.col("tokens"))).alias("free"),
            F.count_if(full).alias("n_full"),
        ).first()
        if row["free"] is None or row["free"] <= 0 or row["n_full"] <= n_full:
            break
        n_full = row["n_full"]
        now = (kept * row["all"] - (row["capped"] or 0)) / row["free"]
        factor = now
        full = F.col("weight") * F.lit(factor) >= 1.0
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(factor)))


def weighed(
    docs: DataFrame, kept: float = KEPT_TOKENS, seed: int = SEED, margins: dict[str, float] = MARGINS, rounds: int = ROUNDS
) -> DataFrame:
    """``measured`` rows with weight, probability and kept.

    A row is kept if the number its id hashes to is below its probability, so repeated ids share their fate. Null names
    of source or language count as a name of their own, null ids as one id. Documents without tokens cannot change any
    margin: they have weight and probability 0 and are not kept. An empty table gives an empty one.
    """
    rows = measured(docs)
    cells = frozen(rows.where("tokens > 0").groupBy(*margins).agg(F.sum("tokens").alias("tokens")))
    weights = frozen(calibrated(raked(cells, margins, rounds), kept).drop("tokens"))
    # cells are as many as the combinations of names; Spark sees the size of the stored table and picks the join
    out = rows.join(weights, list(margins), "left")
    some = F.col("tokens") > 0
    key: Column = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    out = out.withColumns({c: F.when(some, F.col(c)).otherwise(F.lit(0.0)) for c in ("weight", "probability")})
    return out.withColumn("kept", uniform_of(key, seed) < F.col("probability"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs(doc_id, text, lang, source)``: doc_id, source, lang, topic, tokens, weight, probability, kept; other
    columns are ignored. See ``weighed``."""
    return weighed(docs, **options).select("doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "kept")


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. See ``weighed``."""
    return weighed(docs, **options).where("kept").select("row.*")


def mix_sql(kept: float = KEPT_TOKENS, seed: int = SEED, margins: dict[str, float] = MARGINS, rounds: int = ROUNDS) -> str:
    """The same in SQL, over the view ``documents``; weight and probability rounded to six digits."""
    topic = "CASE " + " ".join(f"WHEN {rule} THEN '{name}'" for name, rule in TOPICS) + " ELSE 'prose' END"
    count = lambda p: f"length(text) - length(regexp_replace(text, '{p}', '', 'g'))"
    ctes = [
        f"""counted AS (SELECT doc_id, source, lang, length(text) n,
 length(regexp_replace(regexp_replace(text, '[^ \\n]+', 'x', 'g'), '[ \\n]', '', 'g')) tokens,
 {count("[|]")} n_bars, {count("[A-Z]")} n_upper, {count(chr(92) + "n")} + 1 n_lines
 FROM (SELECT doc_id, coalesce(source, '{NONE}') source, coalesce(lang, '{NONE}') lang, coalesce(text, '') AS text FROM documents))""",
        f"rows0 AS (SELECT doc_id, source, lang, {topic} topic, tokens FROM counted)",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT tokens, 1::DOUBLE w FROM rows0 WHERE tokens > 0 GROUP BY ALL)",
    ]
    for m, power in margins.items():
        ctes.append(f"s_{m} AS (SELECT {m}, sum(tokens)::DOUBLE t FROM c0 GROUP BY {m})")
        ctes.append(f"t_{m} AS (SELECT {m}, pow(t, {power}::DOUBLE) * (sum(t) OVER () / sum(pow(t, {power}::DOUBLE)) OVER ()) target FROM s_{m})")
    at = "c0"
    for k in range(rounds):
        for m in margins:
            ctes.append(
                f"c{k}_{m} AS MATERIALIZED (SELECT source, lang, topic, tokens, "
                f"w * (target / sum(w * tokens) OVER (PARTITION BY {m})) w FROM {at} JOIN t_{m} USING ({m}))"
            )
            at = f"c{k}_{m}"
    factor = f"(SELECT {kept}::DOUBLE * sum(tokens) / sum(w * tokens) f FROM {at})"
    ctes.append(f"f0 AS MATERIALIZED {factor}")
    for k in range(1, CALIBRATIONS):
        ctes.append(
            f"f{k} AS MATERIALIZED (SELECT coalesce(({kept}::DOUBLE * sum(tokens) - coalesce(sum(tokens) FILTER (w * f >= 1), 0)) "
            f"/ sum(w * tokens) FILTER (NOT w * f >= 1), any_value(f)) f FROM {at}, f{k - 1})"
        )
    last = f"f{CALIBRATIONS - 1}"
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, source, lang, topic, r.tokens, round(CASE WHEN r.tokens > 0 THEN w ELSE 0::DOUBLE END, 6) weight,
 round(CASE WHEN r.tokens > 0 THEN least(1::DOUBLE, w * f) ELSE 0::DOUBLE END, 6) probability,
 ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{seed}'), 1, 13))::BIGINT / 4503599627370496::DOUBLE
  < CASE WHEN r.tokens > 0 THEN least(1::DOUBLE, w * f) ELSE 0::DOUBLE END kept
FROM rows0 r LEFT JOIN {at} USING (source, lang, topic), {last}"""
    )
