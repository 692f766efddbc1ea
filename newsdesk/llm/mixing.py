"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Documents are counted into cells of source x language x topic. Token weights of the cells are raked
until their marginals meet the targets; each document is then sampled with the probability its cell's
weight calls for. Only cells and marginals are iterated over, never documents. The targets are those the
caller gives, or the tempered shares of the table itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsdesk.llm.common import shelter
from newsdesk.session import store

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its share of tokens to this power, normalised; 1 keeps the mix as it is.
TEMPER = 0.8
#: Expected share of all tokens that is sampled.
BUDGET = 0.6
ROUNDS, TOLERANCE = 20, 1e-9
#: A given target is met if the share reached differs by no more than this.
SLACK = 0.001
WORDS = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """Topic by the form of a text, for tables without a `topic` column: its number of lines and words."""
    words, lines = F.regexp_count(text, F.lit(WORDS)), F.regexp_count(text, F.lit("\n")) + 1
    return F.when(words < 60, "note").when(words >= 1200, "long").when(words < 25 * lines, "list").otherwise("prose")


def sampling_key(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by id and seed: 48 bits of an md5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def tempered_targets(cells: DataFrame, power: float = TEMPER) -> dict[str, DataFrame]:
    """Per dimension a table (value, target): shares of tokens raised to `power`, summing to one."""
    out = {}
    for name in DIMENSIONS:
        sums = cells.groupBy(F.col(name).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("raised"))
        sums = store(sums)
        total = sums.agg(F.sum("raised")).first()[0] or 1.0
        out[name] = sums.select("value", (F.col("raised") / F.lit(total)).alias("target"))
    return out


def given_targets(cells: DataFrame, shares: Mapping[str, Mapping[str, float]]) -> dict[str, DataFrame]:
    """Tables as of `tempered_targets` from the shares a caller states for some of the dimensions.

    Shares are scaled to sum to one. A value of the cells without a share gets none; "" names NULL.
    """
    out = {}
    for name, wanted in shares.items():
        total = sum(wanted.values())
        if name not in DIMENSIONS or total <= 0 or min(wanted.values()) < 0:
            raise ValueError(f"targets of {name!r}: shares of 0 or more for some of {DIMENSIONS} are needed")
        table = cells.sparkSession.createDataFrame([(v or "", w / total) for v, w in wanted.items()], "value string, target double")
        found = cells.select(F.col(name).alias("value")).distinct()
        out[name] = store(found.join(table, "value", "full").select("value", F.coalesce("target", F.lit(0.0)).alias("target")))
    return out


def marginals(fitted: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """(dimension, value, target, reached) of raked cells; `reached` is the share of the weight, 0 for a value no document has."""
    parts = []
    total = float(fitted.agg(F.sum(F.col("tokens") * F.col("ratio"))).first()[0] or 1.0)
    for name, target in targets.items():
        now = fitted.groupBy(F.col(name).alias("value")).agg((F.sum(F.col("tokens") * F.col("ratio")) / total).alias("reached"))
        parts.append(target.join(now, "value", "left").select(F.lit(name).alias("dimension"), "value", "target", F.coalesce("reached", F.lit(0.0)).alias("reached")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _others(cells: DataFrame, factors: dict[str, DataFrame], skip: str | None = None) -> DataFrame:
    """cells with `mass`: tokens times the factors of all dimensions but `skip`."""
    out = cells.withColumn("mass", F.col("tokens").cast("double"))
    for name, table in factors.items():
        if name != skip:
            out = out.join(table.select(F.col("value").alias(name), F.col("factor").alias(f"f_{name}")), name)
            out = out.withColumn("mass", F.col("mass") * F.col(f"f_{name}")).drop(f"f_{name}")
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """cells (the dimensions and tokens > 0) with `ratio`: raked weight over tokens.

    A factor per value of each dimension is refitted in turn until no factor moves by more than
    TOLERANCE, or `rounds` times. The targets are shares; the weights sum to the tokens, unless no cell
    has a value with a share left. Where the targets contradict each other the last dimension is met;
    `marginals` tells what the others reached.
    """
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumn("ratio", F.lit(1.0))
    factors = {name: store(t.select("value", F.lit(1.0).alias("factor"))) for name, t in targets.items()}
    for _ in range(rounds):
        moved = 0.0
        for name, target in targets.items():
            now = _others(cells, factors, name).groupBy(F.col(name).alias("value")).agg(F.sum("mass").alias("mass"))
            factor = F.when(F.col("mass") > 0, F.col("target") * float(total) / F.col("mass")).otherwise(0.0)
            fitted = store(now.join(target, "value").join(factors[name], "value").select("value", factor.alias("factor"), F.col("factor").alias("old")))
            change = F.when(F.col("old") > 0, F.abs(F.col("factor") / F.col("old") - 1)).otherwise(F.col("factor"))
            moved = max(moved, fitted.agg(F.max(change)).first()[0] or 0.0)
            factors[name] = fitted.select("value", "factor")
        if moved <= TOLERANCE:
            break
    return _others(cells, factors).withColumn("ratio", F.col("mass") / F.col("tokens")).drop("mass")


def calibrate(cells: DataFrame, budget: float) -> DataFrame:
    """cells with `probability` = least(1, scale * ratio); the expected tokens are `budget` of all.

    The scale is solved for exactly: cells found at 1 leave the sum and the rest share what is left.
    """
    scale, seen = 0.0, -1
    while True:
        full = F.col("ratio") * F.lit(scale) >= 1
        row = cells.agg(
            F.sum("tokens").alias("all"), F.count(F.when(full, 1)).alias("n"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("ratio"))).alias("rest")).first()
        if row["n"] == seen or not row["rest"]:
            break
        seen, scale = row["n"], (budget * row["all"] - row["full"]) / row["rest"]
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)))


def weighted(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, power: float = TEMPER, budget: float = BUDGET, seed: int = 1,
             rounds: int = ROUNDS, slack: float | None = SLACK) -> DataFrame:
    """Every row of `docs` (other columns included) with source, lang and topic as used (`m_source`,
    `m_lang`, `m_topic`), `n_tokens`, `weight`, `probability` and `kept`.

    `targets` states token shares per value of some dimensions, for instance {"lang": {"en": 0.7, "fr": 0.3}};
    values it leaves out get weight 0, dimensions it leaves out follow from the others. Given targets that
    are missed by more than `slack` after `rounds` rounds raise a ValueError that names them; slack=None takes
    the nearest weights. Without `targets` the shares of the table are tempered by `power`.

    A NULL source, language or topic is a value of its own, written "". Texts without words weigh
    nothing, have probability 0 and are not kept. Rows that repeat an id are kept or left together, as far
    as they are in one cell; a NULL id draws as the empty text. Cells of equal weight have equal probability.
    Where the table has no `topic` column, `topic_of` gives one.
    """
    inner, restore = shelter(docs, "doc_id", "text", *DIMENSIONS)
    text = F.coalesce(F.col("text"), F.lit(""))
    topic = F.col("topic") if "topic" in docs.columns else topic_of(text)
    counted = inner.withColumns({"m_source": F.coalesce("source", F.lit("")), "m_lang": F.coalesce("lang", F.lit("")),
                                 "m_topic": F.coalesce(topic, F.lit("")), "n_tokens": F.regexp_count(text, F.lit(WORDS)).cast("bigint")})
    cells = store(counted.filter("n_tokens > 0").groupBy(*[F.col(f"m_{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("n_tokens").alias("tokens")))
    wanted = tempered_targets(cells, power) if targets is None else given_targets(cells, targets)
    raked = store(rake(cells, wanted, rounds))
    if targets and slack is not None and not cells.isEmpty():
        missed = marginals(raked, wanted).filter(F.abs(F.col("target") - F.col("reached")) > slack).orderBy("dimension", "value").limit(20).collect()
        if missed:
            raise ValueError("targets are not met: " + ", ".join(f"{r.dimension} {r.value!r} {r.target:.4f} (reached {r.reached:.4f})" for r in missed))
    fitted = store(calibrate(raked, budget))
    rated = fitted.select(*[F.col(d).alias(f"m_{d}") for d in DIMENSIONS], F.col("ratio").alias("weight"), "probability")
    both = counted.join(rated, [f"m_{d}" for d in DIMENSIONS], "left")
    probability = F.when(F.col("n_tokens") > 0, F.col("probability")).otherwise(0.0)
    return both.select(*restore(both), "m_source", "m_lang", "m_topic", "n_tokens", F.when(F.col("n_tokens") > 0, F.col("weight")).otherwise(0.0).alias("weight"),
                       probability.alias("probability"), (sampling_key(F.col("doc_id"), seed) < probability).alias("kept"))


def sample(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, **how) -> DataFrame:
    """The sampled rows of `docs`, with their columns; arguments as for `weighted`."""
    inner, restore = shelter(docs, "doc_id", "text", *DIMENSIONS)
    kept = weighted(inner, targets, **how).filter("kept")
    return kept.select(*restore(kept))
