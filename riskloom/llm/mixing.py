"""Mixing sources to target weights by iterative proportional fitting, in DataFrame terms.

Documents are first summed to cells, one per combination of margin values (source, language,
topic), whatever their number. Raking then goes over the margins in turn: the cells of each
value are multiplied by what its target share needs over what it has. A document is kept
with the probability its cell's factor has against the largest factor, so the expected
tokens of the sample have the target shares, and no probability is above 1. Whether it is
kept is decided by a hash of its id, the same in every run.

That largest factor may be the one of a rare value, and then little is kept of all others.
`least` names a share of the tokens to keep at least. Where raking keeps less, it is bounded:
the probability is min(1, factor), a value that has too few tokens for its share is kept
whole and the shares of the others grow, and cells that reach 1 are kept whole while the
others are raked again until the margins are met.

Defined cases: a null margin value is a value of its own. Documents without tokens are in
their cell but weigh nothing; a cell of weight 0 that no margin raises keeps its factor.
Targets for values that do not occur are left out and the others scaled up; a value without
a target gets nothing. Rows with the same doc_id are kept or dropped together, rows without
an id as well. An empty table gives an empty one. Extra columns are kept.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, text_or_empty
from riskloom.session import materialize

log = logging.getLogger(__name__)

SWEEPS = 60
ERROR = 1e-10
CELLS = 200_000  # in a file of a written sweep
TEMPER = 0.8
SEED = "mix-1"


def words_of(text: str) -> Column:
    """The token weight: white-space separated words."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: str) -> Column:
    """A coarse topic from the marks of the text: the first kind that fits."""
    value = text_or_empty(text)

    def marks(mark: str) -> Column:
        return F.length(value) - F.length(F.replace(value, F.lit(mark), F.lit("")))

    return (
        F.when(marks("|") >= 5, "table")
        .when(marks("!") >= 5, "loud")
        .when(marks("#") + marks("%") + marks("$") >= 5, "symbols")
        .when(value.rlike("[0-9]"), "numbers")
        .when(marks("\n") >= 5, "long form")
        .otherwise("short form")
    )


def _key(column: Column) -> Column:
    """Text for a margin value, another one for null than for any value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """value, want: shares in proportion to a power of the present tokens."""
    have = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("have"))
    return have.select("value", F.pow("have", F.lit(power)).alias("want"))


def _shares(targets: DataFrame, cells: DataFrame, margin: str) -> DataFrame:
    """The targets of the values that have tokens, as shares of 1."""
    have = cells.where("tokens > 0").select(F.col(margin).alias("value")).distinct()
    known = targets.join(have, "value").where("want > 0")
    total = known.agg(F.sum("want")).first()[0] or 1.0
    return known.select(F.col("value").alias(margin), (F.col("want") / F.lit(total)).alias("want"))


def targeted(cells: DataFrame, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per margin the shares wanted of its values, written."""
    return {m: materialize(_shares(t, cells, m), "mix-targets") for m, t in targets.items()}


# Per value of a margin: what is summed over its cells, the step of their factors, and how far
# the value is off before that step.
PLAIN = (
    {"have": "tokens * factor"},
    "CASE WHEN have > 0 THEN coalesce(want, 0) / have ELSE 1 END",
    "abs(have - coalesce(want, 0))",
)
BOUNDED = (
    {
        "held": "CASE WHEN factor >= 1 THEN tokens ELSE 0 END",
        "free": "CASE WHEN factor >= 1 THEN 0 ELSE tokens * factor END",
        "whole": "tokens * factor",
    },
    "CASE WHEN free > 0 AND want > held THEN (want - held) / free"
    " WHEN want < held THEN want / whole ELSE 1 END",
    "coalesce(abs(held + free - want), 0)",
)
Rule = tuple[dict[str, str], str, str]


def _joined_step(before: str, margin: str, rule: Rule, kept: str) -> str:
    """Sums a value by shuffles, for cells in many tasks.

    Sorted joins: a broadcast for each of many tiny joins fills the driver.
    """
    sums, step, off = rule
    each = ", ".join(f"sum({x}) AS {name}" for name, x in sums.items())
    return f"""
  SELECT /*+ MERGE(v) */ {kept}, factor * step AS factor, greatest(miss, off) AS miss
  FROM {before} s JOIN (
    SELECT {margin}, CAST({step} AS DOUBLE) AS step, CAST({off} AS DOUBLE) AS off
    FROM (SELECT {margin}, max(want_{margin}) AS want, {each} FROM {before} GROUP BY {margin})
  ) v ON s.{margin} = v.{margin}"""


def _window_step(before: str, margin: str, rule: Rule, kept: str) -> str:
    """The same by windows, for the cells of one task, which then need no shuffle."""
    sums, step, off = rule
    each = ", ".join(f"sum({x}) OVER ({margin}_cells) AS {name}" for name, x in sums.items())
    return f"""
  SELECT {kept}, factor * CAST({step} AS DOUBLE) AS factor,
    greatest(miss, CAST({off} AS DOUBLE)) AS miss
  FROM (SELECT *, want_{margin} AS want, {each} FROM {before}
    WINDOW {margin}_cells AS (PARTITION BY {margin})) s"""


def _sweep(margins: list[str], rule: Rule, one_task: bool) -> str:
    """SQL of one sweep over cells {state}, which have the target of each margin's value."""
    kept = ", ".join([*(f"s.{m}" for m in margins), *(f"want_{m}" for m in margins), "tokens"])
    step = _window_step if one_task else _joined_step
    parts = ["s0 AS (SELECT *, 0.0D AS miss FROM {state})"]
    for i, margin in enumerate(margins):
        parts.append(f"s{i + 1} AS ({step(f's{i}', margin, rule, kept)})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT * FROM s{len(margins)}"


def _swept(
    state: DataFrame,
    wants: dict[str, DataFrame],
    rule: Rule,
    size: float,
    sweeps: int,
    error: float,
) -> DataFrame:
    """Sweeps until no margin misses its target by more than this part of the size.

    Cells carry the largest miss of a sweep along, so it costs no join, and the write of a sweep
    observes it, so it costs no job: what the driver keeps of a job adds up over many sweeps. Each
    sweep is written, so one is lost at most, and every sweep is the same small plan. Cells that
    fill one file at most are swept in the task that reads it: one stage a sweep, where shuffles
    and joins would make a dozen, all planned and kept by the driver.
    """
    worst = 0.0
    for margin, want in wants.items():
        state = state.join(want.withColumnRenamed("want", f"want_{margin}"), margin, "left")
    parts = max(1, -(-state.count() // CELLS))
    query = _sweep(list(wants), rule, parts == 1)
    for _ in range(sweeps):
        state = state.coalesce(1) if parts == 1 else state
        swept, seen = state.sparkSession.sql(query, state=state).coalesce(parts), Observation()
        swept = materialize(swept.observe(seen, F.max("miss").alias("miss")), "mix-cells")
        state = swept.drop("miss")
        worst = (seen.get["miss"] or 0.0) / size
        if worst <= error:
            break
    else:
        log.warning("raking: a margin misses its target by %.2g after %d sweeps", worst, sweeps)
    return state.drop(*(f"want_{m}" for m in wants))


def raked(
    cells: DataFrame, shares: dict[str, DataFrame], sweeps: int = SWEEPS, error: float = ERROR
) -> DataFrame:
    """cells (margins, tokens) with factor: tokens * factor has the wanted shares."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    state = cells.withColumn("factor", F.lit(1.0 / total if total else 1.0))
    return _swept(state, shares, PLAIN, 1.0, sweeps, error)


def _reachable(cells: DataFrame, share: DataFrame, margin: str, size: float) -> DataFrame:
    """The tokens wanted of each value of a sample of this size, at most what there is."""
    have = cells.where("factor > 0").groupBy(margin).agg(F.sum("tokens").alias("have"))
    table = materialize(share.join(have, margin), "mix-targets")
    each, whole = size, 0
    while True:
        over = F.col("have") <= F.col("want") * F.lit(each)
        n, held, others = table.agg(
            F.count_if(over),
            F.sum(F.when(over, F.col("have")).otherwise(0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("want"))),
        ).first()
        if n == whole and whole or not others:
            break
        each, whole = (size - held) / others, n
        if not n:
            break
    return table.select(margin, F.least("have", F.col("want") * F.lit(each)).alias("want"))


def bounded(
    state: DataFrame,
    shares: dict[str, DataFrame],
    least: float,
    sweeps: int = SWEEPS,
    error: float = ERROR,
) -> DataFrame:
    """Raked cells with factor such that tokens * min(1, factor) has the wanted shares of a
    sample with this share of the tokens. Cells without a chance keep none."""
    usable, weight = state.where("factor > 0").agg(
        F.sum("tokens"), F.sum(F.col("tokens") * F.col("factor"))
    ).first()
    size = least * usable
    wants = {
        m: materialize(_reachable(state, want, m, size), "mix-targets")
        for m, want in shares.items()
    }
    scaled = state.withColumn("factor", F.col("factor") * F.lit(size / weight))
    return _swept(scaled, wants, BOUNDED, size, sweeps, error)


def drawn(doc_id: str, seed: str = SEED) -> Column:
    """A number in [0, 1) that follows from the id."""
    text = F.concat(F.lit(f"{seed}/"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / 2.0**32


def mix(
    docs: DataFrame,
    margins: dict[str, Column],
    tokens: Column,
    targets: dict[str, DataFrame] | None = None,
    power: float = TEMPER,
    sweeps: int = SWEEPS,
    seed: str = SEED,
    least: float | None = None,
    error: float = ERROR,
) -> tuple[DataFrame, dict[str, str]]:
    """docs with tokens, probability and kept, and the (unused) names of these columns.

    targets: per margin the wanted share of each value (value as text, want); for a margin
    without one, shares are the present ones raised to a power. least: the share of the tokens
    of wanted values that is kept at least; None leaves the size to the largest factor. error:
    the part of the sample by which a margin may miss its target; raking stops there.
    """
    keys = dict(zip(margins, fresh(docs, *[f"margin_{i}" for i in range(len(margins))])))
    wanted = ("tokens", "probability", "kept")
    names = dict(zip(wanted, fresh(docs, *wanted)))
    keyed = docs.withColumns(
        {keys[m]: _key(c) for m, c in margins.items()} | {names["tokens"]: tokens}
    )
    cells = keyed.groupBy(*keys.values()).agg(F.sum(names["tokens"]).alias("tokens"))
    cells = materialize(cells, "mix-cells")
    wants = {}
    for margin, key in keys.items():
        given = (targets or {}).get(margin)
        if given is None:
            wants[key] = tempered(cells, key, power)
        else:
            wants[key] = given.select(
                _key(F.col("value")).alias("value"), F.col("want").cast("double").alias("want")
            )
    shares = targeted(cells, wants)
    state = raked(cells, shares, sweeps, error)
    top, weight, usable = state.where("tokens > 0").agg(
        F.max("factor"),
        F.sum(F.col("tokens") * F.col("factor")),
        F.sum(F.when(F.col("factor") > 0, F.col("tokens"))),
    ).first()
    top = top or 1.0
    if least and usable and weight / top < least * usable:
        state, top = bounded(state, shares, min(least, 1.0), sweeps, error), 1.0
    chance = state.select(
        *keys.values(),
        F.round(F.least(F.col("factor") / F.lit(top), F.lit(1.0)), 6).alias(names["probability"]),
    )
    joined = keyed.join(chance, list(keys.values())).drop(*keys.values())
    kept = drawn("doc_id", seed) < F.col(names["probability"])
    return joined.withColumn(names["kept"], kept), names
