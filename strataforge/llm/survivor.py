"""Best representative of each duplicate group: field by field, by votes.

Every row votes for the value each of its fields has: with its source's trust, halved for every half-life it is older than
the field's strongest vote. Votes are summed by normalised value, the value with the most wins its field, the strongest row
behind it gives the value as it is written, and the winners are turned back into one row a group.

Trust is given in bits (each bit doubles the vote) and recency as a whole number in any unit, so that a vote is
2 ** (bits + recency / half_life) up to a factor that is the same for the whole field. Exponents are kept as whole bits and a
fraction, so votes may be as far apart as they like. A half-life below the recency's unit, with a trust above any age, makes
precedence strict: trusted before untrusted, then newer before older, since with half a unit a vote is a quarter of the one a
unit newer, and all later votes together are less than any earlier one.

Of a group's rows with the same trust and recency only the one with the highest id speaks for a field (it is the tie's
resolution, and repeated deliveries of one moment don't outvote others), unless ``every_row`` votes. Groups are brought together
once; where counting finds one with more rows than a task should get, strongest votes and sums are partial aggregates instead
and such a group's rows are spread. What comes out is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.session import materialise

#: Votes of one group that one task should get.
ROWS_PER_GROUP = 500_000
#: Recency of a row that has none: before any timestamp there is, in microseconds.
OLDEST = -(10**17)
#: Votes are whole multiples of this: their sums don't depend on the order they are added in.
GRAIN = 2.0**-32


def microseconds(c: Column) -> Column:
    """A timestamp without zone as a whole number, whatever the session's zone; null for null."""
    at = c.cast("timestamp_ntz")
    seconds = F.unix_date(at.cast("date")).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("long")


def _exponent(trust: Column, recency: Column, half_life: float) -> tuple[Column, Column]:
    """Whole bits and the fraction of a bit, 0 to 1, of a row's vote; exact where half_life is one part of a whole number."""
    age, bits = F.coalesce(recency.cast("long"), F.lit(OLDEST)), F.coalesce(trust.cast("double"), F.lit(0.0))
    if (1 / half_life).is_integer():
        return age * F.lit(int(1 / half_life)) + F.floor(bits), bits - F.floor(bits)
    steps = age / F.lit(half_life)
    rest = (steps - F.floor(steps)) + (bits - F.floor(bits))
    return F.floor(steps) + F.floor(bits) + F.floor(rest), rest - F.floor(rest)


def moments(rows: DataFrame, keys: Sequence[str], fields: dict[str, Column], trust: Column, recency: Column, row_id: Column, half_life: float, votes: Column | None = None, every_row: bool = False, together: bool = False) -> DataFrame:
    """keys, bits and part (the vote's exponent), rows (all of the group's at that moment) and for each field what is voted for:
    struct(row_id, value) or null.

    ``fields`` gives each field's value, null where it isn't filled; ``votes`` is false for rows that count but don't vote.
    Null trust is 0 bits, null recency OLDEST. ``together``: a group's rows are brought to one task first.
    """
    bits, part = _exponent(trust, recency, half_life)
    may = F.lit(True) if votes is None else votes
    said = {name: F.when(may & value.isNotNull(), F.struct(row_id.alias("row_id"), value.cast("string").alias("value"))) for name, value in fields.items()}
    wide = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], bits.alias("_bits"), part.alias("_part"), row_id.alias("_id"), *[c.alias(f"_f{i}") for i, c in enumerate(said.values())])
    wide = wide.repartition(*[f"_k{i}" for i in range(len(keys))]) if together else wide
    return wide.groupBy(*[f"_k{i}" for i in range(len(keys))], "_bits", "_part", *["_id"] * every_row).agg(F.count(F.lit(1)).alias("_rows"), *[F.max(f"_f{i}").alias(f"_f{i}") for i in range(len(fields))])


def survivors(
    rows: DataFrame, keys: Sequence[str], fields: dict[str, Column], *, trust: Column, recency: Column, row_id: Column, half_life: float, votes: Column | None = None, every_row: bool = False,
    at_least: int = 1, rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """One row for each group of at least ``at_least`` rows: keys and, for each field, struct(value, row_id, votes), null where no row fills it.

    ``votes`` of a field is the winning value's sum, the field's strongest single vote counting 1 to 2. Of values with
    equal sums the one with the strongest row wins, then the highest row id. A group none of whose fields is filled gives no
    row; an empty table gives none. Rows with a null key form a group like any other. Values are compared trimmed and lower-cased.
    """
    by = [f"_k{i}" for i in range(len(keys))]
    most = rows.groupBy(*[F.col(k).alias(b) for k, b in zip(keys, by)]).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    given = (rows, keys, fields, trust, recency, row_id, half_life, votes, every_row)
    top = [F.max(F.when(F.col(f"_f{i}").isNotNull(), F.col("_bits"))) for i in range(len(fields))]
    names = [f"_m{i}" for i in range(len(fields))]
    if most <= rows_per_group:
        # One exchange: all that follows is done where a group's rows are.
        w = Window.partitionBy(*by)
        met = moments(*given, together=True).withColumns({"_all": F.sum("_rows").over(w), **{n: t.over(w) for n, t in zip(names, top)}}).where(F.col("_all") >= at_least)
    else:
        met = _meet_spread(materialise(moments(*given), "votes"), by, dict(zip(names, top)), at_least, rows_per_group)
    vote = [F.struct(F.lit(i).alias("i"), F.col(f"_f{i}").alias("said"), (F.col("_bits") - F.col(f"_m{i}")).alias("below")) for i in range(len(fields))]
    long = met.select(*by, "_bits", "_part", F.explode(F.array(*vote)).alias("v")).where("v.said is not null")
    strength = F.floor(F.pow(F.lit(2.0), F.col("v.below") + F.col("_part")) / GRAIN) * GRAIN
    best = F.max(F.struct(F.col("_bits").alias("bits"), F.col("_part").alias("part"), F.col("v.said.row_id").alias("row_id"), F.col("v.said.value").alias("value")))
    tally = long.groupBy(*by, F.col("v.i").alias("i"), F.lower(F.trim("v.said.value")).alias("norm")).agg(F.sum(strength).alias("votes"), best.alias("best"))
    won = tally.groupBy(*by, "i").agg(F.max(F.struct("votes", "best")).alias("w"))
    result = F.struct(F.col("w.best.value").alias("value"), F.col("w.best.row_id").alias("row_id"), F.col("w.votes").alias("votes"))
    wide = won.groupBy(*by).agg(*[F.max(F.when(F.col("i") == i, result)).alias(name) for i, name in enumerate(fields)])
    return wide.withColumnsRenamed(dict(zip(by, keys)))


def _meet_spread(cast: DataFrame, by: Sequence[str], top: dict[str, Column], at_least: int, rows_per_group: int) -> DataFrame:
    """cast with its group's strongest votes, found by partial aggregation and joined back; large groups' rows are spread over salts."""
    groups = cast.groupBy(*by).agg(F.sum("_rows").alias("_all"), F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in top.items()]).where(F.col("_all") >= at_least).drop("_all")
    salts = F.ceil(F.col("_n") / F.lit(rows_per_group)).cast("long")
    # Groups larger than a task should get are few: at most rows / rows_per_group; Spark chooses how to join by their size.
    sizes = groups.select(*[F.col(k).alias(f"_s{k}") for k in by], salts.alias("_salts")).where("_salts > 1")
    spread = cast.join(sizes, _all([F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in by]), "left")
    said = [c for c in cast.columns if c.startswith("_f")]
    spread = spread.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_bits", "_part", *[f"{c}.row_id" for c in said]), "_salts"), F.lit(0))).drop("_salts", *[f"_s{k}" for k in by])
    copied = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_n").withColumnsRenamed({c: f"_g{c}" for c in [*by, "_salt"]})
    return spread.join(copied, _all([F.col(c).eqNullSafe(F.col(f"_g{c}")) for c in [*by, "_salt"]]))


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
