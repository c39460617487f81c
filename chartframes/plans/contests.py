"""League tables and elections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.columns import col
from chartframes.functions.conditions import choose, flag
from chartframes.operators.ordered import numbered_sum, row_number
from chartframes.operators.reshape import pivot_strict
from chartframes.operators.skew import TASK_ROWS
from chartframes.session import pin


def league_table(
    df: DataFrame, season: str, team: str, win: str, draw: str, loss: str, points: str, diff: str
) -> DataFrame:
    """Wins, draws, losses, points, goal difference, matches, points per match and rank in the season.

    Ranked by points per match, then goal difference, then team name.
    """
    totals = df.groupBy(col(season), col(team)).agg(
        *[F.sum(col(c)).alias(n) for n, c in {"w": win, "d": draw, "l": loss, "p": points, "gd": diff}.items()]
    )
    table = totals.withColumn("matches", F.col("w") + F.col("d") + F.col("l")).withColumn(
        "pts_per_match", F.try_divide(F.col("p").cast("double"), F.col("matches"))
    )
    return row_number(pin(table), season, ["-pts_per_match", "-gd", team], "rank")


def running_totals(
    df: DataFrame, season: str, team: str, value: str, order_by: list[str], baseline: bool = True, limit: int | None = TASK_ROWS
) -> DataFrame:
    """Running total of each team by match number, in long form, starting from a zero row; for ``limit`` see ``fits_one_task``."""
    keys = [season, team]
    out = numbered_sum(df, keys, order_by, value, "match_num", "total", limit)
    row = F.struct("match_num", "total")
    if baseline:
        zero = F.struct(
            F.lit(0).cast("bigint").alias("match_num"), F.lit(0).cast(out.schema["total"].dataType).alias("total")
        )
        first = F.col("match_num") == 1
        steps = F.when(first, F.array(zero, row)).otherwise(F.array(row))
    else:
        steps = F.array(row)
    return out.select(col(season), col(team), F.explode(steps).alias("__step")).select(
        col(season), col(team), "__step.match_num", "__step.total"
    )


def running_matrix(
    df: DataFrame,
    season: str,
    team: str,
    value: str,
    order_by: list[str],
    baseline: bool = True,
    values: list | None = None,
) -> DataFrame:
    """Running totals with one column per team and one row per season and match number."""
    long = running_totals(df, season, team, value, order_by, baseline)
    return pivot_strict(long, [season, "match_num"], team, "total", values).orderBy(season, "match_num")


def candidates_by_year(df: DataFrame, period: str, party: str, name: str, values: list | None = None) -> DataFrame:
    """The one name each party has in each period; two names for one party fail the job."""
    names = df.select(col(period), col(party), col(name)).where(col(name).isNotNull()).distinct()
    return pivot_strict(names, period, party, name, values).orderBy(period)


def two_party_margin(
    df: DataFrame,
    keys: list[str],
    party: str,
    votes: str,
    a: str,
    b: str,
    total: str | None = None,
    names: DataFrame | None = None,
    period: str | None = None,
) -> DataFrame:
    """Votes and shares of two parties per unit, the margin, and who won and lost with what share.

    ``total`` is the column of all votes of the unit, the same on each of its rows; without it all
    votes are added up. A party without votes has 0, and ``a`` has to be ahead to win. ``names`` holds a name per party (columns ``a`` and ``b``) for each ``period``.
    """
    whole = F.sum(col(votes)) if total is None else F.max(col(total))
    totals = df.groupBy(*[col(k) for k in keys]).agg(
        F.coalesce(F.sum(F.when(col(party) == a, col(votes))), F.lit(0)).alias("a_votes"),
        F.coalesce(F.sum(F.when(col(party) == b, col(votes))), F.lit(0)).alias("b_votes"),
        whole.alias("total_votes"),
    )
    shares = totals.withColumns(
        {
            "a_pct": F.try_divide(F.col("a_votes").cast("double"), F.col("total_votes")),
            "b_pct": F.try_divide(F.col("b_votes").cast("double"), F.col("total_votes")),
        }
    )
    a_wins, voted = F.col("a_pct") > F.col("b_pct"), F.col("a_pct").isNotNull()  # no votes at all, no winner
    out = {
        "diff_pct": F.col("a_pct") - F.col("b_pct"),
        "abs_diff_pct": F.abs(F.col("a_pct") - F.col("b_pct")),
        "winning_party": F.when(voted, choose(a_wins, F.lit(a), F.lit(b))),
        "losing_party": F.when(voted, choose(a_wins, F.lit(b), F.lit(a))),
        "winning_pct": choose(a_wins, "a_pct", "b_pct"),
        "losing_pct": choose(a_wins, "b_pct", "a_pct"),
    }
    if names is not None:
        shares = shares.join(names.select(col(period), col(a).alias("__a"), col(b).alias("__b")), period, "left")
        out["winner"] = F.when(voted, choose(a_wins, "__a", "__b"))
        out["loser"] = F.when(voted, choose(a_wins, "__b", "__a"))
    return shares.withColumns(out).drop("__a", "__b")


def unit_winners(df: DataFrame, a: str, b: str, a_label: str, b_label: str) -> DataFrame:
    """Add the winning and losing label of each unit; null votes are none, and party ``a`` has to be ahead to win."""
    a_wins = F.coalesce(col(a), F.lit(0)) > F.coalesce(col(b), F.lit(0))
    return df.withColumns(
        {
            "unit_winner": choose(a_wins, F.lit(a_label), F.lit(b_label)),
            "unit_loser": choose(a_wins, F.lit(b_label), F.lit(a_label)),
        }
    )


def win_loss_record(
    df: DataFrame, unit: str, period: str, winner: str, outcomes: DataFrame, outcome: str
) -> DataFrame:
    """How often each unit went with the overall winner of the period, and how often against."""
    judged = df.join(outcomes.select(col(period), col(outcome).alias("__outcome")), period, "left")
    return (
        judged.groupBy(col(unit))
        .agg(
            F.sum(flag(col(winner) == F.col("__outcome"))).alias("win"),
            F.sum(flag(col(winner) != F.col("__outcome"))).alias("loss"),
        )
        .orderBy(F.desc("win"), unit)
    )


def winner_matrix(df: DataFrame, period: str, unit: str, winner: str, units: list | None = None) -> DataFrame:
    """Winning label per period, one column per unit."""
    return pivot_strict(df, period, unit, winner, units).withColumn(period, col(period).cast("string"))
