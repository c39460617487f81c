"""K: league tables and elections."""

from pyspark.sql import functions as F

from chartframes.functions import flag
from chartframes.operators.aggregate import sums
from chartframes.operators.ordered import first_row
from chartframes.operators.reshape import pivot_sum
from chartframes.plans import (
    candidates_by_year,
    league_table,
    running_matrix,
    two_party_margin,
    win_loss_record,
    winner_matrix,
)
from chartframes.plans.contests import running_totals, unit_winners
from chartframes.session import pin
from checks.registry import cents, check, double, rounded

NATIONS = [f"NATION_{i}" for i in range(25)]


def matches(t):
    status = F.col("o_orderstatus")
    wins, draws, losses = flag(status == "F"), flag(status == "O"), flag(status == "P")
    return t.orders.select(
        F.year("o_orderdate").alias("season"),
        F.col("o_custkey").alias("team"),
        wins.alias("win"),
        draws.alias("draw"),
        losses.alias("loss"),
        (3 * wins + draws).alias("points"),
        (wins - losses).alias("diff"),
    )


@check(
    "k04_league_table",
    """WITH m AS (SELECT year(o_orderdate) AS season, o_custkey AS team, (o_orderstatus = 'F')::INT AS win,
         (o_orderstatus = 'O')::INT AS draw, (o_orderstatus = 'P')::INT AS loss FROM orders),
       g AS (SELECT season, team, sum(win)::BIGINT AS w, sum(draw)::BIGINT AS d, sum(loss)::BIGINT AS l,
         sum(3 * win + draw)::BIGINT AS p, sum(win - loss)::BIGINT AS gd FROM m GROUP BY ALL)
       SELECT *, w + d + l AS matches, round(p / (w + d + l), 6) AS pts_per_match,
         row_number() OVER (PARTITION BY season ORDER BY p / (w + d + l) DESC, gd DESC, team) AS rank FROM g""",
)
def k04(t):
    table = league_table(matches(t), "season", "team", "win", "draw", "loss", "points", "diff")
    return table.withColumns(rounded("pts_per_match"))


def nation_months(t):
    """Revenue per nation and month: a season is a year, a match is a month."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    date = F.col("o_orderdate")
    months = joined.groupBy(F.year(date).alias("season"), F.month(date).alias("month"), F.col("n_name").alias("team"))
    return months.agg(F.sum(cents("o_totalprice")).alias("value"))


NATION_MONTHS = """SELECT year(o_orderdate) AS season, month(o_orderdate) AS month, n_name AS team,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""

RUNNING = f"""WITH v AS ({NATION_MONTHS})
    SELECT season, team, row_number() OVER w AS match_num, CAST(sum(value) OVER (PARTITION BY season, team
      ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total FROM v WINDOW w AS (PARTITION BY season, team ORDER BY month)
    UNION ALL SELECT DISTINCT season, team, 0, 0.0 FROM v"""


@check(
    "k05_running_matrix",
    "SELECT season, match_num, "
    + ", ".join(f"max(total) FILTER (team = '{n}') AS {n}" for n in NATIONS)
    + f" FROM ({RUNNING}) GROUP BY season, match_num",
)
def k05(t):
    return running_matrix(nation_months(t), "season", "team", "value", ["month"], values=NATIONS).withColumns(double(*NATIONS))


@check(
    "k05_running_totals",
    """SELECT year(o_orderdate) AS season, o_custkey AS team, row_number() OVER w AS match_num,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY year(o_orderdate), o_custkey
         ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
       FROM orders WINDOW w AS (PARTITION BY year(o_orderdate), o_custkey ORDER BY o_orderdate, o_orderkey)
       UNION ALL SELECT DISTINCT year(o_orderdate), o_custkey, 0, 0.0 FROM orders""",
)
def k05_long(t):
    orders = t.orders.select(
        F.year("o_orderdate").alias("season"),
        F.col("o_custkey").alias("team"),
        "o_orderdate",
        "o_orderkey",
        cents("o_totalprice").alias("value"),
    )
    return running_totals(orders, "season", "team", "value", ["o_orderdate", "o_orderkey"]).withColumns(double("total"))


@check("c10_baseline_row", "SELECT DISTINCT year(o_orderdate) AS season, o_custkey AS team, 0 AS match_num, 0.0::DOUBLE AS total FROM orders")
def c10(t):
    orders = t.orders.select(F.year("o_orderdate").alias("season"), F.col("o_custkey").alias("team"), "o_orderkey", cents("o_totalprice").alias("value"))
    rows = running_totals(orders, "season", "team", "value", ["o_orderkey"])
    return rows.where("match_num = 0").withColumns(double("total"))


def votes(t):
    """An election per year: nations are the states, order statuses the parties, prices the votes."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.year("o_orderdate").alias("year"),
        F.col("n_name").alias("state"),
        F.col("o_orderstatus").alias("party"),
        cents("o_totalprice").alias("votes"),
        "c_name",
        "o_orderkey",
        "o_totalprice",
    )


def nominees(t):
    """The customer of the largest order stands for a party in a year."""
    best = first_row(votes(t), ["year", "party"], ["-o_totalprice", "o_orderkey"])
    return candidates_by_year(best, "year", "party", "c_name", ["F", "O", "P"])


NOMINEES = """SELECT year(o_orderdate) AS year, o_orderstatus AS party, arg_max(c_name, (o_totalprice, -o_orderkey)) AS name
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""

BY_YEAR = f"""SELECT year, max(name) FILTER (party = 'F') AS "F", max(name) FILTER (party = 'O') AS "O",
    max(name) FILTER (party = 'P') AS "P" FROM ({NOMINEES}) GROUP BY year"""


@check("k15_candidates_by_year", BY_YEAR)
def k15(t):
    return nominees(t)


VOTES = """SELECT year(o_orderdate) AS year, n_name AS state,
    coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F'), 0) AS a,
    coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O'), 0) AS b,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""


@check(
    "k12_two_party_margin",
    f"""WITH v AS ({VOTES}), s AS (SELECT *, a::DOUBLE / total::DOUBLE AS pa, b::DOUBLE / total::DOUBLE AS pb FROM v),
        n AS ({BY_YEAR})
        SELECT year, state, a::DOUBLE AS a_votes, b::DOUBLE AS b_votes, total::DOUBLE AS total_votes, round(pa, 6) AS a_pct,
          round(pb, 6) AS b_pct, round(pa - pb, 6) AS diff_pct, round(abs(pa - pb), 6) AS abs_diff_pct,
          CASE WHEN pa > pb THEN 'F' ELSE 'O' END AS winning_party, CASE WHEN pa > pb THEN 'O' ELSE 'F' END AS losing_party,
          round(CASE WHEN pa > pb THEN pa ELSE pb END, 6) AS winning_pct, round(CASE WHEN pa > pb THEN pb ELSE pa END, 6) AS losing_pct,
          CASE WHEN pa > pb THEN "F" ELSE "O" END AS winner, CASE WHEN pa > pb THEN "O" ELSE "F" END AS loser
        FROM s JOIN n USING (year)""",
)
def k12(t):
    out = two_party_margin(votes(t), ["year", "state"], "party", "votes", "F", "O", names=nominees(t), period="year")
    shares = ["a_pct", "b_pct", "diff_pct", "abs_diff_pct", "winning_pct", "losing_pct"]
    return out.withColumns(double("a_votes", "b_votes", "total_votes") | rounded(*shares))


def state_votes(t):
    return pivot_sum(votes(t), ["year", "state"], "party", "votes", ["F", "O", "P"])


def winners(wide):
    return unit_winners(wide, "F", "O", "Filled", "Open")


UNOPPOSED = """SELECT year(o_orderdate) AS year, n_name || '/' || (o_custkey % 50) AS state,
    coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F'), 0) AS a,
    coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P'), 0) AS b,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""


def wards(t):
    """Units so small that many have no votes for one of the parties."""
    ward = F.concat("n_name", F.lit("/"), (F.col("o_custkey") % 50).cast("string"))
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.year("o_orderdate").alias("year"), ward.alias("state"), F.col("o_orderstatus").alias("party"), cents("o_totalprice").alias("votes")
    )


@check(
    "k12_unopposed",
    f"""SELECT year, state, a::DOUBLE AS a_votes, b::DOUBLE AS b_votes, CASE WHEN a > b THEN 'F' ELSE 'P' END AS winning_party,
        round(a::DOUBLE / total::DOUBLE - b::DOUBLE / total::DOUBLE, 6) AS diff_pct FROM ({UNOPPOSED})""",
)
def k12_unopposed(t):
    out = two_party_margin(wards(t), ["year", "state"], "party", "votes", "F", "P")
    out = out.withColumns(double("a_votes", "b_votes") | rounded("diff_pct"))
    return out.select("year", "state", "a_votes", "b_votes", "winning_party", "diff_pct")


@check(
    "k13_unopposed",
    f"SELECT year, state, CASE WHEN a > b THEN 'Filled' ELSE 'Pending' END AS unit_winner FROM ({UNOPPOSED})",
)
def k13_unopposed(t):
    wide = pivot_sum(wards(t), ["year", "state"], "party", "votes", ["F", "O", "P"])
    return unit_winners(wide, "F", "P", "Filled", "Pending").select("year", "state", "unit_winner")


WINNERS = f"""SELECT year, state, CASE WHEN a > b THEN 'Filled' ELSE 'Open' END AS unit_winner FROM ({VOTES})"""


@check(
    "k13_win_loss_record",
    f"""WITH w AS ({WINNERS}), o AS (SELECT year, CASE WHEN sum(a) > sum(b) THEN 'Filled' ELSE 'Open' END AS winner FROM ({VOTES}) GROUP BY year)
        SELECT state, count(*) FILTER (unit_winner = winner) AS win, count(*) FILTER (unit_winner <> winner) AS loss
        FROM w JOIN o USING (year) GROUP BY state""",
)
def k13(t):
    states = pin(state_votes(t))
    years = winners(sums(states, "year", ["F", "O"])).select("year", F.col("unit_winner").alias("winner"))
    return win_loss_record(winners(states), "state", "year", "unit_winner", years, "winner")


@check(
    "k14_winner_matrix",
    "SELECT CAST(year AS VARCHAR) AS year, "
    + ", ".join(f"max(unit_winner) FILTER (state = '{n}') AS {n}" for n in NATIONS)
    + f" FROM ({WINNERS}) GROUP BY year",
)
def k14(t):
    return winner_matrix(winners(state_votes(t)), "year", "state", "unit_winner", NATIONS)
