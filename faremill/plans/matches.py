"""Two-sided records: games between players and matches of one team."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.numbers import pct
from faremill.operators.joins import either_side
from faremill.operators.rows import running_total
from faremill.operators.shape import by_side, unpivot

# fixed values: one side of a game, as JSON text
SIDE = T.StructType(
    [T.StructField("@id", T.StringType()), T.StructField("result", T.StringType())]
)


def game_results(games: DataFrame) -> DataFrame:
    """Player ids of both sides and the winner's; each JSON text is parsed once."""
    sides = games.select(
        F.from_json("white", SIDE).alias("white"), F.from_json("black", SIDE).alias("black")
    )
    white, black = F.col("white")["@id"], F.col("black")["@id"]
    winner = F.when(F.col("white.result") == "win", white).when(
        F.col("black.result") == "win", black
    )
    return sides.select(
        white.alias("white_aid"), black.alias("black_aid"), winner.alias("winner_aid")
    )


def player_summary(games: DataFrame, profiles: DataFrame) -> DataFrame:
    """Games, wins and win rates per player and side.

    Games are counted per player before they meet the profiles, so a player with very many
    games is one row in the join. A player without games shows one game and no rates (the
    left join's own row is counted). Repeated profile rows repeat their counts.
    """
    sides = either_side(game_results(games), ["white_aid", "black_aid"], "aid")
    white, black = F.col("white_aid") == F.col("aid"), F.col("black_aid") == F.col("aid")
    won = F.col("winner_aid") == F.col("aid")
    played = sides.groupBy("aid").agg(
        F.count(F.lit(1)).alias("total_games"),
        F.count_if(white & won).alias("white_wins"),
        F.count_if(black & won).alias("black_wins"),
        F.count_if(white).alias("white_games"),
        F.count_if(black).alias("black_games"),
    )
    people = profiles.groupBy("username", "aid").agg(F.count(F.lit(1)).alias("_copies"))
    joined = people.join(played, "aid", "left")

    def times_copies(name: str, none: int) -> Column:
        return (F.coalesce(F.col(name), F.lit(none)) * F.col("_copies")).alias(name)

    counts = joined.select(
        "username", "aid", times_copies("total_games", 1),
        *[times_copies(c, 0) for c in ("white_wins", "black_wins", "white_games", "black_games")],
    )
    return counts.withColumns(
        {
            "white_win_rate": pct(F.col("white_wins"), F.col("white_games")),
            "black_win_rate": pct(F.col("black_wins"), F.col("black_games")),
        }
    ).orderBy(F.col("total_games").desc(), "aid")


def finished(matches: DataFrame, team: int) -> DataFrame:
    """Finished matches with season and the outcome from the team's side."""
    winner, at_home = F.col("score__winner"), F.col("home_team__id") == team
    own = by_side(at_home, F.lit("HOME_TEAM"), F.lit("AWAY_TEAM"))
    return matches.filter(F.col("status") == "FINISHED").withColumns(
        {
            "season": F.year(F.to_date("season__start_date")),
            "is_home": at_home,
            "is_win": winner == own,
            "is_draw": winner == "DRAW",
            "is_loss": ~winner.isin("DRAW") & (winner != own),
        }
    )


def season_record(matches: DataFrame, team: int) -> DataFrame:
    def times(flag: str) -> Column:
        return F.sum(F.col(flag).cast("int"))

    return (
        finished(matches, team)
        .groupBy("season")
        .agg(
            F.count("id").alias("matches_played"),
            times("is_win").alias("wins"),
            times("is_draw").alias("draws"),
            times("is_loss").alias("losses"),
        )
        .orderBy("season")
    )


def points(win: str, draw: str) -> Column:
    return F.when(F.col(win), 3).when(F.col(draw), 1).otherwise(0)


def running_points(matches: DataFrame, team: int) -> DataFrame:
    """Points after each match of a season, in time order; the id settles equal times."""
    scored = finished(matches, team).select(
        "season", "utc_date", "id", points("is_win", "is_draw").cast("long").alias("points")
    )
    return running_total(scored, ["season"], ["utc_date", "id"], "points", "running_points")


def season_goals(matches: DataFrame, team: int) -> DataFrame:
    home, away = "score__full_time__home", "score__full_time__away"
    return (
        finished(matches, team)
        .groupBy("season")
        .agg(
            F.sum(by_side(F.col("is_home"), home, away)).alias("goals_scored"),
            F.sum(by_side(F.col("is_home"), away, home)).alias("goals_conceded"),
        )
        .orderBy("season")
    )


def season_goals_long(matches: DataFrame, team: int) -> DataFrame:
    return unpivot(
        season_goals(matches, team), ["season"], ["goals_scored", "goals_conceded"],
        "metric", "goals",
    )
