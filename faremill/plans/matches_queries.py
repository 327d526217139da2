"""Games and team matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faremill.plans import matches as m
from faremill.plans.stand_ins import (
    GAMES_SQL,
    MATCHES_SQL,
    TEAM,
    game_source,
    match_source,
    profile_source,
)
from faremill.registry import query
from faremill.sources.landing import flatten
from faremill.sources.tables import plain


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(match_source(spark, sf_dir))


@query(
    "X17 J5 A11 A13 X11 X23",
    f"""WITH {GAMES_SQL}, counts AS (
      SELECT username, aid, count(*) AS total_games,
             count(*) FILTER (WHERE aid = white_aid) AS white_games,
             count(*) FILTER (WHERE aid = black_aid) AS black_games,
             count(*) FILTER (WHERE aid = winner_aid AND aid = white_aid) AS white_wins,
             count(*) FILTER (WHERE aid = winner_aid AND aid = black_aid) AS black_wins
      FROM profiles LEFT JOIN games ON aid IN (white_aid, black_aid)
      GROUP BY ALL)
    SELECT *,
           CASE WHEN white_games > 0
                THEN round(CAST(white_wins AS DOUBLE) * 100 / white_games, 2) END AS white_win_rate,
           CASE WHEN black_games > 0
                THEN round(CAST(black_wins AS DOUBLE) * 100 / black_games, 2) END AS black_win_rate
    FROM counts""",
)
def player_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.player_summary(game_source(spark, sf_dir), profile_source(spark, sf_dir))


@query(
    "A12 X4 X18 F1 R3",
    f"""WITH {MATCHES_SQL}
    SELECT season, count(id) AS matches_played,
           count(CASE WHEN score__winner = own_side THEN 1 END) AS wins,
           count(CASE WHEN score__winner = 'DRAW' THEN 1 END) AS draws,
           count(CASE WHEN score__winner IN ('HOME_TEAM', 'AWAY_TEAM')
                       AND score__winner <> own_side THEN 1 END) AS losses
    FROM finished GROUP BY season""",
)
def season_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.season_record(_matches(spark, sf_dir), TEAM)


@query(
    "W5 X13 O1",
    f"""WITH {MATCHES_SQL}, scored AS (
      SELECT season, utc_date, id,
             CAST(CASE WHEN score__winner = own_side THEN 3
                       WHEN score__winner = 'DRAW' THEN 1 ELSE 0 END AS BIGINT) AS points
      FROM finished)
    SELECT season, utc_date, id, points,
           CAST(sum(points) OVER (PARTITION BY season ORDER BY utc_date, id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_points
    FROM scored""",
)
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(m.running_points(_matches(spark, sf_dir), TEAM))


_GOALS_SQL = f"""{MATCHES_SQL}, goals AS (
  SELECT season,
         CAST(sum(CASE WHEN is_home THEN score__full_time__home ELSE score__full_time__away END)
              AS BIGINT) AS goals_scored,
         CAST(sum(CASE WHEN is_home THEN score__full_time__away ELSE score__full_time__home END)
              AS BIGINT) AS goals_conceded
  FROM finished GROUP BY season
)"""


@query("R2", f"WITH {_GOALS_SQL} SELECT * FROM goals")
def goals_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.season_goals(_matches(spark, sf_dir), TEAM)


@query(
    "R1",
    f"""WITH {_GOALS_SQL}
    SELECT season, 'goals_scored' AS metric, goals_scored AS goals FROM goals
    UNION ALL SELECT season, 'goals_conceded', goals_conceded FROM goals""",
)
def unpivot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.season_goals_long(_matches(spark, sf_dir), TEAM)
