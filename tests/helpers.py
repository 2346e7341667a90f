"""Small hand-made clean match tables for operator tests."""

from matchday.functions.features import DEFAULT_FEATURES

CLEAN_DDL = (
    "match_id bigint, league_id bigint, league_name string, season_name string, match_day bigint, "
    "match_day_name string, team_id_1 bigint, team_id_2 bigint, team_name_1 string, team_name_2 string, "
    "goals_team_1 bigint, goals_team_2 bigint, goals_diff bigint, result_class int, result_name string, "
    "points_team_1 int, points_team_2 int"
)


def clean_rows(spark, games, result_name="Endergebnis"):
    """games: (match_id, league_id, match_day, team_1, team_2, goals_1, goals_2[, day_name])"""
    rows = []
    for g in games:
        mid, lid, day, t1, t2, g1, g2 = g[:7]
        name = g[7] if len(g) > 7 else f"{day}. Spieltag"
        if g1 is None or g2 is None:
            rc = p1 = p2 = None
        else:
            rc = (g1 > g2) - (g1 < g2)
            p1, p2 = {1: (3, 0), 0: (1, 1), -1: (0, 3)}[rc]
        gg1, gg2 = g1 or 0, g2 or 0
        diff = (g1 - g2) if (g1 is not None and g2 is not None) else 0
        rows.append((mid, lid, "L", "2023/2024", day, name, t1, t2, f"T{t1}", f"T{t2}",
                     gg1, gg2, diff, rc, result_name, p1, p2))
    df = spark.createDataFrame(rows, CLEAN_DDL)
    assert df.columns == list(DEFAULT_FEATURES)
    return df
