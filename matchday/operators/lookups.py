"""Previous-match-day lookups: attach a team's table row of match day d-1 to a game on day d.

The semantics are "the row whose match day is exactly one less" (a team that
skipped a day gets nothing), so this is an equi join on a shifted key, not
``lag``. Duplicate keys on the right fan out exactly like the left join they
stand for.

Plan shape, for a base with one row per (match, side) and lookup tables keyed
by (league, team, match day):

* the lookup projection is the same for both teams of a match (neutral column
  names, renamed after the join), so its shuffle is computed once and reused
  for the second team;
* all lookups of team 1 are joined before those of team 2: consecutive joins
  on the same base keys keep the base partitioning, so the base is shuffled
  once per team, not once per lookup;
* rows whose key contains a null can never match. A shuffle join would still
  hash all of them to one reducer (unmapped teams are null), so they carry a
  spread-out salt that joins nothing: the load is split, the result unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.buckets import bucketed_by

# Least number of salts for null-key rows; the session's shuffle width is used when larger.
NULL_KEY_SPREAD = 256
_LK = "_lk_"


def null_spread_salt(keys: Sequence[str], spread_by: str, spread: int = NULL_KEY_SPREAD) -> Column:
    """0 for rows with a complete key; 1..spread (hash of ``spread_by``) for rows with a null in the key."""
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
    return (
        F.when(any_null, F.pmod(F.xxhash64(F.col(spread_by)), F.lit(spread)) + F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def zero_salt(keys: Sequence[str]) -> Column:
    """0 on every row, computed from the key columns.

    A literal 0 would be folded out of the join keys by the optimizer (an
    equality with a constant is not a key), and the salt would then no longer
    take part in the hash partitioning.
    """
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1)).cast("int")


def previous_day_features(
    base: DataFrame,
    tables: Sequence[tuple[DataFrame, Sequence[str]]],
    sides: Sequence[int] = (1, 2),
    league_col: str = "league_id",
    day_col: str = "match_day",
    team_col: str = "team_id",
    offset: int = 1,
    spread_by: str | None = "match_id",
    spread: int | None = None,
) -> DataFrame:
    """Left-join, for every team ``team_id_<side>`` of ``base``, the listed columns of each
    lookup table at (league, team, day - offset), named ``<column>_<side>``.

    Output columns: ``base`` columns, then per table (in order) its columns for
    side 1, then for side 2.

    A table whose buckets are known to be by (league, team, day) is joined on these very columns, so it is read bucket by
    bucket and only the base is shuffled.
    """
    if spread is None:
        # null-key rows never match: spread them as wide as the shuffle itself
        from .skew import shuffle_width

        spread = max(NULL_KEY_SPREAD, shuffle_width(base.sparkSession))
    salt_ok = bool(spread_by) and spread_by in base.columns and spread > 1
    lookups = []
    dealt = [bucketed_by(table) == (league_col, team_col, day_col) for table, _ in tables]
    for table, cols in tables:
        if dealt[len(lookups)]:
            keys = [F.col(c).alias(f"{_LK}{k}") for c, k in ((league_col, "league"), (team_col, "team"), (day_col, "day"))]
            lookups.append((table.select(*keys, *[F.col(c).alias(f"{_LK}{c}") for c in cols]), list(cols)))
            continue
        lookups.append(
            (
                table.select(
                    F.col(league_col).alias(f"{_LK}league"),
                    (F.col(day_col) + F.lit(offset)).alias(f"{_LK}day"),
                    F.col(team_col).alias(f"{_LK}team"),
                    zero_salt([league_col, team_col, day_col]).alias(f"{_LK}salt"),
                    *[F.col(c).alias(f"{_LK}{c}") for c in cols],
                ),
                list(cols),
            )
        )
    salts = {}
    for side in sides:
        keys = [league_col, f"{team_col}_{side}", day_col]
        salts[f"_salt_{side}"] = null_spread_salt(keys, spread_by, spread) if salt_ok else F.lit(0)
    if any(dealt):
        # a null team matches nothing: any id of its own spreads it, and the join's condition rules it out
        for side in sides:
            team = F.col(f"{team_col}_{side}")
            own = F.xxhash64(F.col(spread_by)) if salt_ok else F.lit(0).cast("bigint")
            salts[f"_team_{side}"] = F.coalesce(team, own)
        salts["_day"] = F.col(day_col) - F.lit(offset)
    out = base.withColumns(salts)
    picked: dict[tuple[int, int], list[Column]] = {}
    for side in sides:
        team, salt = f"{team_col}_{side}", f"_salt_{side}"
        for i, (lk, cols) in enumerate(lookups):
            # an alias per join keeps names unambiguous; it vanishes in the physical plan,
            # so both teams' joins still share one lookup shuffle
            a = f"_lk{i}_{side}"
            if dealt[i]:
                cond = (
                    (F.col(league_col) == F.col(f"{a}.{_LK}league")) & (F.col(f"_team_{side}") == F.col(f"{a}.{_LK}team"))
                    & (F.col("_day") == F.col(f"{a}.{_LK}day")) & F.col(team).isNotNull()
                )
                out = out.join(lk.alias(a), cond, "left")
                picked[(i, side)] = [F.col(f"{a}.{_LK}{c}").alias(f"{c}_{side}") for c in cols]
                continue
            cond = (
                (F.col(league_col) == F.col(f"{a}.{_LK}league"))
                & (F.col(team) == F.col(f"{a}.{_LK}team"))
                & (F.col(day_col) == F.col(f"{a}.{_LK}day"))
                & (F.col(salt) == F.col(f"{a}.{_LK}salt"))
            )
            out = out.join(lk.alias(a), cond, "left")
            picked[(i, side)] = [F.col(f"{a}.{_LK}{c}").alias(f"{c}_{side}") for c in cols]
    ordered = [F.col(f"`{c}`") for c in base.columns]
    for i in range(len(lookups)):
        for side in sides:
            ordered += picked[(i, side)]
    return out.select(*ordered)


def previous_day_rows(
    panel: DataFrame,
    columns: Sequence[str],
    name: str = "previous",
    league_col: str = "league_id",
    day_col: str = "match_day",
    team_col: str = "team_id",
    offset: int = 1,
) -> DataFrame:
    """Attach to every row of a team panel the array of structs of ``columns`` of the same team's rows ``offset`` days before.

    A RANGE frame over (league, team) in the order of the day: where the panel is partitioned for its statistics already, no
    further Exchange. The array holds what an equi join on the day would pair the row with: nothing, one row, or all rows of
    a repeated key. Rows with a null in league, team or day match nothing.
    """
    known = F.col(league_col).isNotNull() & F.col(team_col).isNotNull() & F.col(day_col).isNotNull()
    frame = Window.partitionBy(league_col, team_col).orderBy(day_col).rangeBetween(-offset, -offset)
    rows = F.collect_list(F.when(known, F.struct(*columns))).over(frame)
    return panel.withColumn(name, rows)
