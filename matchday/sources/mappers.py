"""Default lookup tables for conforming league and team identities.

They are ordinary dimension DataFrames: pass your own to ``clean`` to extend
or replace them, or read them from CSV with :func:`read_mapper_csv`.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LEAGUE_MAPPER_SCHEMA, TEAM_MAPPER_SCHEMA
from .tables import local_table

# --- fixed values: league name spellings -> one league name (CSV, header first) ---
LEAGUE_MAPPER_CSV = """\
league_name_raw,league_name_unique
1. Fussball-Bundesliga,1. Fussball-Bundesliga
1. Fußball-Bundesliga,1. Fussball-Bundesliga
2. Fussball-Bundesliga,2. Fussball-Bundesliga
2. Fußball-Bundesliga,2. Fussball-Bundesliga
3. Liga,3. Fussball-Bundesliga
3. Fußball-Liga,3. Fussball-Bundesliga
3. Fußball-Bundesliga,3. Fussball-Bundesliga
"""

# --- fixed values: feed team ids -> one id per club (CSV, header first) ----------
TEAM_MAPPER_CSV = """\
team_name,team_id_raw,team_id_unique
1. FC Heidenheim 1846,199,199
1. FC Kaiserslautern,76,76
1. FC Köln,65,65
1. FC Magdeburg,78,78
1. FC Nürnberg,79,79
1. FC Saarbrücken,417,417
1. FC Union Berlin,80,80
1. FSV Mainz 05,81,81
1. FSV Mainz 05 II,196,196
Alemannia Aachen,23,23
Arminia Bielefeld,83,83
Bayer Leverkusen,6,6
Borussia Dortmund,7,7
Borussia Dortmund II,187,187
Borussia Dortmund II,1714,187
Borussia Mönchengladbach,87,87
Chemnitzer FC,202,202
Eintracht Braunschweig,74,74
Eintracht Frankfurt,91,91
Energie Cottbus,93,93
FC Augsburg,95,95
FC Bayern München,40,40
FC Bayern München II,179,179
FC Carl Zeiss Jena,69,69
FC Erzgebirge Aue,66,66
FC Erzgebirge Aue,1067,66
FC Hansa Rostock,102,102
FC Ingolstadt 04,171,171
FC Kickers Würzburg,398,398
FC Rot-Weiss Erfurt,176,176
FC Rot-Weiss Erfurt,2111,176
FC Schalke 04,9,9
FC St. Pauli,98,98
FC Viktoria 1889 Berlin,4597,4597
FC Viktoria Köln,2199,2199
FSV Frankfurt,172,172
FSV Zwickau,1979,1979
Fortuna Düsseldorf,185,185
Fortuna Köln,1718,1718
Hallescher FC,208,208
Hamburger SV,100,100
Hannover 96,55,55
Hannover 96 II,1766,1766
Hertha BSC,54,54
Holstein Kiel,104,104
Jahn Regensburg,181,181
KFC Uerdingen 05,563,563
Karlsruher SC,105,105
Kickers Emden,180,180
Kickers Offenbach,29,29
MSV Duisburg,107,107
Preußen Münster,188,188
RB Leipzig,1635,1635
Rot-Weiss Ahlen,110,110
Rot-Weiss Essen,109,109
Rot-Weiss Oberhausen,173,173
SC Fortuna Köln,1730,1730
SC Freiburg,112,112
SC Freiburg II,2397,2397
SC Paderborn 07,31,31
SC Verl,114,114
SG Dynamo Dresden,177,177
SG Sonnenhof Großaspach,529,529
SSV Ulm 1846,564,564
SV Babelsberg 03,117,117
SV Darmstadt 98,118,118
SV Elversberg 07,198,198
SV Meppen,599,599
SV Sandhausen,119,119
SV Waldhof Mannheim,553,553
SV Wehen Wiesbaden,174,174
SpVgg Greuther Fürth,115,115
SpVgg Oberfranken Bayreuth,2953,2953
SpVgg Unterhaching,116,116
Sportfreunde Lotte,191,191
Stuttgarter Kickers,178,178
TSG 1899 Hoffenheim,123,123
TSG 1899 Hoffenheim,175,123
TSV 1860 München,125,125
TSV Havelse,126,126
TuS Koblenz,127,127
Türkgücü München,5211,5211
VfB Lübeck,532,532
VfB Oldenburg,600,600
VfB Stuttgart,16,16
VfB Stuttgart II,184,184
VfL Bochum,129,129
VfL Osnabrück,36,36
VfL Wolfsburg,131,131
VfR Aalen,183,183
Wacker Burghausen,73,73
Werder Bremen,134,134
Werder Bremen II,135,135
Wuppertaler SV,137,137
Würzburger Kickers,4437,4437
"""
# -----------------------------------------------------------------------------


def _rows(text: str, types: tuple) -> list[tuple]:
    reader = csv.reader(io.StringIO(text))
    next(reader)
    return [tuple(t(v) for t, v in zip(types, row)) for row in reader if row]


def league_mapper(spark: SparkSession) -> DataFrame:
    """The default league mapper (7 spellings of 3 leagues)."""
    return local_table(spark, _rows(LEAGUE_MAPPER_CSV, (str, str)), LEAGUE_MAPPER_SCHEMA)


def team_mapper(spark: SparkSession) -> DataFrame:
    """The default team mapper (raw feed id -> conformed id)."""
    return local_table(spark, _rows(TEAM_MAPPER_CSV, (str, int, int)), TEAM_MAPPER_SCHEMA)


def read_mapper_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Read a mapper CSV with a header and a declared schema (``kind``: league or team)."""
    schema = {"league": LEAGUE_MAPPER_SCHEMA, "team": TEAM_MAPPER_SCHEMA}.get(kind)
    if schema is None:
        raise ValueError("kind must be 'league' or 'team'")
    return spark.read.schema(schema).option("header", True).csv(path)
