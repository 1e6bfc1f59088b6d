"""Fixed values that results depend on, stated as plain data.

Every function takes these as arguments; the constants here are only the defaults.
"""

from __future__ import annotations

# Normalised traffic label -> air zone.
ZONE_MAPPING = {
    # saint_michel
    "st_michel": "saint_michel",
    "quai_st_michel": "saint_michel",
    "pt_st_michel": "saint_michel",
    "gay_lussac": "saint_michel",
    "monge": "saint_michel",
    "lagrange": "saint_michel",
    # nation
    "pl_de_la_nation": "nation",
    "cours_de_vincennes": "nation",
    "av_du_trone": "nation",
    "davout": "nation",
    "soult": "nation",
    "av_ph_Auguste": "nation",
    "philippe_auguste": "nation",
    "roquette": "nation",
    "av_ledru_rollin": "nation",
    "ledru_rollin": "nation",
    # gare_du_nord
    "magenta": "gare_du_nord",
    "maubeuge": "gare_du_nord",
    "marx_dormoy": "gare_du_nord",
    "max_dormoy": "gare_du_nord",
    "la_fayette": "gare_du_nord",
    "ornano": "gare_du_nord",
    "barbes": "gare_du_nord",
    "de_rochechouart": "gare_du_nord",
    "poissonniere": "gare_du_nord",
    "rue_fbg_st_denis": "gare_du_nord",
    "rue_du_fbg_st_denis": "gare_du_nord",
    # paris_centre
    "rivoli": "paris_centre",
    "rue_de_rivoli": "paris_centre",
    "du_palais": "paris_centre",
    "cite": "paris_centre",
    "petit_pont": "paris_centre",
    "rue_du_petit_pont": "paris_centre",
    "pt_notre_dame": "paris_centre",
    "pt_au_change": "paris_centre",
    "quai_de_la_megisserie": "paris_centre",
    "quai_hotel_de_ville": "paris_centre",
    "pl_hotel_de_ville": "paris_centre",
    "carrousel": "paris_centre",
    "pl_du_carrousel": "paris_centre",
    "pt_du_carrousel": "paris_centre",
    "pt_carrousel": "paris_centre",
    "pyramides": "paris_centre",
    "4_septembre": "paris_centre",
}

# Order in which the dashboard lists zones.
ZONE_ORDER = ["chatelet", "gare_du_nord", "nation", "montparnasse", "saint_michel", "paris_centre"]

# Traffic level names and the rounded averages where each next level starts.
LOW, MEDIUM, HIGH = "Low Traffic", "Medium Traffic", "High Traffic"
TRAFFIC_LEVELS = [LOW, MEDIUM, HIGH]
MEDIUM_FROM = 500
HIGH_FROM = 1000

# Text forms in the raw tables.
AIR_TIME_FORMAT = "dd/MM/yyyy HH:mm"
TRAFFIC_PREFIX = "Bd_"

# Validation rules, as SQL predicates over the raw columns. A row is kept only when
# every rule of its table is true, so a NULL drops the row.
AIR_RULES = {
    "pollution_present": "pollution_value IS NOT NULL",
    "pollution_finite": (
        "pollution_value IS NULL OR (pollution_value > double('-Infinity') "
        "AND pollution_value < double('Infinity'))"
    ),
    "aqi_not_negative": "air_quality_index >= 0",
    "temperature_in_range": "temperature BETWEEN -50 AND 60",
    "humidity_in_range": "humidity BETWEEN 0 AND 100",
    "latitude_in_range": "latitude BETWEEN -90 AND 90",
}
# The count arrives as text. Text that is no number counts as negative; infinite counts and NaN have a
# rule of their own, which a caller may leave out.
TRAFFIC_RULES = {
    "count_present": "debit_horaire IS NOT NULL",
    "count_not_negative": "try_cast(debit_horaire AS DOUBLE) >= 0",
    "count_finite": "coalesce(try_cast(debit_horaire AS DOUBLE) < double('Infinity'), true)",
    "segment_open": "etat_arc = 'Ouvert'",
}

# Page size limits of the gold read queries.
DEFAULT_PAGE_SIZE = 20
MAX_POLLUTION_PAGE = 100
MAX_TRAFFIC_PAGE = 200

# Key figures shown when no row is left.
NO_VALUE = "—"
EMPTY_AVERAGE = 0.0

# Bubble size is humidity times a factor, with a floor.
BUBBLE_FLOOR = 20.0
BUBBLE_FACTOR = 0.7
