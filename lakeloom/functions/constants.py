"""Labels, keys, thresholds and tables that results must reproduce exactly."""

from datetime import date

# Fixed values.
# The source writes moments as yyyy-MM-dd HH:mm:ss.
SOURCE_TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

UNKNOWN_KEY = "-1"
UNKNOWN_DATE_KEY = -1
UNKNOWN_LABEL = "Unknown"

FIRST_VALID_FROM = date(1900, 1, 1)
OPEN_VALID_TO = date(9999, 12, 31)

DELIVERED = "DELIVERED"
NO_CATEGORY = "Sin categoria"

SEGMENTS = ("Bronze", "Silver", "Gold")
SEGMENT_WINDOW_DAYS = 365
SILVER_FROM = 5_000
GOLD_ABOVE = 50_000

NEGATIVE_SCORE_MAX = 2
POSITIVE_SCORE_MIN = 4

WEIGHT_LABELS = ("ligero", "medio", "pesado")  # below 500 g, 500 to 2000 g, above 2000 g
WEIGHT_LIMITS = (500, 2000)

DELAY_ON_TIME = "a tiempo"
DELAY_LABELS = ("1-3 dias", "4-7 dias", ">7 dias")
DELAY_LIMITS = (3, 7)

REPURCHASE_WINDOWS = (3, 6, 12)

STATES_BY_REGION = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}

CRITICAL_NULL_RATE = 0.005
SESSION_GAP_MINUTES = 30

JDBC_BATCH_ROWS = 10_000
