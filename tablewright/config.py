"""Parameters of the preparation stages.

Every threshold the stages use lives here so a caller can override it per run
(``PrepConfig(null_threshold=0.5)``) instead of editing a config file.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced, so they are
# stated plainly and kept together.
# ---------------------------------------------------------------------------

# Text tokens a CSV scan turns into null (the pandas default NA token list).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The only strings (after stripping) that make a column boolean.
BOOLEAN_TOKENS = ("Y", "N")

# Default message sink: broker address and topic (overridable by arguments
# and by the KAFKA_BOOTSTRAP_SERVERS / KAFKA_TOPIC environment variables).
KAFKA_SERVERS = "localhost:9092"
KAFKA_TOPIC = "restaurants"

# Defaults of the stages.
CHUNK_SIZE = 50_000
NULL_THRESHOLD = 0.70
NUMERIC_CATEGORICAL_THRESHOLD = 20
DICT_SHARE = 0.5
LIST_SHARE = 0.5
COMMA_SHARE = 0.3
SKEW_LOG_THRESHOLD = 2.0
IQR_FACTOR = 1.5
HISTOGRAM_BINS = 50
KDE_POINTS = 200
KDE_BANDWIDTH = 0.6
TOP_N_CATEGORIES = 20
TOP_N_COOCCURRENCE = 15
SCATTER_SAMPLE_ROWS = 10_000
OHE_MAX_CARDINALITY = 15
PCA_MAX_COMPONENTS = 50
MESSAGE_BATCH_SIZE = 500
INLINE_DICTIONARY_LIMIT = 256
BROADCAST_BYTES = 64 * 1024 * 1024

# Semantic column types.
NUMERIC = "numeric"
NUMERIC_CATEGORICAL = "numeric_categorical"
BOOLEAN = "boolean"
CATEGORICAL = "categorical"
DICT_JSON = "dict_json"
LIST_JSON = "list_json"

# Parse hints attached to list/dict columns.
HINT_DICT = "dict"
HINT_JSON = "json"
HINT_CSV = "csv"

CATEGORY_LIKE = (CATEGORICAL, BOOLEAN, NUMERIC_CATEGORICAL)
LIST_LIKE = (LIST_JSON, DICT_JSON)


@dataclass(frozen=True)
class PrepConfig:
    """Tunable parameters; defaults reproduce the reference behaviour."""

    null_threshold: float = NULL_THRESHOLD
    numeric_categorical_threshold: int = NUMERIC_CATEGORICAL_THRESHOLD
    # ``None`` types each column on the whole table. A number types it on the
    # first rows by row id; later values that do not fit the type are lost.
    type_sample_rows: int | None = None
    no_list: tuple[str, ...] = field(default_factory=tuple)
    top_n_categories: int = TOP_N_CATEGORIES
    top_n_cooccurrence: int = TOP_N_COOCCURRENCE
    scatter_sample_rows: int = SCATTER_SAMPLE_ROWS
    ohe_max_cardinality: int = OHE_MAX_CARDINALITY
    histogram_bins: int = HISTOGRAM_BINS
    kde_points: int = KDE_POINTS
    kde_bandwidth: float = KDE_BANDWIDTH
    skew_log_threshold: float = SKEW_LOG_THRESHOLD
    chunk_size: int = CHUNK_SIZE
    message_batch_size: int = MESSAGE_BATCH_SIZE
    # Per-column distinct-value count up to which a single task may number one
    # column's values (dictionary). Above it positions are distributed.
    single_task_distinct_limit: int = 1_000_000
    # Dictionaries up to this many rows are inlined as map literals instead
    # of being joined. Kept small: every entry is a literal in the plan (built
    # and shipped by the driver); larger dictionaries take a broadcast join.
    inline_dictionary_limit: int = INLINE_DICTIONARY_LIMIT
    # Counted bytes up to which a lookup side may be broadcast.
    broadcast_bytes: int = BROADCAST_BYTES
    # The id column is a dense 0-based row id, so "first n rows" is a filter.
    dense_row_id: bool = True
