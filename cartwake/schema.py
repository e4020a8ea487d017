"""Event schema, rule tables and thresholds shared by every operator."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the ones the source system uses.
# ---------------------------------------------------------------------------
IDLE_VELOCITY = 5.0  # px/s, below is idle
EXIT_Y_BOUND = 100.0  # px, above this line the pointer is near the tab bar
EXIT_VELOCITY = 200.0  # px/s
HEARTBEAT_S = 0.25  # assumed gap when the real one is missing or not positive
MAX_GAP_S = 10.0  # historical variant only: longer gaps fall back to HEARTBEAT_S
TREND_DOWN = 0.8
TREND_UP = 1.2
SLOPE_LIMIT = 10.0
SLOPE_MIN_PAIRS = 10
WINDOWS_S = (5, 10, 30)

HISTORY_ITEMS = 150
WARMUP_HEARTBEATS = 10
STATE_TTL_S = 3600
RETENTION_THRESHOLD = 0.7
BUFFER_LIMIT = 100
TRACKED_PAGES = ("cart", "checkout")
HISTORY_WINDOW_S = 180

UNIT_SHIPPING = 4.0
EXPRESS_FACTOR = 3.0

DEFAULT_DEVICE = "desktop"
DEFAULT_PAGE = "catalog"
DEFAULT_SHIPPING = "standard"

_BASE = ["event_type", "session_id", "user_id", "timestamp"]
_CART = [
    "cart_value",
    "product_count",
    "product_quantities",
    "shipping_option_selected",
    "mouse_click_count",
]
REQUIRED_KEYS = {
    "heartbeat": _BASE + _CART + ["mouse_x", "mouse_y", "page"],
    "page_view": _BASE + ["page"] + _CART,
    "add_to_cart": _BASE + ["product_id", "category", "price"] + _CART,
    "remove_from_cart": _BASE + _CART,
    "start_checkout": _BASE + _CART,
    "purchase": _BASE + _CART + ["payment_method"],
    "abandon": _BASE + _CART + ["abandon_reason"],
    "view_product": _BASE + ["product_id", "category", "price"],
    "accept_offer": _BASE + ["retention_type"],
    "reject_offer": _BASE + ["retention_type"],
}

STATE_FIELDS = [
    "device", "delivery_mode", "shipping_type", "shipping_cost",
    "abandon_reason", "payment_method", "product_id", "category", "price",
    "cart_value", "product_count", "product_quantities",
    "shipping_option_selected", "mouse_click_count", "mouse_x", "mouse_y",
    "page", "user_id", "event_type", "offer_state", "retention_type",
]

# (id, name, price, category); the batch catalogue and the storefront's longer
# one agree on the first thirteen products.
_SHARED_PRODUCTS = [
    ("prod_001", "Laptop Gamer X", 1200.0, "computacion"),
    ("prod_002", "Teclado Mecanico RGB", 85.0, "perifericos"),
    ("prod_003", "Monitor 27 4K", 450.0, "computacion"),
    ("prod_004", "Mouse Inalambrico", 45.0, "perifericos"),
    ("prod_005", "Auriculares Bluetooth", 95.0, "audio"),
    ("prod_006", "Webcam HD 1080p", 70.0, "perifericos"),
    ("prod_007", "Tablet 10 Pulgadas", 350.0, "computacion"),
    ("prod_008", "Smartwatch Deportivo", 200.0, "wearables"),
    ("prod_009", "Silla Ergonomicas", 320.0, "muebles"),
    ("prod_010", "Escritorio Electrico", 580.0, "muebles"),
    ("prod_011", "Camara Web 4K", 130.0, "perifericos"),
    ("prod_012", "Hub USB-C 7 puertos", 40.0, "perifericos"),
    ("prod_013", "Microfono Condensador", 110.0, "audio"),
]
BATCH_CATALOGUE = _SHARED_PRODUCTS + [
    ("prod_014", "iPad Air", 650.0, "computacion"),
    ("prod_015", "Cargador Portatil", 35.0, "accesorios"),
]
STORE_CATALOGUE = _SHARED_PRODUCTS + [
    ("prod_014", "Bocina Portatil", 60.0, "audio"),
    ("prod_015", "Mousepad XL", 25.0, "perifericos"),
    ("prod_016", "Laptop Ultraligera", 950.0, "computacion"),
    ("prod_017", "Disco SSD 1TB", 110.0, "computacion"),
    ("prod_018", "Memoria RAM 32GB", 90.0, "computacion"),
    ("prod_019", "Cargador Inalambrico", 35.0, "accesorios"),
    ("prod_020", "Soporte para Laptop", 50.0, "accesorios"),
]

# Model columns in training order.
MODEL_NUMERIC = [
    "velocity_avg", "velocity_max", "velocity_std",
    "acceleration_avg", "acceleration_max",
    "total_idle_ms", "total_distance_px", "exit_intent_count",
    "total_dwell_ms", "dwell_event_count", "session_duration_s",
    "click_frequency", "idle_ratio", "cart_value_max", "cart_value_avg",
    "cart_delta_total", "shipping_switches", "page_regression_count",
    "heartbeat_count", "total_events", "product_count_max",
    "add_to_cart_count", "remove_from_cart_count", "checkout_count",
    "view_product_count", "payment_hesitation_ms", "events_per_minute",
    "total_clicks",
]
MODEL_CATEGORICAL = ["device"]
MODEL_COLUMNS = MODEL_NUMERIC + MODEL_CATEGORICAL
LABEL = "abandoned"
SEED = 42
TEST_SHARE = 0.2
SMOTE_NEIGHBOURS = 5
FOLDS = 3
FOREST_TREES = 10
FOLD_TREES = 5
BOOSTING = {
    "maxIter": 300,
    "maxDepth": 6,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
}
# ---------------------------------------------------------------------------

EVENT_TYPES = list(REQUIRED_KEYS)
TERMINAL_TYPES = ("purchase", "abandon")

QUANTITIES = T.MapType(T.StringType(), T.LongType())

# One superset row type for all raw events.  Every field is read as text where
# the source casts leniently, so one bad value costs one field and not the row.
RAW_EVENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "event_type", "timestamp", "session_id", "user_id", "mouse_click_count",
        "device", "time_on_page", "page", "cart_value", "product_count",
        "product_quantities", "shipping_option_selected", "delivery_mode",
        "shipping_type", "shipping_cost", "mouse_x", "mouse_y", "product_id",
        "category", "price", "payment_method_selected", "payment_method",
        "abandon_reason", "retention_type", "event_id",
    )]
)

CATALOGUE = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("category", T.StringType(), False),
    ]
)

ORDER = ("ts_us", "event_id")
