"""Fixed values that must equal the reference pipeline's for identical results.

Everything here is data (labels, id sets, defaults), stated plainly and in the
order the reference documents them.
"""

# --- fixed values: traffic-source roots that do not count as "significant" ---
NON_SIGNIFICANT_ROOTS = (-1, 0, 4, 5, 6)

# --- fixed values: session timeout ---
TIMEOUT_QUANTILE = 0.95
DEFAULT_TIMEOUT_SECONDS = 1800

# --- fixed values: model parameters ---
DEFAULT_HALF_LIFE_DAYS = 7.0
DEFAULT_LOOKBACK_DAYS = 90

# --- fixed values: model identifiers, in pipeline order ---
MODELS = ("first_touch", "last_touch", "last_significant", "linear", "time_decay")

# --- fixed values: model display names (dashboard) ---
MODEL_LABELS = {
    "first_touch": "Первый клик",
    "last_touch": "Последний клик",
    "last_significant": "Последний значимый клик",
    "linear": "Линейная",
    "time_decay": "Затухающая",
}

# --- fixed values: names of roots without a sub-id ---
ROOT_LABELS = {
    -1: "Внутренние переходы",
    0: "Прямые заходы",
    1: "Переходы по ссылкам на сайтах",
    4: "С сохранённых страниц",
    5: "Источник не определён",
    6: "По внешним ссылкам",
    7: "Почтовые рассылки",
    11: "QR-код",
}

# --- fixed values: prefixes of roots whose sub-id is resolved by a dictionary ---
ROOT_PREFIXES = {
    2: "Поиск: ",
    3: "Реклама: ",
    8: "Соцсети: ",
    9: "Рекомендации: ",
    10: "Мессенджеры: ",
}
MISSING_NAME_PREFIX = "код "

# --- fixed values: dictionary file per root with a sub-id ---
DICTIONARY_FILES = {
    2: "search_engine_roots.csv",
    3: "adv_engines.csv",
    8: "social_networks.csv",
    9: "recommendation_systems.csv",
    10: "messengers.csv",
}

# --- fixed values: long-format metric labels (direct vs assisted) ---
METRIC_DIRECT = "Прямые"
METRIC_ASSISTED = "Ассоциированные"

# --- fixed values: goal types usable for attribution ---
ATTRIBUTION_GOAL_TYPES = (
    "url", "action", "step",
    "phone", "email", "messenger", "social",
    "file", "search", "payment_system", "chat",
)

# --- fixed values: dashboard limits ---
TOP_SOURCES = 10
TOP_TRANSITIONS = 100
MIN_STEP_VISITS = 5
TOP_LAST_TOUCH = 5
TOP_GOALS = 20
DEFAULT_PERIOD_DAYS = 30
DEFAULT_SELECTOR_MODEL = "linear"
