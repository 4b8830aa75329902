"""Values that results depend on, stated as plain data."""

# Month spellings (Spanish and English, long and short) and numbers.
MONTH_SPELLINGS = {
    "ene": 1, "enero": 1, "jan": 1, "january": 1, "1": 1,
    "feb": 2, "febrero": 2, "february": 2, "2": 2,
    "mar": 3, "marzo": 3, "march": 3, "3": 3,
    "abr": 4, "abril": 4, "apr": 4, "april": 4, "4": 4,
    "may": 5, "mayo": 5, "5": 5,
    "jun": 6, "junio": 6, "june": 6, "6": 6,
    "jul": 7, "julio": 7, "july": 7, "7": 7,
    "ago": 8, "agosto": 8, "aug": 8, "august": 8, "8": 8,
    "sep": 9, "sept": 9, "septiembre": 9, "setiembre": 9, "september": 9, "9": 9,
    "oct": 10, "octubre": 10, "october": 10, "10": 10,
    "nov": 11, "noviembre": 11, "november": 11, "11": 11,
    "dic": 12, "diciembre": 12, "dec": 12, "december": 12, "12": 12,
}

# Regular expressions that name the date, year and month column of a table.
DATE_COLUMN_PATTERNS = [r"^fecha$", r"date", r"periodo", r"mes_ano", r"ano_mes"]
YEAR_COLUMN_PATTERNS = [r"^ano$", r"^anio$", r"year", r"ejercicio"]
MONTH_COLUMN_PATTERNS = [r"^mes$", r"month"]

# Date texts in ISO form, with or without a day and a time.
ISO_DATE = r"^\d{4}-\d{1,2}(-\d{1,2}([ T].*)?)?$"

# Date texts with a year and month, with or without a day, and day or month before the year.
YEAR_FIRST_DATE = r"^\d{4}[-/]\d{1,2}([-/]\d{1,2})?$"
YEAR_LAST_DATE = r"^\d{1,2}[-/]\d{1,2}[-/]\d{4}$"

# Other formats of dates in a date column, and what such texts look like.
DATE_FORMATS = [
    "MMM yyyy", "MMMM yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM-yyyy", "d-MMM-yyyy", "yyyyMM", "yyyyMMdd", "d/M/yy",
]
DATE_LOOK = r"[A-Za-z]{3}.*\d{4}|^\d{6}$|^\d{8}$|^\d{1,2}/\d{1,2}/\d{2}$"

# A year inside a text.
YEAR_PATTERN = r"(19|20)\d{2}"

# Substrings that make a column look like a date when profiling.
DATE_LIKE = ["fecha", "date", "ano", "anio", "year", "mes", "month", "periodo"]

# Delimiters tried when sniffing, in order.
DELIMITERS = [",", ";", "\t", "|"]

# Field texts that pandas' CSV reader takes as missing by default.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Substrings of columns that may enter the composite target.
PROXY_KEYWORDS = ["cement", "construction", "construccion", "area", "costo", "trade", "ipmc"]

# Default material keywords of the two-row-header price table.
MATERIAL_KEYWORDS = [
    "cemento", "cement", "concreto", "hormigon", "mortero", "cal", "agregado", "aglomerante",
]

# Column keywords of the trade-by-product table.
TRADE_KEYWORDS = ["cement", "valor", "volumen", "peso", "kg", "ton", "import", "export"]

# Source columns of the quarterly construction records and their output names.
CONSTRUCTION_COLUMNS = {
    "construction_num_constructions": ["num_construcciones"],
    "construction_area_m2": ["area_con_m2", "area_m2"],
    "construction_cost_gtq": ["costo_aprox_quetzales", "costo_aproximado_quetzales"],
}

# Default name of the composite target.
PROXY_TARGET = "cement_demand_proxy"

# Lags and rolling windows of the supervised frames.
DEFAULT_LAGS = [1, 2, 3, 6, 12]
DEFAULT_WINDOWS = [3, 6, 12]

# First month of the strict panel.
PANEL_START = "2019-01-01"

# Target catalog (column, label, description, unit, priority); the descriptions are our own.
TARGET_CATALOG = [
    ("cement_import_tons", "Cement import tons", "Weight of cement imported in the month, from a source with quantities.", "tons", 10),
    ("cement_export_tons", "Cement export tons", "Weight of cement exported in the month, from a source with quantities.", "tons", 11),
    ("net_cement_import_tons", "Net cement import tons", "Imported less exported weight of cement.", "tons", 12),
    ("cement_import_value_usd", "Cement import value", "Dollar value of cement imports, from trade by product.", "USD", 20),
    ("cement_export_value_usd", "Cement export value", "Dollar value of cement exports, from trade by product.", "USD", 21),
    ("construction_area_m2", "Construction area", "Licensed private building area, a third of each quarter.", "square meters", 50),
    ("construction_cost_gtq", "Construction cost", "Estimated cost of licensed private buildings, a third of each quarter.", "GTQ", 51),
    ("construction_num_constructions", "Number of constructions", "Licensed private buildings, a third of each quarter.", "count", 52),
    ("imae_construction_index", "IMAE construction index", "Activity of the construction sector, original series.", "index", 30),
    ("imae_general_index", "IMAE general index", "Activity of the whole economy, original series.", "index", 31),
    ("imae_construction_yoy", "IMAE construction YoY", "Change of construction activity over twelve months.", "percent", 32),
    ("imae_general_yoy", "IMAE general YoY", "Change of the whole economy's activity over twelve months.", "percent", 33),
    ("imae_construction_trend_index", "IMAE construction trend-cycle index", "Activity of the construction sector, trend and cycle.", "index", 34),
    ("imae_general_trend_index", "IMAE general trend-cycle index", "Activity of the whole economy, trend and cycle.", "index", 35),
    (PROXY_TARGET, "Legacy cement-related proxy", "Mean z-score of the indicators that go with cement demand.", "standardized index", 90),
]
