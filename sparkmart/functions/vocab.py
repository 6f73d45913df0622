"""Closed vocabularies.

FIXED VALUES — these must equal the source system's lists for results to
match; they are stated here plainly, in their natural order.
"""

# French month names (lower case) -> month number, for "Début Juin 2024".
MONTHS_FR = {
    "janvier": 1, "février": 2, "mars": 3, "avril": 4,
    "mai": 5, "juin": 6, "juillet": 7, "août": 8,
    "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12,
}

# Service label aliases (trimmed, lower-cased key) -> canonical label.
SERVICE_ALIASES = {
    "sérigraphie": "Sérigraphie",
    "sérigrafe": "Sérigraphie",
    "serigraphy": "Sérigraphie",
    "sérigr.": "Sérigraphie",
    "sérigrpahie": "Sérigraphie",
    "imprimerie": "Imprimerie",
    "imprimrie": "Imprimerie",
    "imprimeri": "Imprimerie",
    "vidéosurveillance": "Vidéosurveillance",
    "video surveillance": "Vidéosurveillance",
    "vidéo-surveillance": "Vidéosurveillance",
    "vidéosur.": "Vidéosurveillance",
    "maintenance": "Maintenance",
    "reparation": "Maintenance",
    "maintenace": "Maintenance",
    "maint.": "Maintenance",
}

# Payment status aliases (trimmed, lower-cased key) -> canonical status.
STATUS_ALIASES = {
    "payé": "Payé",
    "paye": "Payé",
    "non payé": "Non payé",
    "non paye": "Non payé",
    "en attente": "Non payé",
    "impayé": "Non payé",
    "partiel": "Partiel",
}

# Spellings of the one city that is normalised, and its canonical form.
CITY_VARIANTS = ["pointe noire", "pn", "pte-noire", "pointenoire", "pointe-noire", "p.noire"]
CITY_CANONICAL = "Pointe-Noire"

# Service dimension seed and the allowed payment statuses.
SERVICES = ["Imprimerie", "Sérigraphie", "Maintenance", "Vidéosurveillance"]
PAYMENT_STATUSES = ["Non payé", "Payé", "Partiel"]

# Characters stripped from both ends of text: every character for which
# Python's str.isspace() is true (the source system strips with str.strip()).
WHITESPACE_CODEPOINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITESPACE = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)

# Text that means "missing" after a string cast.
NULL_TOKENS = ["", "nan", "None"]

# Values of a total meaning "not computed" rather than a real amount.
TOTAL_SENTINELS = [0, 999]

# Accent folding used by the slug of a label (ç is not folded).
SLUG_FROM = "éèêëàâäîïôöùûü"
SLUG_TO = "eeeeaaaiioouuu"

# Column length bounds of the mart (table, column, max length).
LENGTH_BOUNDS = [
    ("client", "nom_client", 150),
    ("client", "entreprise", 150),
    ("client", "telephone", 20),
    ("client", "email", 100),
    ("client", "ville", 100),
    ("employe", "nom_employe", 150),
    ("service", "libelle", 50),
    ("facture", "id_facture", 20),
    ("facture", "statut_paiement", 20),
    ("ligne_facture", "description", 255),
    ("fournisseur", "nom", 150),
    ("categorie_achat", "libelle", 50),
    ("achat", "libelle_article", 255),
    ("achat", "mode_paiement", 30),
]

# Order-entry contract bounds.
ORDER_CLIENT_MAX = 150
ORDER_PHONE_MAX = 20
ORDER_EMPLOYEE_MAX = 150
ORDER_DESCRIPTION_MAX = 255
FORECAST_HORIZON_MAX = 180

# Drift monitor defaults.
DRIFT_WINDOW_DAYS = 30
DRIFT_ERROR = 1.0
DRIFT_WARN = 0.85
DRIFT_MIN_POINTS = 10
NAIVE_LAGS = [7, 14, 21, 28]

# Rolling-origin evaluation defaults (days).
CV_INITIAL = 365
CV_PERIOD = 30
CV_HORIZON = 90
CV_HORIZONS_KEPT = [30, 60, 90]
MONTH_MIN_DAYS = 20
TRAILING_DAYS = 180
