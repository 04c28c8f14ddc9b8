"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour
being reproduced: word lists, host lists, weights, defaults.  They are
stated plainly, in their natural order, and are only ever *read* by the
operators.  Change them through the operator parameters, not here.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — facet lexicons (ordered; order defines output order of hits)
# ---------------------------------------------------------------------------

GEOGRAPHY_TERMS = [
    "bangladesh", "bangladeshi", "dhaka", "chattogram", "chittagong", "mongla",
    "payra", "maheshkhali", "khulna", "sylhet", "narayanganj", "bay of bengal",
    "south asia", "south asian",
]

COMMODITY_TERMS = [
    "petroleum", "petroleum product", "petroleum products", "crude oil",
    "refined oil", "fuel oil", "furnace oil", "hsfo", "diesel", "hsd",
    "high speed diesel", "ldo", "light diesel oil", "petrol", "gasoline",
    "motor spirit", "octane", "hobc", "kerosene", "sko", "jet a-1", "jet fuel",
    "aviation fuel", "naphtha", "bitumen", "condensate", "natural gas",
    "pipeline gas", "liquefied natural gas", "lng", "regasified lng", "rlng",
    "liquefied petroleum gas", "lpg", "autogas", "compressed natural gas", "cng",
    "fossil fuel", "fuel demand", "fuel supply", "fuel price",
    "fuel consumption", "fuel import", "fuel distribution", "fuel logistics",
    "energy demand", "energy supply", "fuel depot", "oil depot",
    "petroleum depot", "fuel terminal", "oil terminal", "petroleum terminal",
    "fuel storage", "oil storage", "petroleum storage", "gas storage",
    "fuel tank", "storage tank", "tank farm", "fuel station", "filling station",
    "petrol pump", "fertilizer", "fertiliser", "urea", "dap fertilizer",
    "tsp fertilizer", "mop fertilizer", "muriate of potash",
    "triple super phosphate", "diammonium phosphate",
]

MEASURE_TERMS = [
    "import", "imports", "export", "demand", "consumption", "supply", "sales",
    "requirement", "forecast", "forecasting", "projection", "capacity",
    "storage", "storage capacity", "depot", "terminal", "tank farm",
    "tank capacity", "warehouse", "refinery", "pipeline", "inventory", "stock",
    "throughput", "cost", "price", "pricing", "tariff", "freight", "subsidy",
    "landed cost", "unit value", "expenditure", "quantity", "volume",
    "tonnage", "distance", "route", "routing", "road network", "shipping",
    "lead time", "transit time", "delivery time", "dwell time",
    "turnaround time", "clearance time", "logistics", "supply chain",
    "distribution", "transport", "transportation", "facility location",
    "allocation", "optimization",
]

PENALTY_TERMS = [
    "olive oil", "palm oil", "palm fruit", "neem", "castor", "flaxseed",
    "sunflower", "essential oil", "seed oil", "fish oil", "lemon peel",
    "papaya", "coconut oil", "vegetable oil", "cooking oil", "gene expression",
    "nanoparticle", "nanoparticles", "nanofluid", "biodiesel blend",
    "biodiesel fuel", "methyl ester", "combustion chamber", "engine emission",
    "exhaust emission", "cetane", "injector", "spent fuel", "nuclear",
    "reactor", "radioactive", "molten salt", "bioremediation",
    "contaminated soil", "wastewater", "microorganism", "bacteria",
    "leaf image", "leaf disease", "patient", "patients", "clinical",
    "in vitro", "in vivo", "rats", "mice", "cell line", "concrete", "fuel cell",
    "solar cell", "photovoltaic",
]

PENALTY_STEMS = [
    "transcriptom", "proteom", "genom", "rheolog", "chromatograph", "spectroscop",
]

DATASET_HINT_TERMS = [
    "dataset", "data set", "data on", "data for", "database", "survey data",
    "panel data", "time series",
]

# Geography terms that probes use last.
BROAD_GEOGRAPHY_TERMS = [
    "bangladesh", "bangladeshi", "south asia", "south asian", "bay of bengal",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — scoring weights and defaults
# ---------------------------------------------------------------------------

WEIGHTS = {
    "title_geography": 30,
    "abstract_geography": 12,
    "title_commodity": 26,
    "abstract_commodity": 10,
    "title_measure": 20,
    "abstract_measure": 8,
    "dataset_hint": 10,
    "title_penalty": -45,
    "abstract_penalty": -15,
}

MIN_SCORE = 45
REQUIRE_TITLE_COMMODITY = True
EXTRACT_MIN_SCORE = 60
MIN_TABLE_ROWS = 2
MIN_TABLE_COLS = 2
LANDING_PAGE_MAX_BYTES = 5 * 1024 * 1024
SLUG_MAX_CHARS = 80
SAFE_NAME_MAX_CHARS = 120

# Per-source result caps: OpenAlex min(rows, 200), all others min(rows, 100).
SOURCE_RESULT_CAPS = {"OpenAlex": 200}
DEFAULT_RESULT_CAP = 100

# ---------------------------------------------------------------------------
# FIXED VALUES — sources
# ---------------------------------------------------------------------------

# Registry order = source_ord (API sources first, then HTML result pages).
API_SOURCES = ["OpenAlex", "Crossref Data Journals", "Crossref", "DataCite", "Zenodo"]
HTML_SOURCES = ["Scientific Data", "IEEE DataPort"]
ALL_SOURCES = API_SOURCES + HTML_SOURCES

DATA_JOURNAL_ISSNS = ["2352-3409", "2052-4463", "2306-5729", "1866-3516", "2169-3536"]

# Yield rank +2.
DATA_SOURCE_NAMES = [
    "Crossref Data Journals", "Zenodo", "DataCite", "IEEE DataPort", "Scientific Data",
]

# HTML result-page sources: CSS selectors (in order) and preferred href patterns.
HTML_SOURCE_SELECTORS = {
    "Scientific Data": {
        "selectors": ["article h3 a", "a[data-track-action='view article']", "a[href*='/articles/']"],
        "preferred": ["/articles/"],
    },
    "IEEE DataPort": {
        "selectors": ["a[href*='/documents/']", "a[href*='/open-access/']",
                      "a[href*='/competitions/']", ".search-result a"],
        "preferred": ["/documents/", "/open-access/", "/competitions/"],
    },
}

BLOCK_TEXT_MARKERS = [
    "captcha",
    "verify you are human",
    "access denied",
    "unusual traffic",
    "there was a problem providing the content you requested",
    "ip blocked",
]

BLOCKED_HOSTS = ["sciencedirect.com", "ieeexplore.ieee.org"]

DATA_REPOSITORY_HOSTS = [
    "figshare.com", "zenodo.org", "doi.org/10.5281/zenodo", "doi.org/10.6084/m9.figshare",
    "data.mendeley.com", "doi.org/10.17632", "doi.org/10.7910/dvn", "datadryad.org",
    "osf.io", "dataverse", "github.com", "gitlab.com", "kaggle.com", "pangaea.de",
    "icpsr.umich.edu", "worldbank.org",
]

DATA_FILE_EXTENSIONS = [
    ".csv", ".tsv", ".txt", ".json", ".geojson", ".xlsx", ".xls", ".zip", ".parquet",
    ".sav", ".dta", ".rds", ".rdata", ".nc", ".h5", ".hdf5", ".xml",
]

# Link text that marks a download-ish link (whole words, case-insensitive).
DOWNLOAD_LINK_WORDS = [
    "download", "data", "dataset", "csv", "excel", "spreadsheet", "supplementary", "source data",
]

# Exact (case-insensitive) link texts that are site chrome, not data links.
SITE_CHROME_LINK_TEXTS = [
    "ncbi on github", "github", "gitlab", "twitter", "facebook", "linkedin", "follow ncbi",
]

# content-type fragment -> extension, first match wins.
CONTENT_TYPE_EXTENSIONS = [
    ("text/csv", ".csv"),
    ("tab-separated-values", ".tsv"),
    ("spreadsheetml", ".xlsx"),
    ("application/vnd.ms-excel", ".xls"),
    ("application/json", ".json"),
    ("application/zip", ".zip"),
    ("text/plain", ".txt"),
    ("application/xml", ".xml"),
    ("text/xml", ".xml"),
]

# Figure rendition preference; anything else ranks after these.
IMAGE_EXTENSION_PREFERENCE = [".jpg", ".jpeg", ".png", ".tif", ".tiff", ".gif"]

PMC_ARTICLE_BASE = "https://pmc.ncbi.nlm.nih.gov/articles/"
EUROPEPMC_ARTICLE_BASE = "https://europepmc.org/article/PMC/"
DOI_BASE = "https://doi.org/"

# Article CSV column order; the JSON form adds abstract and searchUrl.
ARTICLE_CSV_COLUMNS = [
    "score", "source", "kind", "title", "journal", "published", "doi", "url",
    "geography", "commodity", "measure", "keyword",
]
ARTICLE_JSON_COLUMNS = [
    "score", "source", "kind", "title", "journal", "published", "doi", "url", "abstract",
    "geography", "commodity", "measure", "keyword", "searchUrl",
]
TABLE_INDEX_COLUMNS = [
    "file", "doi", "title", "source", "score", "tableNumber", "caption", "rows", "columns",
    "articleUrl",
]
FIGURE_INDEX_COLUMNS = ["doi", "title", "figureNumber", "caption", "file", "imageUrl", "articleUrl"]
DATASET_INDEX_COLUMNS = [
    "doi", "title", "linkText", "datasetUrl", "resolvedUrl", "downloadedFiles",
    "downloadStatus", "downloadError", "articleUrl",
]
FLAT_RECORD_COLUMNS = [
    "recordId", "parentRecordId", "recordType", "evidenceType", "doi", "title", "source",
    "score", "kind", "commodity", "measure", "file", "url", "resolvedUrl", "articleUrl",
    "caption", "rows", "columns", "text", "status",
]
