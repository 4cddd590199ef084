"""Word lists, thresholds and weights that results depend on.

Everything here is data. These values are stated exactly as they must be for results to be right; the
code that applies them lives elsewhere and takes them as parameters.
"""

# ---- fixed values: keyword rules (category, subcategory, keywords), in order, first match wins ----
CATEGORY_RULES = [
    ("Footwear", "Boots", ["boot"]),
    ("Footwear", "Sandals", ["sandal", "flip flop", "slide"]),
    ("Footwear", "Slippers & Moccasins", ["slipper", "moccasin", "mocs", "clog"]),
    ("Footwear", "Shoes", ["shoe", "sneaker", "oxford", "loafer", "hiker"]),
    ("Bags & Packs", "Backpacks", ["pack", "rucksack", "knapsack"]),
    ("Bags & Packs", "Bags & Totes", ["bag", "tote", "duffle", "basket", "case", "luggage"]),
    ("Knives & Tools", "Knives & Tools", ["knife", "multitool", "axe", "saw ", "tool"]),
    ("Apparel", "Outerwear", ["jacket", "parka", "coat", "vest", "anorak", "windbreaker"]),
    ("Apparel", "Tops", ["shirt", "tee", "sweater", "hoodie", "fleece", "pullover", "polo",
                         "turtleneck", "cardigan", "top"]),
    ("Apparel", "Bottoms", ["pant", "jean", "short", "skirt", "legging", "chino"]),
    ("Apparel", "Sleep & Lounge", ["pajama", "robe", "nightgown", "boxers", "lounge"]),
    ("Apparel", "Dresses", ["dress"]),
    ("Apparel", "Socks & Base Layers", ["sock", "base layer", "long underwear", "tights"]),
    ("Headwear & Accessories", "Headwear", ["hat", "cap", "beanie", "headwear", "visor",
                                            "balaclava"]),
    ("Headwear & Accessories", "Accessories", ["glove", "mitten", "scarf", "belt", "wallet",
                                               "sunglasses", "watch", "umbrella"]),
    ("Camp & Outdoor", "Camp & Outdoor", ["tent", "sleeping", "lantern", "stove", "chair",
                                          "hammock", "cooler", "camp", "canoe", "kayak", "paddle",
                                          "snowshoe", "sled", "mold", "patch"]),
]
DEFAULT_CATEGORY = ("General Merchandise", "General")

# ---- fixed values: brand lexicon, in order, first match wins ----
BRAND_LEXICON = [
    "L.L.Bean", "Teva", "Keen", "Merrell", "Bogs", "Hoka", "OluKai", "Kork-Ease", "Thule",
    "Darn Tough", "SmartWool", "Superfeet", "Buck", "Buff", "Oakley", "Costa", "Ray-Ban",
    "Carhartt", "Patagonia", "Sperry", "Birkenstock", "Chaco", "Salomon", "Oboz", "Dansko",
    "Blundstone", "Sorel", "Muck", "Crocs", "Minnetonka", "Vionic", "Sanuk", "Rainbow", "Reef",
]
HOUSE_BRAND = "House Brand"

# ---- fixed values: audiences read from the first word of a product name ----
AUDIENCES = ["Womens", "Mens", "Kids", "Toddlers", "Infants", "Adults"]
AUDIENCE_ALIASES = {"Infant": "Infants"}
DEFAULT_AUDIENCE = "Unisex"

# ---- fixed values: contract enumerations and bounds ----
AVAILABILITY = ["In Stock", "Low Stock", "Out of Stock", "Pre-Order"]
MAX_DISCOUNT = 95
MAX_RATING = 5

# ---- fixed values: onboarding defaults ----
NO_CATEGORY = "General Merchandise"
NO_SUBCATEGORY = "General"
NO_BRAND = "Unbranded"

# ---- fixed values: quality score ----
QUALITY_WEIGHTS = {
    "completeness": 0.25,
    "uniqueness": 0.25,
    "validity": 0.20,
    "consistency": 0.15,
    "freshness": 0.15,
}
CRITICAL_COLUMNS = ["product_id", "observed_date", "price"]
PRICE_TOLERANCE = 1.001
FRESHNESS_HORIZON_DAYS = 30
NO_DATA_STALENESS_DAYS = 999
QUALITY_SLO = 0.90
FRESHNESS_SLO = 0.5

# ---- fixed values: warehouse ----
SNAPSHOT_CHECK_COLUMNS = ["product_name", "category", "subcategory", "brand", "image_url"]
DIM_DATE_EXTRA_DAYS = 60
LATE_ARRIVAL_DAYS = 3
DEAL_MIN_DISCOUNT = 15.0

# ---- fixed values: serving ----
SORTABLE = ["avg_price", "avg_rating", "avg_discount", "price_volatility", "total_reviews",
            "product_name"]
DEFAULT_SORT = "avg_price"
PAGE_SIZE_DEFAULT = 24
PAGE_SIZE_MAX = 200

# ---- fixed values: models ----
PROFILE_COLUMNS = ["avg_price", "price_volatility", "avg_discount", "avg_rating", "avg_velocity"]
SEGMENT_LABELS = ["Value", "Premium", "Deal-Driven", "Standard"]
FORECAST_FEATURES = ["price_lag_1", "price_lag_7", "price_ma_7", "price_ma_30", "price_std_7",
                     "velocity_lag_1", "velocity_ma_7", "discount_percentage", "day_of_week",
                     "month_num"]
FORECAST_HORIZON_DAYS = 14
FORECAST_FLOOR = 0.01
Z_SCALE = 0.6745
Z_EPSILON = 1e-9
Z_THRESHOLD = 3.5
MATERIALITY_PCT = 10.0
ALERT_BUDGET = 0.01
FOREST_COLUMNS = ["price_pct_change", "discount_percentage", "price_std_7", "sales_velocity"]
FOREST_TREES = 200
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.005
SEED = 42
CATEGORY_WEIGHT = 2.0
TOP_K = 6
