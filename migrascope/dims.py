"""Names, codes, word lists and thresholds that results depend on."""

from __future__ import annotations

# --- Fixed values: the 20 origin groups and the survey column holding each count. ---
ORIGIN_CODES = {
    "india": ["B05006_015E"],
    "mexico": ["B05006_002E"],
    "china": ["B05006_004E"],
    "philippines": ["B05006_005E"],
    "vietnam": ["B05006_006E"],
    "korea": ["B05006_007E"],
    "cuba": ["B05006_008E"],
    "dominican_republic": ["B05006_009E"],
    "guatemala": ["B05006_010E"],
    "el_salvador": ["B05006_011E"],
    "honduras": ["B05006_012E"],
    "colombia": ["B05006_013E"],
    "brazil": ["B05006_014E"],
    "nigeria": ["B05006_016E"],
    "ethiopia": ["B05006_017E"],
    "jamaica": ["B05006_018E"],
    "haiti": ["B05006_019E"],
    "peru": ["B05006_020E"],
    "ecuador": ["B05006_021E"],
    "venezuela": ["B05006_022E"],
}
ORIGINS = list(ORIGIN_CODES)

# --- Fixed values: survey code of each demographic column. ---
DEMOGRAPHIC_CODES = {
    "total_pop": "B01003_001E",
    "foreign_born_total": "B05006_001E",
    "median_age": "B01002_001E",
    "median_household_income": "B19013_001E",
    "median_rent": "B25064_001E",
    "total_housing_units": "B25001_001E",
    "occupied_housing_units": "B25003_001E",
    "owner_occupied": "B25003_002E",
    "renter_occupied": "B25003_003E",
    "vehicles_available": "B25044_001E",
    "no_vehicles": "B25044_003E",
    "bachelor_degree": "B15003_022E",
    "graduate_degree": "B15003_023E",
    "total_education": "B15003_001E",
}
MEDIAN_COLUMNS = ["median_age", "median_household_income", "median_rent"]

# --- Fixed values: survey code of each language column. ---
LANGUAGE_CODES = {
    "spanish_at_home": "B16001_003E",
    "hindi_at_home": "B16001_011E",
    "chinese_at_home": "B16001_012E",
    "korean_at_home": "B16001_013E",
    "vietnamese_at_home": "B16001_014E",
    "arabic_at_home": "B16001_015E",
    "total_language": "B16001_001E",
}
LANGUAGES_AT_HOME = [c for c in LANGUAGE_CODES if c.endswith("_at_home")]

# --- Fixed values: NAICS codes of each category in the county industry tables, in rule order. ---
INDUSTRY_RULES = {
    "food_services": ["7225"],
    "grocery_stores": ["4451"],
    "specialty_food": ["4452"],
    "clothing_stores": ["4481"],
    "beauty_salons": ["8121"],
    "laundry_services": ["8123"],
    "taxi_services": ["4853"],
    "construction": ["23"],
    "healthcare": ["62"],
    "professional_services": ["54"],
    "accommodation": ["721"],
    "transportation": ["48"],
    "retail_trade": ["44", "45"],
    "wholesale_trade": ["42"],
    "manufacturing": ["31", "32", "33"],
    "agriculture": ["11"],
}

# --- Fixed values: NAICS codes of each category in the business directory, in rule order. ---
DIRECTORY_RULES = {
    "food_services": ["7225", "7223", "7224"],
    "grocery_stores": ["4451", "4452", "4453"],
    "retail_trade": ["44", "45"],
    "personal_services": ["8121", "8123", "8129"],
    "transportation": ["4853", "4854", "4855"],
    "construction": ["23"],
    "healthcare": ["62"],
    "professional_services": ["54"],
    "accommodation": ["721"],
    "manufacturing": ["31", "32", "33"],
}
OTHER_CATEGORY = "other"

# --- Fixed values: words in a business name that point to a cuisine. ---
CUISINE_KEYWORDS = {
    "indian": [
        "indian", "hindi", "punjabi", "bengali", "tamil", "telugu", "gujarati", "marathi",
        "kannada", "malayalam", "oriya", "assamese", "kashmiri", "bombay", "delhi", "mumbai",
        "bangalore", "chennai", "hyderabad", "kolkata", "pune", "ahmedabad", "jaipur", "lucknow",
        "kanpur", "curry", "tandoor", "masala", "biryani", "dal", "naan", "roti", "samosas",
        "pakora", "tikka", "korma", "vindaloo", "butter chicken", "desi", "spice", "chai",
        "lassi", "gulab jamun", "rasgulla",
    ],
    "mexican": [
        "mexican", "mexico", "taco", "burrito", "quesadilla", "enchilada", "fajita", "nachos",
        "guacamole", "salsa", "churro", "tamale", "mole", "pozole", "ceviche", "elote",
        "horchata", "margarita", "tequila", "mezcal", "carnitas", "al pastor", "barbacoa",
        "sopes", "tostadas", "flautas", "empanadas", "chile relleno",
    ],
    "chinese": [
        "chinese", "china", "cantonese", "szechuan", "hunan", "peking", "beijing", "shanghai",
        "hong kong", "taiwan", "dim sum", "lo mein", "chow mein", "fried rice", "kung pao",
        "sweet sour", "general tso", "orange chicken", "beef broccoli", "moo shu", "wonton",
        "dumpling", "spring roll", "egg roll", "hot pot", "peking duck", "char siu", "chow fun",
        "chop suey",
    ],
    "korean": [
        "korean", "korea", "seoul", "busan", "kimchi", "bulgogi", "bibimbap", "galbi", "japchae",
        "korean bbq", "soju", "makgeolli", "banchan", "tteokbokki", "kimbap", "ramen", "udon",
        "pho", "bun", "gochujang", "doenjang", "sesame oil",
    ],
    "vietnamese": [
        "vietnamese", "vietnam", "ho chi minh", "hanoi", "pho", "banh mi", "spring roll",
        "summer roll", "bun", "com tam", "bun bo hue", "cao lau", "mi quang", "banh xeo",
        "goi cuon", "nuoc mam", "fish sauce", "sriracha", "hoisin", "rice paper",
    ],
    "thai": [
        "thai", "thailand", "bangkok", "pad thai", "tom yum", "tom kha", "green curry",
        "red curry", "yellow curry", "massaman", "panang", "larb", "som tam",
        "mango sticky rice", "thai iced tea", "lemongrass", "galangal", "kaffir lime",
        "fish sauce", "coconut milk",
    ],
    "middle_eastern": [
        "middle eastern", "arabic", "persian", "iranian", "lebanese", "syrian", "turkish",
        "egyptian", "moroccan", "falafel", "hummus", "baba ganoush", "tabbouleh", "kebab",
        "shawarma", "gyro", "pita", "naan", "tahini", "za'atar", "sumac", "knafeh", "baklava",
        "halva", "mint tea", "turkish coffee",
    ],
    "caribbean": [
        "caribbean", "jamaican", "haitian", "cuban", "puerto rican", "dominican", "trinidadian",
        "barbadian", "jerk", "curry goat", "ackee", "saltfish", "plantain", "rice peas",
        "callaloo", "sorrel", "ginger beer", "rum", "coconut", "tamarind",
    ],
    "african": [
        "african", "ethiopian", "nigerian", "ghanaian", "senegalese", "moroccan",
        "south african", "injera", "berbere", "wat", "kitfo", "doro wat", "tibs", "fufu",
        "jollof rice", "egusi", "suya", "bobotie", "bunny chow", "biltong", "rooibos tea",
    ],
}
CUISINES = list(CUISINE_KEYWORDS)

# --- Fixed values: business categories an origin group prefers (the same four for every group). ---
PREFERRED_CATEGORIES = ["food_services", "grocery_stores", "specialty_food", "beauty_salons"]
ORIGIN_PREFERENCES = {origin: PREFERRED_CATEGORIES for origin in ORIGINS}

# Which cuisine score counts for which origin group. An empty mapping switches the cuisine term off.
ORIGIN_CUISINE = {
    "india": "indian",
    "mexico": "mexican",
    "china": "chinese",
    "korea": "korean",
    "vietnam": "vietnamese",
    "cuba": "caribbean",
    "dominican_republic": "caribbean",
    "jamaica": "caribbean",
    "haiti": "caribbean",
    "nigeria": "african",
    "ethiopia": "african",
}

# --- Fixed values: directory field names and the column each becomes. ---
DIRECTORY_FIELDS = {
    "BUSINESS_NAME": "business_name",
    "NAICS_CODE": "naics_code",
    "NAICS_DESC": "naics_description",
    "ADDRESS": "address",
    "CITY": "city",
    "STATE": "state",
    "ZIP": "zip_code",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "PHONE": "phone",
    "WEBSITE": "website",
    "EMAIL": "email",
    "YEAR_ESTABLISHED": "year_established",
    "EMPLOYEES": "employees",
    "ANNUAL_SALES": "annual_sales",
    "CERTIFICATION": "certification",
    "MINORITY_OWNED": "minority_owned",
    "WOMAN_OWNED": "woman_owned",
    "VETERAN_OWNED": "veteran_owned",
}

# --- Fixed values: thresholds, score weights, label and model settings. ---
EARTH_RADIUS_KM = 6371.0
LABEL_EPSILON = 1e-8
HOTSPOT_DENSITY = 50.0
HOTSPOT_GROWTH = 25.0
HOTSPOT_MIN_POPULATION = 1000
LOW_POSITIVE_RATE = 0.01
SCORE_CATEGORY = 0.3
SCORE_CUISINE = 0.5
SCORE_EMPLOYEES = 0.1
SCORE_AGE = 0.1
ESTABLISHED_AFTER_YEARS = 5
MATCH_RADIUS_KM = 10.0
MATCH_TOP_K = 20
RECOMMEND_RADIUS_KM = 15.0
RECOMMEND_TOP_K = 10
DISTANCE_BAND_KM = 5.0
INTERVAL_POINTS = 5.0
WINSOR_PROBS = (0.01, 0.99)
CV_FOLDS = 5
CALIBRATION_FOLDS = 3
CV_SEED = 42
ATTRIBUTION_ROWS = 1000
POPULATION_BUCKETS = ["Very Small", "Small", "Medium", "Large", "Very Large"]

# --- Fixed values: model inputs by topic, then the per-origin suffixes. ---
BASE_FEATURES = [
    "total_pop", "foreign_born_density", "median_age", "median_household_income",
    "college_educated_rate", "median_rent", "rent_income_ratio", "homeownership_rate",
    "total_housing_units", "occupied_housing_units",
]
LANGUAGE_FEATURES = [*LANGUAGES_AT_HOME, "language_diversity"]
BUSINESS_FEATURES = [
    "food_services_est", "grocery_stores_est", "specialty_food_est", "clothing_stores_est",
    "beauty_salons_est", "laundry_services_est",
]
TEMPORAL_FEATURES = [
    "foreign_born_growth_1yr", "foreign_born_growth_3yr", "pop_growth_1yr", "pop_growth_3yr",
    "income_growth_1yr", "rent_growth_1yr",
]
INTERACTION_FEATURES = ["rent_income_interaction", "pop_housing_ratio"]
PERIOD_FEATURES = ["covid_period", "post_covid_period", "decade_2010s", "decade_2020s"]
ORIGIN_SUFFIXES = [
    "_density", "_growth_1yr", "_growth_3yr", "_growth_5yr", "_density_ma3", "_density_ma5",
    "_income_interaction", "_rent_interaction", "_education_interaction",
]
SPATIAL_LAG_VARIABLES = ["foreign_born_density", "median_household_income", "median_rent"]
