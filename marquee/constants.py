"""Words, tables, patterns and limits the results depend on."""

# --- fixed values: stored layout -------------------------------------------
AUTO_COLUMNS = [
    "event_id", "facebook_id", "venue_id", "aggregator_id",
    "title", "date_start", "hour_start",
    "venue", "room", "address", "area", "latitude", "longitude",
    "genre", "subgenre", "artists",
    "source_url", "ticket_url", "price", "details", "description",
    "interested", "going", "city", "country",
    "organizers", "social_links", "collective", "status",
    "source", "hour_end", "support_acts", "image_url", "genre_raw", "last_seen",
]
HUMAN_COLUMNS = [
    "venue_override", "address_override", "latitude_override", "longitude_override",
    "genre_override", "hide", "approved", "notes",
]
VENUE_COLUMNS = [
    "id", "canonical_name", "initials", "aliases", "address", "lat", "lng",
    "underground_weight", "genres", "area", "website", "scrape_url", "scrape_type", "hide",
]
SCRAPE_TYPES = ["html", "ical", "json", "playwright"]
APPROVED_WORDS = ["yes", "true", "y", "x", "1", "approved"]
TRUE_WORDS = ["true", "1", "yes", "x", "ja"]
AGENDA_SOURCES = ["vierdeZaal", "minusOne"]

# --- fixed values: source priority (higher wins) -----------------------------
SOURCE_PRIORITY = {
    "facebook": 0,
    "goabase": 1, "beldub": 1, "reggaebe": 1,
    "funke": 2, "chinastraat": 2, "asgaard": 2, "kinkystar": 2, "broei": 2,
    "thecrossover": 2, "molotov": 2, "vierdeZaal": 2, "minusOne": 2,
    "charlatan": 2, "clubsauvage": 2, "trefpunt": 2, "decentrale": 2,
    "haconcerts": 2, "viernulvier": 2, "bijloke": 2, "wintercircus": 2,
    "clubwintercircus": 2, "kompass": 2,
}
DEFAULT_PRIORITY = 1
SIMILAR_AT = 0.85

# --- fixed values: places -----------------------------------------------------
# (name, lat min, lat max, lng min, lng max); the first box that holds a point wins
AREA_BOXES = [
    ("Dampoort", 51.055, 51.070, 3.740, 3.770),
    ("Brugse Poort", 51.055, 51.075, 3.700, 3.730),
    ("Muide", 51.060, 51.075, 3.720, 3.740),
    ("City Centre", 51.040, 51.060, 3.715, 3.740),
]
CITY_BOX = (50.95, 51.15, 3.55, 3.90)
COUNTRY_BOX = (49.49, 51.51, 2.54, 6.41)
LOOKAHEAD_DAYS = 92
LOCAL_ZONE = "Europe/Brussels"
COORD_FIXES = [("kouter - kiosk", 51.05018, 3.7233, "Kouter, 9000 Gent")]

# --- fixed values: artist extraction -------------------------------------------
ARTIST_CONNECTORS = r"(?i)\s+(?:feat\.?|b2b|vs\.?|presents?|&|\+|×|x)\s+"
ARTIST_DELIMITERS = r"[•|/\n]+"
ARTIST_NOISE = [
    "live", "dj set", "dj", "all night long", "doors open", "presents",
    "b2b", "feat", "featuring", "tickets", "more", "+more", "and more",
    "tba", "tbc", "special guest", "guests",
]
ARTIST_FIRST_CHAR = r"^[a-zA-ZÀ-ÿ0-9]"
NAME_SPLIT = r",|\n|\s\+\s"
LINEUP_LINE = (
    r"^[^\w]*[~\s]*🎶?\s*([A-Z][A-Za-z0-9' .&-]{1,30}?)\s*(?:\.{2,}|_{2,}|—|–| - )"
)
SUBTITLE_HINTS = [
    "invites", "presents", "night", "fest", "rave", "matinee", "open mic", "release", "party",
]
LISTED_GENRES = [
    "Drum & Bass", "Hip Hop", "Singer-Songwriter",
    "Punk", "Metal", "Jazz", "Electronic", "Rock", "Wave", "Experimental",
    "Folk", "Pop", "Indie", "Hardcore", "Techno", "House", "Reggae", "Ska",
    "Garage", "Psych", "Noise", "Blues", "Funk", "Soul", "Ambient",
]

# --- fixed values: dates and clock times ----------------------------------------
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
    "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7,
    "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "januari": 1, "februari": 2, "maart": 3, "mei": 5, "juni": 6,
    "juli": 7, "augustus": 8, "oktober": 10, "mrt": 3, "okt": 10,
}
GRACE_DAYS = {"month": 30, "week": 7, "day": 1, "none": 0}

# --- fixed values: price patterns, one per layout met in the sources ----------------
PRICE_PATTERNS = {
    "lineup": r"(?i)(?:vvk|presale|entr[ée]e?|deur|door|entry)\s*:?\s*€?\s*[\d,.]+|€\s*[\d,.]+",
    "euro": r"€\s*[\d,.]+",
    "range": r"€\s*[\d,.]+(?:\s*[–\-]\s*€?\s*[\d,.]+)?",
    "word": r"(?i)[|]\s*(\d+[\d,.]*\s*euro)|€\s*(\d+[\d,.]*)",
    "decimal": r"\d+[,.]\d{2}",
    "free_or_euro": r"(?i)Gratis|€\s*[\d,.]+",
    "presale": r"(?:VVK\s*:?\s*)?€\s*[\d,.]+",
}

# --- fixed values: record keys, in the order they are tried -----------------------
NAME_KEYS = ["name", "title"]
DATE_KEYS = [
    "start_date", "startDate", "start", "date", "start_at", "starts_at",
    "begins_at", "begin_at", "date_from", "dateFrom", "event_date", "datetime",
]
TICKET_KEYS = [
    "ticket_url", "ticketUrl", "buy_url", "shop_url", "shopUrl",
    "registration_url", "registrationUrl", "external_url", "externalUrl",
    "tickets_url", "ticketsUrl", "buy_tickets_url", "ticket_link",
    "payment_url", "booking_url", "website_url", "website", "url", "link",
]
ID_KEYS = ["id", "event_id", "eventId"]
DESCRIPTION_KEYS = ["description", "body", "content", "summary"]
IMAGE_KEYS = ["image", "image_url", "imageUrl", "cover", "banner", "thumbnail", "media_url", "picture"]
START_TIME_KEYS = ["start_time", "startTime", "time"]
END_TIME_KEYS = ["end_time", "endTime", "end_date", "ends_at"]
TICKET_WORDS = r"(?i)ticket|shop|koop|kassa|register|booking|bestel|pay|checkout"
LIST_KEYS = ["events", "data", "items", "results", "list", "records"]
NESTED_LIST_KEYS = ["events", "items", "results"]
IMAGE_STYLES = ["news_detail_large", "large", "news_detail_medium", "medium"]
UNKNOWN_STYLE_RANK = 99

# --- fixed values: link deny lists ---------------------------------------------------
CATEGORY_SLUGS = ["concert", "nightlife", "comedy", "hitjes"]
SITE_PAGES = (
    r"/(nieuws|music-pub|menukaart|history|veelgestelde-vragen|wachtwoord|lost-user|algemene|privacybeleid)"
)
REGISTRATION_PAGES = r"/(individual|group)-registration|/registration"
NON_EVENT_PATHS = r"(?i)^/(category|tag|author|page|feed|wp-|praktisch|360|contact|privacy|vacature)"

# --- fixed values: genre taxonomy rules -------------------------------------------
SUPER_GENRES = [
    "inl", "met", "rnr", "gld", "pwv", "hcp", "alt", "con", "pop", "cou", "rnb", "gos",
    "blu", "jaz", "jam", "rap", "brb", "dnb", "hct", "tec", "hou", "tra", "dtp",
]
GENRE_WEIGHTS = {
    3: ["tec", "hou", "tra", "dnb", "brb", "hct", "dtp", "jam", "rap", "inl"],
    2: ["met", "pwv", "hcp", "alt", "pop", "rnb", "jaz"],
    1: ["rnr", "gld", "con", "cou", "blu", "gos"],
}
GENRE_STOPWORDS = [
    "dub", "trap", "electro", "core", "rave", "wave", "bass", "edm", "raw", "go", "acid", "tek",
]
GENRE_DENY = [
    "rock", "pop", "beat", "revival", "early", "instrumental", "soul", "funk", "disco", "blues", "jazz",
    "country", "metal", "punk", "indie", "wave", "house", "techno", "trance", "dub", "electro", "core", "rave",
    "bass", "edm", "raw", "go", "acid", "tek", "grime", "garage", "hardcore", "ambient", "breaks", "swing",
    "gospel", "ska", "reggae", "jungle", "snap", "crunk", "bounce", "twee", "motown", "juke", "wonky",
    "emo", "screamo",
]
GENRE_NO_AUTO = ["tec02"]
GENRE_KEYWORDS = {
    "dnb": ["dnb", "d&b", "drum and bass"],
    "rnb": ["rnb", "r&b"],
    "tec": ["acid techno", "dub techno", "psychedelic techno", "trance techno"],
    "tec08": ["hard techno"],
    "dnb08": ["dubstep"],
    "jam02": ["ska"],
    "jam04": ["roots reggae"],
    "rnb07": ["disco"],
    "rnb08": ["go-go", "bounce beat"],
    "tec02": ["freetekno", "free tekno", "tekno", "hardtek"],
}
GENRE_ALIASES = {
    "jam05": [
        "dub reggae", "dub soundsystem", "dub sound system", "steppers", "king tubby", "roots dub",
        "stepping", "steppa", "kingstep", "dub circus", "rockers",
    ],
}
GENRE_ACRONYMS = {
    "ebm": "EBM", "nrg": "NRG", "hi-nrg": "Hi-NRG", "idm": "IDM", "aor": "AOR", "a.o.r.": "A.O.R.",
    "ac": "AC", "a.c.": "A.C.", "ccm": "CCM", "vgm": "VGM", "nwobhm": "NWOBHM", "nwoahm": "NWOAHM",
    "uk": "UK", "us": "US", "og": "OG", "rnb": "RnB", "dnb": "DnB", "r&b": "R&B", "d&b": "D&B",
    "r&r": "R'n'R", "p-funk": "P-Funk", "go-go": "Go-Go", "psy": "Psy", "'n'": "'n'", "'n": "'n",
}
GENRE_FORBIDDEN = [
    "rock", "pop", "beat", "revival", "early", "instrumental",
    "b ii", "nu r", "b i", "a c", "a o r",
]

# --- fixed values: festival layout -----------------------------------------------------
FESTIVAL_FALLBACK_HEADER = [
    "title", "venue", "address", "date", "time", "lat", "lng", "desc",
    "url", "categories", "organizer", "price", "image", "source",
]
