"""Word lists, rankings, thresholds and label tables.

These must equal the published rules for results to be right; nothing here is logic.
"""

PACIFIC = "America/Los_Angeles"

# The listing contract, in column order.
LISTING_KEYS = (
    "source", "source_id", "url", "title", "description", "start_dt", "end_dt",
    "venue_name", "venue_address", "price", "register_url", "image_url", "raw",
)

# Source ranking, highest priority first; an unknown source ranks by the host of its url, else last.
SOURCE_ORDER = (
    "eventbrite", "venue_site", "visitseattle", "seattlegov", "do206", "thestranger", "reddit",
)

# Host, or end of a host, -> the source that an unknown source on it ranks like.
HOST_SOURCES = {
    "eventbrite.com": "eventbrite",
    "visitseattle.org": "visitseattle",
    "seattle.gov": "visitseattle",
    "kingcounty.gov": "visitseattle",
    "parks.wa.gov": "visitseattle",
    "everout.com": "do206",
    "thestranger.com": "do206",
    "do206.com": "do206",
    "meetup.com": "do206",
    "facebook.com": "do206",
    "reddit.com": "reddit",
}

# Source -> authority tier used when checking agreement.
SOURCE_TIERS = {
    "eventbrite": "eventbrite",
    "venue_site": "venue_site",
    "visitseattle": "visitseattle",
    "seattlegov": "visitseattle",
    "do206": "aggregator",
    "thestranger": "aggregator",
    "aggregator": "aggregator",
    "reddit": "reddit",
}
SINGLE_SOURCE_TIERS = ("eventbrite", "venue_site")

# Keyword groups and excludes.
KEYWORDS = {
    "fitness": [
        "run", "running", "5k", "10k", "half marathon", "marathon", "race", "ride", "cycling",
        "bike", "swim", "triathlon", "gym", "workout", "training", "bootcamp", "hiit", "crossfit",
        "lifting", "powerlifting", "strength", "pilates", "barre", "spin", "rowing", "climbing",
        "bouldering", "martial arts", "boxing", "kickboxing", "jiu jitsu", "fitness",
    ],
    "wellness": [
        "yoga", "meditation", "breathwork", "mindfulness", "sauna", "cold plunge", "ice bath",
        "recovery", "mobility", "stretch", "massage", "spa", "wellness", "nutrition", "dietitian",
        "mental health", "sleep", "somatic", "sound bath",
    ],
    "lifestyle": [
        "hike", "hiking", "trail", "outdoor", "kayak", "paddle", "paddleboard", "farmers market",
        "market", "community", "social run", "run club", "walk", "walking", "festival", "expo",
        "workshop", "class", "meetup", "popup", "pop-up",
    ],
}
KEYWORD_EXCLUDES = [
    "casino", "gambling", "vape", "cannabis dispensary", "crypto", "nft", "timeshare", "mlm",
    "multi-level marketing", "webinar", "virtual event",
]

# Title words that never make two titles alike.
GENERIC_TITLE_WORDS = [
    "run", "walk", "ride", "yoga", "class", "workout", "fitness", "wellness", "seattle", "event",
    "festival", "market", "night", "day", "free", "community",
]
STOPWORDS = [
    "a", "an", "and", "at", "by", "for", "from", "in", "no", "of", "on", "or", "the", "to", "with",
]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
]

# Canonical fields of a merged event.
CANONICAL_FIELDS = (
    "title", "description", "start_dt", "end_dt", "venue_name", "venue_address", "price",
    "register_url", "image_url", "url",
)

# Matching and search distances.
MATCH_MINUTES = 120
NEVER_MERGE_MINUTES = 180
EARTH_RADIUS_M = 6371008.8
METRES_PER_DEGREE = 111320.0
SEARCH_RADIUS_M = 1500.0
FALLBACK_RADIUS_M = 5000.0
STOP_MERGE_RADIUS_M = 400.0
BOUNDS = {"lat": (47.40, 47.80), "lon": (-122.55, -122.10)}

# GTFS route types by mode, and mode priority.
RAIL_ROUTE_TYPES = (0, 1, 2, 12)
BUS_ROUTE_TYPES = (3, 11)
MODE_PRIORITY = {"bus": 1, "streetcar": 2, "light_rail": 3}

# Neighborhood spellings -> library names.
NEIGHBORHOOD_ALIASES = {
    "u district": "University District",
    "udistrict": "University District",
    "the u district": "University District",
    "university village": "University District",
    "sodo": "SoDo",
    "so do": "SoDo",
    "industrial district": "SoDo",
    "stadium district": "SoDo",
    "downtown seattle": "Downtown",
    "central business district": "Downtown",
    "cbd": "Downtown",
    "slu": "South Lake Union",
    "greenlake": "Green Lake",
    "uptown": "Queen Anne",
    "lower queen anne": "Queen Anne",
    "upper queen anne": "Queen Anne",
    "north queen anne": "Queen Anne",
    "east queen anne": "Queen Anne",
    "west queen anne": "Queen Anne",
    "north beacon hill": "Beacon Hill",
    "mid beacon hill": "Beacon Hill",
    "south beacon hill": "Beacon Hill",
    "north capitol hill": "Capitol Hill",
    "pike pine": "Capitol Hill",
    "alki": "West Seattle",
    "alki point": "West Seattle",
    "admiral": "West Seattle",
    "the junction": "West Seattle",
    "west seattle junction": "West Seattle",
    "phinney": "Phinney Ridge",
    "the ave": "University District",
}

# Stock image library (name, url, description); null url = not curated.
IMAGE_LIBRARY = [
    ("Capitol Hill", None, None),
    ("Ballard", None, None),
    ("Fremont", None, None),
    ("South Lake Union", None, None),
    ("West Seattle", None, None),
    ("Queen Anne", None, None),
    ("Wallingford", None, None),
    ("Georgetown", None, None),
    ("Columbia City", None, None),
    ("University District", None, None),
    ("Belltown", "https://images.unsplash.com/photo-1563663170081-4ff6736ab249?auto=format&fit=crop&w=1600&q=80",
     "The Space Needle rising above the rooftops, seen from Cedar Street in Belltown, Seattle."),
    ("Pioneer Square", "https://images.unsplash.com/photo-1741952863073-ddcb0250990c?auto=format&fit=crop&w=1600&q=80",
     "The Tlingit totem pole in Pioneer Square, Seattle, with the neighborhood's historic "
     "buildings behind it."),
    ("Green Lake", None, None),
    ("Magnolia", None, None),
    ("Beacon Hill", None, None),
    ("Rainier Valley", None, None),
    ("Downtown", "https://images.unsplash.com/photo-1502175353174-a7a70e73b362?auto=format&fit=crop&w=1600&q=80",
     "An aerial view of the downtown Seattle skyline."),
    ("SoDo", "https://images.unsplash.com/photo-1740760055939-19504a345784?auto=format&fit=crop&w=1600&q=80",
     "Lumen Field on Occidental Avenue South, in Seattle's stadium district at the north end "
     "of SoDo."),
    ("Northgate", None, None),
    ("Greenwood", None, None),
    ("Phinney Ridge", None, None),
    ("default", "https://images.unsplash.com/photo-1502175353174-a7a70e73b362?auto=format&fit=crop&w=1600&q=80",
     "An aerial view of the Seattle skyline."),
]
IMAGE_DISCLAIMER = "Illustrative image, not the event venue."
NEIGHBORHOOD_FIELDS = (
    "suburb", "quarter", "neighbourhood", "city_district", "residential", "borough",
)
CITY_FIELDS = ("city", "town", "village", "municipality")

# Photo discovery lists.
META_IMAGE_KEYS = [
    "og:image:secure_url", "og:image", "og:image:url", "twitter:image", "twitter:image:src",
]
IMAGE_CHROME_WORDS = [
    "logo", "icon", "favicon", "sprite", "avatar", "placeholder", "spinner", "loader", "pixel",
    "spacer", "badge", "banner-ad", "1x1",
]
CDN_HOST_HINTS = [
    "cdn", "static", "assets", "images", "media", "wixstatic", "squarespace", "shopify",
    "cloudfront", "imgix", "wp.com", "akamaized", "fastly",
]
NON_PHOTO_EXTENSIONS = [".png", ".bmp", ".tif", ".tiff"]
MIN_IMAGE_SIDE = 200

# Feed aliases, most authoritative first (prefix:name is read as prefix_name).
FEED_ALIASES = {
    "start": ["ev_startdate", "xcal_dtstart", "dtstart", "start_date", "start_time", "startdate",
              "gd_when", "event_start"],
    "end": ["ev_enddate", "xcal_dtend", "dtend", "end_date", "end_time", "enddate", "event_end"],
    "venue": ["ev_location", "xcal_location", "location", "venue", "event_venue"],
    "address": ["xcal_x-calconnect-street", "address", "event_address", "street"],
    "price": ["ev_cost", "cost", "price", "admission", "ticket_price"],
    "register": ["registration_url", "ticket_url", "tickets", "ev_url", "xcal_url"],
}
FEED_BODY_KEYS = [
    "title", "link", "links", "id", "guid", "summary", "subtitle", "description", "content",
    "enclosures", "media_thumbnail", "media_content",
]
JSONLD_CHILD_KEYS = ["@graph", "itemListElement", "item", "subEvent", "events"]
JSONLD_NOT_EVENTS = ["eventvenue", "eventreservation", "eventseries"]
JSONLD_MAX_DEPTH = 6
JSONLD_TEXT_KEYS = ["name", "url", "@id", "text", "contentUrl"]

# Selector lists shared by every site, then per-site lists.
CARD_DEFAULTS = {
    "title": ["h1", "h2", "h3", ".title", "[itemprop=name]"],
    "link": ["a[href]"],
    "date": ["time[datetime]", "time", ".date", ".datetime"],
    "description": [".description", ".summary", "p"],
    "venue": [".venue", ".location", ".place"],
    "address": [".address", "[itemprop=address]"],
    "price": [".price", ".cost", ".ticket-price"],
    "image": ["img[src]", "img[data-src]"],
}
SITE_SELECTORS = {
    "visitseattle": {
        "host": "visitseattle.org",
        "card": [".search-result-preview", ".event-item", "article.event", ".events-list .item",
                 "article"],
        "title": ["h3 a", "h2 a", "h3", "h2", ".title"],
        "date": ["time[datetime]", ".event-date", ".date", "time"],
        "venue": [".venue", ".event-venue", ".location"],
        "price": [".price", ".cost"],
    },
    "seattlegov": {
        "host": "www.seattle.gov",
        "card": [".views-row", ".event-listing", ".calendar-item", "article.node--type-event",
                 "article"],
        "title": [".field--name-title a", "h3 a", "h2 a", "h3", "h2"],
        "date": ["time[datetime]", ".field--name-field-date", ".date-display-single", ".date"],
        "venue": [".field--name-field-location", ".venue", ".location"],
        "address": [".field--name-field-address", ".address"],
    },
    "do206": {
        "host": "do206.com",
        "card": [".ds-listing", ".event-card", "article.ds-listing", "[data-event-id]", "article"],
        "title": [".ds-listing-event-title-text", ".ds-listing-event-title", "h3 a", "h2 a", "h3"],
        "link": ["a.ds-listing-event-title", "a[href]"],
        "date": ["time[datetime]", ".ds-event-time", ".ds-listing-details", "time"],
        "venue": [".ds-venue-name", ".ds-listing-details", ".venue"],
        "price": [".ds-listing-price", ".price"],
    },
    "thestranger": {
        "host": "everout.com",
        "card": [".event-list-item", ".event", "article.event", ".calendar-item", "article"],
        "title": [".event-title a", "h2 a", "h3 a", ".title", "h2"],
        "date": ["time[datetime]", ".event-date", ".date", "time"],
        "venue": [".location-name", ".event-location", ".venue"],
        "address": [".location-address", ".address"],
        "price": [".event-price", ".price", ".cost"],
    },
}
DETAIL_BUDGET = 12

# Words a stated price may use instead of an amount.

# Text rules for drafts.
BANNED_VOCABULARY = [
    "actionable", "beacon", "bustling", "crucial", "curate", "curated", "cutting-edge",
    "deep dive", "delve", "dive deep", "ecosystem", "elevate", "empower", "foster",
    "game-changer", "harness", "holistic", "impactful", "journey", "landscape", "leverage",
    "multifaceted", "notion", "nuanced", "optimize", "paradigm", "pivotal", "realm",
    "revolutionize", "robust", "seamless", "seasoned", "spearhead", "synergy", "tapestry",
    "testament", "thrive", "transformative", "unlock", "vibrant", "vital",
]
BANNED_PHRASES = [
    "in conclusion", "feel free to", "certainly!", "no excuses", "clean eating", "crush it",
    "wellness journey", "unlock your potential", "take it to the next level",
]
SECOND_PERSON = [
    "you should", "your body", "try this", "you need to", "you can", "you will feel",
    "your workout", "you want to",
]
HEALTH_VERBS = [
    "builds", "burns", "improves", "boosts", "strengthens", "prevents", "reduces", "relieves",
    "supports", "helps with", "is good for", "is easier on", "is safe for",
]
HEDGES = [
    "reportedly", "organizers say", "it is said that", "widely considered", "known for",
    "one of the more popular",
]
SUPERLATIVES = [
    "the cheapest", "the flattest", "the only", "the biggest", "the first", "the fastest-growing",
]
MARKETING_WORDS = [
    "premier", "iconic", "beloved", "unforgettable", "signature", "must-attend", "legendary",
]
DRAFT_LEXICON = {
    "banned_vocabulary": BANNED_VOCABULARY,
    "banned_phrase": BANNED_PHRASES,
    "second_person": SECOND_PERSON,
    "health_verb": HEALTH_VERBS,
    "hedge": HEDGES,
    "superlative": SUPERLATIVES,
    "marketing": MARKETING_WORDS,
    "exclude": KEYWORD_EXCLUDES,
}
WEAK_ANCHORS = ["read more", "click here", "this article"]
EM_DASH = "—"
DISCLAIMER = "Event details can change. Confirm with the organizer before you go."

# Thresholds.
RELEVANCE_PASS = 7.0
JUDGE_PASS = 8
MAX_ATTEMPTS = 3
MAX_REHOLDS = 2
ARTICLES_PER_RUN = 5
SECTIONS_MIN, SECTIONS_MAX = 5, 6
WORDS_MIN, WORDS_MAX = 800, 1200
DETAILS_ALLOWANCE = 45
STRICT_WORDS = (880, 1120)
META_TITLE_MAX, META_DESCRIPTION_MAX = 60, 155
HOOK_WORDS_MAX = 30
SLUG_MAX = 60
JUDGE_DIMENSIONS = [
    "voice_brand_compliance", "structural_format_compliance", "editorial_value",
    "factual_venue_integrity", "seattle_local_specificity", "ai_pattern_detection", "seo",
]

# Stages in order, and status texts.
STAGES = ["s3_validate", "s4_write", "s5_factcheck", "s6_judges", "s7_eic", "s9_publish"]
BANNERS = {
    "ended": "This event has ended.",
    "cancelled": "This event was cancelled.",
    "sold_out": "This event is sold out.",
}
DETAILS_LABELS = [
    ("when", "When"), ("where", "Where"), ("cost", "Cost"), ("register", "Register"),
    ("skill_level", "Skill level"), ("what_to_bring", "What to bring"),
]

# Publishing bands (rank, first minute, last minute, midpoint, ISO weekdays).
SLOT_BANDS = [
    (1, 7 * 60, 8 * 60 + 30, 7 * 60 + 45, (2, 3, 4)),
    (2, 11 * 60 + 30, 13 * 60, 12 * 60 + 15, (1, 2, 3, 4, 5)),
    (3, 17 * 60 + 30, 19 * 60, 18 * 60 + 15, (1, 2, 3, 4, 5)),
    (4, 9 * 60, 11 * 60, 10 * 60, (6, 7)),
    (5, 7 * 60, 8 * 60 + 30, 7 * 60 + 45, (1, 5)),
]
PREFERRED_OFFSETS = (7, 6, 5)
WIDENED_OFFSETS = (4, 8, 3, 9, 2, 10)
ANCHOR_OFFSET = 6
SPACING_HOURS = (24, 12, 6)
FRIDAY_CUTOFF_MINUTE = 15 * 60
QUIET_FROM_MINUTE, QUIET_UNTIL_MINUTE = 22 * 60, 5 * 60 + 29
