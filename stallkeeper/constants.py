"""Fixed values. They decide results, so they are listed plainly and in natural order."""

# Phrases that mark a page as boilerplate (case-sensitive substrings).
PHRASES_TO_FILTER = [
    "Result not found",
    "No exact matches found",
    "Not found",
    "Item Not found",
    "Search results for:",
]

# Phrases the time-range extract leaves out (any case, whole words).
PHRASES_TO_EXCLUDE = [
    "Result not found",
    "No exact matches found",
    "Not found",
    "Item Not found",
]

# Candidate labels and sentence template of the zero-shot classifier.
ZERO_SHOT_LABELS = [
    "a real animal",
    "a toy",
    "a print of an animal",
    "an object",
    "a faux animal",
    "an animal body part",
    "a faux animal body part",
]
ZERO_SHOT_TEMPLATE = "This product advertisement is about {}."

# Site labels that may carry extraction rules of their own.
RULE_SITES = [
    "gumtree",
    "auctionzip",
    "1stdibs",
    "canadianlisted",
    "etsy",
    "ukclassifieds",
    "thetaxidermystore",
    "skullsunlimited",
    "glacierwear",
    "picclick",
    "preloved",
    "ebay",
    "ecrater",
]

# Location names replaced before the gazetteer lookup.
LOCATION_ALIASES = {"US": "USA", "GB": "Great Britain"}

# Class names and ids of the auction site's seller, location and description blocks.
SELLER_BLOCK_CLASS = "d-stores-info-categories__container__info__section"
SELLER_SPAN_CLASS = "ux-textspans ux-textspans--BOLD"
LOCATION_BLOCK_CLASS = "ux-labels-values col-12 ux-labels-values--itemLocation"
DESCRIPTION_FRAME_ID = "desc_ifr"

# Fixed value: the substring that makes a URL a listing.
LISTING_URL_TOKEN = "/itm/"
