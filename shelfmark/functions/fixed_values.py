"""Word lists, tables and patterns of the catalog data model.

Fixed values: results depend on them to the letter. They describe the catalog's own vocabulary
(product lines, listing formats, retailers), in the order in which the rules try them.
"""

from __future__ import annotations

#: A word boundary as ASCII sees it; Java's own treats accented letters as word characters.
B0, B1 = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"

NON_FIGURE_MEDIA = r"(?i)_(Pins_and_Badges|Keychains|Plush_Toys|PEZ_Dispensers|Pens|Shirts_and_Jackets|Coin_Banks|Uniform_Patches|Bags|Wallets|Lanyards|Mugs|Posters|Apparel)_[0-9a-f]{6,}"

DROP_LINES = "bitty pop|pocket pop|mystery min|mini vinyl figures"
ACCESSORY_KEYWORDS = "backpack|wallet|crossbody|tote|globe|lanyard|keychain|charm|sling|cardholder|coin bag|zip around|glitter globe"
ACCESSORY_STANDALONE = "pin|pins|case|cases|display|stand|bag|bags"
PROTECTOR_SUFFIX = r"(?i)\s+with Pop!\s*Protector\s*\z"
POP_SUBTYPES = r"(?i)^Pop!\s+((?:(?:Rides Deluxe|Rides|Deluxe|Super(?!\s+Saiyan)|Jumbo|Moments|Moment|Premium|Plus|Towns|Town|Nooks|Comic Cover|Cover|Album|Die-Cast|Movie Poster|Gamerverse|Pez)\s+)+)"

VARIANT_STOPWORDS = ("in", "the", "of", "a", "an", "and", "with", "edition", "le", "version")
NAME_STOPWORDS = ("funko", "pop", "the", "a", "an", "of", "and", "with", "in", "le", "vinyl")

NON_POP_TITLE_WORDS = "backpack|bag|wallet|crossbody|lanyard|keychain|soda|mystery minis|wacky wobbler|funkoverse|bitty pop|pocket pop|pin set|enamel pin|zip around|cardigan|hoodie|jacket|legging|dress|beanie|cap|hat|mug|cup|cushion|plush|peluche|dorbz|vynl|hikari|rock candy|fabrikations|paka paka|spastik plastik"
NON_POP_SERIES = (
    "pop! tees", "pop! homewares", "pop! pins", "pop! keychains", "loungefly", "mystery minis", "wacky wobblers", "vinyl soda",
    "funko soda", "funkoverse", "dorbz", "rock candy", "hikari", "fabrikations", "paka paka", "spastik plastik", "vynl",
    "pop! apparel", "shirts and jackets", "pins and badges", "something wild", "funko games -",
)

SET_SUFFIXES = ("mini vinyl figures", "advent calendar", "mystery box", "vinyl sets", "gift set", "collectors set", "diorama", "build a scene", "build-a-scene")
SET_EXCLUDE_KW = ("exclusive", "gamestop", "eb games", "convention", "comic con", "sdcc", "nycc", "eccc")
SET_GENERIC_LINES = ("funko advent calendar", "funko mini vinyl figures", "mini vinyl figures", "disney mini vinyl figures")

UMBRELLA_CONSOLES = ("animation", "star-wars", "disney", "marvel", "television", "comics", "movies", "games", "heroes", "icons", "rocks", "ad-icons", "retro-toys", "asia", "art-series", "digital", "vinyl-soda", "soda", "rides")
CONSOLE_ACRONYMS = {"wwe": "WWE", "mlb": "MLB", "nfl": "NFL", "nba": "NBA", "nhl": "NHL", "mls": "MLS", "bape": "BAPE", "vhs": "VHS", "se": "SE", "dc": "DC", "tv": "TV", "ufc": "UFC"}

SERIES_HARD_NOISE = (
    "walmart", "wal-mart", "only at walmart", "funko shop", "funko shop.", "funko pop figure", "vinyl figure", "collector's edition", "impressions",
    "icons", "slam", "target", "gamestop", "hot topic", "boxlunch", "box lunch", "fye", "f.y.e.", "amazon", "disney store", "px previews exclusive",
    "summer convention", "summer funko convention", "funko spring convention", "tpm25",
)
SERIES_EVENT_KW = (
    "exclusive", "convention", "sdcc", "nycc", "eccc", "d23", "comic con", "celebration", "loot crate", "blizzard", "walgreens", "px previews", "ccxp",
    "lacc", "galactic convention", "limited edition", "blacklight", "funko fundays", "funko shop", "first to market",
)

REMOVE_TITLES = (
    "Mickey Mouse Holiday Socks", "Passport Issued By Funko", "Wonder Woman Insulated Glass", "Target Marvel UV Socks 3-Pack",
    "Rock 'em Sock 'em Robots (Red)", "Rock 'em Sock 'em Robot (Red)", "Rock 'em Sock 'em Robot (Blue)", "Gremlins - Family Card Game",
    "National Lampoon's Christmas Vacation - Family Card Game", "Batman 80th Socks", "Fuzzy Beast Toe Socks", "Batman Classic TV Socks",
    "Darth Vader 16 Oz. Tumbler W/ Straw", "8-Bit Batman Socks (Green & Blue)", "8-Bit Batman Socks (Blue & Red)", "8-Bit Batman Socks (Gray & Blue)",
    "8-Bit Batman Socks (Orange & Red)", "8-Bit Batman Socks (Purple & Blue)", "Endor Socks", "First Order Emblem Socks", "Snowman Jack Socks",
    "The Last Jedi Poster", "Wonder Woman Socks", "Fright Night Socks", "Darth Vader & Stormtrooper Socks",
)

ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}

#: Fields that later rows of a handle fill, in a merge by handle.
MERGE_FIELDS = (
    "hdbid", "upc", "funkoNumber", "funkoNumberFromTitle", "funkoSource", "price", "available", "productUrl", "funkoPrimaryImage", "popType",
    "hotTopicSku", "gamestopSku", "targetSku", "walmartSku", "amazonSku", "franchise", "funkoSection", "pid", "marketValueLoose", "marketValueComplete",
    "marketValueNew", "marketValueIsApproximate", "pricechartingId", "pricechartingUrl", "pcSeries", "releaseDate", "ebayEpid", "amazonAsin", "printRun",
    "publisher", "pcDescription", "setTag", "franchiseSuggestion",
)
#: Fields that a priced duplicate fills on the row it is a duplicate of.
DEDUPE_FIELDS = (
    "pricechartingId", "pricechartingUrl", "marketValueLoose", "marketValueComplete", "marketValueNew", "upc", "releaseDate", "ebayEpid", "amazonAsin",
    "printRun", "publisher", "pcDescription", "pcSeries", "funkoNumber", "hdbChecked", "franchiseChecked", "hdbid", "priceCheckedAt",
)
#: Label of a detail page's table row: field.
META_LABELS = {
    "Release Date": "releaseDate", "UPC": "upc", "Box Number": "funkoNumber", "Series": "pcSeries", "ePID (eBay)": "ebayEpid", "ASIN (Amazon)": "amazonAsin",
    "Print Run": "printRun", "Publisher": "publisher", "Description": "pcDescription",
}
#: What a reference page's label contains: field.
SKU_LABELS = {"hot topic": "hotTopicSku", "gamestop": "gamestopSku", "target": "targetSku", "walmart": "walmartSku", "amazon": "amazonSku"}
#: How pages state a price, and how many rows there are (shop listings, the shop's facets, sets), in the order of trial.
MONEY = r"\$\s*([0-9,]+\.[0-9]{2})"
SHOP_TOTALS = (r"of\s+([\d,]+)\s+Items?", r"\(([\d,]+)\)\s+Results?", r"([\d,]{2,})\s+Items?")
FACET_TOTALS = (r"of\s+([\d,]+)\s+Items", r"\(([\d,]+)\)\s+Results")
SET_TOTALS = (r"for all\s+([\d,]+)\s+Funko", r"/\s*([\d,]+)\s+items")
BOOLEAN_FIELDS = ("kennySource", "available", "marketValueIsApproximate", "hdbChecked", "franchiseChecked", "isVaulted", "isChase", "isExclusive")
ARRAY_FIELDS = ("series", "funkoFandom", "funkoLicense", "funkoSeries")
STRING_FIELDS = (
    "handle", "title", "imageName", "popType", "pid", "productUrl", "funkoPrimaryImage", "price", "funkoSource", "marketValueLoose", "marketValueComplete",
    "marketValueNew", "pricechartingId", "pricechartingUrl", "priceCheckedAt", "priceSource", "upc", "funkoNumber", "funkoNumberFromTitle", "pcSeries",
    "ebayEpid", "amazonAsin", "printRun", "publisher", "pcDescription", "releaseDate", "hdbid", "hotTopicSku", "gamestopSku", "targetSku", "walmartSku",
    "amazonSku", "franchise", "funkoSection", "setTag", "franchiseSuggestion", "category", "console", "exclusiveRetailer",
)
PRICED_SOURCE, SHOP_SOURCE = "pricecharting", "funko.com"
PRICED_BASE, SHOP_BASE = "https://www.pricecharting.com", "https://www.funko.com"
#: Console sets that discovery never falls below, in the reference's order.
CONSOLE_SLUGS = tuple(
    f"funko-pop-{s}"
    for s in (
        "8-bit ad-icons air-force albums animation aquasox army around-the-world art-cover art-series artists asia bape basketball bitty board-games "
        "books boxing broadway build-a-bear candy christmas classics college comedians comic-covers comics conan deluxe deluxe-moment die-cast "
        "digital directors disney drag-queens fantastic-beasts fantastik-plastik fashion foodies freddy-funko game-covers game-of-thrones games golf "
        "gpk halo harry-potter heroes hockey holidays house-of-the-dragons icons lance league-of-legends magazine-covers magic-the-gathering marines "
        "marvel minis mlb moment monsters movie-posters movies muppets my-little-pony myths nascar navy nba-mascots nfl pets plants plus pusheen "
        "racing retro-toys rides rocks royals sanrio sci-fi se sesame-street snl soccer south-park sports-legends stan-lee star-wars television "
        "tennis the-vote town town-christmas trading-cards trains trolls ufc uglydoll valiant vans vhs-covers wnba wreck-it-ralph wrestling wwe "
        "wwe-covers zodiac"
    ).split()
)

# Paging and retries
PAGE_CEILING = 500
EMPTY_PAGES = 3
FETCH_TRIES = 3
FETCH_BACKOFF_MS = 2000

# Facets of the shop
FACET_DIMS = ("fandom", "license", "series")
