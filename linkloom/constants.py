"""Values that results depend on."""

# Names of states and territories, and their codes.
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "district of columbia": "DC", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM",
    "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI",
    "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY", "puerto rico": "PR", "virgin islands": "VI", "guam": "GU", "american samoa": "AS",
}

# Words that say nothing about who a name belongs to.
NOISE = (
    "inc", "incorporated", "llc", "llp", "lp", "pc", "pa", "pllc", "plc", "ltd", "corp", "corporation",
    "co", "company", "the", "of", "at", "and", "a", "an", "group", "system", "systems", "health",
    "healthcare", "medical", "center", "centre", "ctr", "hospital", "hospitals", "clinic", "clinics", "regional", "memorial", "community",
    "general", "district", "services", "service", "associates", "assoc", "partners", "network", "university", "univ", "st", "saint",
    "dba",
)

# Address words and the forms they are brought to.
ADDRESS_WORDS = {
    "street": "st", "str": "st", "avenue": "ave", "av": "ave", "boulevard": "blvd", "road": "rd", "drive": "dr", "lane": "ln", "court": "ct", "circle": "cir",
    "place": "pl", "parkway": "pkwy", "highway": "hwy", "terrace": "ter", "trail": "trl", "square": "sq", "suite": "ste", "apartment": "apt",
    "building": "bldg", "floor": "fl", "room": "rm", "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw",
    "southeast": "se", "southwest": "sw", "first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th", "sixth": "6th", "seventh": "7th",
    "eighth": "8th", "ninth": "9th", "tenth": "10th", "mount": "mt", "fort": "ft", "doctor": "dr",
}

# Words that label a branch by its place.
COMPASS = (
    "n", "s", "e", "w", "ne", "nw", "se", "sw", "north", "south", "east", "west",
    "northeast", "northwest", "southeast", "southwest", "central", "main", "downtown", "uptown", "campus", "annex",
)

# Former names and states of business in parentheses (Java syntax, case ignored).
ALIAS = r"(?i)\((?:\s*(?:fka|f/k/a|aka|a/k/a|dba|d/b/a|formerly(?:\s+known\s+as)?|now|nka)\s*)(.+?)\)"
STATUS = r"(?i)\(\s*(?:closed|closing|inactive|merged|new|pending|proposed|under\s+construction|campus|satellite|reopened)[^)]*\)"

# Weights and thresholds of scores.
TOKEN_SET, TOKEN_SORT = 0.35, 0.65
ADDRESS_WEIGHTS = {"number": 0.30, "body": 0.22, "city": 0.18, "state": 0.08, "zip": 0.22}
MATCH_WEIGHTS = {"name": 0.40, "number": 0.20, "body": 0.15, "city": 0.10, "state": 0.05, "zip": 0.10}
TOP_K, OVER_FETCH, FLOOR = 6, 3, 55.0
LOCATION_CAP, GAP_LOCATION_CAP = 250, 60
LEAST_NAME_CHARS, SHARED_NAME_PARENTS, LEAST_MARGIN = 4, 5, 3.0

# The names of verdicts and tiers.
VERDICTS = ("Unscored", "ID corroborated", "Probable - name agrees, address differs", "Probable - address agrees, name differs", "Needs review", "Likely wrong ID")
TIERS = ("Strong match - ready to load", "Probable match - review", "Ambiguous - rival candidates", "Weak match - review", "No credible match", "No usable name")
