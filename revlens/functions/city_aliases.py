"""City spelling variants and their canonical names.

FIXED VALUES: the lookup the analysed workload applies to business cities,
exact match after trimming and collapsing whitespace.  The state is not part
of the key (a later scope join on (city, state) resolves homonyms).
"""

CITY_ALIASES = [
    ("Bala Cynwyd", "Philadelphia"),
    ("Center City", "Philadelphia"),
    ("Chestnut Hill", "Philadelphia"),
    ("East Passyunk", "Philadelphia"),
    ("Fishtown", "Philadelphia"),
    ("Manayunk", "Philadelphia"),
    ("Mount Airy", "Philadelphia"),
    ("Mt Airy", "Philadelphia"),
    ("Northern Liberties", "Philadelphia"),
    ("Old City", "Philadelphia"),
    ("Passyunk Square", "Philadelphia"),
    ("Phialdelphia", "Philadelphia"),
    ("Phila", "Philadelphia"),
    ("PHILADELPHIA", "Philadelphia"),
    ("philadelphia", "Philadelphia"),
    ("Philadelphia ", "Philadelphia"),
    ("Philly", "Philadelphia"),
    ("Queen Village", "Philadelphia"),
    ("Rittenhouse", "Philadelphia"),
    ("Rittenhouse Square", "Philadelphia"),
    ("Roxborough", "Philadelphia"),
    ("South Philadelphia", "Philadelphia"),
    ("University City", "Philadelphia"),
    ("Algiers", "New Orleans"),
    ("Bucktown", "New Orleans"),
    ("Bywater", "New Orleans"),
    ("Downtown", "New Orleans"),
    ("new orleans", "New Orleans"),
    ("NEW ORLEANS", "New Orleans"),
    ("Antioch", "Nashville"),
    ("Belle Meade", "Nashville"),
    ("Berry Hill", "Nashville"),
    ("Cane Ridge", "Nashville"),
    ("DONELSON", "Nashville"),
    ("Donelson", "Nashville"),
    ("East Nashville", "Nashville"),
    ("Hermitage", "Nashville"),
    ("Inglewood", "Nashville"),
    ("MADISON", "Nashville"),
    ("Madison", "Nashville"),
    ("NASHVILLE", "Nashville"),
    ("nashville", "Nashville"),
    ("Nashville ", "Nashville"),
    ("Nashville-Davidson metropolitan gover", "Nashville"),
    ("Old Hickory", "Nashville"),
    ("Carrollwood", "Tampa"),
    ("Greater Northdale", "Tampa"),
    ("South Tampa", "Tampa"),
    ("Southwest Tampa", "Tampa"),
    ("TAMPA", "Tampa"),
    ("tampa", "Tampa"),
    ("Tampa Bay", "Tampa"),
    ("Tampa,Fl", "Tampa"),
    ("Temple Terr", "Tampa"),
    ("TEMPLE TERR", "Tampa"),
    ("Temple Terrace", "Tampa"),
    ("Town 'n' Country", "Tampa"),
    ("Town 'N' Country", "Tampa"),
    ("Town n Country", "Tampa"),
    ("Westchase", "Tampa"),
    ("Indianaplois", "Indianapolis"),
    ("INDIANAPOLIS", "Indianapolis"),
    ("indianapolis", "Indianapolis"),
    ("indianopolis", "Indianapolis"),
    ("INpolis", "Indianapolis"),
    ("tucson", "Tucson"),
    ("TUCSON", "Tucson"),
    ("SAINT LOUIS", "Saint Louis"),
    ("saint louis", "Saint Louis"),
    ("Saint Louis,", "Saint Louis"),
    ("St Louis", "Saint Louis"),
    ("st louis", "Saint Louis"),
    ("ST LOUIS", "Saint Louis"),
    ("St Louis County", "Saint Louis"),
    ("St Louis Downtown", "Saint Louis"),
    ("St. Louis", "Saint Louis"),
    ("ST. Louis", "Saint Louis"),
    ("ST. LOUIS", "Saint Louis"),
    ("st. louis", "Saint Louis"),
    ("St. Louis County", "Saint Louis"),
    ("St.Louis", "Saint Louis"),
    ("RENO", "Reno"),
    ("reno", "Reno"),
    ("SANTA BARBARA", "Santa Barbara"),
    ("santa barbara", "Santa Barbara"),
    ("Santa barbra", "Santa Barbara"),
    ("Santa Barbra", "Santa Barbara"),
    ("santa barbra", "Santa Barbara"),
    ("saint petersburg", "Saint Petersburg"),
    ("SAINT PETERSBURG", "Saint Petersburg"),
    ("Saint Petersburg", "Saint Petersburg"),
    ("Saintt Petersburg", "Saint Petersburg"),
    ("St Pete", "Saint Petersburg"),
    ("St Petersburg", "Saint Petersburg"),
    ("st petersburg", "Saint Petersburg"),
    ("St. Petersburg", "Saint Petersburg"),
    ("ST. PETERSBURG", "Saint Petersburg"),
    ("st. petersburg", "Saint Petersburg"),
    ("St.Petersburg", "Saint Petersburg"),
]

# FIXED VALUES: the study scope, (city, state) pairs.
SCOPE_PAIRS = [
    ("Philadelphia", "PA"),
    ("New Orleans", "LA"),
    ("Nashville", "TN"),
    ("Tampa", "FL"),
    ("Indianapolis", "IN"),
    ("Tucson", "AZ"),
    ("Saint Louis", "MO"),
    ("Reno", "NV"),
    ("Santa Barbara", "CA"),
    ("Saint Petersburg", "FL"),
]

MIN_REVIEW_YEAR = 2010

# FIXED VALUES: raw spellings inspected by the variant report, and the
# spellings of the same city that count as canonical there.
PHILADELPHIA_VARIANTS = [
    "Bala Cynwyd",
    "Center City",
    "Chestnut Hill",
    "East Passyunk",
    "Fishtown",
    "Manayunk",
    "Mount Airy",
    "Mt Airy",
    "Northern Liberties",
    "Old City",
    "Passyunk Square",
    "Phialdelphia",
    "Phila",
    "PHILADELPHIA",
    "philadelphia",
    "Philadelphia ",
    "Philadelphia",
    "Philly",
    "Queen Village",
    "Rittenhouse",
    "Rittenhouse Square",
    "Roxborough",
    "South Philadelphia",
    "University City",
]
CANONICAL_PHILADELPHIA = ["Philadelphia", "PHILADELPHIA", "philadelphia"]
