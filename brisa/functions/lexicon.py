"""Word lists and category lists used by the review analyses.

FIXED VALUES - these must stay exactly as the analyses define them
(the words searched for, the cuisine lists and the regional groupings).
"""

# Negative words paired with authenticity language.
NEGATIVE_WORDS = ["dirty", "cheap", "kitsch", "rude", "simple", "bad"]

# Cuisine categories counted for the "legitimate" reviews.
CUISINE_TYPES = [
    "American (New)", "American (Traditional)", "Italian", "Mexican", "Japanese",
    "Chinese", "Thai", "Indian", "French", "Korean", "Mediterranean", "Soul",
]

# Cuisines grouped by region of origin.
SOUTH_AMERICA = ["Mexican", "New Mexican Cuisine", "Peruvian", "Cuban"]
SOUTH_ASIA = ["Thai", "Indian", "Pakistani"]
EUROPE = ["Italian", "French", "Greek", "German", "Spanish", "Irish"]

# Category dropped from the negative / non-negative tables.
DROPPED_CATEGORY = "Restaurants"
RESTAURANT_MARKER = "restaurant"
CATEGORY_SEPARATOR = ", "
