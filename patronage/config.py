"""Business constants and rule tables.

Everything here is data, not logic: the operators in ``functions/rules.py``
compile these tables into native Spark column expressions.
"""

from __future__ import annotations


# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source system's constants for results
# to match. Keep them verbatim and in this order.
# ---------------------------------------------------------------------------

# Non-merchandise stock codes (exact match, case-sensitive).
NON_MERCH_CODES = (
    "POST", "DOT", "M", "C2", "D", "BANK CHARGES",
    "PADS", "AMAZONFEE", "CRUK", "S", "B", "DCGSSGIRL", "DCGSSBOY",
)
# Non-merchandise stock-code prefixes (case-sensitive).
NON_MERCH_PREFIXES = ("gift_", "DCGS")
# An invoice number starting with this marker is a cancellation.
CANCEL_PREFIX = "C"

# Product category rules: (category, regex) — first match wins, tested on the
# upper-cased, trimmed description.
CATEGORY_RULES = (
    ("Christmas & Seasonal", r"CHRISTMAS|XMAS|ADVENT|EASTER|HALLOWEEN|WINTER WONDERLAND"),
    ("Bags & Accessories", r"\bBAG\b|PURSE|WALLET|JEWELLERY|NECKLACE|BRACELET|UMBRELLA|\bHANDBAG"),
    ("Kitchen & Dining", r"MUG|\bCUP\b|PLATE|BOWL|JAM\b|CAKE|BAKING|KITCHEN|TEA TOWEL|\bSPOON\b|JAR|KETTLE|SAUCER|\bJUG\b|\bTEACUP\b|TEAPOT|SUGAR|BISCUIT TIN|BUTTER DISH"),
    ("Home Decor", r"\bLIGHT\b|CANDLE|HOLDER|DECORATION|FRAME|MIRROR|CLOCK|LANTERN|\bSIGN\b|DOORMAT|CUSHION|BLANKET|WALLPAPER|BUNTING|WREATH"),
    ("Stationery & Gifts", r"\bCARD\b|NOTEBOOK|\bPEN\b|\bGIFT\b|WRAP|PAPER|STICKER|\bPENCIL\b|CALENDAR|DIARY|BOOKMARK|PENCIL CASE"),
    ("Toys & Games", r"\bTOY\b|GAME|PUZZLE|\bDOLL\b|RATTLE|BALL\b|SPINNING"),
    ("Garden & Outdoor", r"GARDEN|PLANT POT|OUTDOOR|WATERING|BIRD FEEDER|PLANTER"),
    ("Bath & Body", r"\bSOAP\b|\bBATH\b|\bTOWEL\b|SPONGE|LOOFAH"),
)
# Fallback category (the label that exists in the margin table).
FALLBACK_CATEGORY = "Other / Miscellaneous"

# Finance-provided blended gross margin per category: (category, margin, note).
CATEGORY_MARGINS = (
    ("Christmas & Seasonal", "0.6000", "Higher seasonal premium"),
    ("Bags & Accessories", "0.5500", "Fashion accessories blended rate"),
    ("Kitchen & Dining", "0.5000", "Standard homeware rate"),
    ("Home Decor", "0.5500", "Decorative items blended rate"),
    ("Stationery & Gifts", "0.5200", "Gift/paper products rate"),
    ("Toys & Games", "0.4800", "Competitive category, lower margin"),
    ("Garden & Outdoor", "0.4500", "Volume-driven, lower margin"),
    ("Bath & Body", "0.5000", "Standard health/beauty rate"),
    ("Other / Miscellaneous", "0.4800", "Conservative blended default"),
)
DEFAULT_MARGIN = "0.48"

DAYS_PER_MONTH = 30.5
RFM_TILES = 5
CLV_TILES = 3

# Campaign matrix: (rfm_segment, campaign name, cost per customer, uplift).
CAMPAIGN_MATRIX = (
    ("Champions", "VIP Early Access", 15, 0.20),
    ("Loyal Customers", "Loyalty Rewards Upsell", 10, 0.15),
    ("New Customers", "Onboarding Series", 8, 0.25),
    ("Potential Loyalists", "Membership Offer", 12, 0.18),
    ("Promising", "Cross-Sell Campaign", 9, 0.12),
    ("Need Attention", "Personalized Re-Engagement", 11, 0.10),
    ("At Risk", "Win-Back Discount", 14, 0.08),
    ("Cannot Lose Them", "Priority Win-Back", 18, 0.12),
    ("Lost", "Re-Activation Email", 5, 0.03),
    ("Hibernating", "General Newsletter", 3, 0.02),
)
CAMPAIGN_FALLBACK = ("General Newsletter", 3, 0.02)
BLANKET_COST_PER_CUSTOMER = 12

# SQL-side campaign preview (segment -> campaign); differs from the matrix for
# 'Cannot Lose Them'. Unlisted segments fall back to 'General Newsletter'.
PREVIEW_CAMPAIGNS = (
    ("Champions", "VIP Early Access"),
    ("Loyal Customers", "Loyalty Rewards Upsell"),
    ("Potential Loyalists", "Membership Offer"),
    ("At Risk", "Win-Back Discount"),
    ("Cannot Lose Them", "Personalized Re-Engagement"),
    ("Need Attention", "Personalized Re-Engagement"),
    ("Lost", "Re-Activation Email"),
    ("New Customers", "Onboarding Series"),
    ("Promising", "Cross-Sell Campaign"),
    ("Hibernating", "General Newsletter"),
)
PREVIEW_FALLBACK = "General Newsletter"
# clv_segment -> priority tier (SQL preview); anything else -> 3.
PRIORITY_TIERS = (("High", 1), ("Medium", 2))
PRIORITY_FALLBACK = 3

# ROI band thresholds: roi_pct >= 200 green, >= 100 amber, else red.
ROI_BANDS = ((200, "green"), (100, "amber"))
ROI_BAND_FALLBACK = "red"

# RFM segment rules, first match wins. Each rule: (segment, condition) where a
# condition maps score name -> (low, high) inclusive bounds, or a tuple of such
# maps meaning "any of". Scores are 1..5.
SQL_SEGMENT_RULES = (
    ("Champions", {"r": (4, 5), "f": (4, 5), "m": (4, 5)}),
    ("Loyal Customers", {"r": (3, 5), "f": (4, 5), "m": (3, 5)}),
    ("New Customers", {"r": (4, 5), "f": (1, 2), "m": (1, 2)}),
    ("Potential Loyalists", {"r": (3, 5), "f": (2, 5), "m": (3, 5)}),
    ("Promising", {"r": (3, 5), "f": (3, 5)}),
    ("Need Attention", {"r": (2, 2), "f": (2, 5), "m": (2, 5)}),
    ("At Risk", ({"r": (2, 2), "f": (1, 2)}, {"r": (2, 2), "m": (1, 2)})),
    ("Cannot Lose Them", {"r": (1, 1), "f": (3, 5), "m": (3, 5)}),
    ("Lost", {"r": (1, 1)}),
)
NOTEBOOK_SEGMENT_RULES = (
    ("Champions", {"r": (4, 5), "f": (4, 5), "m": (4, 5)}),
    ("Loyal Customers", {"r": (3, 5), "f": (3, 5), "m": (3, 5)}),
    ("New Customers", {"r": (4, 5), "f": (1, 2)}),
    ("Potential Loyalists", {"r": (3, 5), "f": (2, 5), "m": (1, 3)}),
    ("Promising", {"r": (4, 5), "f": (2, 5), "m": (3, 5)}),
    ("Need Attention", {"r": (3, 3), "f": (1, 3)}),
    ("At Risk", {"r": (1, 2), "f": (4, 5)}),
    ("Cannot Lose Them", {"r": (1, 2), "f": (2, 5), "m": (3, 5)}),
    ("Lost", {"r": (1, 2), "f": (1, 2), "m": (1, 2)}),
)
SEGMENT_FALLBACK = "Hibernating"

# Chart orderings used by the reindexed summaries.
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
TIER_ORDER = ("High", "Medium", "Low")

# ---------------------------------------------------------------------------
# Test-data adapter constants (driver TPC-H-style tables -> retail tables).
# The production category rules match almost nothing in the generated part
# names, so the adapter categorises with this rule table instead.
# ---------------------------------------------------------------------------
ADAPTER_CATEGORY_RULES = (
    ("Christmas & Seasonal", r"\bRED\b"),
    ("Bags & Accessories", r"RING"),
    ("Kitchen & Dining", r"PLATE"),
    ("Toys & Games", r"WIDGET|GIZMO"),
    ("Garden & Outdoor", r"ANVIL|ROD"),
)
ADAPTER_STATUS = (("F", "Completed"), ("O", "Open"), ("P", "Pending"))
