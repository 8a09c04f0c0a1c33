"""Names and codes of the input files and output tables.

They have to be exactly these for the feeds to be read and the tables to be
found by their users.
"""

from __future__ import annotations

#: Sales below this amount are transfers, not market prices.
PRICE_FLOOR = 2000

#: The code written where no zip code is known.
ZERO_ZIP = "00000"

# Assessor roll, CSV headers.
ASSESSOR_ZIP = "PREMISE ADDRESS: Zip Code (MDP Field: PREMZIP. SDAT Field #26)"
ASSESSOR_DATE_1 = "SALES SEGMENT 1: Transfer Date (YYYY.MM.DD) (MDP Field: TRADATE. SDAT Field #89)"
ASSESSOR_PRICE_1 = "SALES SEGMENT 1: Consideration (MDP Field: CONSIDR1. SDAT Field #90)"
ASSESSOR_DATE_2 = "SALES SEGMENT 2: Transfer Date (YYYY.MM.DD) (SDAT Field #109)"
ASSESSOR_PRICE_2 = "SALES SEGMENT 2: Consideration (SDAT Field #110)"
ASSESSOR_DATE_3 = "SALES SEGMENT 3: Transfer Date (YYYY.MM.DD) (SDAT Field #129)"
ASSESSOR_PRICE_3 = "SALES SEGMENT 3: Consideration (SDAT Field #130)"
ASSESSOR_SQUARE_FEET = "C.A.M.A. SYSTEM DATA: Structure Area (Sq.Ft.) (MDP Field: SQFTSTRC. SDAT Field #241)"
ASSESSOR_STYLE = "ADDITIONAL C.A.M.A. Data: Building Style Code and Description (MDP Field: STRUSTYL/DESCSTYL. SDAT Field #264)"
ASSESSOR_DWELLING = "ADDITIONAL C.A.M.A. Data: Dwelling Type (MDP Field: STRUBLDG. SDAT Field #265)"

# Assessor roll, structure types that count as housing.
HOUSING_STYLES = ["STRY", "HOUSING", "OTHER"]
HOUSING_DWELLINGS = ["DWEL", "HOUSING", "STRY", "OTHER"]

# Sales ledger, building class codes per market segment.
ALL_HOMES_CODES = ["01", "02", "03", "04", "07", "08", "09", "10", "12", "13", "14", "15", "23", "28"]
CONDO_CODES = ["04", "12", "13", "15", "28"]
SINGLE_FAMILY_CODES = ["01"]

# Segment and measure names; joined with the source tag they give the table name.
ALL_HOMES = "allHomes"
CONDOS = "condos"
SINGLE_FAMILY = "sfHomes"
TOTAL = "price"
PER_SQUARE_FOOT = "price_sf"
TABLE_SUFFIX = {TOTAL: "", PER_SQUARE_FOOT: "BySF"}

# Source tags.
ASSESSOR = "MD"
PROVIDER = "QZ"
LISTING = "RDC"
LEDGER = "NYC"

# Provider metric code -> (segment, measure).
PROVIDER_METRICS = {
    "MSPAH": (ALL_HOMES, TOTAL),
    "MSPFCO": (CONDOS, PER_SQUARE_FOOT),
    "MSPFAH": (ALL_HOMES, PER_SQUARE_FOOT),
    "MSPFSF": (SINGLE_FAMILY, PER_SQUARE_FOOT),
}
