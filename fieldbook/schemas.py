"""Column lists and the fixed vocabulary shared by all operators."""

from __future__ import annotations

# ---- fixed values -----------------------------------------------------------------------------
# These have to equal the published conventions for results to be comparable.

SEX_LABELS = {1: "Male", 2: "Female"}
RES_LABELS = {1: "Resident", 0: "Nonresident"}

# lower bounds of the seven age categories; the last one is open-ended
AGE_BREAKS = (0, 18, 25, 35, 45, 55, 65)

# upper age of each census age group (census table B01001), in order; the last one is open-ended
ACS_AGE_UPPER = (4, 9, 14, 17, 19, 20, 21, 24, 29, 34, 39, 44, 49, 54, 59, 61, 64, 66, 69, 74, 79, 84, 100)

SEGMENTS = ("tot", "res", "sex", "agecat", "county")
SEGMENT_LABELS = {
    "tot": "All",
    "res": "Residency",
    "sex": "Gender",
    "agecat": "Age",
    "county": "County",
    "month": "month",
}

R3_LABELS = ("Recruit", "Renew", "Reactivate")
R3_BLIND_YEARS = 5

LIC_TYPES = ("fish", "hunt", "combo", "trap", "other")
DURATIONS = (1, 99)
FIRST_SALE_YEAR = 2000
FIRST_BIRTH_YEAR = 1870
SALE_MONTHS = (0, 15)

# percent thresholds for year-over-year change, and for the share of unknown categories
YEAR_CHANGE_PARTICIPANTS = {"tot": 20, "res": 35, "sex": 35, "agecat": 35, "county": 70}
YEAR_CHANGE_RECRUITS = {"tot": 30, "res": 45, "sex": 45, "agecat": 45, "county": 150}
SCALEUP_PERCENT = 25

CUST_COLUMNS = ("cust_id", "sex", "birth_year", "county_fips")
CUST_STANDARD_COLUMNS = (
    "cust_id", "sex", "dob", "last", "first", "state", "cust_res", "cust_period", "raw_cust_id",
)
SALE_COLUMNS = ("cust_id", "lic_id", "year", "month")
SALE_STANDARD_COLUMNS = (
    "cust_id", "lic_id", "year", "dot", "start_date", "end_date", "sale_period", "raw_sale_id",
)
LICENSE_SALE_COLUMNS = ("cust_id", "lic_id", "year", "res", "month")

# months that a partial-year run cannot have sales in yet, by quarter: never filled with zero
UNREACHED_MONTHS = {2: tuple(range(7, 16))}

RATE_THRESHOLD = 0.5


def age_labels(breaks=AGE_BREAKS) -> list[str]:
    """Category labels such as ``18-24`` and ``65+`` for ascending lower bounds."""
    closed = [f"{lo}-{hi - 1}" for lo, hi in zip(breaks, breaks[1:])]
    return closed + [f"{breaks[-1]}+"]


def acs_age_label(age: int) -> str:
    """Census age-group label holding one year of age."""
    lower = 0
    for upper in ACS_AGE_UPPER:
        if age <= upper:
            break
        lower = upper + 1
    if lower == 0:
        return "Under 5 years"
    if upper == ACS_AGE_UPPER[-1]:
        return f"{lower} years and over"
    if upper == lower:
        return f"{lower} years"
    joiner = "and" if upper == lower + 1 else "to"
    return f"{lower} {joiner} {upper} years"
