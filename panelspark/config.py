"""Assumptions, account ranges and column names."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Assumptions:
    """Rates behind the revenue-requirement models (fixed values as defaults)."""

    depreciation_rate: float = 0.035
    wacc: float = 0.075
    tax_rate: float = 0.27
    grc_tax_rate: float = 0.15
    ag_allocation: float = 0.70
    om_escalation: float = 0.03
    rate_base_growth: float = 0.04
    avg_monthly_kwh: float = 500.0

    def __post_init__(self) -> None:
        if self.tax_rate >= 1.0:
            raise ValueError(f"tax_rate must be below 1 for the gross-up, got {self.tax_rate}")


DEFAULTS = Assumptions()

# Functional category -> inclusive account range.
CATEGORY_RANGES = {
    "production": (500, 557),
    "transmission": (560, 574),
    "distribution": (580, 598),
    "customer_service": (901, 910),
    "admin_general": (920, 935),
}
OTHER_CATEGORY = "other"
CATEGORIES = [*CATEGORY_RANGES, OTHER_CATEGORY]
OM_COLUMNS = [f"om_{c}" for c in CATEGORIES]

# Workbook header -> column name. Repeated headers carry .1, .2, ...
SALES_HEADERS = {
    "Data Year": "report_year",
    "Utility Number": "utility_id_eia",
    "Utility Name": "utility_name",
    "State": "state",
    "Ownership": "ownership",
    "Thousand Dollars": "revenue_residential_k",
    "Megawatthours": "sales_mwh_residential",
    "Count": "customers_residential",
    "Thousand Dollars.1": "revenue_commercial_k",
    "Megawatthours.1": "sales_mwh_commercial",
    "Count.1": "customers_commercial",
    "Thousand Dollars.2": "revenue_industrial_k",
    "Megawatthours.2": "sales_mwh_industrial",
    "Count.2": "customers_industrial",
    "Thousand Dollars.4": "revenue_total_k",
    "Megawatthours.4": "sales_mwh_total",
    "Count.4": "customers_total",
}

# Row selectors in the accounting tables.
REPORTED = "reported_value"
CALCULATED = "calculated_value"
ELECTRIC = "electric"
REVENUE_ACCOUNT = "400"
PLANT_IN_SERVICE = "utility_plant_in_service_classified_and_unclassified"
ACCUMULATED_DEPRECIATION = (
    "accumulated_provision_for_depreciation_amortization_and_depletion_of_plant_utility"
)
TARGET_STATE = "CA"

# Name, id in the accounting tables, id in the sales tables.
UTILITY_IDS = [
    ("PG&E", 183, 14328),
    ("SCE", 155, 17609),
    ("SDG&E", 218, 16609),
]
YEARS = [2018, 2019, 2020, 2021, 2022, 2023]

WHOLE_CENTS = 100  # for callers whose amounts are whole cents: exact sums in any order

SECTORS = ["residential", "commercial", "industrial"]
COST_DRIVERS = ["customers_total", "sales_mwh_total", "rate_base"]
SUMMARY_METRICS = ["om_total", "om_per_customer", "om_per_mwh", "rate_base"]

# Scenario name, O&M escalation, rate base growth, WACC. The first is the base.
BILL_SCENARIOS = [
    ("Base Case", 0.03, 0.04, 0.075),
    ("High O&M Escalation", 0.05, 0.04, 0.075),
    ("Low O&M Escalation", 0.01, 0.04, 0.075),
    ("High Rate Base Growth", 0.03, 0.06, 0.075),
    ("Low Rate Base Growth", 0.03, 0.02, 0.075),
    ("High WACC", 0.03, 0.04, 0.085),
    ("Low WACC", 0.03, 0.04, 0.065),
]
# WACC and A&G allocation steps of the sensitivities.
WACC_RANGE = [0.055, 0.065, 0.075, 0.085, 0.095]
AG_ALLOCATIONS = [0.41, 0.50, 0.60, 0.70]
