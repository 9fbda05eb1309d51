"""Declared schemas of the input tables and the panel's column order."""

from pyspark.sql import types as T

from panelspark.config import OM_COLUMNS, SECTORS


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_LONG, _INT, _STR, _DBL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

EXPENSES = _struct(
    ("utility_id_ferc1", _LONG),
    ("report_year", _INT),
    ("ferc_account", _STR),
    ("dollar_value", _DBL),
    ("row_type_xbrl", _STR),
)
PLANT = _struct(
    ("utility_id_ferc1", _LONG),
    ("report_year", _INT),
    ("utility_type", _STR),
    ("utility_plant_asset_type", _STR),
    ("row_type_xbrl", _STR),
    ("ending_balance", _DBL),
)
INCOME = _struct(
    ("utility_id_ferc1", _LONG),
    ("report_year", _INT),
    ("utility_type", _STR),
    ("ferc_account", _STR),
    ("income_type", _STR),
    ("dollar_value", _DBL),
)
ID_MAP = _struct(
    ("utility_id_ferc1", _LONG),
    ("utility_id_eia", _LONG),
    ("utility_name", _STR),
)

_SECTORS_AND_TOTAL = [*SECTORS, "total"]
REVENUE_COLUMNS = [f"revenue_{s}_k" for s in _SECTORS_AND_TOTAL]
SALES_COLUMNS = [f"sales_mwh_{s}" for s in _SECTORS_AND_TOTAL]
CUSTOMER_COLUMNS = [f"customers_{s}" for s in _SECTORS_AND_TOTAL]

# One landed sales row. `row_ordinal` is the position in the landed files; "first value"
# roll-ups need it because Spark rows have no order of their own.
SALES = _struct(
    ("report_year", _INT),
    ("utility_id_eia", _LONG),
    ("utility_name", _STR),
    ("state", _STR),
    ("ownership", _STR),
    *[
        (name, dtype)
        for s in _SECTORS_AND_TOTAL
        for name, dtype in [
            (f"revenue_{s}_k", _DBL),
            (f"sales_mwh_{s}", _DBL),
            (f"customers_{s}", _LONG),
        ]
    ],
    ("row_ordinal", _LONG),
)

PANEL_COLUMNS = [
    "utility_id_ferc1",
    "utility_id_eia",
    "utility_name",
    "report_year",
    *OM_COLUMNS,
    "om_total",
    "grc_om",
    "rate_base",
    "operating_revenues_ferc",
    *SALES_COLUMNS,
    *CUSTOMER_COLUMNS,
    *REVENUE_COLUMNS,
    "om_per_customer",
    "grc_om_per_customer",
    "om_per_mwh",
    "rate_base_per_customer",
    "revenue_per_customer",
]
