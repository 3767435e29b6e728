"""Parameters of every step, with the default business rules."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# Stock codes that are charges rather than products.
NON_PRODUCT_CODES = (
    "POST", "DOT", "BANK", "PADS", "M", "S", "ADJUST", "AMAZFIT", "gift",
)

# Category keywords; the first category with a hit wins.
CATEGORY_KEYWORDS = {
    "home_decor": ("HOME", "DECOR", "FRAME", "SIGN", "WALL", "MIRROR", "CANDLE", "LAMP"),
    "kitchen": ("MUG", "CUP", "PLATE", "BOWL", "KITCHEN", "COOK", "CAKE", "BAKING"),
    "garden": ("GARDEN", "PLANT", "FLOWER", "SEED", "OUTDOOR"),
    "gifts": ("GIFT", "WRAP", "BOX", "BAG", "BIRTHDAY", "CHRISTM", "XMAS", "PARTY"),
    "stationery": ("PAPER", "CARD", "BOOK", "PEN", "PENCIL", "NOTE", "DIARY"),
    "toys": ("TOY", "GAME", "DOLL", "PLAY", "PUZZLE", "KIDS"),
    "fashion": ("SCARF", "HAT", "BAG", "PURSE", "JEWEL", "NECKLACE", "BRACELET"),
    "storage": ("BOX", "TIN", "BASKET", "STORAGE", "RACK", "SHELF", "ORGANIS"),
    "services": ("POST", "DOT", "BANK", "PADS", "ADJUST", "M", "S", "AMAZFIT"),
}

# Two-digit stock-code prefixes below each limit fall in that category.
CATEGORY_CODE_LIMITS = ((22, "home_decor"), (50, "gifts"), (75, "kitchen"))
CATEGORY_CODE_REST = "storage"
CATEGORY_UNKNOWN = "miscellaneous"

# Default holiday dates (2009-2011).
DEFAULT_HOLIDAYS = (
    "2009-01-01", "2009-04-10", "2009-04-13", "2009-05-04",
    "2009-05-25", "2009-08-31", "2009-12-25", "2009-12-28",
    "2010-01-01", "2010-04-02", "2010-04-05", "2010-05-03",
    "2010-05-31", "2010-08-30", "2010-12-27", "2010-12-28",
    "2011-01-03", "2011-04-22", "2011-04-25", "2011-04-29",
    "2011-05-02", "2011-05-30", "2011-08-29", "2011-12-26", "2011-12-27",
)

RISK_LEVELS = (
    "Critical Stockout Risk", "High Stockout Risk", "Moderate Stockout Risk",
    "Overstock Risk", "Mild Overstock Risk", "Volatile Demand", "Healthy",
)

ACTION_REORDER = "🚨 Reorder Immediately"
ACTION_INCREASE = "📦 Increase Purchase"
ACTION_MONITOR = "📊 Monitor Closely"
ACTION_CLEARANCE = "🏷 Clearance Sale"
ACTION_BUNDLE = "🔗 Bundle Offer"
ACTION_MARKDOWN = "📉 Markdown Promotion"
ACTION_REDUCE = "📉 Reduce Purchase"
ACTION_NONE = "✅ Healthy – No Action"

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

# Header spellings accepted for each raw column, in order of preference.
HEADER_SPELLINGS = {
    "InvoiceNo": ("InvoiceNo", "Invoice", "invoice", "invoice_no"),
    "StockCode": ("StockCode", "stock_code", "stockcode", "SKU"),
    "Description": ("Description", "description", "desc", "product_name"),
    "Quantity": ("Quantity", "quantity", "qty", "Qty"),
    "InvoiceDate": ("InvoiceDate", "invoice_date", "date", "Date"),
    "UnitPrice": ("UnitPrice", "Price", "price", "unit_price"),
    "CustomerID": ("CustomerID", "Customer ID", "customer_id", "cust_id"),
    "Country": ("Country", "country"),
}
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class CleaningRules:
    country: str | None = "United Kingdom"
    excluded_codes: tuple[str, ...] = NON_PRODUCT_CODES
    cancel_prefix: str = "C"
    timestamp_formats: tuple[str, ...] = (
        "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy",
        "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
        "yyyy-MM-dd'T'HH:mm:ss",
    )


@dataclass(frozen=True)
class PromotionRule:
    earlier_sale_days: int = 30
    min_sale_days: int = 5
    price_ratio: float = 0.85


@dataclass(frozen=True)
class AbcRule:
    a_share: float = 0.80
    b_share: float = 0.95


@dataclass(frozen=True)
class StockPolicy:
    default_lead_days: int = 7
    default_price: float = 1.0
    lead_cover: float = 1.5
    min_cover_days: float = 2.0
    order_cost: float = 50.0
    holding_rate: float = 0.20
    min_holding_cost: float = 0.01
    min_order: float = 12.0
    opening_cover_days: float = 84.0
    no_demand_cover: float = 999.0


@dataclass(frozen=True)
class FeatureRules:
    quantity_lags: tuple[int, ...] = (1, 7, 14, 21, 28, 35)
    revenue_lags: tuple[int, ...] = (7, 14, 28)
    quantity_windows: tuple[int, ...] = (7, 14, 28, 56)
    revenue_windows: tuple[int, ...] = (7, 28)
    # (span, observations needed before a value is given)
    quantity_ewma: tuple[tuple[int, int], ...] = ((7, 3), (28, 7))
    slope_days: int = 14
    new_product_days: int = 30
    mature_product_days: int = 180


@dataclass(frozen=True)
class ForecastRules:
    horizon: int = 28
    folds: int = 1
    min_train_days: int = 90
    history_days: int = 120
    min_history_rows: int = 60
    seed: int = 42
    checkpoint_every: int = 7
    # None means the published 84-feature list.
    features: tuple[str, ...] | None = None
    models: tuple[str, ...] = ("RandomForest", "GradientBoosting", "DeepBoosting", "SampledBoosting")


@dataclass(frozen=True)
class RiskRules:
    critical_days: float = 7.0
    high_days: float = 14.0
    watch_days: float = 30.0
    balanced_days: float = 60.0
    overstock_days: float = 90.0
    dead_days: float = 365.0
    volatile_cv: float = 1.5
    stockout_weight: float = 0.60
    overstock_weight: float = 0.40
    penalty: float = 2.0
    holding_rate: float = 0.20
    stockout_cost_factor: float = 1.5
    reducible_share: float = 0.70
    recovery_share: float = 0.85
    forecast_days: int = 28
    default_lead_days: int = StockPolicy.default_lead_days
    default_price: float = StockPolicy.default_price
    default_momentum: float = 1.0
    default_class: str = "C"
    # Stockout score: where each band of cover starts, and what it loses over the band.
    empty_score: float = 100.0
    lead_score: float = 90.0
    lead_drop: float = 40.0
    critical_score: float = 70.0
    critical_drop: float = 30.0
    high_score: float = 40.0
    high_drop: float = 20.0
    watch_score: float = 20.0
    watch_drop: float = 15.0
    covered_score: float = 5.0
    cv_points: float = 10.0
    cv_most: float = 20.0
    # Overstock score: where each band starts, and what it gains over the band.
    dead_score: float = 90.0
    over_score: float = 60.0
    over_rise: float = 30.0
    balanced_score: float = 30.0
    balanced_rise: float = 30.0
    covered_rise: float = 15.0
    # Least scores of the levels.
    critical_level: float = 75.0
    high_level: float = 50.0
    moderate_level: float = 30.0
    overstock_level: float = 70.0
    mild_overstock_level: float = 40.0
    # What the actions look at.
    rising_momentum: float = 1.2
    bundle_days: float = 180.0
    abc_weights: dict[str, float] = field(
        default_factory=lambda: {"A": 3.0, "B": 2.0, "C": 1.0}
    )
