"""Run parameters and fixed values.

Everything here is plain data: windows, experiment configuration, and the
value tables the enrichments draw from.  Functions receive these objects; no
module reads global state at execution time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Pinned audit/run timestamp used by catalog queries so that results are
# reproducible and comparable with the SQL oracle.  Library callers pass their
# own ``run_at`` (or None for current_timestamp()).
RUN_AT = "2024-02-01 00:00:00"
# "as of" instant for ticket dates, freshness and TTL rules in catalog queries.
AS_OF = "2024-01-31 00:00:00"


@dataclass(frozen=True)
class ExperimentWindow:
    """Baseline and experiment periods, inclusive date strings.

    ``inclusive_days=False`` reproduces the warehouse semantics where an end
    date compares as midnight (rest of the last day falls outside).
    """

    baseline_start: str = "1998-01-01"
    baseline_end: str = "1998-06-30"
    experiment_start: str = "1998-07-01"
    experiment_end: str = "1998-12-31"
    inclusive_days: bool = False


@dataclass(frozen=True)
class ExperimentConfig:
    """The two-arm overlay experiment.

    Arm names, the experiment name and the 1.2 effect buffer are fixed values
    of the source system; rates and traffic are parameters.
    """

    name: str = "free_shipping_threshold_test_v1_1_1"
    control_name: str = "current_threshold"
    treatment_name: str = "reduced_threshold"
    control_allocation: float = 0.5
    treatment_allocation: float = 0.5
    effect_size: float = 0.2
    effect_buffer: float = 1.2
    baseline_orders_per_user: float = 1.0
    daily_eligible_users: int = 4
    countries: tuple[str, ...] = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4",
                                  "NATION_5", "NATION_6", "NATION_7", "NATION_8", "NATION_9")
    seed: int = 42
    window: ExperimentWindow = field(default_factory=ExperimentWindow)

    @property
    def duration_days(self) -> int:
        from datetime import date

        s = date.fromisoformat(self.window.experiment_start)
        e = date.fromisoformat(self.window.experiment_end)
        return (e - s).days + 1

    @property
    def target_rate(self) -> float:
        return self.baseline_orders_per_user * (1 + self.effect_size * self.effect_buffer)

    @property
    def additional_orders_per_user(self) -> float:
        return self.target_rate - self.baseline_orders_per_user

    @property
    def cohort_cap(self) -> int:
        return (self.daily_eligible_users * self.duration_days) // 2


# ---------------------------------------------------------------------------
# Fixed values of the source system (must equal it for equal results).
# ---------------------------------------------------------------------------

# Multi-experiment programme: name, arms, allocation, start, end, description, metric.
LEGACY_EXPERIMENTS = (
    ("checkout_button_color", ("blue_button", "green_button", "orange_button"), (0.33, 0.33, 0.34),
     "2023-01-15", "2023-12-31", "Testing checkout button color impact on conversion", "conversion_rate"),
    ("free_shipping_threshold", ("threshold_50", "threshold_75", "threshold_100"), (0.33, 0.33, 0.34),
     "2023-02-01", "2023-12-31", "Testing free shipping threshold on average order value", "average_order_value"),
    ("product_recommendations", ("collaborative_filtering", "content_based", "hybrid"), (0.33, 0.33, 0.34),
     "2023-03-01", "2023-12-31", "Testing recommendation algorithm effectiveness", "click_through_rate"),
    ("email_frequency", ("weekly", "biweekly", "monthly"), (0.33, 0.33, 0.34),
     "2023-04-01", "2023-12-31", "Testing email marketing frequency impact on engagement", "email_engagement_rate"),
)

# Logistics: warehouses (id, location, region), carriers, package base costs, carrier multipliers.
WAREHOUSES = (
    ("WH_NYC", "New York, NY", "Northeast"),
    ("WH_LAX", "Los Angeles, CA", "West"),
    ("WH_CHI", "Chicago, IL", "Midwest"),
    ("WH_DFW", "Dallas, TX", "South"),
    ("WH_ATL", "Atlanta, GA", "Southeast"),
)
CARRIERS = ("FedEx", "UPS", "USPS", "DHL", "Amazon Logistics")
PACKAGE_BASE_COST = (
    ("envelope", "4.99"),
    ("small_box", "8.99"),
    ("medium_box", "12.99"),
    ("large_box", "18.99"),
    ("oversized", "29.99"),
)
CARRIER_MULTIPLIER = (
    ("USPS", "0.8"),
    ("FedEx", "1.1"),
    ("UPS", "1.0"),
    ("DHL", "1.3"),
    ("Amazon Logistics", "0.9"),
)
DELIVERY_INSTRUCTIONS = (None, "Leave at door", "Ring doorbell", "Signature required")
TRACKING_PATTERN = "##??########"

# Support tickets.
TICKETS_PER_USER = ((1, 0.5), (2, 0.3), (3, 0.15), (4, 0.05))
ISSUE_CATEGORIES = (
    ("shipping_delay", 0.25), ("product_defect", 0.20), ("return_request", 0.18),
    ("billing_question", 0.15), ("account_issue", 0.12), ("general_inquiry", 0.10),
)
PRIORITIES = (("low", 0.50), ("medium", 0.35), ("high", 0.15))
PRIORITY_BY_CATEGORY = {
    "shipping_delay": (("medium", 0.6), ("high", 0.4)),
    "product_defect": (("medium", 0.5), ("high", 0.5)),
}
TICKET_STATUSES = (("resolved", 0.70), ("closed", 0.20), ("in_progress", 0.08), ("open", 0.02))
SATISFACTION_BY_STATUS = {
    "resolved": ((3, 0.2), (4, 0.5), (5, 0.3)),
    "closed": ((3, 0.2), (4, 0.5), (5, 0.3)),
    "in_progress": ((2, 0.3), (3, 0.5), (4, 0.2)),
    "open": ((1, 0.4), (2, 0.4), (3, 0.2)),
}
AGENTS = ("Sarah Johnson", "Mike Chen", "Lisa Rodriguez", "David Kim", "Emma Thompson", "Alex Martinez")
CHANNELS = (("email", 0.45), ("live_chat", 0.30), ("phone", 0.15), ("contact_form", 0.10))
RESOLUTION_BASE_HOURS = (
    ("shipping_delay", 12), ("product_defect", 24), ("return_request", 8),
    ("billing_question", 6), ("account_issue", 4), ("general_inquiry", 2),
)
RESOLUTION_PRIORITY_MULT = (("high", "0.5"), ("medium", "1.0"), ("low", "1.5"))
RESPONSE_BASE_MINUTES = (("live_chat", 5), ("phone", 2), ("email", 120), ("contact_form", 180))
RESPONSE_PRIORITY_MULT = (("high", "0.3"), ("medium", "1.0"), ("low", "2.0"))
TICKET_DESCRIPTIONS = {
    "shipping_delay": (
        "My order was supposed to arrive 3 days ago but tracking shows it's still in transit",
        "Package has been stuck at shipping facility for over a week",
        "Expected delivery date has passed, need update on my order status",
        "Tracking information hasn't updated in 5 days, is my package lost?",
    ),
    "product_defect": (
        "Received item with manufacturing defect, requesting replacement",
        "Product arrived damaged in packaging, multiple scratches visible",
        "Item doesn't match description on website, wrong specifications",
        "Quality issue with product, stopped working after 2 days of use",
    ),
    "return_request": (
        "Would like to return item, doesn't fit as expected",
        "Product not suitable for my needs, requesting return authorization",
        "Received wrong size, need to exchange for correct size",
        "Item doesn't meet expectations, would like full refund",
    ),
    "billing_question": (
        "Charged twice for the same order, need refund for duplicate charge",
        "Discount code didn't apply at checkout, can you adjust my bill?",
        "Subscription billing question, unexpected charge on my account",
        "Payment method was charged but order shows as pending",
    ),
    "account_issue": (
        "Cannot log into my account, password reset not working",
        "Account was suspended, need help reactivating",
        "Email preferences not saving, still receiving unwanted newsletters",
        "Unable to update shipping address in account settings",
    ),
    "general_inquiry": (
        "Question about product compatibility with other items",
        "When will this item be back in stock?",
        "Do you ship to my location? Need shipping information",
        "Looking for product recommendations for my specific needs",
    ),
}

# Transaction JSON fields cast to double / boolean by the flatten step; all
# other discovered keys stay strings.
DOUBLE_FIELDS = (
    "amount", "risk_score", "product_price", "payment_credit_limit", "first_payment_amount",
    "customer_tenure_days", "installment_count", "cart_abandonment_count", "checkout_speed",
    "economic_stress_factor", "price_comparison_time", "customer_address_stability",
)
BOOLEAN_FIELDS = ("will_default", "device_is_trusted", "product_bnpl_eligible")
REQUIRED_FIELDS = ("transaction_id", "customer_id", "_timestamp", "amount")

# Accepted values of the declarative checks.
ORDER_STATUSES = ("Complete", "Cancelled", "Processing", "Shipped", "Returned")
TXN_STATUSES = ("completed", "pending", "failed", "cancelled")
RISK_LEVELS = ("very_low", "low", "medium", "high", "very_high")
TIME_PERIODS = ("baseline_period", "experiment_period")

# Cache / monitoring.
CACHE_TTL_DAYS = 7
FRESHNESS_WINDOW_HOURS = 24
STALE_AFTER_HOURS = 2
QUEUE_ALERT_THRESHOLD = 10_000

# Date-range guard of the ingestion entry points.
MIN_INGEST_YEAR = 2020
MAX_DAILY_VOLUME = 50_000
