"""Dates, thresholds, lookup tables and wordings that results depend on."""

from __future__ import annotations

from datetime import datetime

# Churn window, snapshot calendar and split of each snapshot.
CHURN_DAYS = 180
MAX_VALID_DATE = datetime(2018, 8, 31)
SNAPSHOTS = {
    datetime(2017, 7, 1): "train",
    datetime(2017, 8, 1): "train",
    datetime(2017, 9, 1): "train",
    datetime(2017, 10, 1): "train",
    datetime(2017, 11, 1): "train",
    datetime(2017, 12, 1): "train",
    datetime(2018, 1, 1): "validation",
    datetime(2018, 2, 1): "validation",
    datetime(2018, 3, 1): "test",
}

# Thresholds.
LATE_DELIVERY_DAYS = 46
COVERAGE_WINDOWS = [90, 120, 180, 270]
EVENT_HORIZON_DAYS = 730
LAPSED_DAYS = 150

# Categories without a translation that have an agreed English name.
CATEGORY_OVERRIDES = {
    "pc_gamer": "pc_gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": "kitchen_appliances_food_prep",
}

# Unit costs.
CHANNEL_COST = {"email": 0.05, "sms": 0.08, "push": 0.02}
INTERVENTION_COST = {
    "discount_offer": 25.0,
    "personal_outreach": 12.0,
    "free_shipping": 15.0,
    "loyalty_points": 8.0,
}

# Customer tiers by revenue percentile, and the segment of each tier.
TIER_FLOORS = {"platinum": 0.99, "gold": 0.90, "silver": 0.60, "bronze": 0.0}
TIER_SEGMENT = {
    "platinum": "high_value",
    "gold": "high_value",
    "silver": "standard",
    "bronze": "low_value",
}

# Risk tiers.
RISK_EDGES = [0.0, 0.5, 0.8, 1.0]
RISK_LABELS = ["low", "medium", "high"]

# Scenario presets and the budget multiples of the marginal curve.
RETENTION_EFFECTS = {"conservative": 0.10, "moderate": 0.20, "optimistic": 0.35}
BUDGET_MULTIPLES = [0.5, 0.75, 1.0, 1.25, 1.5, 2.0]

# Caveats that travel with every monetary figure.
MODEL_CAVEAT = (
    "Estimated based on a model with limited predictive power "
    "(ROC-AUC ~0.55-0.65) - treat as a rough prioritization signal "
    "for where to focus retention effort, not a precise forecast."
)
EFFECT_CAVEAT = (
    "retention_effect_pct is a user-supplied assumption, not derived "
    "from this project's data or any external benchmark -- treat ROI "
    "figures as directional, not promised outcomes."
)

# Model inputs.
NUMERIC_FEATURES = [
    "days_since_last_purchase",
    "orders_last_30_days",
    "orders_last_90_days",
    "orders_last_180_days",
    "lifetime_orders",
    "lifetime_revenue",
    "purchase_frequency",
    "purchase_gap_mean",
    "purchase_gap_std",
    "average_delivery_delay",
    "late_delivery_rate",
    "average_delivery_days",
    "average_review_score",
    "negative_review_rate",
    "installment_frequency",
    "payment_value",
    "recent_90d_revenue",
    "previous_90d_revenue",
    "purchase_frequency_trend_90d",
    "review_trend_90d",
    "recent_delivery_delay",
    "unique_categories",
    "category_concentration",
    "unique_sellers",
    "seller_concentration",
    "n_support_tickets",
    "n_tickets_last_90_days",
    "pct_tickets_resolved",
    "pct_tickets_escalated",
    "avg_resolution_hours",
    "avg_ticket_satisfaction",
    "n_campaigns_received",
    "pct_campaigns_opened",
    "pct_campaigns_clicked",
    "pct_campaigns_converted",
    "days_since_last_campaign",
    "has_been_targeted_for_retention",
]
CATEGORICAL_FEATURES = ["preferred_payment_method", "customer_state"]
INDICATORS = {
    "has_repeat_purchase": ["purchase_gap_mean", "purchase_gap_std"],
    "has_review": ["average_review_score", "negative_review_rate"],
    "has_delivered_order": [
        "average_delivery_delay",
        "late_delivery_rate",
        "average_delivery_days",
    ],
    "has_recent_delivered_order": ["recent_delivery_delay"],
    "has_support_history": [
        "pct_tickets_resolved",
        "pct_tickets_escalated",
        "avg_resolution_hours",
        "avg_ticket_satisfaction",
    ],
    "has_campaign_history": [
        "pct_campaigns_opened",
        "pct_campaigns_clicked",
        "pct_campaigns_converted",
        "days_since_last_campaign",
    ],
}
# Feature-table columns that repeat another one.
DUPLICATED_FEATURES = {
    "days_since_previous_order": "days_since_last_purchase",
    "recent_90d_order_count": "orders_last_90_days",
    "revenue_last_90_days": "recent_90d_revenue",
    "lifetime_purchase_frequency": "purchase_frequency",
    "historical_delivery_delay": "average_delivery_delay",
}
# Equal to one another for customers with a single order.
COLLINEAR_FEATURES = {
    "average_order_value": "lifetime_revenue",
    "max_order_value": "lifetime_revenue",
}

# Model settings.
TREE_SETTINGS = {
    "max_depth": 3,
    "step_size": 0.03,
    "subsample": 0.8,
    "features": 0.8,
    "l1": 0.5,
    "l2": 2.0,
    "min_child_weight": 10,
    "rounds": 1000,
    "patience": 30,
}

# Left out of customer-facing explanations only.
SUPPRESSED_FACTORS = ["has_been_targeted_for_retention"]

# Reader-facing feature names.
FEATURE_LABELS = {
    "days_since_last_purchase": "Days since their last purchase",
    "orders_last_30_days": "Orders placed in the last 30 days",
    "orders_last_90_days": "Orders placed in the last 90 days",
    "orders_last_180_days": "Orders placed in the last 180 days",
    "lifetime_orders": "Total number of purchases ever made",
    "lifetime_revenue": "Total amount spent, lifetime",
    "average_order_value": "Average amount spent per order",
    "max_order_value": "Largest single order value",
    "purchase_frequency": "How often they typically purchase",
    "purchase_gap_mean": "Average days between their purchases",
    "purchase_gap_std": "How consistent their purchase timing is",
    "average_delivery_delay": "Average delivery delay vs. the promised date",
    "late_delivery_rate": "Share of their orders that arrived late",
    "average_delivery_days": "Average time from order to delivery",
    "average_review_score": "Average rating they've given (1-5 stars)",
    "negative_review_rate": "Share of their reviews that were negative",
    "installment_frequency": "Average number of payment installments used",
    "payment_value": "Total amount paid across all orders",
    "recent_90d_revenue": "Amount spent in the last 90 days",
    "previous_90d_revenue": "Amount spent in the 90 days before that",
    "purchase_frequency_trend_90d": "Change in how often they buy (recent vs. prior)",
    "review_trend_90d": "Change in their review scores (recent vs. earlier)",
    "recent_delivery_delay": "Average delivery delay in the last 90 days",
    "unique_categories": "Number of different product categories bought",
    "category_concentration": "How focused their purchases are on one category",
    "unique_sellers": "Number of different sellers bought from",
    "seller_concentration": "How focused their purchases are on one seller",
    "n_support_tickets": "Number of support tickets filed",
    "n_tickets_last_90_days": "Support tickets filed in the last 90 days",
    "pct_tickets_resolved": "Share of their support tickets that got resolved",
    "pct_tickets_escalated": "Share of their support tickets that got escalated",
    "avg_resolution_hours": "Average time to resolve their support tickets",
    "avg_ticket_satisfaction": "Average satisfaction rating on their support tickets",
    "n_campaigns_received": "Number of marketing messages received",
    "pct_campaigns_opened": "Share of marketing messages they opened",
    "pct_campaigns_clicked": "Share of marketing messages they clicked",
    "pct_campaigns_converted": "Share of marketing messages that led to a purchase",
    "days_since_last_campaign": "Days since their last marketing message",
    "has_been_targeted_for_retention": "Has previously received a retention offer",
    "has_repeat_purchase": "Has purchased more than once",
    "has_review": "Has left at least one review",
    "has_delivered_order": "Has had at least one order delivered",
    "has_recent_delivered_order": "Had a delivery in the last 90 days",
    "has_support_history": "Has contacted support before",
    "has_campaign_history": "Has received marketing messages before",
}

#: orders of one person that lie no further apart are looked at as doubles
NEAR_SECONDS = 3600
NEAR_CENTS = 100
