"""Declared schemas of the raw tables and the names of derived columns."""

from __future__ import annotations

# Column names and types of the raw campaign files.
CAMPAIGN_LABELS = "client_id string, treatment_flg tinyint, target tinyint"
CLIENTS = (
    "client_id string, first_issue_date timestamp_ntz, first_redeem_date timestamp_ntz,"
    " age int, gender string"
)
PURCHASES = (
    "client_id string, transaction_id string, transaction_datetime timestamp_ntz,"
    " regular_points_received double, express_points_received double,"
    " regular_points_spent double, express_points_spent double, purchase_sum double,"
    " store_id string, product_id string, product_quantity double,"
    " trn_sum_from_iss double, trn_sum_from_red double"
)

# File name of each raw table and its schema, in conversion order.
RAW_TABLES = {"uplift_train": CAMPAIGN_LABELS, "clients": CLIENTS, "purchases": PURCHASES}

KEY = "client_id"
TREATMENT = "treatment"
OUTCOME = "y"
KEYS = [KEY, TREATMENT, OUTCOME]

# The 30 client features, in table order.
FEATURES = [
    "age",
    "gender_f",
    "gender_m",
    "gender_u",
    "tenure_days",
    "redeemed_before_cutoff",
    "days_issue_to_redeem",
    "n_transactions",
    "n_stores",
    "active_months",
    "txn_per_active_month",
    "total_spend",
    "mean_spend",
    "max_spend",
    "recency_days",
    "first_purchase_days",
    "mean_days_between_txn",
    "n_transactions_30d",
    "spend_30d",
    "mean_basket_lines",
    "mean_basket_quantity",
    "regular_points_received",
    "express_points_received",
    "regular_points_spent",
    "express_points_spent",
    "express_received_txn_share",
    "redeemed_amount",
    "redeemed_spend_share",
    "redeem_txn_share",
    "n_products",
]
