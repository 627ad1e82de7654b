"""Declared schemas of the raw tables; nothing is inferred.

Zip prefixes are text: read as numbers they would lose leading zeros.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Table names, columns and types.
COLUMNS = {
    "customers": """customer_id STRING, customer_unique_id STRING,
        customer_zip_code_prefix STRING, customer_city STRING, customer_state STRING""",
    "orders": """order_id STRING, customer_id STRING, order_status STRING,
        order_purchase_timestamp TIMESTAMP_NTZ, order_approved_at TIMESTAMP_NTZ,
        order_delivered_carrier_date TIMESTAMP_NTZ,
        order_delivered_customer_date TIMESTAMP_NTZ,
        order_estimated_delivery_date TIMESTAMP_NTZ""",
    "order_items": """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date TIMESTAMP_NTZ, price DECIMAL(12,2), freight_value DECIMAL(12,2)""",
    "order_payments": """order_id STRING, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DECIMAL(12,2)""",
    "order_reviews": """review_id STRING, order_id STRING, review_score SMALLINT,
        review_comment_title STRING, review_comment_message STRING,
        review_creation_date TIMESTAMP_NTZ, review_answer_timestamp TIMESTAMP_NTZ""",
    "products": """product_id STRING, product_category_name STRING, product_name_lenght DOUBLE,
        product_description_lenght DOUBLE, product_photos_qty DOUBLE, product_weight_g DOUBLE,
        product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE""",
    "sellers": """seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING,
        seller_state STRING""",
    "geolocation": """geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE,
        geolocation_lng DOUBLE, geolocation_city STRING, geolocation_state STRING""",
    "product_category_name_translation": """product_category_name STRING,
        product_category_name_english STRING""",
    "customer_support": """ticket_id STRING, customer_unique_id STRING,
        created_at TIMESTAMP_NTZ, issue_type STRING, priority STRING, resolution_hours DOUBLE,
        resolved BOOLEAN, customer_satisfaction SMALLINT, escalated BOOLEAN""",
    "marketing_campaigns": """campaign_id STRING, customer_unique_id STRING,
        campaign_date TIMESTAMP_NTZ, channel STRING, campaign_type STRING,
        offer_percentage DOUBLE, opened BOOLEAN, clicked BOOLEAN, converted BOOLEAN,
        campaign_cost DECIMAL(12,2)""",
    "customer_costs": """customer_unique_id STRING, acquisition_cost DECIMAL(12,2),
        annual_service_cost DECIMAL(12,2), support_cost DECIMAL(12,2),
        discount_cost DECIMAL(12,2), estimated_processing_cost DECIMAL(12,2)""",
    "customer_segments": """customer_unique_id STRING, segment STRING, customer_tier STRING,
        account_manager STRING, strategic_account BOOLEAN""",
    "retention_interventions": """intervention_id STRING, customer_unique_id STRING,
        intervention_type STRING, cost DECIMAL(12,2), success_probability DOUBLE,
        created_at TIMESTAMP_NTZ, outcome STRING""",
}

#: short names used by the plans
CANONICAL = {
    "customers": "customers",
    "orders": "orders",
    "items": "order_items",
    "payments": "order_payments",
    "reviews": "order_reviews",
    "products": "products",
    "sellers": "sellers",
    "geolocation": "geolocation",
    "translation": "product_category_name_translation",
    "tickets": "customer_support",
    "campaigns": "marketing_campaigns",
    "costs": "customer_costs",
    "segments": "customer_segments",
    "interventions": "retention_interventions",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(" ".join(COLUMNS[table].split()))
