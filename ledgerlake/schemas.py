"""Columns and types of every table, as Spark DDL."""

from __future__ import annotations

import re

_AUDIT = "ingested_at timestamp, source_name string, batch_id string"
_PLACE = "file_name string, line_number bigint"
_FILE = f"raw_line string, {_PLACE}"
_STAGED = (
    "is_valid boolean, validation_errors string, created_at timestamp, updated_at timestamp,"
    " batch_id string"
)
_STAMPS = "created_at timestamp, updated_at timestamp"
_VERSION = (
    "effective_from date, effective_to date, is_current boolean,"
    " created_at timestamp, updated_at timestamp"
)

# Table names, column names and types. Sums are wider than the 15 digits a
# small installation needs, so that totals over a very large fact table cannot overflow.
TABLES = {
    "raw.api_products": "source_id string, title string, price string, description string,"
    " category string, image_url string, rating_rate string, rating_count string,"
    f" raw_json string, {_PLACE}, {_AUDIT}",
    "raw.api_users": "source_id string, email string, username string, firstname string,"
    " lastname string, city string, street string, zipcode string, phone string,"
    f" raw_json string, {_PLACE}, {_AUDIT}",
    "raw.api_carts": "source_id string, user_id string, cart_date string,"
    f" products_json string, raw_json string, {_PLACE}, {_AUDIT}",
    "raw.csv_products": "product_id string, product_name string, category string, price string,"
    f" cost string, stock_quantity string, supplier string, {_FILE}, {_AUDIT}",
    "raw.csv_customers": "customer_id string, first_name string, last_name string, email string,"
    " phone string, city string, state string, country string, registration_date string,"
    f" {_FILE}, {_AUDIT}",
    "raw.csv_sales": "sale_id string, customer_id string, product_id string, quantity string,"
    " unit_price string, total_amount string, sale_date string, payment_method string,"
    f" {_FILE}, {_AUDIT}",
    "staging.products": "source_product_id string, source_system string, title string,"
    " category string, price decimal(10,2), cost decimal(10,2), description string,"
    " image_url string, rating_rate decimal(3,2), rating_count int, stock_quantity int,"
    f" supplier string, {_STAGED}",
    "staging.customers": "source_customer_id string, source_system string, email string,"
    " first_name string, last_name string, full_name string, phone string, city string,"
    f" state string, country string, registration_date date, {_STAGED}",
    "staging.sales": "source_sale_id string, source_system string, source_customer_id string,"
    " source_product_id string, quantity int, unit_price decimal(10,2),"
    f" total_amount decimal(12,2), sale_date date, payment_method string, {_STAGED}",
    "dw.dim_date": "date_key int, full_date date, day_of_week int, day_name string,"
    " day_of_month int, day_of_year int, week_of_year int, month_num int, month_name string,"
    " month_short string, quarter int, quarter_name string, year int, is_weekend boolean,"
    " is_holiday boolean, fiscal_year int, fiscal_quarter int",
    "dw.dim_product": "product_key bigint, product_id string, title string, category string,"
    " price decimal(10,2), cost decimal(10,2), description string, image_url string,"
    " rating_rate decimal(3,2), rating_count int, stock_quantity int, supplier string,"
    f" {_VERSION}",
    "dw.dim_customer": "customer_key bigint, customer_id string, email string,"
    " first_name string, last_name string, full_name string, phone string, city string,"
    " state string, country string, region string, registration_date date,"
    f" customer_segment string, {_VERSION}",
    "dw.fact_sales": "sale_key bigint, date_key int, product_key bigint, customer_key bigint,"
    " sale_id string, source_system string, payment_method string, quantity int,"
    " unit_price decimal(10,2), total_amount decimal(12,2), cost_amount decimal(12,2),"
    " created_at timestamp, batch_id string, year int, month int",
    "mart.sales_daily": "date_key int, full_date date, year int, month_num int,"
    " month_name string, day_name string, is_weekend boolean, total_orders bigint,"
    " total_quantity bigint, total_revenue decimal(22,2), total_cost decimal(22,2),"
    " total_profit decimal(22,2), avg_order_value decimal(22,2), unique_customers bigint,"
    f" unique_products bigint, {_STAMPS}",
    "mart.product_performance": "product_key bigint, product_id string, title string,"
    " category string, price decimal(10,2), total_orders bigint, total_quantity_sold bigint,"
    " total_revenue decimal(22,2), total_profit decimal(22,2),"
    " avg_quantity_per_order decimal(22,2), first_sale_date date, last_sale_date date,"
    f" days_since_last_sale int, revenue_rank bigint, quantity_rank bigint, {_STAMPS}",
    "mart.customer_summary": "customer_key bigint, customer_id string, full_name string,"
    " email string, city string, country string, total_orders bigint, total_quantity bigint,"
    " total_spent decimal(22,2), avg_order_value decimal(22,2), first_purchase_date date,"
    " last_purchase_date date, days_since_last_purchase int, customer_tenure_days int,"
    f" customer_segment string, rfm_score string, {_STAMPS}",
    "mart.category_analysis": "category string, year int, month_num int, product_count bigint,"
    " total_orders bigint, total_quantity bigint, total_revenue decimal(22,2),"
    " total_profit decimal(22,2), avg_product_price decimal(22,2), unique_customers bigint,"
    f" revenue_mom_change decimal(22,2), revenue_yoy_change decimal(22,2), {_STAMPS}",
    "quality.ingestion_log": "batch_id string, pipeline_name string, source_name string,"
    " source_type string, records_received bigint, bytes_received bigint, records_stored bigint,"
    " records_rejected bigint, quality_score decimal(5,2), extraction_started_at timestamp,"
    " extraction_completed_at timestamp, load_started_at timestamp, load_completed_at timestamp,"
    " duration_seconds bigint, status string, error_message string, created_at timestamp",
    "quality.rejection_details": "batch_id string, source_name string, rejection_reason string,"
    " rejection_count bigint, sample_values string, created_at timestamp",
    "quality.transformation_log": "batch_id string, pipeline_name string, step_name string,"
    " source_layer string, target_layer string, target_table string, records_input bigint,"
    " records_output bigint, records_inserted bigint, records_updated bigint,"
    " records_deleted bigint, records_rejected bigint, started_at timestamp,"
    " completed_at timestamp, duration_seconds bigint, status string, error_message string,"
    " created_at timestamp",
    "quality.data_quality_rules": "rule_id int, rule_name string, rule_description string,"
    " target_table string, target_column string, rule_type string, rule_expression string,"
    f" severity string, is_active boolean, {_STAMPS}",
    "quality.rule_execution_results": "batch_id string, rule_id int, records_checked bigint,"
    " records_passed bigint, records_failed bigint, pass_rate decimal(5,2),"
    " sample_failures string, executed_at timestamp",
    "quality.daily_summary": "summary_date date, total_pipelines_run bigint,"
    " successful_pipelines bigint, failed_pipelines bigint, total_records_received bigint,"
    " total_records_stored bigint, total_records_rejected bigint,"
    " overall_quality_score decimal(5,2), total_transforms_run bigint,"
    " successful_transforms bigint, total_rules_executed bigint, rules_passed bigint,"
    f" rules_failed bigint, {_STAMPS}",
    # Ours: what was refused, which batches are staged, and which sales wait for a dimension.
    "quality.rejected_records": "batch_id string, source_name string, record_key string,"
    " rejection_reasons string, record string, created_at timestamp",
    "staging.loaded_batches": "source_name string, raw_batch string, written bigint,"
    " batch_id string, loaded_at timestamp",
    "staging.waiting_sales": "source_sale_id string, source_system string, skip_reason string",
}

# Tables that are written by partition; all others are refreshed as a whole.
PARTITIONS = {
    **{name: ["batch"] for name in TABLES if name.startswith("raw.")},
    "quality.ingestion_log": ["batch"],
    "quality.rejection_details": ["batch"],
    "quality.rejected_records": ["batch"],
    "quality.transformation_log": ["batch"],
    "quality.rule_execution_results": ["batch"],
    "staging.loaded_batches": ["batch"],
    "dw.fact_sales": ["year", "month"],
}


def split_columns(ddl: str) -> list[str]:
    """The `name type` pairs of flat DDL; commas inside brackets belong to a type."""
    return re.split(r",\s*(?![^(]*\))", ddl)


# Columns the tables show but do not store.
COMPUTED = {
    "dw.dim_product": {
        "profit_margin": "CASE WHEN cost > 0 THEN try_divide(price - cost, price) * 100 END"
    },
    "dw.fact_sales": {"profit_amount": "total_amount - coalesce(cost_amount, 0)"},
}

# Longest text the staging tables take.
TEXT_LIMITS = {
    "source_product_id": 50,
    "source_customer_id": 50,
    "source_sale_id": 50,
    "title": 500,
    "category": 255,
    "image_url": 1000,
    "supplier": 255,
    "email": 255,
    "first_name": 100,
    "last_name": 100,
    "full_name": 200,
    "phone": 50,
    "city": 100,
    "state": 100,
    "country": 100,
    "payment_method": 50,
}

# Nested records as the landing files hold them. Numbers stay text until they are cleaned.
# A user's password is left out on purpose: it is not needed and must not be stored.
LANDING = {
    "api_products": "id string, title string, price string, description string,"
    " category string, image string, rating struct<rate: string, count: string>",
    "api_users": "id string, email string, username string,"
    " name struct<firstname: string, lastname: string>,"
    " address struct<city: string, street: string, zipcode: string>, phone string",
    "api_carts": "id string, userId string, date string,"
    " products array<struct<productId: string, quantity: string>>",
}

CART_ITEMS = "array<struct<productId: string, quantity: string>>"
