"""Declared schemas of the target tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
}


def _schema(columns: str) -> StructType:
    """``name TYPE, ...`` without needing a running session."""
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names, order and types of the target tables. Misspelt names are the export's own.
CATALOGUE = _schema(
    "ts TIMESTAMP, category STRING, product_url STRING, title STRING, short_description STRING, "
    "price_now STRING, price_was STRING, currency STRING, main_image_url STRING, ean STRING, "
    "model STRING, stock_status STRING, slug STRING"
)

PHONES = _schema(
    "ts TIMESTAMP, brand STRING, product_url STRING, name STRING, price_raw STRING, "
    "in_stock BOOLEAN, specs_json STRING, description STRING, variants_json STRING, "
    "scrape_error STRING"
)

COMPLETED_ORDERS = _schema(
    "order_number STRING, order_id STRING, sku_id STRING, sku_title STRING, sold_qty BIGINT, "
    "deal_price DOUBLE, promotion_type STRING, discount DOUBLE, order_time TIMESTAMP, "
    "payment_time TIMESTAMP, complete_time TIMESTAMP, status STRING, shop_name STRING"
)

STOCK = _schema(
    "listing_id STRING, sku_id STRING, vendor_product_id STRING, title STRING, currency STRING, "
    "market_reference_price DOUBLE, selling_price DOUBLE, fbk_inventory BIGINT, "
    "non_fbk_inventory BIGINT, status STRING, updated_at_ts TIMESTAMP, shop_name STRING"
)

# Stock export headers and their column names.
STOCK_HEADERS = {
    "ListingId": "listing_id",
    "SkuId": "sku_id",
    "Vendor Product Id": "vendor_product_id",
    "Title": "title",
    "Currency": "currency",
    "Market Reference Price": "market_reference_price",
    "Selling Price": "selling_price",
    "FBK Inventory": "fbk_inventory",
    "Non-FBK Inventory": "non_fbk_inventory",
    "Status": "status",
}

# Statement tabs and the table each one feeds.
STATEMENT_TABS = {
    "bill": "finance_bill",
    "bill details": "finance_bill_details",
    "operation fee": "finance_operation_fees",
    "storage fee": "finance_storage_fees",
    "ds processing fee": "finance_ds_fees",
    "fine": "finance_fines",
    "other deductions": "finance_deductions",
    "customer service discount": "finance_cs_discount",
    "billing appeal": "finance_appeals",
    "compensation": "finance_compensation",
}

LINEAGE = "source_filename STRING, statement_start_date DATE, statement_end_date DATE"

# Declared statement columns; the other tabs declare the lineage columns only.
BILL = _schema(
    f"{LINEAGE}, store_id STRING, store_name STRING, total_valume DOUBLE, goods_number BIGINT, "
    "total_commission DOUBLE, ds_quality_inspection_fee DOUBLE, settlement_payable_1 DOUBLE, "
    "fine DOUBLE, warehouse_operation_fee DOUBLE, warehouse_storage_fee DOUBLE, "
    "ds_processing_fee DOUBLE, lite_shipping_fee DOUBLE, customer_service_discount_fee DOUBLE, "
    "other_deductions DOUBLE, billing_appeal DOUBLE, compensations DOUBLE, "
    "settlement_payable_2 DOUBLE, previous_balance DOUBLE, final_settlement_payable DOUBLE, "
    "remark STRING"
)

BILL_DETAILS = _schema(
    f"{LINEAGE}, store_id STRING, store_name STRING, order_sn STRING, payment_time TIMESTAMP, "
    "finnshed_time TIMESTAMP, goods_id STRING, goods_name STRING, goods_price DOUBLE, "
    "goods_num BIGINT, rate DOUBLE, complete_amount DOUBLE, commission DOUBLE, "
    "ds_quality_inspection_fee DOUBLE, settlement DOUBLE, fine DOUBLE, "
    "warehouse_operation_fee DOUBLE, warehouse_storage_fee DOUBLE, ds_processing_fee DOUBLE, "
    "lite_shipping_fee DOUBLE, customer_service_discount_fee DOUBLE, other_deductions DOUBLE, "
    "billing_appeal DOUBLE, compensations DOUBLE, settlement_payable DOUBLE, "
    "previous_balance DOUBLE, final_settlement_payable DOUBLE"
)

STATEMENT_SCHEMAS = {tab: _schema(LINEAGE) for tab in STATEMENT_TABS} | {
    "bill": BILL,
    "bill details": BILL_DETAILS,
}
