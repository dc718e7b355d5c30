"""Declared schemas and the fixed vocabularies of the order exports.

Everything in the "fixed values" blocks must equal what the marketplace
exports contain (header text, city spellings, platform names); they are data,
not logic, and are kept together here in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Export header text -> master column (order export, xlsx/csv).
# Two headers name the fee rate (old and new export layout).
# ---------------------------------------------------------------------------
ORDER_EXPORT_HEADERS: dict[str, str] = {
    "訂單編號": "order_sn",
    "訂單狀態": "order_status",
    "不成立原因": "cancellation_reason",
    "退貨 / 退款狀態": "return_refund_status",
    "買家帳號": "buyer_username",
    "訂單成立日期": "order_creation_timestamp",
    "商品總價": "product_total_price",
    "買家支付運費": "buyer_paid_shipping_fee",
    "蝦皮補助運費": "shopee_shipping_subsidy",
    "退貨運費": "return_shipping_fee",
    "買家總支付金額": "total_amount_paid_by_buyer",
    "蝦皮補貼金額": "shopee_subsidy_amount",
    "蝦幣折抵": "shopee_coin_offset",
    "銀行信用卡活動折抵": "credit_card_promotion_discount",
    "優惠代碼": "voucher_code",
    "賣場優惠券": "seller_voucher",
    "賣家蝦幣回饋券": "seller_coin_cashback_voucher",
    "優惠券": "voucher",
    "成交手續費": "transaction_fee",
    "其他服務費": "other_service_fee",
    "金流與系統處理費": "payment_processing_fee",
    "分期付款期數": "installment_plan_periods",
    "金流處理費率": "payment_processing_fee_rate",
    "金流與系統處理費率": "payment_processing_fee_rate",
    "成交手續費規則名稱": "transaction_fee_rule_name",
    "商品名稱": "product_name",
    "商品選項名稱": "product_variation",
    "商品原價": "product_original_price",
    "商品活動價格": "product_campaign_price",
    "主商品貨號": "product_sku_main",
    "商品選項貨號": "product_sku_variation",
    "數量": "quantity",
    "退貨數量": "return_quantity",
    "促銷組合指標": "promo_bundle_indicator",
    "蝦皮促銷組合折扣:促銷組合標籤": "promo_bundle_discount_label",
    "收件地址": "recipient_address",
    "收件者電話": "recipient_phone",
    "蝦皮專線和包裹查詢碼": "shopee_hotline_and_tracking_code",
    "取件門市店號": "pickup_store_id",
    "城市": "recipient_city",
    "行政區": "recipient_district",
    "郵遞區號": "recipient_postal_code",
    "收件者姓名": "recipient_name",
    "寄送方式": "shipping_method",
    "出貨方式": "shipping_provider",
    "備貨時間": "days_to_ship",
    "付款方式": "payment_method",
    "最晚出貨日期": "ship_by_date",
    "包裹查詢號碼": "tracking_number",
    "買家付款時間": "buyer_payment_timestamp",
    "實際出貨時間": "actual_shipping_timestamp",
    "訂單完成時間": "order_completion_timestamp",
    "買家備註": "buyer_note",
    "備註": "seller_note",
}

# Long export headers that are collapsed by substring
# (substring -> short header), checked in this order.
LONG_HEADER_SUBSTRINGS: list[tuple[str, str]] = [
    ("若您是自行配送請使用後方蝦皮專線和包裹查詢碼聯繫買家", "收件者電話"),
    ("請複製下方完整編號提供給您配合的物流商當做聯絡電話", "蝦皮專線和包裹查詢碼"),
]

# ---------------------------------------------------------------------------
# Spreadsheet (sheet) export header text -> master column.
# ---------------------------------------------------------------------------
SHEET_EXPORT_HEADERS: dict[str, str] = {
    "店鋪名稱": "shop_name",
    "買家帳號": "buyer_username",
    "訂單日期": "order_date",
    "訂單編號": "order_sn",
    "訂單編號(從這邊貼上)": "order_sn",
    "訂單狀態": "order_status",
    "不成立原因": "cancellation_reason",
    "退貨 / 退款狀態": "return_refund_status",
    "訂單成立日期": "order_creation_timestamp",
    "商品 總價": "product_total_price",
    "商品總價": "product_total_price",
    "買家支付運費": "buyer_paid_shipping_fee",
    "蝦皮補助運費": "shopee_shipping_subsidy",
    "退貨運費": "return_shipping_fee",
    "買家總支付金額": "total_amount_paid_by_buyer",
    "蝦皮補貼金額": "shopee_subsidy_amount",
    "蝦幣折抵": "shopee_coin_offset",
    "銀行信用卡活動折抵": "credit_card_promotion_discount",
    "優惠代碼": "voucher_code",
    "賣場優惠券": "seller_voucher",
    "賣家蝦幣回饋券": "seller_coin_cashback_voucher",
    "優惠券": "voucher",
    "成交手續費": "transaction_fee",
    "其他服務 費": "other_service_fee",
    "其他服務費": "other_service_fee",
    "金流與系統處理費": "payment_processing_fee",
    "分期付款期數": "installment_plan_periods",
    "金流與系統處理費率": "payment_processing_fee_rate",
    "成交手續費規則名稱": "transaction_fee_rule_name",
    "商品名稱": "product_name",
    "商品選項名稱": "product_variation",
    "商品原價": "product_original_price",
    "商品活動價格": "product_campaign_price",
    "主商品貨號": "product_sku_main",
    "商品選項貨號": "product_sku_variation",
    "數量": "quantity",
    "退貨數量": "return_quantity",
    "促銷 組合指標": "promo_bundle_indicator",
    "促銷組合指標": "promo_bundle_indicator",
    "蝦皮促銷組合折扣:促銷組合標籤": "promo_bundle_discount_label",
    "收件地址": "recipient_address",
    "收件者電話 (若您是自行配送請使用後方蝦皮專線和包裹查詢碼聯繫買家)": "recipient_phone",
    "蝦皮專線和包裹查詢碼  (請複製下方完整編號提供給您配合的物流商當做聯絡電話)": "shopee_hotline_and_tracking_code",
    "取件門市店號": "pickup_store_id",
    "城市": "recipient_city",
    "行政區": "recipient_district",
    "郵遞區號": "recipient_postal_code",
    "收件者姓名": "recipient_name",
    "寄送方式": "shipping_method",
    "出貨方式": "shipping_provider",
    "備貨時間": "days_to_ship",
    "付款方式": "payment_method",
    "最晚出貨日期": "ship_by_date",
    "包裹查詢號碼": "tracking_number",
    "買家付款時間": "buyer_payment_timestamp",
    "實際出貨時間": "actual_shipping_timestamp",
    "訂單完成時間": "order_completion_timestamp",
    "買家備註": "buyer_note",
    "備註": "seller_note",
}
# Sheet header alias and the helper columns a sheet carries.
SHEET_HEADER_ALIASES: dict[str, str] = {"訂單編號(從這邊貼上)": "訂單編號"}
SHEET_HELPER_COLUMNS: list[str] = ["訂單編號2", "排行", "買家總支付金額2"]

# Platform shops kept in a separate (special) master.
SPECIAL_PLATFORMS: list[str] = ["MOMO購物中心", "PC購物中心", "Yahoo購物中心", "東森購物"]

# Recipient city spelling -> reporting label (26 spellings, 22 labels).
CITY_LABELS: dict[str, str] = {
    "臺北市": "Taipei City", "台北市": "Taipei City",
    "新北市": "New Taipei City",
    "桃園市": "Taoyuan City",
    "基隆市": "Keelung City",
    "新竹市": "Hsinchu City",
    "新竹縣": "Hsinchu County",
    "苗栗縣": "Miaoli County",
    "臺中市": "Taichung City", "台中市": "Taichung City",
    "彰化縣": "Changhua County",
    "南投縣": "Nantou County",
    "雲林縣": "Yunlin County",
    "嘉義市": "Chiayi City",
    "嘉義縣": "Chiayi County",
    "臺南市": "Tainan City", "台南市": "Tainan City",
    "高雄市": "Kaohsiung City",
    "屏東縣": "Pingtung County",
    "宜蘭縣": "Yilan County",
    "花蓮縣": "Hualien County",
    "臺東縣": "Taitung County", "台東縣": "Taitung County",
    "澎湖縣": "Penghu County",
    "金門縣": "Kinmen County",
    "連江縣": "Lienchiang County",
}

# Text tokens that mean "no value" in exported CSVs.
NULL_TOKENS: list[str] = ["nan", "NaN", "None"]
# Timestamp placeholders in order exports.
TIMESTAMP_NULL_TOKENS: list[str] = ["-", "", "nan", "NaN"]
# Voucher histogram bin edges, half-open [lo, hi).
VOUCHER_BIN_EDGES: list[float] = [0, 10, 25, 50, 100, 200, 500, float("inf")]
# Order-file name anchor.
FILE_NAME_ANCHOR = "_Order.all."

# ---------------------------------------------------------------------------
# Master (order line) schema: column order of the master table and types.
# ---------------------------------------------------------------------------
DATE_COLUMNS = ["processing_date", "order_date", "ship_by_date"]
TIMESTAMP_COLUMNS = [
    "order_creation_timestamp", "buyer_payment_timestamp",
    "actual_shipping_timestamp", "order_completion_timestamp",
]
CURRENCY_COLUMNS = [
    "product_total_price", "buyer_paid_shipping_fee", "shopee_shipping_subsidy",
    "return_shipping_fee", "total_amount_paid_by_buyer", "shopee_subsidy_amount",
    "shopee_coin_offset", "credit_card_promotion_discount", "transaction_fee",
    "other_service_fee", "payment_processing_fee", "product_original_price",
    "product_campaign_price",
]
RATE_COLUMNS = ["payment_processing_fee_rate"]
INTEGER_COLUMNS = ["quantity", "return_quantity", "installment_plan_periods", "days_to_ship"]
MASTER_COLUMNS: list[str] = [
    "shop_name", "shop_account", "processing_date", "order_date", "order_sn",
    "order_status", "cancellation_reason", "return_refund_status", "buyer_username",
    "order_creation_timestamp", "product_total_price", "buyer_paid_shipping_fee",
    "shopee_shipping_subsidy", "return_shipping_fee", "total_amount_paid_by_buyer",
    "shopee_subsidy_amount", "shopee_coin_offset", "credit_card_promotion_discount",
    "voucher_code", "seller_voucher", "seller_coin_cashback_voucher", "voucher",
    "transaction_fee", "other_service_fee", "payment_processing_fee",
    "installment_plan_periods", "payment_processing_fee_rate", "transaction_fee_rule_name",
    "product_name", "product_variation", "product_original_price", "product_campaign_price",
    "product_sku_main", "product_sku_variation", "quantity", "return_quantity",
    "promo_bundle_indicator", "promo_bundle_discount_label", "recipient_address",
    "recipient_phone", "shopee_hotline_and_tracking_code", "pickup_store_id",
    "recipient_city", "recipient_district", "recipient_postal_code", "recipient_name",
    "shipping_method", "shipping_provider", "days_to_ship", "payment_method",
    "ship_by_date", "tracking_number", "buyer_payment_timestamp",
    "actual_shipping_timestamp", "order_completion_timestamp", "buyer_note", "seller_note",
]


def column_type(name: str) -> T.DataType:
    """Declared type of a master column (text unless listed)."""
    if name in DATE_COLUMNS:
        return T.DateType()
    if name in TIMESTAMP_COLUMNS:
        # exports carry wall-clock times without a zone
        return T.TimestampNTZType()
    if name in CURRENCY_COLUMNS or name in RATE_COLUMNS:
        return T.DoubleType()
    if name in INTEGER_COLUMNS:
        return T.LongType()
    return T.StringType()


# What each master column holds (the table's column comments).
COLUMN_DESCRIPTIONS: dict[str, str] = {
    "shop_name": "Shop the order was placed at",
    "shop_account": "Marketplace account of the shop",
    "processing_date": "Day the line was processed into this table",
    "order_date": "Order day, read from the order number or the sheet",
    "order_sn": "Order number given by the marketplace",
    "order_status": "State of the order at the time of export",
    "cancellation_reason": "Why the order was cancelled, if it was",
    "return_refund_status": "State of a return or refund, if there is one",
    "buyer_username": "Buyer's account name",
    "order_creation_timestamp": "Wall-clock time the order was created",
    "product_total_price": "Price of all products of the order",
    "buyer_paid_shipping_fee": "Shipping paid by the buyer",
    "shopee_shipping_subsidy": "Shipping paid by the marketplace",
    "return_shipping_fee": "Shipping of a return",
    "total_amount_paid_by_buyer": "Everything the buyer paid for the order (repeated on each line)",
    "shopee_subsidy_amount": "Discount paid by the marketplace",
    "shopee_coin_offset": "Part paid with marketplace coins",
    "credit_card_promotion_discount": "Discount of a card promotion",
    "voucher_code": "Code of the voucher used",
    "seller_voucher": "Discount of the seller's voucher",
    "seller_coin_cashback_voucher": "Coins given back by the seller's voucher",
    "voucher": "Discount of the marketplace's voucher",
    "transaction_fee": "Fee per transaction charged to the seller",
    "other_service_fee": "Other service fees charged to the seller",
    "payment_processing_fee": "Payment and system fee charged to the seller",
    "installment_plan_periods": "Number of instalments",
    "payment_processing_fee_rate": "Payment fee as a fraction (0.02 is 2 %)",
    "transaction_fee_rule_name": "Name of the fee rule applied",
    "product_name": "Name of the line's product",
    "product_variation": "Chosen variation of the product",
    "product_original_price": "List price of the product",
    "product_campaign_price": "Price of the product in the campaign",
    "product_sku_main": "Seller's number of the product",
    "product_sku_variation": "Seller's number of the variation",
    "quantity": "Pieces ordered",
    "return_quantity": "Pieces returned",
    "promo_bundle_indicator": "Whether the line belongs to a bundle",
    "promo_bundle_discount_label": "Label of the bundle's discount",
    "recipient_address": "Delivery address",
    "recipient_phone": "Recipient's phone number",
    "shopee_hotline_and_tracking_code": "Contact number and code for the carrier",
    "pickup_store_id": "Number of the pick-up store",
    "recipient_city": "Delivery city",
    "recipient_district": "Delivery district",
    "recipient_postal_code": "Delivery postal code",
    "recipient_name": "Recipient's name",
    "shipping_method": "Delivery method chosen by the buyer",
    "shipping_provider": "Carrier",
    "days_to_ship": "Days the seller has to ship",
    "payment_method": "How the buyer paid",
    "ship_by_date": "Last day to ship",
    "tracking_number": "Parcel number",
    "buyer_payment_timestamp": "Wall-clock time of the payment",
    "actual_shipping_timestamp": "Wall-clock time of shipping",
    "order_completion_timestamp": "Wall-clock time the order was completed",
    "buyer_note": "Buyer's note",
    "seller_note": "Seller's note",
}


MASTER_SCHEMA = T.StructType([
    T.StructField(c, column_type(c), True, {"comment": COLUMN_DESCRIPTIONS[c]}) for c in MASTER_COLUMNS
])

ORPHAN_SCHEMA = T.StructType(
    MASTER_SCHEMA.fields + [T.StructField("orphaned_timestamp", T.TimestampNTZType(), True)]
)

# Order identity (whole-order upsert granularity) and the sheet variant.
ORDER_KEY = ["order_date", "order_sn", "buyer_username"]
SHEET_ORDER_KEY = ["order_sn", "buyer_username", "order_creation_timestamp"]

# ---------------------------------------------------------------------------
# Column subsets of the reporting marts.
# ---------------------------------------------------------------------------
SUMMARY_FIRST_COLUMNS = [
    "shop_name", "shop_account", "processing_date", "order_date", "order_status",
    "cancellation_reason", "return_refund_status", "buyer_username",
    "order_creation_timestamp", "total_amount_paid_by_buyer", "voucher",
    "buyer_note", "seller_note",
]
DETAIL_COLUMNS = [
    "order_sn", "shop_name", "shop_account", "processing_date", "order_date", "order_status",
    "cancellation_reason", "return_refund_status", "buyer_username", "order_creation_timestamp",
    "product_total_price", "total_amount_paid_by_buyer", "product_name", "product_variation",
    "product_original_price", "product_campaign_price", "product_sku_main",
    "product_sku_variation", "quantity", "return_quantity", "promo_bundle_indicator",
    "promo_bundle_discount_label", "buyer_note", "seller_note",
]
HEADER_COLUMNS = [c for c in DETAIL_COLUMNS if c != "product_sku_variation"]
SHIPPING_COLUMNS = [
    "order_sn", "shop_name", "shop_account", "processing_date", "order_date", "order_status",
    "cancellation_reason", "return_refund_status", "buyer_username", "order_creation_timestamp",
    "recipient_address", "recipient_phone", "shopee_hotline_and_tracking_code",
    "pickup_store_id", "recipient_city", "recipient_district", "recipient_postal_code",
    "recipient_name", "shipping_method", "shipping_provider", "days_to_ship",
    "payment_method", "ship_by_date", "tracking_number", "buyer_payment_timestamp",
    "actual_shipping_timestamp", "order_completion_timestamp", "buyer_note", "seller_note",
]
