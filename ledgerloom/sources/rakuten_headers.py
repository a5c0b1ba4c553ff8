"""Column names of the Rakuten order export.

Fixed values: the header text of the export and the name of each column in the order tables.
Older exports end after the 155th column.
"""

ORDER_HEADERS = {
    "注文番号": "order_number",
    "ステータス": "status",
    "サブステータスID": "substatus_id",
    "サブステータス": "sub_status",
    "注文日時": "order_date_time",
    "注文日": "order_date",
    "注文時間": "order_time",
    "キャンセル期限日": "cancellation_deadline_date",
    "注文確認日時": "order_confirmation_date",
    "注文確定日時": "order_confirmed_date",
    "発送指示日時": "shipment_instruction_date_and_time",
    "発送完了報告日時": "shipment_completion_report_date",
    "支払方法名": "payment_method_name",
    "クレジットカード支払い方法": "credit_card_payment_method",
    "クレジットカード支払い回数": "number_of_credit_card_payments",
    "配送方法": "shipping_method",
    "配送区分": "shipping_category",
    "注文種別": "order_type",
    "複数送付先フラグ": "multiple_destination_flag",
    "送付先一致フラグ": "destination_match_flag",
    "離島フラグ": "remote_island_flag",
    "楽天確認中フラグ": "rakuten_confirmation_flag",
    "警告表示タイプ": "warning_display_type",
    "楽天会員フラグ": "rakuten_member_flag",
    "購入履歴修正有無フラグ": "purchase_history_modification_flag",
    "商品合計金額": "product_total_price",
    "消費税合計": "total_consumption_tax",
    "送料合計": "shipping_total",
    "代引料合計": "cash_on_delivery_total",
    "請求金額": "billing_amount",
    "合計金額": "total_amount",
    "ポイント利用額": "amount_of_points_used",
    "クーポン利用総額": "total_coupon_usage",
    "店舗発行クーポン利用額": "store_issued_coupon_usage_amount",
    "楽天発行クーポン利用額": "amount_of_coupons_issued_by_rakuten",
    "注文者郵便番号1": "orderer_zip_code_1",
    "注文者郵便番号2": "orderer_postal_code_2",
    "注文者住所都道府県": "orderer_address_prefecture",
    "注文者住所郡市区": "orderers_address",
    "注文者住所それ以降の住所": "orderer_address_subsequent_address",
    "注文者姓": "last_name_of_orderer",
    "注文者名": "orderer_name",
    "注文者姓カナ": "orderer_surname_kana",
    "注文者名カナ": "orderers_name_kana",
    "注文者電話番号1": "orderer_phone_number_1",
    "注文者電話番号2": "orderer_phone_number_2",
    "注文者電話番号3": "orderer_phone_number_3",
    "注文者メールアドレス": "orderer_email_address",
    "注文者性別": "gender_of_orderer",
    "申込番号": "application_number",
    "申込お届け回数": "application_delivery_times",
    "送付先ID": "recipient_id",
    "送付先送料": "destination_postage",
    "送付先代引料": "delivery_address",
    "送付先消費税合計": "destination_consumption_tax_total",
    "送付先商品合計金額": "total_amount_of_goods_to_be_sent_to",
    "送付先合計金額": "destination_total_amount",
    "のし": "noshi",
    "送付先郵便番号1": "destination_postal_code_1",
    "送付先郵便番号2": "mailing_address_postal_code_2",
    "送付先住所都道府県": "shipping_address_prefecture",
    "送付先住所郡市区": "mailing_address_county_city",
    "送付先住所それ以降の住所": "shipping_address_subsequent_address",
    "送付先姓": "mailing_to_last_name",
    "送付先名": "destination_name",
    "送付先姓カナ": "mailing_address_last_name_kana",
    "送付先名カナ": "destination_name_kana",
    "送付先電話番号1": "destination_phone_number_1",
    "送付先電話番号2": "mailing_address_phone_number_2",
    "送付先電話番号3": "mailing_address_phone_number_3",
    "商品明細ID": "product_details_id",
    "商品ID": "product_id",
    "商品名": "product_name",
    "商品番号": "item_number",
    "商品管理番号": "merchandise_control_number",
    "単価": "unit_price",
    "個数": "quantity",
    "送料込別": "shipping_fee_not_included",
    "税込別": "tax_not_included",
    "代引手数料込別": "cod_fee_not_included",
    "項目・選択肢": "item_choice",
    "ポイント倍率": "point_multiplier",
    "納期情報": "delivery_date_information",
    "在庫タイプ": "inventory_type",
    "ラッピングタイトル1": "wrapping_title_1",
    "ラッピング名1": "wrapping_name_1",
    "ラッピング料金1": "wrapping_fee_1",
    "ラッピング税込別1": "lapping_including_tax_1",
    "ラッピング種類1": "wrapping_type_1",
    "ラッピングタイトル2": "wrapping_title_2",
    "ラッピング名2": "wrapping_name_2",
    "ラッピング料金2": "wrapping_fee_2",
    "ラッピング税込別2": "wrapping_tax_included_2",
    "ラッピング種類2": "wrapping_type_2",
    "お届け時間帯": "delivery_time_zone",
    "お届け日指定": "specify_delivery_date",
    "担当者": "manager",
    "ひとことメモ": "note",
    "メール差込文 (お客様へのメッセージ)": "mail_insert_message_to_customer",
    "ギフト配送希望": "request_for_gift_delivery",
    "コメント": "comment",
    "利用端末": "terminal_used",
    "メールキャリアコード": "mail_carrier_code",
    "あす楽希望フラグ": "tomorrow_raku_hope_flag",
    "医薬品受注フラグ": "pharmaceutical_order_flag",
    "楽天スーパーDEAL商品受注フラグ": "rakuten_super_deal_product_order_flag",
    "メンバーシッププログラム受注タイプ": "membership_program_order_type",
    "決済手数料": "settlement_fee",
    "注文者負担金合計": "orderers_contribution_total",
    "店舗負担金合計": "total_store_charges",
    "外税合計": "excluded_tax_total",
    "決済手数料税率": "settlement_fee_tax_rate",
    "ラッピング税率1": "wrapping_tax_rate_1",
    "ラッピング税額1": "wrapping_tax_amount_1",
    "ラッピング税率2": "wrapping_tax_rate_2",
    "ラッピング税額2": "wrapping_tax_amount_2",
    "送付先外税合計": "total_destination_tax",
    "送付先送料税率": "destination_postage_tax_rate",
    "送付先代引料税率": "shipping_destination_cod_tax_rate",
    "商品税率": "commodity_tax_rate",
    "商品毎税込価格": "tax_included_price_for_each_product",
    "10%税率": "tax_rate_10_percent",
    "10%請求金額": "billed_amount_10_percent",
    "10%請求額に対する税額": "tax_on_billed_amount_10_percent",
    "10%合計金額": "total_amount_10_percent",
    "10%決済手数料": "settlement_fee_10_percent",
    "10%クーポン割引額": "coupon_discount_amount_10_percent",
    "10%利用ポイント数": "usage_points_10_percent",
    "8%税率": "tax_rate_8_percent",
    "8%請求金額": "billed_amount_8_percent",
    "8%請求額に対する税額": "tax_on_billed_amount_8_percent",
    "8%合計金額": "total_amount_8_percent",
    "8%決済手数料": "settlement_fee_8_percent",
    "8%クーポン割引額": "coupon_discount_amount_8_percent",
    "8%利用ポイント数": "points_used_8_percent",
    "0%税率": "tax_rate_0_percent",
    "0%請求金額": "billed_amount_0_percent",
    "0%請求額に対する税額": "tax_on_invoice_amount_0_percent",
    "0%合計金額": "total_amount_0_percent",
    "0%決済手数料": "payment_fee_0_percent",
    "0%クーポン割引額": "coupon_discount_amount_0_percent",
    "0%利用ポイント数": "usage_points_0_percent",
    "単品配送フラグ": "single_item_delivery_flag",
    "購入時配送会社": "delivery_company_at_the_time_of_purchase",
    "領収書発行回数": "number_of_receipts_issued",
    "領収書初回発行日時": "first_issue_date_and_time_of_receipt",
    "領収書最終発行日時": "date_and_time_of_last_issue_of_receipt",
    "支払い期限日": "payment_due_date",
    "支払い方法変更期限日": "deadline_for_changing_payment_method",
    "返金手続き期限日": "deadline_for_refund_procedure",
    "店舗発行クーポンコード": "store_issued_coupon_code",
    "店舗発行クーポン名": "store_issued_coupon_name",
    "楽天発行クーポンコード": "rakuten_issued_coupon_code",
    "楽天発行クーポン名": "rakuten_issued_coupon_name",
    "警告表示タイプ詳細": "warning_display_type_details",
    "SKU管理番号": "sku_management_number",
    "システム連携用SKU番号": "sku_integration_number",
    "SKU情報": "sku_info",
    "最強配送フラグ": "strongest_delivery_flag",
    "注文当日出荷フラグ": "order_same_day_shipping_flag",
    "置き配フラグ": "delivery_flag",
    "置き配場所": "delivery_location",
}

BULK_COLUMN_COUNT = 155

# Columns that are not text.
TIME_COLUMNS = (
    "order_date_time",
    "order_date",
    "order_time",
    "cancellation_deadline_date",
    "order_confirmation_date",
    "order_confirmed_date",
    "shipment_instruction_date_and_time",
    "shipment_completion_report_date",
    "first_issue_date_and_time_of_receipt",
    "date_and_time_of_last_issue_of_receipt",
    "payment_due_date",
    "deadline_for_changing_payment_method",
    "deadline_for_refund_procedure",
)

NUMBER_COLUMNS = (
    "product_total_price",
    "number_of_credit_card_payments",
    "total_consumption_tax",
    "shipping_total",
    "cash_on_delivery_total",
    "billing_amount",
    "total_amount",
    "amount_of_points_used",
    "total_coupon_usage",
    "store_issued_coupon_usage_amount",
    "amount_of_coupons_issued_by_rakuten",
    "total_amount_of_goods_to_be_sent_to",
    "destination_total_amount",
    "unit_price",
    "quantity",
    "settlement_fee",
    "total_store_charges",
    "excluded_tax_total",
)
