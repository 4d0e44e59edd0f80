"""Payment-side collections. Target fields and their source paths."""

PAYMENTS = """
pk_payment                          _id
fk_customer                         custId
val_linked_orders_count             orders                                   count
txt_linked_order_ids                orders                                   join
ts_payment_date                     date
ts_payment_created                  createdAt
ts_payment_updated                  updatedAt
ts_delivery_date                    -
des_payment_status                  status
des_country
val_failed_attempts_count
des_error_code
imp_payment_amount                  amount
imp_invoice_amount
imp_discount_amount                 discount
pct_discount_percent
imp_extras_amount
imp_shipping_amount
imp_additional_delivery_amount
imp_paid_additional_delivery_amount -
imp_delivery_fee                    -
fk_stripe_customer                  stripeCustId
cod_stripe_payment_id
cod_stripe_charge_id
cod_stripe_invoice_id               -
des_payment_method_type
cod_card_last4
pct_subscription_discount_applied   discountsApplied.subscriptionDiscountPercent
val_referral_count_applied          discountsApplied.referralCount
flg_is_trial
flg_is_first_renewal
flg_is_rescheduled
flg_is_additional
flg_is_legacy
flg_renewal_email_sent              isRenewalEmailSent
val_line_items_count                lineItems                                line_count
val_total_product_qty               lineItems                                line_qty
val_total_product_grams             lineItems                                line_grams
imp_line_items_total_amount         lineItems                                line_amount
txt_products_list                   lineItems                                line_products
val_refunds_count                   refunds                                  refund_count
imp_total_refund_amount             refunds                                  refund_amount
des_latest_refund_status            refunds                                  latest_refund status
des_latest_refund_reason            refunds                                  latest_refund_category
cod_pricing_factor
cod_coupon
cod_invoice_code                    -
dropped
cod_applied_coupon                  discountsApplied.appliedCoupon
pct_trial_discount_applied          discountsApplied.trialDiscountPercent
"""

COUPONS = """
pk_coupon                           _id
cod_coupon                          _id
ts_coupon_created_at                createdAt
ts_updated_at                       -
des_coupon_type                     type
des_country
flg_is_not_applicable
"""

TABLES = {"payments": PAYMENTS, "coupons": COUPONS}
