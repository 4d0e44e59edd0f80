"""Archived collections. Target fields and their source paths."""

LEADS_ARCHIVE = """
pk_lead_archive                     _id
fk_lead                             _id
ts_lead_created_at                  createdAt
ts_lead_updated_at
ts_updated_at
ts_trial_delivery_default           defaultDeliveryDate
ts_trial_delivery                   trialDeliveryDate
des_email
des_phone
des_given_name
des_family_name
des_name                            -
des_country
cod_zip
imp_trial_amount
imp_trial_discount
imp_subscription_amount
imp_subscription_discount
pct_subscription_discount           subscriptionDiscountPercent
val_orders_in_cycle
val_usage_count
val_mailing_stage
cod_coupon
cod_campaign_id
des_email_deliverability            -
des_sales_status                    sales                                    member_text status
ts_sales_assigned_at                sales                                    member_time assignedAt
val_sales_reassignment_count        sales                                    member_integer reassignmentCount
val_sales_comments_count            sales                                    member_count comments
val_dogs_count                      dogs                                     dog_count
txt_dog_names                       dogs                                     dog_names
val_total_dog_weight:double         dogs                                     dog_weight
flg_mixed_plan                      isMixedPlan
flg_anonymous                       isAnonymous
flg_contact_by_sms                  contactBySMS
flg_updated_on_hubspot              isUpdatedOnHubspot
flg_updated_on_iterable             isUpdatedOnIterable
flg_trial_info_email_pending        -
flg_has_purchase_intent             -
flg_has_gift                        -
flg_notification_sent               -
flg_unserved_region                 -
flg_has_acquisition_data            acquisition                              is_present
flg_has_shared_info                 sharedInfo                               is_present
flg_has_subscription_data           subscription                             is_present
flg_has_tracking_data               -
flg_has_address                     address                                  is_present
flg_has_payment_log                 paymentLog                               is_present
flg_has_appointment_request         -
val_version                         __v
dropped
flg_has_email_deliverability        emailDeliverability                      is_present
"""

ORDERS_ARCHIVE = """
pk_order                            _id
fk_customer                         custId
cod_payment
des_full_name
ts_order_created                    createdAt
ts_order_updated                    updatedAt
ts_delivery_date
ts_initial_date
des_order_status                    status
des_country
txt_address_line1                   address.line1
txt_address_line2                   address.line2
des_locality                        address.locality
cod_zip                             address.zip
des_address_country                 address.country
des_email
des_phone
flg_is_trial
flg_is_secondary
flg_is_last_in_cycle
flg_is_additional
flg_is_first_renewal
flg_is_rescheduled
flg_is_express_delivery
flg_has_additional_ice_bags
flg_address_is_locked
flg_is_legacy
flg_was_moved
flg_was_moved_back
flg_was_reset
flg_notification_sent
val_package_bag_count               package.bagCount
val_total_package_count             package.totalPackageCount
val_total_weight_kg:double          package.totalWeightKg
des_delivery_company                delivery.deliveryCompany
flg_delivery_has_issue              delivery.hasIssue
val_total_bags                      content.bagCount
val_chicken_portions                content.menu.chicken
val_turkey_portions                 content.menu.turkey
des_locked_by
des_updated_by                      __updatedBy
val_delta_days
val_version                         __v
"""

PAYMENTS_ARCHIVE = """
pk_payment                          _id
fk_customer                         custId
val_linked_orders_count             orders                                   count
txt_linked_order_ids                orders                                   join
ts_payment_date                     date
ts_payment_created                  createdAt
ts_payment_updated                  updatedAt
ts_initial_date
des_payment_status                  status
des_country
val_failed_attempts_count
flg_first_attempt_failed
imp_payment_amount                  amount
imp_invoice_amount
imp_discount_amount                 discount
pct_discount_percent
imp_extras_amount
imp_shipping_amount
fk_stripe_customer                  stripeCustId
cod_stripe_payment_id
cod_stripe_invoice_id
cod_stripe_charge_id
val_line_items_count                lineItems                                line_count
val_total_product_qty               lineItems                                line_qty
val_total_product_grams             lineItems                                line_grams
imp_line_items_total_amount         lineItems                                line_amount
flg_is_trial
flg_is_first_renewal
flg_is_additional
flg_is_legacy
flg_was_moved
cod_coupon
cod_invoice_code
val_version                         __v
"""

CHANGELOGS = """
pk_changelog                        _id
ts_created_at
ts_updated_at
des_entity_type                     _id                                      entity_type
fk_entity_id                        _id
val_total_changes                   logs                                     change_count
val_system_changes                  logs                                     changes_by SYSTEM
val_api_changes                     logs                                     changes_by apikey01
val_user_changes                    logs                                     changes_by_others SYSTEM apikey01
ts_last_change                      logs                                     latest_change createdAt
des_last_change_actor               logs                                     latest_change updatedBy
txt_last_change_key                 logs                                     latest_change key
txt_top_changed_fields              logs                                     top_keys
val_unique_fields_changed           logs                                     distinct_keys
"""

TABLES = {
    "leads-archive": LEADS_ARCHIVE,
    "orders-archive": ORDERS_ARCHIVE,
    "payments-archive": PAYMENTS_ARCHIVE,
    "changelogs": CHANGELOGS,
}
