"""Order-side collections. Target fields and their source paths."""

ORDERS = """
pk_order                            _id
fk_customer                         custId
cod_payment
des_full_name
ts_order_created                    createdAt
ts_order_updated                    updatedAt
ts_delivery_date
ts_tentative_delivery_date
ts_delivery_issue_date              -
ts_delivery_issue_added             -
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
flg_is_for_robots
flg_is_additional
flg_is_first_renewal
flg_is_mixed_plan
flg_is_rescheduled
flg_is_express_delivery
flg_has_christmas_extra             -
flg_has_additional_ice_bags
flg_is_agency_pickup
flg_address_is_locked
flg_is_legacy                       -
flg_updated_while_processing        -
flg_notification_sent
val_cooling_packs_qty
val_package_bag_count               package.bagCount
val_total_package_count             package.totalPackageCount
val_total_weight_kg:double          package.totalWeightKg
val_package_handlers_count          package                                  member_count handlers
flg_package_has_issue               package.hasIssue
des_package_issue_category          package.issueType
val_delta_days
des_additional_order_reason
des_locked_by
val_eligible_promotional_extras_qty -
des_delivery_company                delivery.deliveryCompany
flg_delivery_has_issue              delivery.hasIssue
des_delivery_issue_category         delivery.issueType
val_total_bags                      content                                  bag_total
val_chicken_bags                    content                                  bag_meat chicken
val_salmon_bags                     content                                  bag_meat salmon
val_beef_bags                       content                                  bag_meat beef
val_turkey_bags                     content                                  bag_meat turkey
val_bag_size_100_count              content                                  bag_size 100
val_bag_size_300_count              content                                  bag_size 300
val_bag_size_400_count              content                                  bag_size 400
val_bag_size_500_count              content                                  bag_size 500
dropped
cod_tracking_url                    delivery.trackingUrl
cod_parcel_id                       delivery.parcelId
des_label_group                     delivery.labelGroup
val_extras_count                    content                                  member_count extras
val_additional_extras_count         content                                  member_count additionalExtras
"""

DELIVERIES = """
pk_delivery                         _id
fk_customer                         custId
des_full_name
cod_parcel_id
ts_delivery_created                 createdAt
ts_delivery_updated                 updatedAt
ts_delivery_date_scheduled          deliveryDate
ts_delivery_date_actual             date
ts_issue_solved_at                  issue.solvedAt
des_delivery_status                 status
des_country
des_delivery_company
des_label_group
txt_address_line1                   address.line1
txt_address_line2                   address.line2
des_locality                        address.locality
cod_zip                             address.zip
des_address_country                 address.country
flg_is_for_robots
flg_cust_label_printed              isPrinted.cust
flg_internal_label_printed          isPrinted.internal
flg_has_issue                       issue.hasIssue
txt_issue_reason                    issue.reason
flg_has_label_data                  labelData                                has_text
val_label_data_length               labelData                                text_length
flg_has_internal_label_data         internalLabelData                        has_text
val_internal_label_data_length      internalLabelData                        text_length
"""

PACKAGES = """
pk_package                          _id
fk_handler                          handlerId
ts_created_at
ts_updated_at
ts_used_at
val_bag_count
val_daily_grams
flg_is_trial
flg_is_used                         usedAt                                   is_present
"""

TABLES = {"orders": ORDERS, "deliveries": DELIVERIES, "packages": PACKAGES}
