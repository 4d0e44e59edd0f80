"""Customer-side collections. Target fields and their source paths."""

CUSTOMERS = """
pk_client                           _id
ts_customer_created_at              createdAt
ts_updated_at
ts_last_session                     lastSessionAt
des_email
des_phone
des_given_name
des_family_name
des_country
txt_address                         address.line1
txt_address_aux                     address.line2
des_locality                        address.locality
cod_zip                             address.zip
des_country_address                 address.country
imp_trial_amount                    trial.amount
imp_trial_discount                  trial.discount
val_trial_total_daily_grams         trial.consolidatedTrial.totalDailyGrams
val_trial_bag_count                 trial.consolidatedTrial.bagCount
des_subscription_status             subscription.status
fk_stripe_customer                  subscription.stripeCustId
cod_card_last4                      subscription.cardLast4
imp_subscription_amount             subscription.amount
val_orders_in_cycle                 subscription.ordersInCycle
val_payment_cycle_weeks             subscription.paymentCycleWeeks
val_total_daily_grams               subscription.totalDailyGrams
val_payment_issues_count            subscription.paymentIssuesCount
des_delivery_company                subscription.deliveryCompany
val_cooling_packs_qty               subscription.coolingPacksQty
pct_computed_discount               subscription.computedDiscountPercent
cod_coupon                          subscription.coupon.code
val_referral_count                  subscription.coupon.referralCount
pct_coupon_discount                 subscription.coupon.discountPercent
val_active_orders_count             subscription.activeOrders                count_always
cod_active_payment                  subscription.activePayment
flg_review_invitation_pending       subscription.isReviewInvitationPending
des_last_review_invitation          subscription.lastReviewInvitation
flg_contacted_after_pause           -
flg_contacted_after_status_update   subscription.isContactedAfterStatusUpdated
flg_updated_on_hubspot              isUpdatedOnHubspot
flg_updated_on_iterable             isUpdatedOnIterable
val_legacy_id
des_acquisition_form_number         -
val_dogs_count                      dogs                                     dog_count
txt_dog_names                       dogs                                     dog_names
val_total_dog_weight:double         dogs                                     dog_weight
val_internal_comments_count         internalComments                         comment_count
ts_last_internal_comment            internalComments                         newest_comment
dropped
fk_trial_sales_agent                trial.salesAgent
des_trial_source                    trial.source
ts_subscription_status_updated      subscription.statusUpdatedAt
fk_subscription_status_updated_by   subscription.statusUpdatedBy
imp_extras_amount                   subscription.extrasAmount
des_payment_method_id               subscription.paymentMethodId
des_payment_method_type             subscription.paymentMethodType
val_paid_orders_count               subscription.paidOrders.count
imp_paid_orders_total               subscription.paidOrders.totalAmount
flg_is_mixed_plan                   subscription.isMixedPlan
ts_first_mixed_plan                 subscription.firstMixedPlanAt
ts_subscription_paused              subscription.pausedAt
des_pause_reason_category           subscription.reasonForPause.category
des_pause_reason_subcategory        subscription.reasonForPause.subcategory
val_paused_count                    subscription.pausedCount
cod_new_cycle_after_order           subscription.newCycleAfterOrder
flg_has_acquisition_data            acquisition                              has_object
"""

LEADS = """
pk_client                           _id
ts_lead_created_at                  createdAt
ts_lead_updated_at
ts_updated_at
ts_trial_delivery_default           defaultDeliveryDate
ts_trial_delivery                   trialDeliveryDate
ts_sales_assigned                   sales.assignedAt
ts_sales_state_updated              sales.stateUpdatedAt
ts_payment_attempted                -
des_email
des_phone
des_given_name
des_family_name
des_country
cod_zip
txt_address                         address.line1
txt_address_aux                     address.line2
des_locality                        address.locality
des_country_address                 address.country
des_sales_status                    sales.status
fk_sales_agent                      sales.assignedTo
val_assignment_count                sales.assignmentCount
val_usage_count
txt_not_interested_reason           sales.notInterestedReason.category
des_not_interested_subcategory      sales.notInterestedReason.subcategory
imp_trial_amount
imp_trial_discount
imp_subscription_amount
imp_subscription_discount
pct_subscription_discount           subscriptionDiscountPercent
val_orders_in_cycle
des_acquisition_source_first        acquisition.first.source
des_acquisition_source_last         acquisition.last.source
flg_mixed_plan                      isMixedPlan
cod_pricing_factor                  subscription.pricingFactor
flg_anonymous                       isAnonymous
flg_contact_by_sms                  contactBySMS
cod_coupon
cod_campaign_id
txt_payment_log_source              -
dropped
fk_stripe_customer_lead             subscription.stripeCustId
ts_initial_payment_attempted        subscription.initialPaymentAttemptedAt
cod_stripe_payment_id               subscription.stripePaymentId
flg_updated_on_iterable             isUpdatedOnIterable
flg_updated_on_hubspot              isUpdatedOnHubspot
val_dogs_count                      dogs                                     dog_count
flg_has_payment_log                 paymentLog                               is_present
"""

USERS_METADATA = """
pk_user_metadata                    _id
fk_customer                         _id
txt_password_hash                   password
cod_verification_token
ts_auth_created_at                  createdAt
ts_auth_updated_at                  updatedAt
ts_last_session_at                  -
val_version                         __v
flg_is_suspended
"""

TABLES = {"customers": CUSTOMERS, "leads": LEADS, "users-metadata": USERS_METADATA}
