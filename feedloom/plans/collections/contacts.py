"""Contact and retention collections. Target fields and their source paths."""

CONTACTS_LOGS = """
pk_contact_log                      _id
ts_created_at
ts_updated_at
val_logs_count                      logs                                     log_count
val_total_call_duration             logs                                     log_duration
val_call_count                      logs                                     log_kind call
val_email_count                     logs                                     log_kind email
val_sms_count                       logs                                     log_kind sms
ts_last_contact                     logs                                     last_log startedAt
des_last_contact_type               logs                                     last_log eventType
des_last_contact_direction          logs                                     last_log direction
des_last_contact_status             logs                                     last_log status
val_last_contact_duration           logs                                     last_log duration
fk_last_contact_agent               logs                                     last_log agent
dropped
fk_lead                             _id
"""

RETENTIONS = """
pk_retention                        _id
fk_customer                         cust
ts_created_at
ts_updated_at
ts_assigned_at
ts_paused_at
ts_reactivated_at
ts_contacted_at
ts_appointment_at
des_retention_status                status
val_reassignment_count
val_contact_channels_count          contactChannels                          count
txt_contact_channels                contactChannels                          join
des_pause_reason_category           reasonForPause                           member_text category
des_pause_reason_subcategory        reasonForPause                           member_text subcategory
val_comeback_probability:double     reasonForPause                           member_real comebackProbab
fk_sys_user
cod_zendesk_ticket                  zendeskTicketId
flg_reactivated_by_agent            isReactivatedByAgent
flg_retention_due_to_agent          isRetentionDueToAgent
"""

NOTIFICATIONS = """
pk_notification                     _id
fk_recipient
des_recipient_model
fk_document                         docId
des_document_model                  docModel
des_notification_type
txt_data                            -
ts_created_at
ts_updated_at
ts_read_at
flg_is_read                         readAt                                   is_present
"""

APPOINTMENTS = """
pk_appointment                      _id
fk_sys_user                         sysUserId
fk_lead                             leadId
ts_created_at
ts_updated_at
ts_starts_at
txt_notes
"""

ENGAGEMENT_HISTORIES = """
pk_engagement                       _id
ts_created_at
ts_updated_at
flg_survey_engaged                  cust.tests.customerDataSurvey.isEngaged
des_survey_value                    cust.tests.customerDataSurvey.value
flg_has_daily_grams_recommendations cust.recommendationData.dailyGrams       has_items
flg_has_menu_recommendations        cust.recommendationData.menus            has_items
"""

TABLES = {
    "contacts-logs": CONTACTS_LOGS,
    "retentions": RETENTIONS,
    "notifications": NOTIFICATIONS,
    "appointments": APPOINTMENTS,
    "engagement-histories": ENGAGEMENT_HISTORIES,
}
