"""Back-office collections. Target fields and their source paths."""

GEOCONTEXT = """
pk_geocontext                       _id
val_ip_range_start:string           fromIp
val_ip_range_end:string             toIp
des_country
"""

INVALID_PHONES = """
pk_phone                            _id
des_phone_number                    _id
des_country
des_created_by
ts_created_at
"""

SYSUSERS = """
pk_sysuser                          _id
des_given_name
des_family_name
des_email
des_country
ts_created_at
ts_updated_at
ts_last_session_at
txt_roles                           roles                                    join
des_role
txt_manages_countries               managesCountries                         join
flg_is_suspended
flg_is_sales_available              sales.isAvailable
flg_has_sales_tracking              sales                                    is_present
flg_has_retentions                  retentions                               is_present
"""

STATS = """
pk_stat                             _id
ts_created_at
ts_updated_at
val_year
val_month
des_stat_type                       _id                                      stat_type
fk_agent_or_handler                 _id                                      stat_agent
des_stat_country                    country
val_total_assigned_leads            totals.assignedLeads.total
val_total_appointments              totals.appointments
val_total_sales                     totals.sales
val_total_not_answered              totals.notAnswered
val_total_not_interested            totals.notInterested
val_total_orders                    totals.orderCount
val_total_packages                  totals.packageCount
pct_conversion_rate                 conversionRate
pct_retention_rate                  retentionRate
imp_average_sales                   averageSales
"""

SYSINFO = """
pk_config                           _id
ts_updated_at
des_config_type                     _id
flg_has_cron_settings               cron                                     is_present
flg_has_email_settings              transactionalEmails                      is_present
flg_has_sales_settings              sales                                    is_present
flg_has_robot_settings              robots                                   is_present
flg_has_stock_levels                levels                                   is_present
flg_has_agent_lists                 _id                                      has_agent_list
val_chicken_stock                   levels.chicken.300
val_salmon_stock                    levels.salmon.300
val_beef_stock                      levels.beef.300
val_turkey_stock                    levels.turkey.300
"""

TABLES = {
    "geocontext": GEOCONTEXT,
    "invalid-phones": INVALID_PHONES,
    "sysusers": SYSUSERS,
    "stats": STATS,
    "sysinfo": SYSINFO,
}
