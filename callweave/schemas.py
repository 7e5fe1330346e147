"""Fixed record layouts: column names and types in file order.

Types: i integer, l long, d decimal(32,16), t timestamp without zone, s string.
Numbers that name something (subscribers, networks, sessions) stay strings.
"""

from __future__ import annotations

TYPES = {"i": "int", "l": "bigint", "d": "decimal(32,16)", "t": "timestamp_ntz", "s": "string"}


def _layout(text: str) -> list[tuple[str, str]]:
    return [(name, TYPES[kind]) for name, kind in (x.split(":") for x in text.split())]


# The layouts of the files.
USAGE_LOG = _layout("""
usage_log_id:l rate_plan_id:i currency_id:i user_id:i customer_id:i sim_id:l service_type_id:i service_provider_id:i
sim_service_plan_id:l account_id:i cr_user:i cr_time:t up_user:i up_time:t record_status:i last_session_req_num:i
session_id:s iccid:s msisdn:s imei:s imsi:s service_type_sub_cd:s roaming_mccmnc:s rat_type:s usage_unit:d
usage_start_time:t usage_update_time:t usage_end_time:t cost_amount:d price_amount:d last_grant_quota_unit:d
last_grant_cost_per_unit:d last_grant_quota_cost:d last_grant_price_per_unit:d last_grant_quota_price:d addon_imsi:s
addon_msisdn:s last_grant_shared_bucket_type_ids:s opposite_number:s roaming_destination_id:i act_usage_unit:d
act_cost_amount:d act_price_amount:d last_grant_vt:i last_grant_sim_service_plan_id:l last_grant_request_log_id:l
notes:s additional_sim_id:l additional_roaming_destination_id:i mt_sip_diverted:i original_voice_call_type:s
actual_opposite_number:s pdp_address:s last_grant_sim_service_plan_bucket_id:l
last_grant_sim_service_plan_bucket_start_ref:t last_grant_sim_service_plan_detail_id:l sim_master_id:l rating_group:s
traffic_rat:s last_grant_sim_service_plan_bucket_purchase_seq:s
""")

REQUEST_LOG = _layout("""
request_log_id:l currency_id:l service_type_id:l service_provider_id:l rate_plan_id:l account_id:l sim_id:l
sim_service_plan_id:l customer_id:l user_id:l cr_user:l cr_time:t up_user:l up_time:t record_status:l display_order:l
req_type:s req_time:t session_id:s session_req_num:l iccid:s msisdn:s imei:s imsi:s roaming_mccmnc:s rat_type:s
init_granted_volume:d update_used_volume:d total_used_volume:d exchange_rate:d cost_currency_cd:s
cost_exchange_rate:d price_currency_cd:s price_exchange_rate:d cost_init_granted_money:d cost_update_used_money:d
cost_total_used_money:d price_init_granted_money:d price_update_used_money:d price_total_used_money:d validity_time:l
rating_group:s user_location_info:s apn:s service_context:s charging_characteristic:s sgsn_address:s notes:s
addon_imsi:s addon_msisdn:s service_type_sub_cd:s opposite_number:s roaming_destination_id:l act_update_used_volume:d
act_total_used_volume:d act_price_update_used_money:d act_price_total_used_money:d act_cost_update_used_money:d
act_cost_total_used_money:d additional_sim_id:l additional_roaming_destination_id:l operation_status:s
""")

SERVICE_PLAN = _layout("""
sim_service_plan_id:l service_provider_id:l service_type_id:l currency_id:l account_id:l customer_id:l
provisioning_category_id:l cr_user:l cr_time:t up_user:l up_time:t record_status:i display_order:i service_plan_id:l
service_plan_code:s service_plan_desc:s each_quota:l unit:s volume:d validity_time:l tier0_speed:s tier0_cd:s
imei_lock_enabled:i activate_days:i face_value:d selling_price:d discounted_ratio:d service_end_type:i
reserved_period:i notification_type:i frozen_period:i activation_fee:d top_up_type:i event_message_status:i
effective_days:i service_plan_nature:i service_pool_nature:i stop_data_after_service_end:i bucket_mode:i
bundle_code:s bundle_type:s service_plan_type_id:l sim_id:l sim_master_id:l effective_start:t effective_end:t
plan_condition:i activate_start:t activate_end:t balance:d used_unit:d used_money:d recurring_date:t
""")

SMSC_FIELDS = """
delivery_date submit_date addr_src_digits addr_src_ton addr_src_npi addr_dst_digits addr_dst_ton addr_dst_npi
message_delivery_status origination_type message_type orig_system_id message_id dvl_message_id receipt_local_message_id
nnn_digits imsi corr_id originator_sccp_address mt_service_center_address orig_network_id network_id mproc_notes msg_parts
char_numbers processing_time delivery_delay schedule_delivery_delay delivery_count sms_text reason_for_failure
""".split()

#: The older layout of SMS-centre lines has no submit_date.
SMSC_FIELDS_30 = [f for f in SMSC_FIELDS if f != "submit_date"]
