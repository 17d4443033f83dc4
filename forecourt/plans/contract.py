"""Output contract of the deal master and the margin base (names and order as published)."""

DEAL_MASTER_COLUMNS = [
    "deal_id", "deal_status", "sell_lead_id", "registration_no", "deal_hub", "make", "model",
    "variant", "color", "make_year", "mileage", "fuel_type", "no_of_owners", "buy_lead_id",
    "sub_sub_source_f", "buyer_name", "buyer_number", "inside_sales", "hub_sales",
    "procurement_price", "listing_price", "sell_price", "paper_transfer_cost", "warranty_cost",
    "insurance_validity_date", "payment_amount", "token_amount", "car_live_date", "token_date", "edd1",
    "loan_interest", "loan_vendor", "loan_flow_status", "login_date", "approved_rejected_date",
    "net_disbursed_amount", "self_loan_interest", "refund_status", "delivery_time",
    "deal_cancellation_time", "cancellation_reason", "car_return_time", "car_return_reason",
]
MARGIN_COLUMNS = DEAL_MASTER_COLUMNS + ["actual_refurb_cost"]
