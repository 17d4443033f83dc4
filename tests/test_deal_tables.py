"""Deal master and margin base on the warehouse-shaped deal tables (FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

from forecourt.plans.deal_master_tables import (
    MASTER_COLUMNS, deal_master_from_tables, margin_base_from_tables,
)

M = "decimal(18,2)"
SCHEMAS = {
    "deal": f"id long, buy_lead_id long, sell_lead_id long, status_id long, deal_hub_id long, created_by_id long, "
            f"created_time timestamp_ntz, delivery_time timestamp_ntz, final_amount {M}, loan_facilitation int, "
            f"self_loan int, cancellation_reason string, target_delivery_time timestamp_ntz, "
            f"deal_cancellation_time timestamp_ntz, car_return_time timestamp_ntz, car_return_reason string, "
            f"insurance_renewal int, insurance_renewal_amount {M}",
    "status": "id long, description string",
    "buy_lead": "id long, category string, contact_details_id long, source_object_type_id long, source_object_id long",
    "lead": "id long, profile_id long, procurement_category string",
    "lead_profile": "id long, make_id long, model_id long, variant_id long, color string, fuel_type string, "
                    "registration_no string, make_year int, mileage int, no_of_owners int",
    "listing": "lead_id long, added_on timestamp_ntz",
    "hub": "id long, display_name string",
    "make": "id long, display_name string",
    "model": "id long, display_name string",
    "variant": "id long, display_name string",
    "user_task": "context_id long, context_type_id int, finished_by_id long",
    "user": "id long, full_name string",
    "contact": "id long, name string, contact_number string",
    "content_type": "id long",
    "visit": "buy_lead_id long, created_by_id long, visit_start_time timestamp_ntz, visit_type_id int, "
             "scheduled_visit int",
    "procured_car": f"lead_id long, price {M}, trading_partner_id long",
    "price_value": f"id long, target_object_id long, target_object_type_id int, label_id int, created_by_id long, "
                   f"value {M}",
    "payment_order": "id long, context_id long, context_type_id int, created_by_id long",
    "payment": f"order_id long, item_id long, created_by_id long, amount {M}, payment_date timestamp_ntz, "
               f"last_updated timestamp_ntz, status string",
    "payment_item": "id long, name string",
    "contract": "id long, trade_object_id long",
    "receivable": f"contract_id long, amount {M}, status string",
    "refund_request": "deal_id long, status string",
    "registration_check": "lead_id long, insurance_validity date",
    "loan_app": "id long, deal_id long, created_at timestamp_ntz, lead_status int, lead_owner_id long",
    "bank_loan_app": f"id long, loan_app_id long, bank_id long, status int, net_disbursed_amount {M}",
    "bank": "id long, display_name string",
    "loan_log": "created_at timestamp_ntz, bank_loan_application_id long, loan_application_id long, "
                "bank_loan_status int, loan_status int",
    "web_article": "id long, url string",
    "platform": "id long, display_name string",
    "ext_request": "id long, listing_id long",
    "ext_listing": "id long, account_id long",
    "platform_account": "id long, platform_id long",
}


def _d(y, m, d, h=10):
    return dt.datetime(y, m, d, h)


def _deal(i, buy, sell, status, created):
    return (i, buy, sell, status, 1, 5, created, None, Decimal("1000.00"), 1, 0, None, None, None, None, None,
            0, None)


def test_deal_master_on_deal_tables(spark):
    rows = {
        "status": [(1, "Delivery Done"), (2, "Token Collected"), (3, "deal requested"), (4, "Deal Cancelled")],
        "deal": [_deal(1, 10, 20, 1, _d(2021, 10, 5)), _deal(2, 10, 21, 2, _d(2021, 10, 20)),
                 _deal(3, 11, 22, 4, _d(2021, 11, 2)), _deal(4, 11, 23, 3, _d(2021, 11, 3))],
        "buy_lead": [(10, "bcm", 100, 246, 500), (11, "bcm", None, 356, None)],
        "lead": [(20, 200, "P"), (21, 201, "P"), (22, 202, "P")],
        "lead_profile": [(200, 1, 1, 1, "red", "PETROL", "REG20", 2018, 1000, 1),
                         (201, 1, 1, 1, "blue", "PETROL", "REG21", 2019, 2000, 2),
                         (202, 1, 1, 1, "grey", "CNG", "REG22", 2020, 3000, 1)],
        # two listings of lead 20 on one local date: one group, twice the receivable
        "listing": [(20, _d(2021, 10, 1, 4)), (20, _d(2021, 10, 1, 9))],
        "hub": [(1, "Hub at Example Mall, City")],
        "make": [(1, "MakeA")], "model": [(1, "ModelB")], "variant": [(1, "VarC")],
        "user": [(5, "Hub Person")],
        "contact": [(100, "Buyer", "99999")],
        "content_type": [(246,), (356,)],
        "visit": [(10, 7, _d(2021, 10, 2), 2, 1), (10, 8, _d(2021, 10, 3), 2, 1), (10, 8, _d(2021, 10, 4), 2, 1)],
        "contract": [(900, 1)],
        "receivable": [(900, Decimal("100.00"), "approved"), (900, Decimal("7.00"), "pending")],
        "loan_app": [(1, 2, _d(2021, 10, 21), 6, None)],
        "bank_loan_app": [(1, 1, 1, 4, Decimal("50000.00"))],
        "bank": [(1, "Bank One")],
        "loan_log": [(_d(2021, 10, 22), 1, 1, 4, 6)],
        "web_article": [(500, "https://site.example/ad")],
    }
    tb = {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()}
    dm = deal_master_from_tables(tb, category="bcm", source_labels=[(187, "Portal")], hub_rules=[("%Example Mall%", "Example Mall")],
                                 url_rules=[("%example%", "Example")])
    assert dm.columns == MASTER_COLUMNS
    got = {r.deal_id: r for r in dm.collect()}
    assert sorted(got) == [1, 2, 3]                       # 4 is an excluded status
    one, two, three = got[1], got[2], got[3]
    # 100 approved x 2 visit rows (distinct creators) x 2 listings on one date
    assert one.payment_amount == Decimal("400.00")
    assert one.car_live_date == dt.date(2021, 10, 1) and one.deal_status == "Delivered"
    assert one.sub_sub_source_f == "Example" and one.deal_hub == "Example Mall"
    assert one.buyer_name is None and one.loan_flow_status is None
    assert two.payment_amount is None and two.loan_flow_status == "Loan Approved"
    assert two.loan_vendor == "Bank One" and two.login_date == dt.date(2021, 10, 22)
    assert three.sub_sub_source_f is None and three.deal_status == "Cancelled"   # no contact -> null source

    refurb = spark.createDataFrame([(20, "REG20", 12.5), (None, "X", 1.0)], "sell_lead_id long, reg_no string, "
                                   "actual_refurb_cost double")
    mb = margin_base_from_tables(dm, refurb)
    assert mb.columns == MASTER_COLUMNS + ["actual_refurb_cost"]
    costs = {r.deal_id: r.actual_refurb_cost for r in mb.collect()}
    assert costs == {1: 12.5, 2: None, 3: None}


def test_fan_outs_and_hidden_keys_by_hand(spark):
    """Several contracts, refund requests and procured cars on one deal; the external-request chain; a hidden
    key (the loan's confirmation date) that splits a deal."""
    rows = {
        "status": [(2, "Token Collected")],
        "deal": [_deal(1, 10, 20, 2, _d(2021, 10, 5)), _deal(2, 11, 21, 2, _d(2021, 10, 6))],
        "buy_lead": [(10, "bcm", 100, 321, 600), (11, "bcm", 100, 187, 1)],
        "contact": [(100, "Buyer", "99999")],
        "content_type": [(321,), (187,)],
        "ext_request": [(600, 70)], "ext_listing": [(70, 80)], "platform_account": [(80, 90)], "platform": [(90, "Autosite")],
        "lead": [(20, 200, "P"), (21, 201, "P")],
        "visit": [(10, 7, _d(2021, 10, 2), 2, 1), (10, 8, _d(2021, 10, 3), 2, 1)],
        "contract": [(900, 1), (901, 1), (902, 2)],
        "receivable": [(900, Decimal("100.00"), "approved"), (900, Decimal("50.00"), "approved"),
                       (901, Decimal("30.00"), "approved"), (901, Decimal("9.00"), "pending"), (902, Decimal("5.00"), "approved")],
        "refund_request": [(1, "open"), (1, "open"), (1, "closed")],
        "procured_car": [(20, Decimal("10.00"), 1), (20, Decimal("20.00"), 2)],
    }
    tb = {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()}
    dm = deal_master_from_tables(tb, category="bcm", source_labels=[(187, "Portal")], hub_rules=[], url_rules=[])
    got = sorted((r.deal_id, r.refund_status or "", r.procurement_price, r.payment_amount, r.sub_sub_source_f) for r in dm.collect())
    # (100 + 50 + 30) x 2 visit rows = 360; the status 'open' stands twice, so its groups hold 720
    ten, twenty = Decimal("10.00"), Decimal("20.00")
    assert got == [(1, "closed", ten, Decimal("360.00"), "Autosite"), (1, "closed", twenty, Decimal("360.00"), "Autosite"),
                   (1, "open", ten, Decimal("720.00"), "Autosite"), (1, "open", twenty, Decimal("720.00"), "Autosite"),
                   (2, "", None, Decimal("5.00"), "Portal")]


def test_two_metadata_rows_double_the_invoice(spark):
    from forecourt.plans.refurb import refurb_cost, refurb_inputs_from_tables

    ts = _d(2021, 10, 5)
    tb = {
        "invoice": spark.createDataFrame([(1, 11, 100, 500, 3, "INV-1", ts, ts, None), (2, 12, 100, 501, 3, "INV-2", ts, ts, None)],
                                         "id long, job_card_id long, car_id long, refurb_car_id long, vendor_id long, "
                                         "invoice_no string, created_at timestamp_ntz, in_date timestamp_ntz, out_date timestamp_ntz"),
        "workshop": spark.createDataFrame([(3, "North Works")], "id long, name string"),
        "invoice_meta": spark.createDataFrame([(1, "A"), (1, "B"), (2, "REFURB"), (2, "SOLD")], "invoice_id long, refurb_category string"),
        "car": spark.createDataFrame([(100, 20, "REG20")], "id long, object_id long, registration_no string"),
        "refurb_car": spark.createDataFrame([(500, 3, "REFURB"), (501, 3, None)], "id long, workshop_id long, refurb_category string"),
        "job_row": spark.createDataFrame([(1, 2, Decimal("10.00"), Decimal("5.00")), (2, 1, Decimal("4.00"), Decimal("0.00"))],
                                         "invoice_id long, part_count int, part_cost decimal(18,2), labour_cost decimal(18,2)"),
        "refurb_user": spark.createDataFrame([(1, "Asha", "Rao")], "id long, first_name string, last_name string"),
        "job_card_user": spark.createDataFrame([(11, 1)], "job_card_id long, user_id long"),
    }
    cost = refurb_cost(*refurb_inputs_from_tables(tb, [])).collect()
    # invoice 1: the car's category holds for both metadata rows, 2 x 25; invoice 2: the category of its own rows, one of
    # them not allowed, 1 x 4; (50 + 4) x 0.82
    assert [(r.sell_lead_id, r.reg_no, r.actual_refurb_cost) for r in cost] == [(20, "REG20", Decimal("0.82") * Decimal("54.00"))]
